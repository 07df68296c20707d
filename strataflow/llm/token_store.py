"""Token ids in compressed blocks that share one dictionary and open at any document.

A store is a folder of three Parquet tables:

``blocks``      part, block, first_id, last_id, first, n_tokens, payload
``dictionary``  dict_sha256, width, n_samples, content
``parts``       part, start: ids in all parts before

Parts and the blocks in them follow ascending doc_id, NULL first.  A payload is

    magic "TOK1" | width of an id in bytes (1 byte) | SHA-256 of the dictionary (32 bytes)
    | number of documents (4 bytes) | for each: offset of its frame (8 bytes), number of ids (4 bytes)
    | the frames, each one document's little-endian ids in zstandard with the dictionary

all numbers little-endian.  A document is read by opening its block's index and
one frame; nothing else is decompressed.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas, release_memory, releasing
from strataflow.session import new_path, stage

MAGIC = b"TOK1"
HEAD = "<4sB32sI"
ENTRY = "<QI"
#: The only split for which texts are known to be rows of words: no part holds white space.
WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes above which a word is encoded each time it occurs.
LONG = 256

_TOKENIZER: dict[str, object] = {}
_WORDS: dict[tuple[str, int], tuple[Words, list[bytes] | None]] = {}


def tokenizer(path: str):
    """The tokenizer of a file, once per process."""
    if path not in _TOKENIZER:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        _TOKENIZER.clear()
        _WORDS.clear()
        _TOKENIZER[path] = own
    return _TOKENIZER[path]


def _steps(file: dict, part: str, inner: str) -> list[dict]:
    found = file.get(part) or {}
    return found.get(inner, []) if found.get("type") == "Sequence" else [found]


def whole_texts_only(own) -> list[bytes] | None:
    """What makes a text go to the tokenizer whole: bytes that its lower-cased form holds.

    None if every text must, since the file does not fold letter case and drop
    all white space before anything else: then no text is a row of words.
    """
    file = json.loads(own.to_str())
    normal, split = _steps(file, "normalizer", "normalizers"), _steps(file, "pre_tokenizer", "pretokenizers")
    folds = [n.get("type") for n in normal] == ["NFC", "Replace", "Lowercase"] and normal[1]["pattern"] == {"Regex": r"\s+"}
    parts = split[0].get("type") == "Split" and split[0]["behavior"] == "Removed" and split[0]["invert"]
    if not (folds and parts and split[0]["pattern"] == {"Regex": WORD_PARTS}) or file.get("post_processor") or file.get("truncation"):
        return None
    return [t["content"].lower().encode() for t in file["added_tokens"]]


def spellings(own) -> tuple[dict[str, str], dict[str, str]]:
    """Letters and ASCII symbols with the form in which the tokenizer's model gets each.

    Both are asked of the tokenizer: a letter is what makes one part with the
    letters around it and is spelled there as alone.  No two characters of these
    ranges compose.  None at all if texts are no rows of words for the tokenizer,
    or parts are not simply spelled byte by byte.
    """
    if whole_texts_only(own) is None:
        return {}, {}
    rest = _steps(json.loads(own.to_str()), "pre_tokenizer", "pretokenizers")[1:]
    if [(r.get("type"), r.get("add_prefix_space"), r.get("use_regex")) for r in rest] != [("ByteLevel", False, False)]:
        return {}, {}

    def parts(text: str) -> list[str]:
        return [p for p, _ in own.pre_tokenizer.pre_tokenize_str(own.normalizer.normalize_str(text))]

    def like(some: Iterator[str], beside: str) -> dict[str, str]:
        alone = [(c, parts(c)) for c in some]
        return {c: p[0] for c, p in alone if len(p) == 1 and parts(beside + c + beside) == [beside + p[0] + beside]}

    letters = like(map(chr, (*range(0x61, 0x7B), *range(0x80, 0x900), *range(0x1E00, 0x2000))), "a")
    return letters, like((chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()), "%")


class Words(dict):
    """Words, lower-cased in ASCII, with their serialized ids; each is encoded when first asked for.

    The tokenizer splits a word into the parts of ``WORD_PARTS`` and its model
    encodes each by itself, so a word of known letters, digits and symbols is
    split here and only parts not met before go to the model: that spares the
    tokenizer's normalizer and pattern, which cost far more.  Any other word goes
    to the tokenizer.  At most ``max_words`` words and parts are remembered, then
    the memory starts anew; words above ``LONG`` bytes are not remembered.
    """

    def __init__(self, own, width: int):
        super().__init__()
        self.own, self.model, self.width, self.max_words = own, own.model, width, 0
        letters, symbols = spellings(own)
        self.spell = {ord(c): s for c, s in (letters | symbols).items()}
        self.known = self.parts = None
        if letters and symbols:
            a, s = ("".join(map(re.escape, x)) for x in (letters, symbols))
            self.known = re.compile(f"[{a}0-9{s}]+").fullmatch
            self.parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{a}]+|[0-9]|[{s}]+").findall

    def keep(self, word: bytes, raw: bytes) -> bytes:
        if len(self) >= self.max_words:
            self.clear()
        self[word] = raw
        return raw

    def part(self, text: str) -> bytes:
        word = text.encode()
        raw = self.get(word)
        if raw is None:
            ids = [t.id for t in self.model.tokenize(text.translate(self.spell))]
            raw = self.keep(word, struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids))
        return raw

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if len(word) > LONG:
            return self.whole(text)
        if self.known is None or not self.known(text):
            return self.keep(word, self.whole(text))
        parts = self.parts(text)
        return self.part(text) if len(parts) == 1 else self.keep(word, b"".join(map(self.part, parts)))

    def whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype=f"<u{self.width}").tobytes()


def encode_texts(texts: list[str | None], path: str, width: int, end_id: int, max_words: int) -> list[bytes]:
    """The serialized ids of whole texts, each with the end id.

    The tokenizer drops white space and never joins across it, and it folds
    letter case, so a text's ids are those of its space-separated words in turn.
    At most ``max_words`` words are remembered.  A text that spells an added
    token goes to the tokenizer whole, as all texts do if the file is of another
    kind.
    """
    own, end = tokenizer(path), end_id.to_bytes(width, "little")
    if (path, width) not in _WORDS:
        _WORDS.clear()
        _WORDS[path, width] = Words(own, width), whole_texts_only(own)
    words, added = _WORDS[path, width]
    words.max_words = max_words
    get, out = words.__getitem__, []
    for text in texts:
        folded = (text or "").encode().lower()
        if added is None or any(a in folded for a in added):
            out.append(words.whole(text or "") + end)
        else:
            out.append(b"".join(map(get, folded.split())) + end)
    return out


def forget_words() -> None:
    """Give back what the words that this Python worker has met take up."""
    _WORDS.clear()
    release_memory()


def _widths(path: str, end_id: int) -> int:
    return 2 if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def _dictionary(tokens: DataFrame, max_samples: int, sample_bytes: int, dict_bytes: int) -> tuple[bytes, int]:
    """A dictionary trained on the first bytes of ``max_samples`` documents, picked by hash."""
    import zstandard

    keyed = tokens.withColumn("h", F.xxhash64("_hash", F.lit(7)))
    last = keyed.select("h").orderBy("h").limit(max_samples).agg(F.max("h")).first()[0]
    # Only the picked rows' ids are read and sent; equal texts are one sample.
    picked = keyed.where(F.col("h") <= F.lit(last)).groupBy("h").agg(
        F.min(F.substring("ids", 1, sample_bytes)).alias("s")
    )
    samples = [bytes(r.s) for r in picked.orderBy("h").collect() if r.s] if last is not None else []
    content = b""
    if sum(map(len, samples)) >= 16 * dict_bytes and len(samples) >= 100:
        try:
            content = zstandard.train_dictionary(dict_bytes, samples).as_bytes()
        except zstandard.ZstdError:
            content = b""
    if not content:  # too little for training: the samples themselves
        content = b"".join(samples)[-dict_bytes:]
    return content, len(samples)


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    tokenizer_path: str,
    end_id: int = 1,
    block_bytes: int = 4 << 20,
    level: int = 3,
    max_samples: int = 2000,
    sample_bytes: int = 16 << 10,
    dict_bytes: int = 64 << 10,
    max_words: int = 1_000_000,
) -> None:
    """Encode every whole text, append ``end_id``, and write a store to ``path``.

    The dictionary is fitted on a bounded sample (``max_samples`` documents of
    which ``sample_bytes`` each); every document is written whole.  Documents
    are range-sorted by doc_id, then by a hash of the text, so an id that many
    rows share is spread over tasks.  NULL and empty texts are one end id.
    NULL ids come first.  An empty table makes a store without blocks.  Columns
    other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    width = _widths(tokenizer_path, end_id)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = encode_texts(b["text"].tolist(), tokenizer_path, width, end_id, max_words)
            yield pd.DataFrame({"doc_id": b["doc_id"], "_hash": b["_hash"], "ids": ids})

    columns = docs.select("doc_id", F.xxhash64("text").alias("_hash"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    tokens = stage(map_pandas(columns, releasing(encode), f"doc_id {id_type}, _hash long, ids binary"), "token_ids")
    content, n_samples = _dictionary(tokens, max_samples, sample_bytes, dict_bytes)
    sha = hashlib.sha256(content).digest()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        forget_words()  # all texts are encoded by now
        shared = zstandard.ZstdCompressionDict(content) if content else None
        press = zstandard.ZstdCompressor(level=level, dict_data=shared)
        part = TaskContext.get().partitionId()
        frames: list[bytes] = []
        counts: list[int] = []
        ids: list = []
        held = first = block = 0

        def close() -> pd.DataFrame:
            at, index = struct.calcsize(HEAD) + struct.calcsize(ENTRY) * len(frames), []
            for f, n in zip(frames, counts):
                index.append(struct.pack(ENTRY, at, n))
                at += len(f)
            payload = b"".join([struct.pack(HEAD, MAGIC, width, sha, len(frames)), *index, *frames])
            return pd.DataFrame(
                {
                    "part": [part], "block": [block], "ids": [ids],
                    "first": [first], "n_tokens": [sum(counts)], "payload": [payload],
                }
            )

        for b in batches:
            for doc_id, raw in zip(b["doc_id"], b["ids"]):
                frames.append(press.compress(raw))
                counts.append(len(raw) // width)
                ids.append(None if pd.isna(doc_id) else doc_id)
                held += len(frames[-1])
                if held >= block_bytes:
                    yield close()
                    first, block = first + sum(counts), block + 1
                    frames, counts, ids, held = [], [], [], 0
        if frames:
            yield close()

    order = [F.asc_nulls_first("doc_id"), "_hash"]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    schema = f"part int, block int, ids array<{id_type}>, first long, n_tokens long, payload binary"
    ends = {"first_id": F.array_min("ids"), "last_id": F.array_max("ids")}
    map_pandas(ordered, releasing(pack), schema).withColumns(ends).write.parquet(f"{path}/blocks")
    spark.createDataFrame(
        [(sha.hex(), width, n_samples, bytearray(content))], "dict_sha256 string, width int, n_samples int, content binary"
    ).write.parquet(f"{path}/dictionary")
    written = spark.read.parquet(f"{path}/blocks")
    # One row per part: as many as tasks wrote the blocks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    written.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("start")
    ).write.parquet(f"{path}/parts")


def open_block(payload: bytes, sha: bytes, content: bytes):
    """A function that reads document ``k`` of a block, and the number of documents."""
    import numpy as np
    import zstandard

    magic, width, named, n = struct.unpack_from(HEAD, payload, 0)
    if magic != MAGIC or named != sha or hashlib.sha256(content).digest() != sha:
        raise ValueError("the block was written with another format or dictionary")
    shared = zstandard.ZstdCompressionDict(content) if content else None
    unpress = zstandard.ZstdDecompressor(dict_data=shared)
    begin, step = struct.calcsize(HEAD), struct.calcsize(ENTRY)

    def read(k: int):
        if not 0 <= k < n:
            raise IndexError(k)
        at, count = struct.unpack_from(ENTRY, payload, begin + step * k)
        end = struct.unpack_from(ENTRY, payload, begin + step * (k + 1))[0] if k + 1 < n else len(payload)
        raw = unpress.decompress(payload[at:end], max_output_size=count * width)
        return np.frombuffer(raw, dtype=f"<u{width}")

    return read, n


def _shared(spark: SparkSession, path: str) -> tuple[bytes, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return bytes.fromhex(row.dict_sha256), bytes(row.content)


def read_ids(spark: SparkSession, path: str, doc_ids: list) -> DataFrame:
    """doc_id and ids of some documents: only blocks whose range of ids holds one are opened."""
    sha, content = _shared(spark, path)
    wanted = set(doc_ids)
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    hit = F.lit(False)
    for d in wanted:
        hit = hit | ((F.col("first_id") <= F.lit(d)) & (F.col("last_id") >= F.lit(d)))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, payload in zip(b["ids"], b["payload"]):
                read, _ = open_block(payload, sha, content)
                found = [(d, read(k).tolist()) for k, d in enumerate(ids) if d in wanted]
                yield pd.DataFrame(found, columns=["doc_id", "ids"])

    chosen = blocks.where(hit).select("ids", "payload")
    return map_pandas(chosen, pick, f"doc_id {id_type}, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from a store."""
    sha, content = _shared(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    kind = "double" if id_type in ("float", "double") else id_type

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for b in batches:
            for ids, payload, start in zip(b["ids"], b["payload"], b["start"]):
                read, n = open_block(payload, sha, content)
                rows = []
                for k in range(n):
                    got = read(k)
                    rows.append((ids[k], start, len(got), zlib.crc32(got.astype("<u4").tobytes())))
                    start += len(got)
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                if id_type in ("bigint", "int"):
                    out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    placed = blocks.join(spark.read.parquet(f"{path}/parts"), "part").select(
        "ids", "payload", (F.col("start") + F.col("first")).alias("start")
    )
    return map_pandas(placed, unpack, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer_path: str, **settings) -> DataFrame:
    """Write a store to the shared folder and return the digests read back from it."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path=tokenizer_path, **settings)
    return digests(docs.sparkSession, path)
