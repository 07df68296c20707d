from __future__ import annotations

import zlib

import numpy as np
import pytest

from strataflow.llm import token_store
from strataflow.llm.queries import tokenizer_file
from strataflow.session import new_path

ROWS = [
    (5, "Hello, World!  it's 12.5 éÀ ß"), (3, None), (3, ""), (None, "no id"), (None, "no id"),
    (7, "x" * 5000 + " tail"), (8, "end <|endoftext|> next"), (8, "a<|StartOfText|>b <|startoftext|>."), (9, "\x01 mark a\x01b <|endoftext|> İstanbul ΣΑΣ é 日本語　漢字"), (5, "same id"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "h") for i, t in ROWS], "doc_id long, text string, part int, _hash string")


def plain(text):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_file())
    return [*own.encode(text or "", add_special_tokens=False).ids, 1]


def test_round_trip(spark, docs):
    got = token_store.write_and_read(docs, tokenizer_file()).collect()
    want = sorted((len(plain(t)), zlib.crc32(np.array(plain(t), dtype="<u4").tobytes())) for _, t in ROWS)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 3, 3, 5, 5, 7, 8, 8, 9]
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))


def test_short_access_and_blocks(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * (i % 40)) for i in range(500)], "doc_id long, text string")
    path = new_path(spark, "store")
    token_store.write_tokens(docs, path, tokenizer_path=tokenizer_file(), block_bytes=500, dict_bytes=1024)
    assert spark.read.parquet(f"{path}/blocks").count() > 10
    got = {r.doc_id: r.ids for r in token_store.read_ids(spark, path, [17, 18, 499, 9999]).collect()}
    assert got == {i: plain(f"word {i} " * (i % 40)) for i in (17, 18, 499)}
    row = spark.read.parquet(f"{path}/blocks").first()
    with pytest.raises(ValueError):
        token_store.open_block(bytes(row.payload), b"0" * 32, b"other")
    spread = [r.start for r in token_store.digests(spark, path).orderBy("doc_id").collect()]
    assert spread == list(np.cumsum([0] + [len(plain(f"word {i} " * (i % 40))) for i in range(499)]))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.write_and_read(none, tokenizer_file()).count() == 0


def test_words_remembered_anew(spark):
    texts = [f"alpha{k} beta, gamma. é. x.. 9. don't, a,. ,a . it's. ß, q.," for k in range(300)]
    token_store.tokenizer(tokenizer_file())
    raw = token_store.encode_texts(texts, tokenizer_file(), 2, 1, 50)
    assert [np.frombuffer(r, dtype="<u2").tolist() for r in raw] == [plain(t) for t in texts]


def test_tokenizers_that_do_not_drop_white_space():
    from pathlib import Path

    from tokenizers import Tokenizer

    folder = Path(tokenizer_file()).parent
    texts = ["Two  words\n\n and Tab\t.", "<|endoftext|> é", "", None, "x" * 300]
    seen = 0
    for file in sorted(folder.rglob("*.json")):
        try:
            own = Tokenizer.from_file(str(file))
        except Exception:
            continue
        seen += 1
        raw = token_store.encode_texts(texts, str(file), 4, 1, 100)
        want = [[*own.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        assert [np.frombuffer(r, dtype="<u4").tolist() for r in raw] == want, file.name
    assert seen
    token_store.tokenizer(tokenizer_file())


def test_words_of_known_letters_go_to_the_model(monkeypatch):
    own, called = token_store.tokenizer(tokenizer_file()), []

    class Watched:
        def __getattr__(self, name):
            called.extend([name] if name.startswith("encode") else [])
            return getattr(own, name)

    monkeypatch.setattr(token_store, "tokenizer", lambda path: Watched())
    monkeypatch.setattr(token_store, "_WORDS", {})
    texts = ["Éöü Straße, it's we'll 'x'sy %'s 12.5% größer%%%|= ΣΑΣ жЁ", f"one {'a' * 256} Élan."]
    raw = token_store.encode_texts(texts, tokenizer_file(), 2, 1, 1000)
    assert [np.frombuffer(r, dtype="<u2").tolist() for r in raw] == [plain(t) for t in texts]
    assert not called  # neither the normalizer nor the pattern of the tokenizer ran


def test_words_of_all_kinds(monkeypatch):
    import random

    monkeypatch.setattr(token_store, "_WORDS", {})
    pick = random.Random(6)
    own = token_store.tokenizer(tokenizer_file())
    letters, symbols = token_store.spellings(own)
    assert set("aéßжω") < set(letters) and not set("İ1'̣̈") & set(letters) and len(symbols) == 32
    kinds = [
        "abst'lvermd.,%ÉéßS9ſKİ", "aeọ́̈ͅ'z", "각가각'a1", "\x01\x1c\x7f\x85\xa0　'sa٣²Ⅷ",
        "".join([*letters, *symbols]), [chr(c) for c in range(0x21, 0x3100)],
    ]
    texts = [" ".join("".join(pick.choices(kind, k=pick.randint(1, 9))) for _ in range(200)) for kind in kinds for _ in range(20)]
    texts += ["é" * 128 + " " + "é" * 129 + ". " + "漢" * 500 + " " + "é" * 129 + "."]
    want = [[*own.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for width, kind in ((2, "<u2"), (4, "<u4")):
        raw = token_store.encode_texts(texts, tokenizer_file(), width, 1, 3000)
        assert [np.frombuffer(r, dtype=kind).tolist() for r in raw] == want
    assert len(token_store._WORDS) == 1 and all(len(w) <= 3000 for w, _ in token_store._WORDS.values())


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_store, "_WORDS", {})
    raw = token_store.encode_texts(["some words"], tokenizer_file(), 2, 1, 100)
    assert token_store._WORDS
    token_store.forget_words()
    assert not token_store._WORDS and token_store.encode_texts(["some words"], tokenizer_file(), 2, 1, 100) == raw
