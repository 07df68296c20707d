"""Secrets in texts: fixed patterns, and Markov models of random and ordinary strings."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas

#: Fixed patterns, in the order of their kinds; what follows each is the least length of its match or value.
ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
VALUE_LENGTH, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "markov")
#: Characters of the models; 0 is the edge of a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
RUN = r"[A-Za-z0-9+/_.=-]{%d,}"
SYMBOLS = len(ALPHABET) + 1


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) of the fixed patterns, by start and kind.

    The matches of a kind are leftmost and do not overlap; one that is too short
    is dropped after it has been matched.
    """
    out = []
    if "=" in text or ":" in text:
        for m in re.finditer(ASSIGN, text):
            if m.end(2) - m.start(2) >= VALUE_LENGTH:
                out.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in re.finditer(ACCESS, text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                out.append((m.start(), 1, m.end(), m.start(), m.end()))
    for m in re.finditer(HEX, text):
        out.append((m.start(), 2, m.end(), m.start(), m.end()))
    out.sort()
    return out


def _runs(text: str, spans: list, length: int) -> Iterator[re.Match]:
    """Runs of model characters that touch no span."""
    at, ends = 0, sorted((s[0], s[2]) for s in spans)
    for m in re.finditer(RUN % length, text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        near = itertools.takewhile(lambda x: x[0] < m.end(), itertools.islice(ends, at, None))
        if not any(e > m.start() for _, e in near):
            yield m


def _codes(strings: list[str]):
    """Symbol numbers of the strings in a row, each after an edge, and a last edge."""
    import numpy as np

    table = np.zeros(256, dtype=np.int64)
    table[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(1, SYMBOLS)
    return table[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii", "replace"), dtype=np.uint8)]


def count_pairs(strings: list[str]):
    """How often each symbol follows each other one."""
    import numpy as np

    c = _codes(strings)
    return np.bincount(c[:-1] * SYMBOLS + c[1:], minlength=SYMBOLS * SYMBOLS)


def drawn_strings(n: int = 4000, length: int = 32, seed: int = 11) -> list[str]:
    """Labelled samples of random strings as key generators make them, the same in every run."""
    import numpy as np

    rng = np.random.default_rng(seed)
    kinds = [ALPHABET[:62], ALPHABET[:64], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:62] + "_-"]
    return ["".join(rng.choice(list(kinds[k % len(kinds)]), length)) for k in range(n)]


def train(docs: DataFrame, *, least: int = 8) -> dict:
    """Log probabilities of a symbol after another, for random and for ordinary strings.

    Labelled samples: values of the fixed patterns ("found") and strings drawn
    by chance ("drawn") are random, all other runs of ``least`` or more model
    characters in the documents are ordinary.  All documents are counted; each
    task returns one row of counts for each label, so what reaches the driver
    does not grow with the texts.  Texts without samples give flat models.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        sums = {label: np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64) for label in ("found", "ordinary")}
        for b in batches:
            found, ordinary, held = [], [], 0
            for t in b["text"]:
                if not t:
                    continue
                spans = base_spans(t)
                found += [t[s[3] : s[4]] for s in spans]
                ordinary += [m.group() for m in _runs(t, spans, least)]
                held += len(t)
                if held > 4_000_000:
                    sums["found"] += count_pairs(found)
                    sums["ordinary"] += count_pairs(ordinary)
                    found, ordinary, held = [], [], 0
            sums["found"] += count_pairs(found)
            sums["ordinary"] += count_pairs(ordinary)
        for label, counts in sums.items():
            k = np.flatnonzero(counts)
            yield pd.DataFrame({"label": label, "pair": k, "n": counts[k]})

    counted = map_pandas(docs.select("text"), step, "label string, pair long, n long")
    rows = counted.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()  # 2 x 69 x 69 at most
    return model_of({label: [(r.pair, r.n) for r in rows if r.label == label] for label in ("found", "ordinary")})


def model_of(counts: dict[str, list[tuple[int, int]]], drawn: list[str] | None = None) -> dict:
    import numpy as np

    tables = {}
    for label in ("found", "ordinary", "drawn"):
        n = np.zeros(SYMBOLS * SYMBOLS)
        if label == "drawn":
            n += count_pairs(drawn_strings() if drawn is None else drawn)
        for pair, times in counts.get(label, ()):
            n[pair] = times
        n[0] = 0  # an edge after an edge is where nothing stood
        n = n.reshape(SYMBOLS, SYMBOLS) + 0.1
        tables[label] = np.log(n / n.sum(axis=1, keepdims=True)).ravel()
    return tables


def log_ratio(strings: list[str], model: dict):
    """Log likelihood of each string as random, by the better of two models, over that as ordinary."""
    import numpy as np

    c = _codes(strings)
    pairs = c[:-1] * SYMBOLS + c[1:]
    starts = np.flatnonzero(c[:-1] == 0)
    as_found, as_drawn, as_ordinary = (
        np.add.reduceat(model[k][pairs], starts) for k in ("found", "drawn", "ordinary")
    )
    return np.logaddexp(as_found, as_drawn) - np.log(2.0) - as_ordinary


def find(docs: DataFrame, model: dict, *, least: int = 16, threshold: float = 12.0) -> DataFrame:
    """doc_id, counts by kind, and the spans of every whole text.

    ``base_spans`` and ``spans`` are kind:start:end in code points, end
    exclusive, by start and then kind.  ``spans`` adds runs of ``least`` or more
    characters that touch no base span and are likelier random than ordinary by
    ``threshold`` nats.  NULL and empty texts have no spans.  Repeated rows are
    scanned like others; an empty table gives no rows; other columns are ignored.
    """
    schema = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for b in batches:
            rows = []
            for t in b["text"]:
                t = t or ""
                base = base_spans(t)
                runs = list(_runs(t, base, least))
                more = []
                if runs:
                    odd = np.flatnonzero(log_ratio([m.group() for m in runs], model) >= threshold)
                    more = [(runs[k].start(), 3, runs[k].end()) for k in odd]
                named = [f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in base]
                every = sorted([s[:3] for s in base] + more)
                rows.append(
                    [sum(s[1] == k for s in base) for k in range(3)]
                    + [len(more), named, [f"{KINDS[k]}:{s}:{e}" for s, k, e in every]]
                )
            names = ["n_assign", "n_access", "n_hex", "n_markov", "base_spans", "spans"]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    columns = "n_assign long, n_access long, n_hex long, n_markov long, base_spans array<string>, spans array<string>"
    return map_pandas(docs.select("doc_id", "text"), step, f"doc_id {schema}, {columns}")
