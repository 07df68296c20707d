"""Quality of texts by positive-unlabelled learning with a non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas, on_path
from strataflow.session import stage

#: Hashed word shapes, after the measures.
SHAPES = 64
MEASURES = (
    "log_chars", "log_words", "upper", "lower", "digit", "space", "other_letter", "mark", "control",
    "top_mark", "mean_word", "long_words", "distinct_words", "top_word", "same_next", "same_next_pair",
    "distinct_pairs", "lone_marks", "marked_words", "upper_words", "line_words", "distinct_lines", "ends",
)
WIDTH = len(MEASURES) + SHAPES


def _letter_kinds():
    """For each code point below 65536: 0 other mark, 1 upper, 2 lower, 3 digit, 4 space, 5 other letter, 6 control."""
    import unicodedata

    import numpy as np

    kinds = np.zeros(65536, dtype=np.uint8)
    by = {"Lu": 1, "Lt": 1, "Ll": 2, "Nd": 3, "Nl": 3, "No": 3, "Zs": 4, "Zl": 4, "Zp": 4, "Lo": 5, "Lm": 5, "Mn": 5, "Mc": 5, "Cc": 6, "Cf": 6}
    for c in range(65536):
        kinds[c] = by.get(unicodedata.category(chr(c)), 0)
    kinds[[9, 10, 11, 12, 13]] = 4
    return kinds


_KINDS: list = []


def measures(text: str | None) -> list[float]:
    """The measures of one whole text, all finite; a text without words has only its lengths."""
    import numpy as np

    if not _KINDS:
        _KINDS.append(_letter_kinds())
    out = np.zeros(WIDTH)
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    n = len(points)
    out[0] = np.log1p(n)
    if not n:
        return out.tolist()
    kinds = _KINDS[0][np.minimum(points, 65535)]
    share = np.bincount(kinds, minlength=7) / n
    out[2:9] = share[[1, 2, 3, 4, 5, 0, 6]]
    marks = points[kinds == 0]
    if len(marks):
        out[9] = np.bincount(marks[marks < 65536] if (marks < 65536).any() else [0]).max() / n
    words = text.split()
    m = len(words)
    out[1] = np.log1p(m)
    if not m:
        return out.tolist()
    ids = dict.fromkeys(words)
    for k, w in enumerate(ids):
        ids[w] = k
    row = np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=m)
    out[10] = np.log1p(share[[1, 2, 3, 5, 0]].sum() * n / m)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=m)
    out[11] = (lengths > 20).mean()
    out[12] = len(ids) / m
    out[13] = np.bincount(row).max() / m
    if m > 1:
        same = row[1:] == row[:-1]
        out[14] = same.mean()
        pairs = row[1:] * len(ids) + row[:-1]
        out[16] = len(np.unique(pairs)) / len(pairs)
    if m > 3:
        out[15] = (row[2:] == row[:-2]).mean()
    # Words told by their ends: cheap marks of markup, shouting and tables.
    shapes: dict[str, int] = {}
    lone = marked = upper = 0
    for w in ids:
        last = w[-1]
        if not last.isalnum():
            if len(w) == 1:
                lone += 1
            elif len(w) > 2 and not w[-2].isalnum():
                marked += 1
        if len(w) > 1 and w.isupper():
            upper += 1
        shape = f"{'A' if w[0].isupper() else 'a' if w[0].isalpha() else w[0]}{'' if last.isalnum() else w[-3:] if not w[-2:-1].isalnum() else last}"
        shapes[shape] = shapes.get(shape, 0) + 1
    counts = np.bincount(row)
    lone_all = sum(int(counts[k]) for w, k in ids.items() if len(w) == 1 and not w.isalnum())
    out[17], out[18], out[19] = lone_all / m, marked / len(ids), upper / len(ids)
    lines = text.split("\n")
    out[20] = np.log1p(m / len(lines))
    out[21] = len(set(lines)) / len(lines)
    out[22] = np.count_nonzero(np.isin(points, (33, 46, 63))) / m
    import zlib

    for shape, k in shapes.items():
        out[len(MEASURES) + zlib.crc32(shape.encode("utf-8", "surrogatepass")) % SHAPES] += k / len(ids)
    return out.tolist()


@dataclass
class Model:
    """A linear score on standardised measures; ``prior`` is the estimated share of positives."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    bias: float
    prior: float
    known: bool = True

    def score(self, rows):
        """Probability of being positive for rows of measures; 0.5 if nothing could be learnt."""
        import numpy as np

        if not self.known:
            return np.full(len(rows), 0.5)
        x = np.clip((np.asarray(rows) - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(x @ np.asarray(self.weights) + self.bias, -500, 500)))


def estimate_prior(positive, unlabelled, delta: float = 0.1) -> float:
    """The share of positives among the unlabelled, from scores on rows not fitted on.

    Above a threshold the unlabelled hold at least ``prior`` times the positives'
    share, so the least ratio of the two bounds the prior; the threshold is the
    one whose ratio, with its confidence bound, is least.
    """
    import numpy as np

    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.unique(p)
    above_p = 1 - np.searchsorted(p, cuts, side="left") / len(p)
    above_u = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    slack = np.sqrt(np.log(4 / delta) / (2 * len(u))) + np.sqrt(np.log(4 / delta) / (2 * len(p)))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def _descend(x, trusted, prior: float, steps: int, rate: float, decay: float):
    """Weights that minimise the non-negative unbiased risk by full-batch Adam steps.

    Risk of the negatives is what the unlabelled rows have beyond ``prior`` times
    the positives; where that falls below 0, the step undoes it instead.
    """
    import numpy as np

    p, u = x[trusted], x[~trusted]
    w, m, v = np.zeros(x.shape[1] + 1), 0.0, 0.0

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def grad(rows, factor):
        return np.append(rows.T @ factor, factor.sum()) / len(rows)

    for t in range(1, steps + 1):
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        below = grad(u, sigmoid(zu)) - prior * grad(p, sigmoid(zp))
        if negative >= 0:
            g = prior * grad(p, -sigmoid(-zp)) + below
        else:
            g = -below
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit(positive, unlabelled, *, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """A model from measures of trusted positives and of unlabelled texts."""
    import numpy as np

    if len(positive) < 2 or len(unlabelled) < 2:
        return Model([0.0] * WIDTH, [1.0] * WIDTH, [0.0] * WIDTH, 0.0, 0.5, known=False)
    rows = np.vstack([positive, unlabelled]).astype(float)
    trusted = np.arange(len(rows)) < len(positive)
    mean, scale = rows[~trusted].mean(axis=0), rows[~trusted].std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = np.clip((rows - mean) / scale, -8, 8)
    # The prior comes from rows that the first model has not seen.
    half = np.arange(len(rows)) % 2 == 0
    if min(np.count_nonzero(trusted & half), np.count_nonzero(~trusted & half), np.count_nonzero(trusted & ~half)) == 0:
        half[:] = True
        rest = half
    else:
        rest = ~half
    first = _descend(x[half], trusted[half], 0.5, steps, rate, decay)
    z = x @ first[:-1] + first[-1]
    prior = estimate_prior(z[rest & trusted], z[rest & ~trusted])
    w = _descend(x, trusted, prior, steps, rate, decay)
    return Model(mean.tolist(), scale.tolist(), w[:-1].tolist(), float(w[-1]), prior)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the measures of each row's whole text as ``measures``."""
    columns = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields if f.name != "text")

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[keep].assign(measures=[measures(t) for t in b["text"]])

    return map_pandas(columns, step, f"{schema}, measures array<double>")


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, max_rows: int = 8000, **settings) -> Model:
    """Fit on documents for which ``learn`` holds.

    Trusted positives are those with label quality 1; the unlabelled are
    documents with or without a label, which is not looked at.  At most
    ``max_rows`` of each, picked by a hash of id and text, are fitted on.
    """
    import numpy as np

    own = docs.where(learn).select("doc_id", "text")
    trusted = labels.where("quality = 1").select("doc_id").distinct()

    def sample(ids: DataFrame | None, seed: int):
        # Ids and hashes are joined and sorted; only the picked rows' texts are read again.
        hashed = own.withColumn("h", F.xxhash64("doc_id", "text", F.lit(seed)))
        named = hashed.select("doc_id", "h")
        named = named if ids is None else named.join(ids, "doc_id", "left_semi")
        picked = stage(named.select("h").orderBy("h").limit(max_rows).distinct(), "picked_rows")
        rows = measured(hashed.join(F.broadcast(picked), "h", "left_semi"), ["h"])  # max_rows at most
        return np.array([r.measures for r in rows.orderBy("h").limit(max_rows).collect()]).reshape(-1, WIDTH)

    return fit(sample(trusted, 1), sample(None, 2), **settings)


def score(docs: DataFrame, model: Model, keep: list[str], *, threshold: float = 0.3) -> DataFrame:
    """``keep``, score and predicted of every row of ``docs``.

    NULL and empty texts are scored by their lengths of 0.  Repeated rows get
    equal scores; an empty table gives no rows; a model without samples gives
    every row 0.5.  Only the text enters the score.
    """
    columns = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields if f.name != "text")

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = model.score([measures(t) for t in b["text"]]) if len(b) else []
            yield b[keep].assign(score=found)

    scored = map_pandas(columns, step, f"{schema}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, *, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model does not reject; same columns, in one pass.

    Rows stay in Arrow batches; only the texts of some hundred rows at a time
    become Python strings.
    """

    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                texts = some.column(some.schema.get_field_index("text")).to_pylist()
                kept = np.asarray(model.score([measures(t) for t in texts])) >= threshold
                yield some.filter(pa.array(kept))

    on_path(docs.sparkSession)
    return docs.mapInArrow(step, docs.schema)
