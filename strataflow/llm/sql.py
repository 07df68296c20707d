"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

ROW_KEY = """md5(concat_ws(chr(31), coalesce(strlen(doc_id::VARCHAR)::VARCHAR, '-'), coalesce(doc_id::VARCHAR, ''),
    coalesce(strlen(text)::VARCHAR, '-'), coalesce(text, '')))"""

#: Time by share x of the demand, for the three schedules.
FADE = """CASE WHEN x * 2.0 <= 1.25 THEN (sqrt(9.0 - 4.0 * (x * 2.0)) - 3.0) / -2.0
    ELSE 0.5 + (sqrt(greatest(4.0 - 4.0 * (x * 2.0 - 1.25), 0.0)) - 2.0) / -2.0 END"""
RISE = """CASE WHEN x * 2.0 <= 0.75 THEN (sqrt(1.0 + 4.0 * (x * 2.0)) - 1.0) / 2.0
    ELSE 0.5 + (sqrt(4.0 + 4.0 * (x * 2.0 - 0.75)) - 2.0) / 2.0 END"""


def _position(x: str) -> str:
    fade, rise = (f"({s})".replace("x *", f"{x} *") for s in (FADE, RISE))
    return f"least(greatest(CASE rank % 3 WHEN 0 THEN {fade} WHEN 1 THEN {x} ELSE {rise} END, 0.0), 1.0)"


def mixing_rows(docs: str) -> str:
    """CTEs that end in ``mixed``: one row per row of ``docs``."""
    return f"""
sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, {ROW_KEY} AS key
  FROM {docs}),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1 AS rank FROM sums),
weighted AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS lim FROM ranked),
stepped AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM weighted)
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM weighted),
level AS (SELECT max(lev) AS lev FROM (
  SELECT lev FROM stepped WHERE weight * lev <= lim ORDER BY lim / weight, rank LIMIT 1)),
targets AS (
  SELECT source, rank, source_size, least(lim, weight * (SELECT lev FROM level)) AS target FROM weighted),
placed AS (
  SELECT s.*, t.rank, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *,
    CASE WHEN size = 0 THEN CASE WHEN target > 0 THEN {_position('least(middle / target, 1.0)')} ELSE 0.0 END
         WHEN middle < target THEN {_position('(middle / target)')} END AS p1,
    CASE WHEN size > 0 AND middle + source_size < target
         THEN {_position('((middle + source_size) / target)')} END AS p2
  FROM placed)"""


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def hit_rows(docs: str) -> str:
    """CTEs that end in ``hit``: one row per row of ``docs``, with its benchmark hits."""
    pattern = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    split = f"coalesce(regexp_extract_all({LOWER.format('text')}, {pattern}), [])"
    return f"""
dw AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, {split} AS w FROM {docs}),
iw AS (SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, {split} AS w FROM benchmark) WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS s FROM iw)),
grams AS (
  SELECT rid, k, s, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM dw, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
occurs AS (SELECT rid, s, grams.k, item_id FROM grams JOIN win USING (k, g)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM occurs) GROUP BY rid),
listed AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM occurs GROUP BY rid),
hit AS (
  SELECT dw.*, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(ids, '') AS ids
  FROM dw LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid))"""


def terms(text: str) -> str:
    return f"coalesce(regexp_extract_all({LOWER.format(text)}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), [])"


ORACLE: dict[str, str] = {
    "op7_decontamination": f"""WITH {hit_rows('documents')}
SELECT doc_id, len(w)::BIGINT AS n_words, n_hit, n_items, sha256(ids) AS items_sha256, n_hit > 0 AS contaminated FROM hit""",
    "op9_mixing": f"""WITH {mixing_rows('documents')}
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * ((p1 IS NOT NULL)::INT + (p2 IS NOT NULL)::INT))::BIGINT AS taken,
       p1::DOUBLE AS first_position, p2::DOUBLE AS second_position
FROM mixed""",
    "op8_nearest": """WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM near)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op11_lexical": f"""WITH
dt AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, {terms('text')} AS w FROM documents),
it AS (SELECT item_id, row_number() OVER () AS n, {terms('text')} AS w FROM benchmark),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM dt WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, n, t FROM (SELECT item_id, n, unnest(w) AS t FROM it)),
tf AS (
  SELECT rid, doc_id, len, t, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, len(w)::BIGINT AS len, unnest(w) AS t FROM dt)
  WHERE t IN (SELECT t FROM wanted) GROUP BY ALL),
weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM tf, whole GROUP BY t),
scored AS (
  SELECT n, item_id, rid, doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN tf USING (t) JOIN weights USING (t), whole GROUP BY n, item_id, rid, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_collocations": f"""WITH
pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex({LOWER.format('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS MATERIALIZED (
  SELECT lang, len(g) AS k, g, count(*)::BIGINT AS f
  FROM (SELECT lang, w[s:s + k - 1] AS g
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s
              FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k))
  GROUP BY lang, g),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM grams WHERE f >= 100),
inside AS (
  SELECT DISTINCT lang, o.g[s:s + k2 - 1] AS g, f
  FROM (SELECT lang, g, f, k, k2, unnest(range(1, k - k2 + 2)) AS s
        FROM often, (SELECT unnest([2, 3, 4]) AS k2) WHERE k > k2) o),
around AS (SELECT lang, g, max(f) AS most FROM inside GROUP BY lang, g),
cuts AS (
  SELECT lang, g, f AS a, unnest(range(1, k)) AS c FROM often LEFT JOIN around USING (lang, g)
  WHERE k >= 2 AND (most IS NULL OR 100 * most < 100 * f)),
parts AS (
  SELECT cuts.*, n, x.f AS l, y.f AS r, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN totals USING (lang)
  JOIN often x ON x.lang = cuts.lang AND x.g = cuts.g[1:c]
  JOIN often y ON y.lang = cuts.lang AND y.g = cuts.g[c + 1:]),
least AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ') COLLATE "C") AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op13_suffixes": """WITH
d AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS LAST) AS o, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT o, s, md5(substr(h, 2 * s + 1, 200)) AS g
  FROM (SELECT o, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
later AS (
  SELECT o, s FROM (SELECT o, s, row_number() OVER (PARTITION BY g ORDER BY o, s) AS nth FROM strings) WHERE nth > 1),
fresh AS (SELECT *, s > coalesce(lag(s) OVER (PARTITION BY o ORDER BY s) + 100, -1) AS new FROM later),
spans AS (
  SELECT o, min(s) AS a, max(s) + 100 AS z
  FROM (SELECT o, s, sum(new::INT) OVER (PARTITION BY o ORDER BY s) AS span FROM fresh) GROUP BY o, span),
between AS (SELECT *, coalesce(lag(z) OVER (PARTITION BY o ORDER BY a), 0) AS upto FROM spans),
sums AS (
  SELECT o, sum(z - a)::BIGINT AS gone, count(*)::BIGINT AS n_spans, max(z) AS last,
         string_agg(substr(h, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS kept
  FROM between JOIN d USING (o) GROUP BY o)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN sums USING (o)""",
}
