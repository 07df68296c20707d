from __future__ import annotations

import re

from strataflow.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, size=10):
    words, hit, found = split(text), set(), set()
    for item_id, item in items:
        own = split(item)
        k = min(size, len(own))
        for s in range(len(own) - k + 1 if own else 0):
            for at in range(len(words) - k + 1):
                if words[at : at + k] == own[s : s + k]:
                    hit.update(range(at, at + k))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short, item!"), (10, "short item"),
    (3, None), (4, "..."), (1, "a repeated id with other words that is long enough to matter here"), (None, "nameless item"),
    (5, "the the the the the the the the the the the"),
]
DOCS = [
    (1, "x ONE, two three-four five six seven eight nine ten y"), (1, "a short item; short item"), (2, None), (2, ""),
    (None, "nameless   item"), (None, "nameless   item"), (3, "one two three four five six seven eight nine"),
    (4, "the " * 25), (5, "two three four five six seven eight nine ten eleven twelve"), (6, "ten"), (7, "Élan short\x00item é"),
    (8, "one two three four five six seven eight nine ten eleven twelve " * 3),
]


def frames(spark, docs=DOCS, items=ITEMS):
    d = spark.createDataFrame([(i, t, "k", 5) for i, t in docs], "doc_id long, text string, text_hash string, n long")
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def test_against_brute_force(spark):
    d, items = frames(spark)
    for block in (16 << 20, 300):  # one block, several blocks
        got = decontaminate.scan(d, items, block_bytes=block).collect()
        have = sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r.item_ids)) for r in got)
        assert have == sorted((i or -1, *brute(t, ITEMS)) for i, t in DOCS)


def test_drop_hit(spark):
    d, items = frames(spark)
    left = decontaminate.drop_hit(d, items)
    assert left.columns == d.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 2, 3, 6]


def test_empty_tables(spark):
    d, items = frames(spark)
    assert decontaminate.scan(d.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.scan(d, items.limit(0)).collect()} == {0}


def test_plan_is_native_and_keeps_documents_in_place(spark, capsys):
    d, items = frames(spark)
    decontaminate.scan(d, items).explain("formatted")
    text = capsys.readouterr().out
    assert "Python" not in text and "Pandas" not in text


def test_words_are_split_and_not_extracted(spark, capsys):
    """The same words as a search for each, at a twentieth of its time."""
    texts = ["", None, " ", "a", "-a", "a-", "--A--b\x00Ç\u2003𝒳9_z|", "\x7f", "É1É", "a\nb\r\nc\x1f", "日本 語", "[x]^`{y}~\u0080"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = rows.select("i", decontaminate._words().alias("w")).collect()
    assert {r.i: list(r.w) for r in got} == {i: split(t) for i, t in enumerate(texts)}
    d, items = frames(spark)
    d.select(decontaminate._words()).explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
