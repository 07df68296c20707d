from __future__ import annotations

import json
import random

import pytest

from strataflow.llm import tool_calls

SCHEMA = "conv_id long, turn long, role string, text string, seq int, mid string, json string"
WEATHER = {
    "type": "object", "required": ["city"], "additionalProperties": False,
    "properties": {"city": {"type": "string"}, "days": {"type": "integer", "minimum": 1}, "unit": {"enum": ["c", "f"]}},
}


def call(*calls, content=""):
    return json.dumps({"content": content, "tool_calls": list(calls)})


def one(id, arguments, name="weather", **more):
    return {"id": id, "name": name, "arguments": arguments, **more}


def result(id, content="ok"):
    return json.dumps({"tool_call_id": id, "content": content})


def run(spark, rows, schemas=None):
    df = spark.createDataFrame([(*r, 1, "m", "j") for r in rows], SCHEMA)
    got = tool_calls.format_messages(df, schemas).collect()
    return sorted(got, key=lambda r: (-1 if r.conv_id is None else r.conv_id, r.seq))


def test_links_order_and_schemas(spark):
    rows = [
        (1, 0, "system", json.dumps({"tools": [{"name": "weather", "parameters": WEATHER}]})),
        (1, 1, "tool", result("a", "sunny")),
        (1, 2, "assistant", call(one("a", {"days": 2.0, "city": "Köln"}), one("b", '{"town":"x"}'), one("c", "no json"), one("d", {}, "other"))),
        (1, 3, "tool", result("b")),
        (1, 4, "tool", result("zz")),
        (2, 0, "assistant", call(one("a", {"city": "x"}))),
    ]
    got = [r for r in run(spark, rows) if r.conv_id == 1]
    assert [(r.turn, r.seq) for r in got] == [(0, 1), (2, 2), (1, 3), (3, 4), (4, 5)]
    calls = got[1]
    assert (calls.n_calls, calls.n_linked, calls.n_invalid) == (4, 2, 3)
    assert [r.linked for r in got] == [False, False, True, True, False]
    own = json.loads(calls.json)["tool_calls"]
    assert own[0]["arguments"] == {"city": "Köln", "days": 2} and own[0]["errors"] == []
    assert own[1]["errors"] == ["$.city: missing", "$.town: not allowed"]
    assert own[2]["errors"] == ["$: no JSON"] and own[3]["errors"] == ["$: no schema"]
    assert '"arguments":{"city":"Köln","days":2}' in calls.json
    given = [r for r in run(spark, rows, {"weather": WEATHER}) if r.conv_id == 2]
    assert given[0].n_invalid == 0


def test_chains_cycles_and_repeated_ids(spark):
    rows = [
        (1, 0, "assistant", call(one("c3", {}, after=["c2"]))),
        (1, 1, "assistant", call(one("c2", {}, after=["c1"]))),
        (1, 2, "assistant", call(one("c1", {}))),
        (1, 3, "tool", result("c1")), (1, 4, "tool", result("c2")), (1, 5, "tool", result("c3")),
        (2, 0, "assistant", call(one("x", {}, after=["y"]))), (2, 1, "assistant", call(one("y", {}, after=["x"]))),
        (2, 2, "tool", result("x")), (2, 3, "tool", result("y")),
        (3, 0, "assistant", call(one("r", {}))), (3, 1, "tool", result("r", "first")),
        (3, 2, "assistant", call(one("r", {}))), (3, 3, "tool", result("r", "second")), (3, 4, "tool", result("r", "third")),
    ]
    got = run(spark, rows)
    first = [r.turn for r in got if r.conv_id == 1]
    place = {t: k for k, t in enumerate(first)}
    assert place[2] < place[3] < place[1] < place[4] < place[0] < place[5]
    assert [r.turn for r in got if r.conv_id == 2] == [0, 1, 2, 3]
    assert any(r.cyclic for r in got if r.conv_id == 2) and not any(r.cyclic for r in got if r.conv_id != 2)
    assert [r.linked for r in got if r.conv_id == 3 and r.role == "tool"] == [True, True, False]


def test_after_takes_the_latest_earlier_use(spark):
    rows = [
        (1, 0, "assistant", call(one("c1", {}))), (1, 1, "tool", result("c1")),
        (1, 3, "assistant", call(one("d", {}, after=["c1"]))), (1, 4, "tool", result("d")),
        (1, 5, "assistant", call(one("c1", {}, after=["d"]))), (1, 6, "tool", result("c1")),
        (1, 7, "assistant", call(one("e", {}, after=["c1"]))), (1, 8, "tool", result("e")),
    ]
    got = run(spark, rows[::-1]) + run(spark, rows)
    assert [r.turn for r in got] == [0, 1, 3, 4, 5, 6, 7, 8] * 2 and not any(r.cyclic for r in got)


def test_only_messages_in_a_circle_keep_their_turns(spark):
    rows = [
        (None, 0, "assistant", call(one("x", {}, after=["y"]))), (None, 1, "assistant", call(one("y", {}, after=["x"]))),
        (None, 2, "tool", result("x")), (None, 3, "tool", result("y")),
        (None, 4, "tool", result("a")), (None, 5, "assistant", call(one("a", {}))),
        (None, 6, "assistant", call(one("b", {}, after=["z"]))), (None, 7, "assistant", call(one("z", {}, after=["x"]))),
        (None, 8, "tool", result("z")), (None, 9, "tool", result("b")),
    ]
    rows += [(None, 1000 - k, "assistant", call(one(f"k{k}", {}, after=[f"k{k - 1}"]))) for k in range(300)]
    rows += [(None, 2000 - k, "tool", result(f"k{k}")) for k in range(300)]
    got = run(spark, rows)
    turns = [r.turn for r in got]
    assert turns[:10] == [0, 1, 2, 3, 5, 4, 7, 8, 6, 9]
    assert [r.turn for r in got if r.cyclic] == [0, 1, 2, 3]
    place = {t: k for k, t in enumerate(turns)}
    chain = [t for k in range(300) for t in (1000 - k, 2000 - k)]
    assert [place[t] for t in chain] == sorted(place[t] for t in chain)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, ""), (1, None, "user", "{not json"), (None, 0, "user", "[1]"), (None, 0, "user", "[1]"),
        (1, 2, "user", "  é \"quoted\"\n"), (1, 2, "user", "  é \"quoted\"\n"), (1, 3, "assistant", '{"tool_calls": [null, {"id": null}]}'),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert [r.seq for r in got] == [1, 2, 1, 2, 3, 4, 5, 6]
    texts = [json.loads(r.json)["content"] for r in got]
    assert texts == ["[1]", "[1]", "{not json", "", "", '  é "quoted"\n', '  é "quoted"\n', ""]
    assert run(spark, []) == []


def test_canonical_json_and_schema_rules():
    assert tool_calls.canonical({"b": 1.0, "a": [float("nan"), 0.5, "é"]}) == '{"a":[null,0.5,"é"],"b":1}'
    assert tool_calls.errors([1, "x"], {"type": "array", "items": {"type": "integer"}}) == ["$[1]: not integer"]
    assert tool_calls.errors(True, {"type": "integer"}) and not tool_calls.errors(3.0, {"type": "integer"})
    assert tool_calls.errors(5, {"maximum": 4, "enum": [1]}) == ["$: not in enum", "$: above maximum"]


MALFORMED = [
    {"minimum": "3"}, {"minimum": None}, {"maximum": True}, {"enum": 5}, {"type": 5}, {"type": [{}]}, {"type": "strng"}, {"type": []},
    {"required": 5}, {"required": [["a"]]}, {"properties": [1]}, {"additionalProperties": "no"},
]


@pytest.mark.parametrize("schema", MALFORMED)
def test_malformed_keywords_are_one_error(schema):
    key = next(iter(schema))
    assert tool_calls.errors({"a": 1}, schema) == [f"$: schema: {key}"]
    nested = {"properties": {"x": schema}, "required": ["y"]}
    assert tool_calls.errors({"x": 3, "y": 1}, nested) == [f"$.x: schema: {key}"]


def test_values_that_are_no_schema():
    assert tool_calls.errors(1, 7) == ["$: schema: no object"]
    assert tool_calls.errors({"a": 1}, {"properties": {"a": None}}) == ["$.a: schema: no object"]
    assert tool_calls.errors([1], {"items": 4}) == ["$: schema: items"]
    assert tool_calls.errors(True, {"enum": [1]}) == ["$: not in enum"] and tool_calls.errors(1.0, {"enum": [1]}) == []


def test_deep_values(spark):
    depth = 5000
    value, schema = 1, {"type": "string"}
    for _ in range(depth):
        value, schema = [value], {"items": schema}
    assert tool_calls.canonical(value) == "[" * depth + "1" + "]" * depth
    found = tool_calls.errors(value, schema)
    assert found == ["$" + "[0]" * depth + ": not string"]
    deep = "[" * depth + "]" * depth
    rows = [(1, 0, "system", json.dumps({"tools": [{"name": "weather", "parameters": {"minimum": "3", "type": 5}}]}))]
    rows += [(1, 1, "assistant", '{"tool_calls": [{"id": "a", "name": "weather", "arguments": %s}]}' % json.dumps(deep)), (1, 2, "tool", result("a"))]
    got = run(spark, rows)
    assert [r.n_invalid for r in got] == [0, 1, 0]


def test_canonical_matches_the_plain_form():
    rng = random.Random(3)

    def value(depth):
        kind = rng.randrange(8 if depth else 5)
        if kind < 5:
            return rng.choice([None, True, 3, -2.5, 4.0, "é\n", "", "\u2028"])
        return [value(depth - 1) for _ in range(3)] if kind < 6 else {rng.choice("abcdef"): value(depth - 1) for _ in range(3)}

    for _ in range(200):
        v = value(4)
        text = tool_calls.canonical(v)
        assert json.loads(text) == v
        whole = json.loads(json.dumps(v), parse_float=lambda x: int(float(x)) if float(x).is_integer() else float(x))
        assert text == json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def brute_order(rows):
    """Turn and depth of each message, by repeating the rule until nothing moves; calls are numbered over all."""
    parsed = [json.loads(t) for _, t in rows]
    called = {c["id"]: m for m, p in enumerate(parsed) for c in p.get("tool_calls", [])}
    answered = {p["tool_call_id"]: m for m, p in enumerate(parsed) if "tool_call_id" in p}
    needs = {m: set() for m in range(len(rows))}
    for i in called.keys() & answered.keys():
        needs[answered[i]].add(called[i])
    for m, p in enumerate(parsed):
        for c in p.get("tool_calls", []):
            needs[m] |= {answered[i] for i in c.get("after", []) if i in called and i in answered}
    at = {m: (turn, 0) for m, (turn, _) in enumerate(rows)}
    moved = True
    while moved:
        moved = False
        for m in at:
            late = max((at[n] for n in needs[m]), default=None)
            if late is not None and late >= at[m]:
                at[m], moved = (late[0], late[1] + 1), True
    return [rows[m][0] for m in sorted(at, key=lambda m: (*at[m], rows[m][0]))]


def test_generated_conversations_against_repeated_rule(spark):
    rng, rows, want = random.Random(8), [], {}
    for conv in range(25):
        n = rng.randrange(2, 14)
        messages = []
        for k in range(n):
            after = [f"{j}" for j in range(k) if rng.random() < 0.25]
            messages += [call(one(f"{k}", {"city": "x"}, after=after)), result(f"{k}")]
        messages += [json.dumps({"content": "talk"}) for _ in range(rng.randrange(4))]
        rng.shuffle(messages)
        own = list(enumerate(messages))
        want[conv] = brute_order(own)
        rows += [(conv, turn, "r", text) for turn, text in own]
    got = run(spark, rows)
    for conv in want:
        mine = [r for r in got if r.conv_id == conv]
        assert not any(r.cyclic for r in mine)
        assert [r.turn for r in mine] == want[conv]
