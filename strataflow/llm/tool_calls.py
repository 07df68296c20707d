"""Conversations as canonical JSON, with tool calls tied to their results.

A message that calls tools is a JSON object ``{"content", "tool_calls": [{"id",
"name", "arguments", "after"}]}``; a call may also hold name and arguments under
``function``, and ``after`` names calls whose results it needs.  A result is
``{"tool_call_id", "content"}``, a declaration of tools ``{"tools": [{"name",
"parameters"}]}`` with a JSON schema.  Every other text is plain content.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas, ranked_within, row_key
from strataflow.llm.components import components
from strataflow.session import stage

MESSAGE = (
    "struct<content:string, tool_call_id:string, "
    "tool_calls:array<struct<id:string, name:string, arguments:string, after:array<string>, "
    "function:struct<name:string, arguments:string>>>, "
    "tools:array<struct<name:string, parameters:string, function:struct<name:string, parameters:string>>>>"
)


class _Part(str):
    """Text of the output, told apart from a string value."""


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, and characters as themselves; numbers that are whole print as such.

    Values of any depth are written without recursion.
    """
    out, todo = [], [value]
    while todo:
        v = todo.pop()
        if type(v) is _Part:
            out.append(v)
        elif isinstance(v, dict):
            parts = [_Part("{")]
            for n, (k, x) in enumerate(sorted(((str(k), x) for k, x in v.items()), key=lambda kx: kx[0])):
                parts += [_Part(("," if n else "") + json.dumps(k, ensure_ascii=False) + ":"), x]
            todo.extend(reversed([*parts, _Part("}")]))
        elif isinstance(v, list):
            parts = [_Part("[")]
            for n, x in enumerate(v):
                parts += [_Part(","), x] if n else [x]
            todo.extend(reversed([*parts, _Part("]")]))
        elif isinstance(v, float):
            whole = math.isfinite(v) and v == int(v) and abs(v) < 2**53
            out.append(json.dumps(int(v) if whole else v if math.isfinite(v) else None))
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


def parse_json(text: str | None):
    """The value of a JSON text; a JSON string that holds JSON is opened once more; None if it is none."""
    for _ in range(2):
        try:
            text = json.loads(text) if isinstance(text, str) else text
        except (ValueError, RecursionError):
            return None
        if not isinstance(text, str):
            break
    return text


def _number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


#: What a value must be for each type that a schema can name.
KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": _number,
    "integer": lambda v: _number(v) and v == v // 1,
}
#: Whether a schema's keyword has a form that can be applied.
FORMS = {
    "type": lambda t: t in KINDS if isinstance(t, str) else isinstance(t, list) and bool(t) and all(isinstance(k, str) and k in KINDS for k in t),
    "enum": lambda e: isinstance(e, list),
    "minimum": _number,
    "maximum": _number,
    "properties": lambda p: isinstance(p, dict),
    "required": lambda r: isinstance(r, list) and all(isinstance(k, str) for k in r),
    "additionalProperties": lambda a: isinstance(a, (bool, dict)),
    "items": lambda i: isinstance(i, (bool, dict)),
}


def errors(value, schema) -> list[str]:
    """Where a value breaks a schema: type, enum, required, properties, additionalProperties, items, bounds.

    A keyword of a form that cannot be applied is an error of the schema, one
    entry, and is passed over; values and schemas of any depth are checked.
    """
    out, todo = [], [(value, schema, "$")]
    while todo:
        value, schema, at = todo.pop()
        if schema is True:
            continue
        if schema is False:
            out.append(f"{at}: not allowed")
            continue
        if not isinstance(schema, dict):
            out.append(f"{at}: schema: no object")
            continue
        own = {}
        for key, form in FORMS.items():
            if key in schema:
                if form(schema[key]):
                    own[key] = schema[key]
                else:
                    out.append(f"{at}: schema: {key}")
        wanted = own.get("type", [])
        wanted = [wanted] if isinstance(wanted, str) else wanted
        if wanted and not any(KINDS[k](value) for k in wanted):
            out.append(f"{at}: not {' or '.join(wanted)}")
        if "enum" in own and canonical(value) not in {canonical(x) for x in own["enum"]}:
            out.append(f"{at}: not in enum")
        if _number(value):
            if "minimum" in own and value < own["minimum"]:
                out.append(f"{at}: below minimum")
            if "maximum" in own and value > own["maximum"]:
                out.append(f"{at}: above maximum")
        inside = []
        if isinstance(value, dict):
            fields = own.get("properties", {})
            out += [f"{at}.{k}: missing" for k in own.get("required", []) if k not in value]
            for k, v in value.items():
                if k in fields:
                    inside.append((v, fields[k], f"{at}.{k}"))
                elif "additionalProperties" in own:
                    inside.append((v, own["additionalProperties"], f"{at}.{k}"))
        elif isinstance(value, list) and "items" in own:
            inside = [(v, own["items"], f"{at}[{n}]") for n, v in enumerate(value)]
        todo.extend(reversed(inside))
    return out


def _in_order(messages: DataFrame, edges: DataFrame) -> DataFrame:
    """mid, at, depth, cyclic: where each message stands that edges may move.

    Messages keep the order of their turns, except that one that needs another
    comes after it: it takes the other's turn and stands one deeper.  Messages
    that need each other in a circle keep their turns; those around them do not.

    Messages that edges tie are placed together in one task, in time in
    proportion to their edges, if one of these goes against the turns at all.
    Only the numbers and turns of messages are gathered for it.
    """
    kind = messages.schema["turn"].dataType.simpleString()
    schema = f"mid long, at {kind}, depth long, cyclic boolean"
    u, v = (messages.select(F.col("mid").alias(end), F.col("turn").alias(f"{end}_turn")) for end in ("before", "after"))
    edges = stage(edges.select("before", "after").join(u, "before").join(v, "after"), "turns")
    early = edges.where(F.struct("before_turn") >= F.struct("after_turn"))
    if early.isEmpty():
        return messages.sparkSession.createDataFrame([], schema)
    ties = components(edges.select(F.col("before").alias("u"), F.col("after").alias("v")))
    ties = stage(ties.select(F.col("node").alias("before"), "root"), "ties")
    # A message that needs only itself is tied to no other.
    tied = stage(edges.join(ties, "before", "left").withColumn("root", F.coalesce("root", "before")), "tied")
    moved = tied.where(F.struct("before_turn") >= F.struct("after_turn")).select("root").distinct()

    def place(table):
        import pyarrow as pa

        turn, needs, after = {}, {}, {}
        for a, b, at, bt in zip(*(table[c].to_pylist() for c in ("before", "after", "before_turn", "after_turn"))):
            turn[a], turn[b] = at, bt
            needs.setdefault(b, []).append(a)
            after.setdefault(a, []).append(b)
        # Tarjan's circles without recursion: a circle is found after all that come after it.
        number, low, on, open_, circle, found = {}, {}, set(), [], {}, []
        for first in turn:
            if first in number:
                continue
            path = [(first, iter(after.get(first, ())))]
            number[first] = low[first] = len(number)
            open_.append(first)
            on.add(first)
            while path:
                m, rest = path[-1]
                n = next(rest, None)
                if n is None:
                    path.pop()
                    if path:
                        low[path[-1][0]] = min(low[path[-1][0]], low[m])
                    if low[m] == number[m]:
                        found.append([])
                        while True:
                            n = open_.pop()
                            on.discard(n)
                            circle[n] = len(found) - 1
                            found[-1].append(n)
                            if n == m:
                                break
                elif n not in number:
                    number[n] = low[n] = len(number)
                    open_.append(n)
                    on.add(n)
                    path.append((n, iter(after.get(n, ()))))
                elif n in on:
                    low[m] = min(low[m], number[n])

        at, cyclic = {}, {}
        for members in reversed(found):
            for m in members:
                own = (True, turn[m], 0) if turn[m] is not None else (False, 0, 0)
                cyclic[m] = len(members) > 1 or m in needs.get(m, ())
                if not cyclic[m]:
                    last = max((at[n] for n in needs.get(m, ())), default=None)
                    if last is not None and last >= own:
                        own = (*last[:2], last[2] + 1)
                at[m] = own
        mids = list(turn)
        rows = {
            "mid": mids, "at": [at[m][1] if at[m][0] else None for m in mids],
            "depth": [at[m][2] for m in mids], "cyclic": [cyclic[m] for m in mids],
        }
        types = [pa.int64(), table.schema.field("before_turn").type, pa.int64(), pa.bool_()]
        return pa.table([pa.array(c, t) for c, t in zip(rows.values(), types)], names=list(rows))

    return stage(tied.join(moved, "root").groupBy("root").applyInArrow(place, schema), "places")


def format_messages(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """conv_id, turn, seq, role, n_calls, n_linked, n_invalid, linked, cyclic and json of every message.

    Calls and results of a conversation meet by identifier in a hash join; where
    an identifier is used again, the n-th result belongs to the n-th call.
    ``seq`` counts the messages of a conversation in topological order: a result
    comes after its call, a call after the results it names in ``after``, and
    otherwise turns decide.  Where an identifier named in ``after`` is used again,
    its latest use before the call counts, or else its first.  Messages that need
    each other in a circle keep their turns and are marked.  Arguments are held against the schema that the conversation
    declares for the tool, or that ``schemas`` has; arguments that are no JSON,
    and tools without a schema, are invalid.  ``json`` has the role, content,
    calls and results in canonical form.

    NULL and empty texts are empty content; text that is no JSON object of the
    forms above is plain content.  NULL conversations, turns and roles are kept
    (NULL turns first).  Repeated rows are messages of their own.  An empty table
    gives no rows; other columns are ignored.  A conversation is never gathered
    in one task, save for the numbers of messages that need each other.
    """
    known = {name: json.dumps(s) for name, s in (schemas or {}).items()}
    looks = F.ltrim("text").startswith("{")
    parsed = F.when(looks, F.from_json(F.col("text"), MESSAGE, {"mode": "PERMISSIVE"}))
    messages = stage(
        conversations.select(
            "conv_id", "turn", "role", "text", parsed.alias("m"), F.monotonically_increasing_id().alias("mid"),
            row_key(F.col("role"), F.col("text")).alias("tie"),
        ),
        "messages",
    )
    calls = messages.select("conv_id", "turn", "tie", "mid", F.posexplode("m.tool_calls").alias("k", "c")).select(
        "conv_id", "turn", "tie", "mid", "k",
        F.col("c.id").alias("call_id"),
        F.coalesce("c.name", "c.function.name").alias("name"),
        F.coalesce("c.arguments", "c.function.arguments").alias("arguments"),
        "c.after",
    )
    order = [F.asc_nulls_first("turn"), "tie", "mid"]
    calls = stage(ranked_within(calls, ["conv_id", "call_id"], [*order, "k"], "calls"), "ranked_calls")
    results = messages.where("m.tool_call_id is not null").select(
        "conv_id", "turn", "tie", "mid", F.col("m.tool_call_id").alias("call_id")
    )
    results = stage(ranked_within(results, ["conv_id", "call_id"], order, "results"), "ranked_results")

    same = (
        F.col("c.conv_id").eqNullSafe(F.col("r.conv_id"))
        & (F.col("c.call_id") == F.col("r.call_id"))
        & (F.col("c._nth") == F.col("r._nth"))
    )
    links = calls.alias("c").join(results.hint("shuffle_hash").alias("r"), same).select(
        "c.conv_id", "c.call_id", "c.turn", "c.tie", F.col("c.mid").alias("call_mid"), "c.k", "c._nth", F.col("r.mid").alias("result_mid")
    )
    links = stage(links, "links")
    # The place among uses and needs, less that among needs, is the number of uses before.
    needs = calls.select("conv_id", "turn", "tie", "mid", F.lit(0).alias("use"), F.explode("after").alias("call_id")).distinct()
    needs = stage(needs.join(links.select("conv_id", "call_id").distinct().alias("l"), (
        needs["conv_id"].eqNullSafe(F.col("l.conv_id")) & (needs["call_id"] == F.col("l.call_id"))
    ), "left_semi"), "needs")
    uses = links.select("conv_id", "turn", "tie", F.col("call_mid").alias("mid"), F.lit(1).alias("use"), "call_id")
    keys = ["conv_id", "call_id"]
    among = ranked_within(needs.unionByName(uses), keys, [*order, "use"], "needs_and_uses").where("use = 0")
    alone = ranked_within(needs, keys, order, "ranked_needs")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.call_id") == F.col("b.call_id")) & (F.col("a.mid") == F.col("b.mid"))
    wanted = among.alias("a").join(alone.alias("b"), same).select(
        "a.conv_id", "a.call_id", "a.mid", F.greatest(F.col("a._nth") - F.col("b._nth"), F.lit(1)).alias("nth")
    )
    met = wanted.alias("n").join(
        links.alias("l"),
        F.col("n.conv_id").eqNullSafe(F.col("l.conv_id")) & (F.col("n.call_id") == F.col("l.call_id")) & (F.col("nth") == F.col("l._nth")),
    ).select("n.conv_id", F.col("l.result_mid").alias("before"), F.col("n.mid").alias("after"))
    edges = links.select("conv_id", F.col("call_mid").alias("before"), F.col("result_mid").alias("after")).union(
        met
    )
    edges = stage(edges.distinct(), "edges")
    places = _in_order(messages, edges)

    tools = messages.select("conv_id", "turn", "mid", F.explode("m.tools").alias("t")).select(
        "conv_id",
        F.coalesce("t.name", "t.function.name").alias("name"),
        F.struct("turn", "mid", F.coalesce("t.parameters", "t.function.parameters").alias("schema")).alias("t"),
    )
    declared = tools.groupBy("conv_id", "name").agg(F.max("t")["schema"].alias("schema"))
    linked = links.select("call_mid", "k", F.lit(True).alias("linked")).distinct()
    with_schema = (
        calls.alias("c")
        .join(declared.alias("d"), F.col("c.conv_id").eqNullSafe(F.col("d.conv_id")) & (F.col("c.name") == F.col("d.name")), "left")
        .join(linked.alias("l"), (F.col("c.mid") == F.col("l.call_mid")) & (F.col("c.k") == F.col("l.k")), "left")
    )
    own = with_schema.groupBy("c.mid").agg(  # the calls of one message
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("c.k").alias("k"), F.col("call_id").alias("id"), F.col("c.name").alias("name"), "arguments",
                    "schema", F.coalesce("linked", F.lit(False)).alias("linked"),
                )
            )
        ).alias("calls")
    )
    answered = links.select(F.col("result_mid").alias("mid")).distinct().withColumn("answers", F.lit(True))
    whole = (
        messages.join(own, "mid", "left").join(answered, "mid", "left").join(places, "mid", "left")
        .withColumn("cyclic", F.coalesce("cyclic", F.lit(False)))
        .withColumn("at", F.when(F.col("cyclic"), F.col("turn")).otherwise(F.coalesce("at", "turn")))
        .withColumn("depth", F.when(F.col("cyclic"), F.lit(0)).otherwise(F.coalesce("depth", F.lit(0))))
    )
    columns = ["conv_id", "turn", "role", "text", "m", "mid", "tie", "calls", "answers", "at", "depth", "cyclic"]
    placed = [F.asc_nulls_first("at"), "depth", *order]
    ordered = ranked_within(whole.select(columns), ["conv_id"], placed, "ordered_messages")

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for role, text, content, call_id, calls, answers in zip(
                b["role"], b["text"], b["content"], b["tool_call_id"], b["calls"], b["answers"]
            ):
                out = {"role": role, "content": text or ""}
                done, n_linked, n_invalid = [], 0, 0
                for c in [] if calls is None else calls:
                    arguments = parse_json(c["arguments"])
                    schema = parse_json(c["schema"] if c["schema"] is not None else known.get(c["name"]))
                    wrong = ["$: no schema"] if schema is None else errors(arguments, schema)
                    if arguments is None:
                        wrong = ["$: no JSON"]
                    done.append(
                        {
                            "id": c["id"], "name": c["name"], "linked": bool(c["linked"]), "errors": wrong,
                            "arguments": c["arguments"] if arguments is None else arguments,
                        }
                    )
                    n_linked += bool(c["linked"])
                    n_invalid += bool(wrong)
                if done:
                    out |= {"content": content or "", "tool_calls": done}
                if call_id is not None:
                    out |= {"content": content or "", "tool_call_id": call_id, "linked": bool(answers)}
                rows.append((len(done), n_linked, n_invalid, bool(answers), canonical(out)))
            made = pd.DataFrame(rows, columns=["n_calls", "n_linked", "n_invalid", "linked", "json"])
            yield pd.concat([b[["conv_id", "turn", "seq", "role", "cyclic"]].reset_index(drop=True), made], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in conversations.schema.fields}
    schema = (
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, seq long, role string, cyclic boolean, "
        "n_calls long, n_linked long, n_invalid long, linked boolean, json string"
    )
    flat = ordered.select(
        "conv_id", "turn", F.col("_nth").alias("seq"), "role", "text", "m.content", "m.tool_call_id", "calls",
        F.coalesce("answers", F.lit(False)).alias("answers"), "cyclic",
    )
    return map_pandas(flat, step, schema)
