"""Linking, ordering and checking of tool calls."""

import json
import random

import pytest

from gridloom.llm import tool_chat
from gridloom.llm.oracles import ORACLES
from gridloom.llm.queries import QUERIES
from tests.oracle import compare, connect

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, extra string"
RESULTS = "conv_id long, turn long, call_id string, content string, status string"
SCHEMAS = {
    "add": {
        "type": "object",
        "required": ["a", "b"],
        "additionalProperties": False,
        "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "number", "maximum": 9}, "c": {"enum": ["x", None]}},
    },
    "list": {"type": "object", "properties": {"items": {"type": "array", "items": {"type": "string", "maxLength": 2}}}},
}


def test_statuses_levels_and_lines(spark):
    calls = [
        (1, 0, "c0", "add", '{"b":2, "a":1}', None, "e"),
        (1, 2, "c1", "add", '{"a":1,"b":10}', ["c0", "c0"], "e"),
        (1, 4, "c2", "list", '{"items":["é","abc"]}', ["c1", "c0"], "e"),
        (1, 6, "loop", "list", "{}", ["loop2"], "e"),
        (1, 7, "loop2", "list", "{}", ["loop"], "e"),
        (1, 8, "waits", "list", "{}", ["never"], "e"),
        (1, 9, "c0", "add", "not json", None, "e"),
        (1, 9, None, "nobody", None, None, "e"),
        (2, 0, "c0", "add", '{"a":true,"b":1}', None, "e"),
        (2, 0, "c0", "add", '{"a":true,"b":1}', None, "e"),
        (None, 0, "c0", "list", "{}", None, "e"),
    ]
    results = [
        (1, 1, "c0", "3", "s"),
        (1, 3, "c0", "again", "s"),
        (1, 1, "c1", "too early", "s"),
        (1, 5, "c1", None, "s"),
        (1, 5, "c1", "b", "s"),
        (1, 5, "gone", "x", "s"),
        (1, 5, None, "x", "s"),
    ]
    rows = tool_chat.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    assert len(rows) == len(calls) + len(results)
    said = sorted(str((r.conv_id, r.turn, r.call_id, r.status, r.level, r.valid)) for r in rows if r.part == "call")
    assert said == sorted(
        map(
            str,
            [
                (1, 0, "c0", "answered", 0, True), (1, 2, "c1", "answered", 1, False), (1, 4, "c2", "open", 2, False),
                (1, 6, "loop", "open", None, True), (1, 7, "loop2", "open", None, True), (1, 8, "waits", "open", None, True),
                (1, 9, "c0", "repeated", None, False), (1, 9, None, "open", None, False),
                (2, 0, "c0", "open", 0, False), (2, 0, "c0", "repeated", None, False), (None, 0, "c0", "open", None, True),
            ],
        )
    )
    got = sorted(str((r.turn, r.call_id, r.status, r.level)) for r in rows if r.part == "result")
    assert got == sorted(
        map(
            str,
            [
                (1, "c0", "answer", 0), (3, "c0", "repeated", None), (1, "c1", "early", None), (5, "c1", "answer", 1),
                (5, "c1", "repeated", None), (5, "gone", "orphan", None), (5, None, "orphan", None),
            ],
        )
    )
    line = next(r.line for r in rows if r.call_id == "c2")
    assert line == '{"arguments":{"items":["é","abc"]},"id":"c2","name":"list","type":"call"}'
    assert all(tool_chat.canonical(json.loads(r.line)) == r.line for r in rows)


def test_faults():
    assert tool_chat.faults({"a": 1, "b": 2.5, "c": None}, SCHEMAS["add"]) == []
    assert tool_chat.faults({"a": -1, "c": "y", "d": 0}, SCHEMAS["add"]) == [
        "$.b: missing", "$.a: below minimum", "$.c: not in enum", "$.d: unknown",
    ]
    assert tool_chat.faults([], SCHEMAS["add"]) == ["$: not object"]


@pytest.mark.parametrize(
    "schema, good, bad",
    [
        ({"type": ["string", "null"]}, [None, "a"], [1]),
        ({"const": 1}, [1, 1.0], [True, 2]),
        ({"enum": [1, [True]]}, [1, [True]], [True, [1]]),
        ({"pattern": "^a+$"}, ["aa", 3], ["ab", "a\n"]),
        ({"exclusiveMinimum": 0, "exclusiveMaximum": 2}, [1], [0, 2]),
        ({"minItems": 1, "maxItems": 2, "uniqueItems": True}, [[1, True]], [[], [1, 1.0], [1, 2, 3]]),
        ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, ["a", 3], [2]),
        ({"oneOf": [{"minimum": 3}, {"maximum": 5}]}, [2, 6], [4]),
        ({"allOf": [{"minimum": 3}], "not": {"const": 4}}, [3], [2, 4]),
        ({"additionalProperties": {"type": "integer"}, "maxProperties": 1}, [{"a": 1}], [{"a": "b"}, {"a": 1, "b": 2}]),
        ({"$ref": "#/$defs/n", "$defs": {"n": {"properties": {"n": {"$ref": "#/$defs/n"}}, "type": "object"}}}, [{"n": {}}], [{"n": {"n": 1}}]),
    ],
)
def test_keywords(schema, good, bad):
    tool_chat.checked(schema)
    assert [v for v in good if tool_chat.faults(v, schema)] == []
    assert [v for v in bad if not tool_chat.faults(v, schema)] == []


@pytest.mark.parametrize(
    "schema",
    [
        {"format": "date"}, {"items": {"if": {}}}, {"type": "text"}, {"pattern": "("}, {"$ref": "other.json"}, {"minItems": "1"},
        {"$ref": "#/$defs/a", "$defs": {"a": {"anyOf": [{"$ref": "#/$defs/a"}]}}},
    ],
)
def test_unknown_keywords_are_refused_before_the_job(schema):
    with pytest.raises(ValueError):
        tool_chat.linked(None, None, {"tool": schema})


def test_odd_arguments_do_not_end_the_job(spark):
    """Halves of surrogate pairs, no numbers, numbers beyond doubles, deep and long values."""
    deep = "[" * 500 + "]" * 500
    schemas = {
        "any": {},
        "tree": {"$ref": "#/$defs/n", "$defs": {"n": {"type": "array", "items": {"$ref": "#/$defs/n"}}}},
        "whole": {"properties": {"n": {"type": "integer", "enum": [1, 2]}}},
    }
    given = [
        ("any", '{"q":"\\ud800"}', True), ("any", '{"q":NaN}', False), ("any", '{"q":-Infinity}', False), ("any", '{"q":1e400}', False),
        ("any", "[" * 100_000, False), ("any", "[" * 50_000 + "]" * 50_000, False), ("any", '"' + "x" * 2_000_000 + '"', True),
        ("any", deep, True), ("tree", "[[],[[]]]", True), ("tree", "[[1]]", False), ("whole", '{"n":1.0}', True), ("whole", '{"n":1.5}', False),
        ("any", "1" * 5000, False), ("any", '"\\ud83d\\ude00"', True), ("any", None, False), ("any", "", False),
    ]
    calls = [(1, k, f"c{k}", name, body, None, "e") for k, (name, body, _) in enumerate(given)]
    calls.append((1, 99, "c99", "tree", deep, None, "e"))
    rows = {r.turn: r for r in tool_chat.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), schemas).collect()}
    assert {k: rows[k].valid for k in range(len(given))} == {k: want for k, (_, _, want) in enumerate(given)}
    assert rows[99].valid in (True, False)
    assert '"q":"\\ud800"' in rows[0].line and '"q":NaN' not in rows[1].line.replace('\\"', "") and "😀" in rows[13].line
    for r in rows.values():
        json.loads(r.line, parse_constant=lambda name: pytest.fail(name))


def test_empty(spark):
    none = tool_chat.linked(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS)
    assert none.collect() == []


def test_turns_as_tool_use(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", None), (1, 2, "system", "s"), (None, 0, "user", "q"), (1, None, "user", "q")]
    calls, results, messages = tool_chat.as_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = tool_chat.linked(calls, results, tool_chat.ASK, messages).collect()
    assert len(found) == len(rows)
    out = {r.turn: r for r in found if r.conv_id == 1 and r.part != "message"}
    assert [(out[t].status, out[t].level, out[t].valid) for t in (0, 1, 2)] == [("answered", 0, True), ("answer", 0, None), ("open", 1, False)]


def test_every_turn_has_a_row(spark, tmp_path):
    """Other roles, no role, no conversation and no turn; also against the SQL."""
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "system", 'say "é"'), (1, 3, "tool", None), (1, 4, None, "n"),
        (None, 0, "user", "q"), (None, 1, "assistant", "a"), (2, None, "user", "q"), (2, None, "assistant", None), (None, None, "system", "s"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    calls, results, messages = tool_chat.as_chat(df)
    out = tool_chat.linked(calls, results, tool_chat.ASK, messages).collect()
    assert len(out) == len(rows)
    said = {(r.conv_id, r.turn, r.part): (r.call_id, r.status, r.level, r.valid, r.line) for r in out}
    assert said[1, 2, "message"] == (None, None, None, None, '{"content":"say \\"é\\"","role":"system","type":"message"}')
    assert said[1, 3, "message"][-1] == '{"content":null,"role":"tool","type":"message"}'
    assert said[1, 4, "message"][-1] == '{"content":"n","role":null,"type":"message"}'
    assert said[None, 0, "call"][:4] == (None, "open", None, True) and said[2, None, "call"][:4] == (None, "open", None, False)
    assert said[None, 1, "result"][:3] == said[2, None, "result"][:3] == (None, "orphan", None)
    name = "op2_tool_chat"
    assert compare(spark, connect(str(tmp_path)), name, QUERIES[name], ORACLES[name], str(tmp_path)) is None


def test_levels_of_chains_and_joins(spark):
    """Against longest paths, over long chains, trees, joins, loops and gaps."""
    rng = random.Random(9)
    needs = {f"a{i}": [f"a{i - 1}"] if i else [] for i in range(70)}
    needs |= {f"b{i}": [f"a{rng.randrange(70)}"] for i in range(20)}
    for i in range(40):
        pool = list(needs)
        needs[f"c{i}"] = sorted({rng.choice(pool) for _ in range(rng.randrange(4))})
    needs |= {"l0": ["l2"], "l1": ["l0"], "l2": ["l1"], "after": ["l1"], "self": ["self"], "gap": ["nowhere"], "both": ["a1", "gap"], "m": ["l0", "a3"]}
    level = {}
    while True:
        new = {c: 1 + max((level[x] for x in n), default=-1) for c, n in needs.items() if c not in level and all(x in level for x in n)}
        if not new:
            break
        level |= new
    df = spark.createDataFrame([(k, c, n) for k in (1, 2) for c, n in needs.items()], "conv_id long, call_id string, needs array<string>")
    got = tool_chat.levels(df).collect()
    assert len(got) == 2 * len(level) and all(r.level == level[r.call_id] for r in got)
