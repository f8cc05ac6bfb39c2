"""Tool calls and their results: linked, ordered, checked and written as canonical JSON."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import settled, stored

_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


#: Keywords that say nothing about a value, and those that are checked.
_NOTES = {"title", "description", "default", "examples", "$comment", "$schema", "$defs", "definitions"}
_LISTS, _SINGLE = ("allOf", "anyOf", "oneOf"), ("items", "additionalProperties", "not")
_COUNTS = ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties")
_BOUNDS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum")
_CHECKED = {"type", "enum", "const", "pattern", "uniqueItems", "properties", "required", "$ref", *_LISTS, *_SINGLE, *_COUNTS, *_BOUNDS}


def _number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def checked(schema: Any, root: Any = None, at: str = "$") -> None:
    """Raise ``ValueError`` unless all keywords of the schema are known and well-formed.

    ``$ref`` may name a place in ``$defs`` or ``definitions`` of the same schema; those are
    checked once, from the top.
    """
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: not a schema")
    top = root is None
    root = schema if top else root
    if unknown := sorted(set(schema) - _NOTES - _CHECKED):
        raise ValueError(f"{at}: unknown keywords {unknown}")
    kinds = schema.get("type", [])
    good = all(isinstance(k, str) and k in _TYPES for k in (kinds if isinstance(kinds, list) else [kinds]))
    good &= all(isinstance(schema.get(k, 0), int) and schema.get(k, 0) >= 0 for k in _COUNTS)
    good &= all(_number(schema.get(k, 0)) for k in _BOUNDS)
    good &= isinstance(schema.get("enum", []), list) and isinstance(schema.get("uniqueItems", True), bool)
    good &= isinstance(schema.get("required", []), list) and isinstance(schema.get("properties", {}), dict)
    good &= all(isinstance(schema.get(k, []), list) for k in _LISTS) and isinstance(schema.get("pattern", ""), str)
    if not good:
        raise ValueError(f"{at}: a keyword has a value that it cannot have")
    try:
        re.compile(_ended(schema.get("pattern", "")))
    except re.error as wrong:
        raise ValueError(f"{at}: pattern {wrong}") from wrong
    if "$ref" in schema:
        ref = schema["$ref"]
        _in_place(_referred(ref, root), root, (ref,))
    for k in _LISTS:
        for n, part in enumerate(schema.get(k, [])):
            checked(part, root, f"{at}.{k}[{n}]")
    for k in _SINGLE:
        if k in schema:
            checked(schema[k], root, f"{at}.{k}")
    for name, part in schema.get("properties", {}).items():
        checked(part, root, f"{at}.{name}")
    if top:
        for k in ("$defs", "definitions"):
            for name, part in schema.get(k, {}).items():
                checked(part, root, f"{at}.{k}.{name}")


def _in_place(schema: Any, root: dict, through: tuple[str, ...]) -> None:
    """Raise ``ValueError`` if a reference comes back to itself without a step into the value."""
    if not isinstance(schema, dict):
        return
    if "$ref" in schema:
        ref = schema["$ref"]
        if ref in through:
            raise ValueError(f"{ref} leads to itself")
        _in_place(_referred(ref, root), root, (*through, ref))
    for part in [*(p for k in _LISTS for p in schema.get(k, [])), schema.get("not")]:
        _in_place(part, root, through)


def _referred(ref: Any, root: dict) -> Any:
    parts = ref.split("/") if isinstance(ref, str) else []
    if len(parts) == 3 and parts[0] == "#" and parts[1] in ("$defs", "definitions") and parts[2] in root.get(parts[1], {}):
        return root[parts[1]][parts[2]]
    raise ValueError(f"unknown reference {ref!r}")


def _ended(pattern: str) -> str:
    """The pattern with ``$`` as the very end, not the place before a last line break."""
    return re.sub(r"\\.|\[(?:\\.|[^\]\\])*\]|\$", lambda m: r"\Z" if m[0] == "$" else m[0], pattern)


def _same(value: Any) -> Any:
    """What equal JSON values share: 1 is 1.0 but not true."""
    if isinstance(value, dict):
        return "object", frozenset((k, _same(v)) for k, v in value.items())
    if isinstance(value, list):
        return "array", tuple(map(_same, value))
    return isinstance(value, bool), value


def faults(value: Any, schema: Any, at: str = "$", root: Any = None) -> list[str]:
    """What in a value goes against a schema whose keywords are those that ``checked`` lets pass."""
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    root = schema if root is None else root
    kinds = schema.get("type", [])
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if kinds and not any(_TYPES[kind](value) for kind in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = faults(value, _referred(schema["$ref"], root), at, root) if "$ref" in schema else []
    if "enum" in schema and _same(value) not in map(_same, schema["enum"]):
        out.append(f"{at}: not in enum")
    if "const" in schema and _same(value) != _same(schema["const"]):
        out.append(f"{at}: not the constant")
    for part in schema.get("allOf", []):
        out += faults(value, part, at, root)
    if "anyOf" in schema and all(faults(value, part, at, root) for part in schema["anyOf"]):
        out.append(f"{at}: fits none")
    if "oneOf" in schema and sum(not faults(value, part, at, root) for part in schema["oneOf"]) != 1:
        out.append(f"{at}: does not fit exactly one")
    if "not" in schema and not faults(value, schema["not"], at, root):
        out.append(f"{at}: fits what it must not")
    if _number(value):
        if value < schema.get("minimum", value):
            out.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{at}: above maximum")
        if "exclusiveMinimum" in schema and not value > schema["exclusiveMinimum"]:
            out.append(f"{at}: not above minimum")
        if "exclusiveMaximum" in schema and not value < schema["exclusiveMaximum"]:
            out.append(f"{at}: not below maximum")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: too long")
        if not re.search(_ended(schema.get("pattern", "")), value):
            out.append(f"{at}: not of the pattern")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            out.append(f"{at}: number of items")
        if schema.get("uniqueItems") and len(set(map(_same, value))) < len(value):
            out.append(f"{at}: repeated items")
        for i, item in enumerate(value if "items" in schema else []):
            out += faults(item, schema["items"], f"{at}[{i}]", root)
    if isinstance(value, dict):
        if not schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", len(value)):
            out.append(f"{at}: number of properties")
        known = schema.get("properties", {})
        out += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        more = schema.get("additionalProperties", True)
        for name, item in sorted(value.items()):
            if name in known:
                out += faults(item, known[name], f"{at}.{name}", root)
            elif more is False:
                out.append(f"{at}.{name}: unknown")
            else:
                out += faults(item, more, f"{at}.{name}", root)
    return out


_LONE = re.compile("[\ud800-\udfff]")


def canonical(value: Any) -> str:
    """JSON with sorted keys, no white space, and characters as they are; halves of surrogate pairs,
    which UTF-8 cannot hold, are escaped."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _LONE.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def _finite(digits: str) -> float:
    value = float(digits)
    if value in (float("inf"), float("-inf")):
        raise ValueError(f"{digits} is beyond any number")
    return value


def _no_number(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def parsed(text: str | None) -> tuple[Any, bool]:
    """The value of a JSON text and True, or the text itself and False: where it is no JSON (NaN and
    infinities are none), holds a number beyond doubles, or is nested too deep to be written again."""
    try:
        value = json.loads(text, parse_constant=_no_number, parse_float=_finite)
        canonical(value)
    except (TypeError, ValueError, RecursionError):
        return text, False
    return value, True


def fits(value: Any, schema: Any) -> bool:
    """Whether a value has no faults. One that is nested too deep to be checked does not fit."""
    try:
        return not faults(value, schema)
    except RecursionError:
        return False


def levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)`` of calls ``(conv_id, call_id, needs)`` in topological order.

    A call without needs has level 0, any other one more than the highest of its needs. Calls
    that wait for a missing call or for themselves have no row.

    A call with one need is a link of a chain. Chains are shortened first: each link takes over
    where its need leads, which halves the way left in every round. Calls with several needs
    then stand at most a few steps above what they wait for, and a round resolves one level of
    them, for all conversations at once.
    """
    key = ["conv_id", "call_id"]
    needs = F.array_distinct(F.coalesce("needs", F.array().cast("array<string>")))
    waiting = settled(calls.select(*key, needs.alias("needs")))
    many = F.size("needs")
    chain = settled(waiting.where(many == 1).select(*key, F.col("needs")[0].alias("to"), F.lit(1).alias("steps")))
    longest, reach, moving = chain.count(), 1, True
    while moving and reach <= longest:  # what still moves after that goes in circles
        onward = chain.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        moved = chain.join(onward, ["conv_id", "to"], "left")
        chain = settled(
            moved.select(
                *key,
                F.coalesce("next", "to").alias("to"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNotNull().alias("moved"),
            )
        )
        moving = not chain.where("moved").isEmpty()
        reach *= 2
    heads = chain.select("conv_id", F.col("call_id").alias("need"), "to", "steps")
    edges = waiting.where(many > 1).select(*key, F.explode("needs").alias("need"), many.alias("n"))
    edges = edges.join(heads, ["conv_id", "need"], "left").select(
        *key, "n", F.coalesce("to", "need").alias("to"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")
    )
    edges = settled(edges)
    done = settled(waiting.where(many == 0).select(*key, F.lit(0).alias("level")))
    fresh = not edges.isEmpty()
    while fresh:
        met = edges.join(done.withColumnRenamed("call_id", "to"), ["conv_id", "to"])
        ready = met.groupBy(*key).agg(
            F.count("*").alias("met"), F.max("n").alias("n"), F.max(F.col("level") + F.col("steps")).alias("level")
        )
        ready = settled(ready.where("met = n").select(*key, "level").join(done, key, "left_anti"))
        done = settled(done.union(ready))
        fresh = not ready.isEmpty()
    along = chain.join(done.withColumnRenamed("call_id", "to"), ["conv_id", "to"])
    return done.union(along.select(*key, (F.col("level") + F.col("steps")).alias("level")))


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], messages: DataFrame | None = None) -> DataFrame:
    """One row ``(conv_id, turn, part, call_id, status, level, valid, line)`` per call, result and message.

    ``calls`` has ``(conv_id, turn, call_id, name, arguments, needs)``, ``results`` has
    ``(conv_id, turn, call_id, content)``. An identifier belongs to its first call, by turn and
    then by arguments and name; its first later result, by turn and content, answers it.
    Status of a call: ``answered``, ``open`` (no result), or ``repeated`` (not the first); of a
    result: ``answer``, ``repeated``, ``early`` (not after its call) or ``orphan`` (no call). Rows
    without an identifier are ``open`` and ``orphan``. Only first ones are compared, each
    found by an aggregation, so repeated identifiers never multiply.

    Arguments that are no JSON (see ``parsed``) are kept as text and are not valid; 1.0 is an integer.

    ``level`` is the place of a first call in topological order (NULL: never ready), its answer
    has the same. ``valid`` tells whether a call's arguments are JSON and fit the schema of its
    tool; unknown tools do not. ``line`` is canonical JSON of the row. ``messages`` has ``(conv_id,
    turn, role, text)`` of rows that are neither; they have a ``line`` only.
    """
    for schema in schemas.values():
        checked(schema)
    key = ["conv_id", "call_id"]
    calls = stored(calls.withColumn("row", F.monotonically_increasing_id()))
    results = stored(results.withColumn("row", F.monotonically_increasing_id()))
    order = F.struct("turn", F.expr("arguments IS NOT NULL"), "arguments", "name", "row")
    first = calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL").groupBy(*key)
    first = settled(first.agg(F.min_by(F.struct("row", "turn", "needs"), order).alias("c")))
    level = levels(first.select(*key, "c.needs"))
    later = results.join(first.select(*key, F.col("c.turn").alias("asked")), key).where("turn > asked")
    answer = later.groupBy(*key).agg(F.min_by("row", F.struct("turn", F.expr("content IS NOT NULL"), "content", "row")).alias("answer"))
    known = first.select(*key, F.col("c.row").alias("first"), F.col("c.turn").alias("asked"))
    known = settled(known.join(answer, key, "left").join(level, key, "left"))
    own = F.col("row") == F.col("first")
    said = calls.join(known, key, "left").select(
        "conv_id",
        "turn",
        F.lit("call").alias("part"),
        "call_id",
        F.when(F.col("first").isNull(), "open").when(~own, "repeated").when(F.col("answer").isNull(), "open").otherwise("answered").alias("status"),
        F.when(own, F.col("level")).cast("long").alias("level"),
        "name",
        F.col("arguments").alias("body"),
    )
    hit = F.col("row") == F.col("answer")
    got = results.join(known, key, "left").select(
        "conv_id",
        "turn",
        F.lit("result").alias("part"),
        "call_id",
        F.when(F.col("first").isNull(), "orphan")
        .when(hit, "answer")
        .when(F.coalesce(F.col("turn") > F.col("asked"), F.lit(False)), "repeated")
        .otherwise("early")
        .alias("status"),
        F.when(hit, F.col("level")).cast("long").alias("level"),
        F.lit(None).cast("string").alias("name"),
        F.col("content").alias("body"),
    )
    rows = said.unionByName(got)
    if messages is not None:
        none = {c: F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes if c in ("call_id", "status", "level")}
        part = F.lit("message").alias("part")
        rest = messages.select("conv_id", "turn", part, *none.values(), F.col("role").alias("name"), F.col("text").alias("body"))
        rows = rows.unionByName(rest)
    return _written(rows, schemas)


def _written(rows: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid: list[bool | None] = []
            lines: list[str] = []
            for part, call, name, body in zip(*(batch.column(c) for c in ("part", "call_id", "name", "body")), strict=True):
                part, call, name, body = (x.as_py() for x in (part, call, name, body))
                if part == "call":
                    value, sound = parsed(body)
                    valid.append(sound and name in schemas and fits(value, schemas[name]))
                    lines.append(canonical({"arguments": value, "id": call, "name": name, "type": part}))
                elif part == "message":
                    valid.append(None)
                    lines.append(canonical({"content": body, "role": name, "type": part}))
                else:
                    valid.append(None)
                    lines.append(canonical({"content": body, "id": call, "type": part}))
            kept = [batch.column(c) for c in names[:6]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(valid, pa.bool_()), pa.array(lines, pa.string())], names=names)

    names = ["conv_id", "turn", "part", "call_id", "status", "level", "valid", "line"]
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in names[:6]), "valid boolean", "line string"])
    return rows.mapInArrow(run, schema)


def line_hash(line: str) -> str:
    return hashlib.sha256(line.encode()).hexdigest()


#: The tool that a user's turn stands for, where conversations hold no calls of their own.
ASK = {
    "ask": {
        "type": "object",
        "required": ["question", "turn"],
        "additionalProperties": False,
        "properties": {
            "question": {"type": "string", "minLength": 1, "maxLength": 300},
            "turn": {"type": "integer", "minimum": 0},
        },
    }
}


def as_chat(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turns of ``(conv_id, turn, role, text)`` as calls, results and messages, each in one of them.

    A user's turn is a call of ``ask`` that needs the call two turns before; an assistant's
    turn is the result of the call one turn before. Without conversation or turn they have no
    identifier. Turns of other roles or of none are messages.
    """
    keyed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    name = lambda back: F.when(keyed, F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string")))
    calls = conversations.where("role = 'user'").select(
        "conv_id",
        "turn",
        name(0).alias("call_id"),
        F.lit("ask").alias("name"),
        F.to_json(F.struct(F.col("text").alias("question"), "turn")).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(name(2))).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
    results = conversations.where("role = 'assistant'").select("conv_id", "turn", name(1).alias("call_id"), F.col("text").alias("content"))
    messages = conversations.where("role IS NULL OR role NOT IN ('user', 'assistant')").select("conv_id", "turn", "role", "text")
    return calls, results, messages
