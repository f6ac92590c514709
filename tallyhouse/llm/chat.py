"""Chat formatting: tool calls linked with their results, ordered, checked and serialised.

Messages are rows (conv_id, turn, role, content, calls, call_id): ``calls`` an array of
(id, name, arguments as JSON text), ``call_id`` the call that a result answers. Calls and
results meet in a hash join on conversation and identifier. Arguments are checked against
the JSON schema of their tool and written as canonical JSON: keys in code point order, no
white space, no escapes that JSON does not need. An argument ``{"$result": id}``
makes the message wait for that result.

Order: every message waits for the messages it follows from (a result for its call, a call
for the results it names). ``at`` is the first turn at which it can stand, the largest of its own and
of all before it, and ``depth`` the longest chain before it among messages with its ``at``, so that
(at, depth, turn) sorts every conversation topologically; where the turns are in order already,
that is the order of turns. Both are found in rounds that join only messages that have to
move: as many rounds as a chain of moved messages is long, none for a conversation in order,
however long it is. No conversation is gathered in one place: each message keeps its own row
and its sort keys.

Of several calls with one identifier the first counts, of several results the first is linked
and the others are ``repeated``. Null and empty calls are no calls; a null content is written as
null. Messages in a cycle, or behind one at the same ``at``, are marked and have depth -1. Equal rows get
equal results; null conversations are linked among themselves. Other columns are left out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import staged
from tallyhouse.operators.joins import join_by_key

_TYPES = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "number": (int, float),
    "integer": int,
    "null": type(None),
}


def _is(value, kind: str) -> bool:
    if isinstance(value, bool) and kind in ("number", "integer"):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind])


def faults(value, schema: Mapping, path: str = "$") -> list[str]:
    """Violations of a JSON schema: type, enum, required, properties, additionalProperties,
    items, minimum, maximum, minLength, maxLength, minItems, maxItems."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{path}: not of type {'|'.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{path}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{path}: above maximum")
    if isinstance(value, (str, list)):
        name = "Length" if isinstance(value, str) else "Items"
        if len(value) < schema.get(f"min{name}", 0):
            out.append(f"{path}: below min{name}")
        if len(value) > schema.get(f"max{name}", len(value)):
            out.append(f"{path}: above max{name}")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += faults(item, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}: lacks {k}" for k in schema.get("required", []) if k not in value]
        for key in sorted(value):
            if key in known:
                out += faults(value[key], known[key], f"{path}.{key}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}: unknown {key}")
    return out


def canonical(value) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    try:
        text.encode()
    except UnicodeEncodeError:  # a lone surrogate is only possible escaped
        text = json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)
    return text


def _references(value) -> list[str]:
    """Identifiers in ``{"$result": id}``, anywhere in a value."""
    out, work = [], [value]
    while work:
        one = work.pop()
        if isinstance(one, dict):
            if set(one) == {"$result"} and isinstance(one["$result"], str):
                out.append(one["$result"])
            else:
                work += one.values()
        elif isinstance(one, list):
            work += one
    return sorted(set(out))


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def _number(text: str) -> float:
    """A number with a fraction or an exponent, which must be finite. It keeps that kind: 1.0 and 1e0 have one form,
    the integer 1 has another."""
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is out of range")
    return value


def _format(role, content, calls, call_id, schemas):
    """JSON line, identifiers of the calls, references and faults of one message."""
    line, ids, needs, wrong = {"role": role, "content": content}, [], [], []
    if call_id is not None:
        line["call_id"] = call_id
    for call in calls or []:
        if call is None:
            continue
        try:
            arguments = json.loads(
                call["arguments"] or "", parse_constant=_refuse, parse_float=_number
            )
            needs += _references(arguments)
            if call["name"] in schemas:
                wrong += faults(arguments, schemas[call["name"]])
            else:
                wrong.append(f"unknown tool {call['name']}")
        except (ValueError, RecursionError):
            arguments = call["arguments"]
            wrong.append("arguments are not JSON")
        line.setdefault("calls", []).append(
            {"id": call["id"], "name": call["name"], "arguments": arguments}
        )
        if call["id"] is not None:
            ids.append(call["id"])
    return canonical(line), ids, needs, wrong


def _formatted(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    columns = ["conv_id", "turn", "role", "content", "calls", "call_id"]
    source = messages.select(*columns)
    node = F.xxhash64(
        *[F.coalesce(F.to_json(F.struct(c)), F.lit("{}")) for c in columns]
    ).alias("node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in columns[2:]]
            found = [_format(*row, schemas) for row in zip(*values, strict=True)]
            json_, ids, needs, wrong = zip(*found, strict=True) if found else ((), (), (), ())
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_pydict(
                {
                    **{c: batch.column(c) for c in ("node", "conv_id", "turn", "role", "call_id")},
                    "json": pa.array(json_, pa.string()),
                    "ids": pa.array(ids, strings),
                    "needs": pa.array(needs, strings),
                    "faults": pa.array(wrong, strings),
                }
            )

    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.select(node, *columns).mapInArrow(
        run,
        f"node long, conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, "
        "call_id string, json string, ids array<string>, needs array<string>, "
        "faults array<string>",
    )


def _moved(edges: DataFrame) -> DataFrame:
    """(node, at) of the nodes that have to wait beyond their own turn; edges are
    (node, turn, before, before_turn)."""
    wait = F.max("at").alias("at")
    frontier = staged(
        edges.where("before_turn > turn").select("node", F.col("before_turn").alias("at"))
        .groupBy("node").agg(wait)
    )
    moved = frontier
    while not frontier.isEmpty():
        pushed = (
            join_by_key(edges, frontier.withColumnRenamed("node", "before"), ["before"])
            .where("at > turn")
            .groupBy("node")
            .agg(wait)
        )
        known = moved.withColumnRenamed("at", "known")
        frontier = staged(
            join_by_key(pushed, known, ["node"], "left")
            .where("known IS NULL OR at > known")
            .select("node", "at")
        )
        moved = staged(moved.unionByName(frontier).groupBy("node").agg(wait))
    return moved


def _depths(edges: DataFrame) -> DataFrame:
    """(node, depth) of the nodes of edges (node, before) that are not in a cycle or behind
    one."""
    open_ = staged(edges)
    roots = open_.select(F.col("before").alias("node")).distinct()
    done = roots.join(open_.select("node").distinct(), "node", "left_anti")
    done = staged(done.select("node", F.lit(0).alias("depth")))
    while True:
        ready = staged(
            join_by_key(open_, done.withColumnRenamed("node", "before"), ["before"], "left")
            .groupBy("node")
            .agg((F.max("depth") + 1).alias("depth"), F.every(F.col("depth").isNotNull()).alias("all"))
            .where("all")
            .drop("all")
        )
        if ready.isEmpty():
            return done
        done = staged(done.unionByName(ready))
        open_ = staged(open_.join(ready.select("node"), "node", "left_anti"))


def _ordered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, at, depth) of every node, depth -1 in a cycle; edges are (node, before)."""
    turns = nodes.select(F.col("node").alias("before"), F.col("turn").alias("before_turn"))
    timed = staged(join_by_key(join_by_key(edges, nodes, ["node"]), turns, ["before"]))
    moved = _moved(timed)
    placed = join_by_key(nodes, moved, ["node"], "left").select(
        "node", F.coalesce("at", "turn").alias("at")
    )
    befores = moved.select(F.col("node").alias("before"), F.col("at").alias("before_at"))
    level = (
        join_by_key(join_by_key(timed, moved, ["node"], "left"), befores, ["before"], "left")
        .where(F.coalesce("at", "turn") == F.coalesce("before_at", "before_turn"))
        .select("node", "before")
    )
    level = staged(level)
    depths = _depths(level)
    chained = staged(
        level.select("node").unionByName(level.select(F.col("before").alias("node"))).distinct()
    )
    depth = join_by_key(chained, depths, ["node"], "left").select(
        "node", F.coalesce("depth", F.lit(-1)).alias("depth")
    )
    return join_by_key(placed, depth, ["node"], "left").select(
        "node", "at", F.coalesce("depth", F.lit(0)).alias("depth")
    )


def link(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per message: (conv_id, turn, role, call_id, at, depth, state, valid, faults,
    json). ``state``: plain, call, unanswered, result, orphan, repeated or cyclic."""
    rows = staged(_formatted(messages, schemas))
    nodes = rows.dropDuplicates(["node"])
    conv = F.xxhash64(F.col("conv_id").isNull(), "conv_id").alias("conv")
    call = nodes.select(conv, "node", "turn", F.explode("ids").alias("id"))
    result = nodes.where("call_id is not null").select(
        conv, "node", "turn", F.col("call_id").alias("id")
    )
    first = F.min(F.struct("turn", "node"))
    callers = call.groupBy("conv", "id").agg(first.alias("caller"))
    answers = result.groupBy("conv", "id").agg(first.alias("answer"))
    called = join_by_key(result, callers, ["conv", "id"], "left")
    called = join_by_key(called, answers, ["conv", "id"])
    results = called.select(
        "node",
        F.col("caller.node").alias("before"),
        F.when(F.col("caller").isNull(), "orphan")
        .when(F.col("answer.node") != F.col("node"), "repeated")
        .otherwise("result")
        .alias("result_state"),
    )
    results = staged(results)
    answered = (
        join_by_key(call, answers, ["conv", "id"], "left")
        .groupBy("node")
        .agg(F.every(F.col("answer").isNotNull()).alias("answered"))
    )
    need = nodes.select(conv, "node", F.explode(F.array_distinct("needs")).alias("id"))
    needed = staged(join_by_key(need, answers, ["conv", "id"], "left").select(
        "node", "id", F.col("answer.node").alias("before")
    ))
    missing = (
        needed.where("before is null")
        .groupBy("node")
        .agg(F.sort_array(F.collect_set(F.concat(F.lit("no result "), "id"))).alias("missing"))
    )
    edges = (
        results.where("before is not null").select("node", "before")
        .unionByName(needed.where("before is not null").select("node", "before"))
        .distinct()
    )
    order = _ordered(nodes.select("node", "turn"), edges)
    out = rows
    for side in (order, results.select("node", "result_state"), answered, missing):
        out = join_by_key(out, side, ["node"], "left")
    problems = F.concat("faults", F.coalesce("missing", F.array().cast("array<string>")))
    return out.select(
        "conv_id",
        "turn",
        "role",
        "call_id",
        "at",
        "depth",
        F.when(F.col("depth") < 0, "cyclic")
        .when(F.col("result_state").isNotNull(), F.col("result_state"))
        .when(F.col("answered"), "call")
        .when(~F.col("answered"), "unanswered")
        .otherwise("plain")
        .alias("state"),
        (F.size(problems) == 0).alias("valid"),
        problems.alias("faults"),
        "json",
    )
