"""Chat formatting: tool calls linked to their results, in an order that respects what depends on what.

Each turn gives events: a message, the calls it makes, or the result it brings. Calls and results meet in a hash join on
conversation and identifier. A call whose arguments refer to another call's result comes after it; depths follow from
joins along these references, which only referring calls take part in. Arguments are checked against the tool's schema.
Every event is one row of canonical JSON (sorted keys, no spaces, UTF-8), so no conversation is ever gathered into one
row or task: events are sorted over all conversations into ranges, which may cut a conversation, and numbered in each; what
a conversation has in earlier ranges is added. The first event of an identifier is found by partial aggregation.

A call is a member of `tool_calls` of an assistant turn whose text is a JSON object: {"id", "name", "arguments"}.
A result is the text of a `tool` turn that is a JSON object with `tool_call_id`. An argument refers to a result by a
string "$ref:<id>". Any other text is a message as it stands.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from cellframe.llm.base import sf_table, slices
from cellframe.sources.scratch import written

REF = "$ref:"
#: Tools known to the registered query: the checked part of JSON Schema is type, required, properties, items, enum.
SCHEMAS: dict[str, dict[str, Any]] = {
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}},
    "calculate": {"type": "object", "required": ["expression"], "properties": {"expression": {"type": "string"}}},
    "weather": {"type": "object", "required": ["city"], "properties": {"city": {"type": "string"}, "unit": {"enum": ["celsius", "fahrenheit"]}}},
}
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int, "number": (int, float), "null": type(None)}
_EVENT = "conv_id long, turn long, part int, kind string, call_id string, name string, fault string, refs array<string>, json string, uid long"


def canonical(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def fault_of(value: Any, schema: dict[str, Any], at: str = "$") -> str | None:
    """The first fault of a value against a schema, or None. A reference stands for any value."""
    if isinstance(value, str) and value.startswith(REF):
        return None
    if (kind := schema.get("type")) and (not isinstance(value, _TYPES[kind]) or isinstance(value, bool) and kind in ("integer", "number")):
        return f"{at}: not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    if isinstance(value, dict):
        for key in schema.get("required", ()):
            if key not in value:
                return f"{at}.{key}: missing"
        for key, sub in sorted(schema.get("properties", {}).items()):
            if key in value and (fault := fault_of(value[key], sub, f"{at}.{key}")):
                return fault
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            if fault := fault_of(x, schema["items"], f"{at}[{i}]"):
                return fault
    return None


def refs_of(value: Any) -> set[str]:
    if isinstance(value, str):
        return {value[len(REF) :]} if value.startswith(REF) else set()
    children = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return set().union(*map(refs_of, children))


def _object(text: str | None) -> dict[str, Any] | None:
    if not text or not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def events_of(role: str | None, text: str | None, schemas: dict[str, dict[str, Any]]) -> Iterator[tuple]:
    """(part, kind, call_id, name, fault, refs, json) of one turn."""
    value = _object(text) if role in ("assistant", "tool") else None
    if role == "tool" and value is not None and value.get("tool_call_id") is not None:
        call = str(value["tool_call_id"])
        yield 0, "result", call, None, None, [], canonical({"content": value.get("content"), "role": "tool", "tool_call_id": call})
        return
    calls = value.get("tool_calls") if role == "assistant" and value is not None else None
    if not isinstance(calls, list):
        yield 0, "message", None, None, None, [], canonical({"content": text, "role": role})
        return
    yield 0, "message", None, None, None, [], canonical({"content": value.get("content"), "role": role})
    for i, c in enumerate(calls, 1):
        c = c if isinstance(c, dict) else {}
        name, args = c.get("name"), c.get("arguments")
        if isinstance(args, str):
            try:
                args = json.loads(args)
            except (ValueError, RecursionError):
                pass
        call = None if c.get("id") is None else str(c["id"])
        known = isinstance(name, str) and name in schemas
        fault = "no identifier" if call is None else "unknown tool" if not known else fault_of(args, schemas[name])
        yield i, "call", call, name if isinstance(name, str) else None, fault, sorted(refs_of(args)), canonical({"arguments": args, "id": call, "name": name, "role": "assistant"})


def _events(turns: DataFrame, schemas: dict[str, dict[str, Any]]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
        names = [x.split()[0] for x in _EVENT.split(", ")]
        uid = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = [(conv, turn, *e) for conv, turn, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True) for e in events_of(role, text, schemas)]
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.record_batch([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array(range(uid, uid + len(rows)), pa.int64())], names=names)
            uid += len(rows)

    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).mapInArrow(run, _EVENT)


def _depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth, at: of calls (conv_id, call_id, turn, refs), the longest chain of references below, and
    the turn from which the call can stand. Calls of a cycle, and what refers to them, get depth -1.

    A round settles the calls whose references are all settled; rounds are as many as the longest chain.
    """
    plain = calls.where(F.size("refs") == 0).select("conv_id", "call_id", F.lit(0).alias("depth"), F.col("turn").alias("at"))
    edges = calls.where(F.size("refs") > 0).select("conv_id", "call_id", "turn", F.explode("refs").alias("ref"))
    known = calls.select("conv_id", F.col("call_id").alias("ref"))
    # A reference to a call that doesn't exist binds nothing.
    edges = written(edges.join(known, ["conv_id", "ref"], "left_semi"), "refs")
    bound = edges.select("conv_id", "call_id").distinct()
    free = calls.where(F.size("refs") > 0).join(bound, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.lit(0).alias("depth"), F.col("turn").alias("at"))
    done = plain.unionByName(free)
    if not edges.limit(1).count():
        return done
    # Only settled calls that something refers to take part.
    named = edges.select("conv_id", F.col("ref").alias("call_id")).distinct()
    settled, out = written(done.join(named, ["conv_id", "call_id"], "left_semi"), "settled"), done
    while True:
        below = edges.join(settled.select("conv_id", F.col("call_id").alias("ref"), "depth", "at"), ["conv_id", "ref"], "left")
        new = below.groupBy("conv_id", "call_id").agg(F.max("turn").alias("turn"), F.count("*").alias("n"), F.count("depth").alias("m"), F.max("depth").alias("depth"), F.max("at").alias("at")).where("n = m")
        new = written(new.select("conv_id", "call_id", (F.col("depth") + 1).alias("depth"), F.greatest("turn", "at").alias("at")), "settled")
        if not new.limit(1).count():
            break
        out, settled = out.unionByName(new), settled.unionByName(new)
        edges = written(edges.join(new, ["conv_id", "call_id"], "left_anti"), "refs")
    rest = edges.groupBy("conv_id", "call_id").agg(F.max("turn").alias("at")).select("conv_id", "call_id", F.lit(-1).alias("depth"), "at")
    return out.unionByName(rest)


def linked(turns: DataFrame, schemas: dict[str, dict[str, Any]] | None = None) -> DataFrame:
    """conv_id, turn, part, kind, call_id, depth, status, position, json: one row for each event.

    position counts 0, 1, 2, ... in the conversation: by the turn from which an event can stand, then depth, calls
    before results, then turn and part. status: `ok`; for calls also `invalid: <fault>`, `no_result`, `cycle`, and
    `repeated_id` for all but the first call of an identifier; for results `orphan` without a call and `repeated_result`
    for all but the first. A result before its call in the table is placed after it.
    Nulls: a null conv_id is a conversation of its own, a null turn comes first, null roles and texts are written as
    JSON null, calls without identifier link with nothing. Empty texts are messages. Rows that repeat are events each.
    Columns beyond conv_id, turn, role and text are ignored. An empty table gives an empty result.
    """
    events = written(_events(turns, SCHEMAS if schemas is None else schemas), "events")
    plain = events.where("kind = 'message' OR call_id IS NULL OR conv_id IS NULL")
    tools = events.where("kind <> 'message' AND call_id IS NOT NULL AND conv_id IS NOT NULL")
    firsts = tools.groupBy("kind", "conv_id", "call_id").agg(F.min(F.struct("turn", "part", "json", "uid"))["uid"].alias("uid"))
    firsts = written(firsts.select("uid", F.lit(True).alias("first")), "firsts")
    tools = tools.join(firsts, "uid", "left")
    calls, results = tools.where("kind = 'call'"), tools.where("kind = 'result'")
    first = written(calls.where("first"), "calls")
    depths = written(_depths(first.select("conv_id", "call_id", F.coalesce("turn", F.lit(-1)).alias("turn"), "refs")), "depths")
    answered = results.where("first").select("conv_id", "call_id", F.lit(True).alias("answered"))
    one = first.join(depths.hint("shuffle_hash"), ["conv_id", "call_id"], "left").join(answered.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    status = F.when(F.col("depth") == -1, "cycle").when(F.col("fault").isNotNull(), F.concat(F.lit("invalid: "), F.col("fault"))).when(F.col("answered").isNull(), "no_result").otherwise("ok")
    keep = ("conv_id", "turn", "part", "kind", "call_id", "json", "uid")
    turn = F.coalesce("turn", F.lit(-1))
    rows = one.select(*keep, "depth", "at", status.alias("status"))
    rows = rows.unionByName(calls.where("first IS NULL").select(*keep, F.lit(0).alias("depth"), turn.alias("at"), F.lit("repeated_id").alias("status")))
    met = results.join(depths.withColumnRenamed("at", "since").hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    status = F.when(F.col("since").isNull(), "orphan").when(F.col("first").isNull(), "repeated_result").otherwise("ok")
    rows = rows.unionByName(met.select(*keep, F.coalesce("depth", F.lit(0)).alias("depth"), F.greatest(turn, F.coalesce("since", turn)).alias("at"), status.alias("status")))
    status = F.when(F.col("kind") == "message", "ok").when(F.col("kind") == "result", "orphan").otherwise(F.concat(F.lit("invalid: "), F.coalesce("fault", F.lit("no conversation"))))
    rows = rows.unionByName(plain.select(*keep, F.lit(0).alias("depth"), turn.alias("at"), status.alias("status")))

    # Messages of a turn first, then calls by depth, each before its result; a cycle's calls last.
    depth = F.when(F.col("depth") < 0, 1 << 30).otherwise(F.col("depth"))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    order = [key, F.col("at"), F.col("kind") != "message", depth, F.col("kind") == "result", *map(F.col, ("turn", "part", "json", "uid"))]
    numbered = _numbered(written(rows, "rows").withColumn("key", key), order)
    return numbered.select("conv_id", "turn", "part", "kind", "call_id", F.col("depth").cast("int"), "status", "position", "json")


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with `position`: 0, 1, 2, ... for each `key` by order, whose first part is the key and last part is unique.

    Only keys at the ends of a range can go on in another; their counts, two at most for each range, are broadcast.
    """
    schema = StructType([*rows.schema.fields, StructField("range", IntegerType()), StructField("row", LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for k in batch["key"].to_pylist():
                count = count + 1 if k == last else 0
                last = k
                at.append(count)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([here] * len(at), pa.int32()), pa.array(at, pa.int64())], names=schema.names)

    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    done = written(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(run, schema), "numbered")
    ends = done.groupBy("range").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    counts = done.select("range", "key").join(F.broadcast(ends), "range").where("key = lo OR key = hi").groupBy("key", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("key", "range", F.sum("n").over(before).alias("offset"))
    return done.join(F.broadcast(offsets), ["key", "range"], "left").withColumn("position", (F.coalesce("offset", F.lit(0)) + F.col("row")).cast("long"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(sf_table(spark, sf_dir, "conversations"))
