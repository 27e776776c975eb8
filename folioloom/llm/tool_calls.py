"""Chat formatting: tool-call linking.

Messages are calls and results of tools; an identifier belongs to its conversation. Calls of one
identifier are folded to the first by turn, results to a list by turn, so each side of the hash join has one
row for an identifier and none is hot. Calls name the calls of their conversation they depend on; each gets a
level, one more than the highest it depends on, and their order is (level, turn, call_id). Arguments are
checked against the tool's schema, and every linked call becomes one line of canonical JSON: keys sorted, no
spaces, text unescaped where JSON allows; several results are a list in their order.

Levels are found in blocks: the calls of a conversation in a range of turns, and where these are more than
`BLOCK` their parts by hash. In a round each block orders all of its calls that do not wait for other blocks, in one
linear pass, however long their chains; then the levels found go to the calls of other blocks that wait for them. A
conversation of ordinary size is one block and takes one round, whatever its graph; a chain takes one more round each
time it leaves a block. Rounds are written tables and hold only what is still open. Names of calls that do not
exist hold nothing up.

Defined results: a call without a result is `unanswered`, a result without a call `orphan`, calls
that wait for each other `cyclic` with a null level, messages with a null identifier `no id`, one
row each, and others `linked`. Messages without a conversation are one conversation. `n_calls` and `n_results` count
what was folded. Null or broken arguments and tools without a schema are errors of that call, not of the job. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import math
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import drop, ship, stored, tidy

TURNS = 4096  # of a conversation that may lie in one block
BLOCK = 50_000  # calls in a block, about
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def is_kind(value, kind: str) -> bool:
    if kind == "integer":
        return not isinstance(value, bool) and (isinstance(value, int) or isinstance(value, float) and value.is_integer())
    if kind == "number":
        return not isinstance(value, bool) and isinstance(value, (int, float))
    return isinstance(value, KINDS[kind])


def faults(value, schema: dict, place: str = "$") -> list[str]:
    """What a value has against a JSON schema, of which this knows: type, enum, required,
    properties, additionalProperties (true or false), items, minimum, maximum, minLength, maxLength."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_kind(value, k) for k in kinds):
        return [f"{place}: not of type {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{place}: not one of the allowed values")
    if is_kind(value, "number"):
        if "minimum" in schema and value < schema["minimum"]:
            found.append(f"{place}: less than {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            found.append(f"{place}: more than {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            found.append(f"{place}: shorter than {schema['minLength']}")
        if len(value) > schema.get("maxLength", math.inf):
            found.append(f"{place}: longer than {schema['maxLength']}")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += faults(item, schema["items"], f"{place}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{place}.{key}: missing" for key in sorted(schema.get("required", [])) if key not in value]
        for key in sorted(value):
            if key in known:
                found += faults(value[key], known[key], f"{place}.{key}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{place}.{key}: unknown")
    return found


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def by_turn(turn: str = "turn"):
    """Messages without a turn come last."""
    return F.coalesce(turn, F.lit((1 << 63) - 1)).alias("order")


def waits_of(calls: DataFrame) -> DataFrame:
    """calls with `range`, `part` (their block) and `needs`: the calls of the conversation they wait for."""
    ranged = calls.withColumn("range", F.expr(f"coalesce(turn, 0) div {TURNS}"))
    parts = ranged.groupBy("conv", "range").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    nodes = ranged.join(parts, ["conv", "range"]).withColumn(
        "part", F.pmod(F.xxhash64("call_id"), "parts")).select("conv", "call_id", "range", "part", "depends_on")
    asked = nodes.select("conv", "call_id", F.explode(F.array_distinct("depends_on")).alias("needs"))
    there = nodes.select("conv", F.col("call_id").alias("needs"))
    known = asked.join(there, ["conv", "needs"], "left_semi").groupBy("conv", "call_id").agg(F.collect_list("needs").alias("needs"))
    return nodes.drop("depends_on").join(known, ["conv", "call_id"], "left").withColumn(
        "needs", F.coalesce("needs", F.array().cast("array<string>"))).withColumn("base", F.lit(0).cast("long"))


def levelled(table: pa.Table) -> pa.Table:
    """The calls of one block with their level, null where they wait for other blocks or in a cycle.

    base: one more than the highest level among the calls of other blocks that no longer hold a call up.
    """
    ids, needs, base = (table.column(c).to_pylist() for c in ("call_id", "needs", "base"))
    place = {x: i for i, x in enumerate(ids)}
    followers, waiting, level = [[] for _ in ids], [], list(base)
    for i, names in enumerate(needs):
        waiting.append(len(names))
        for name in names:
            if name in place:
                followers[place[name]].append(i)
    ready = [i for i, n in enumerate(waiting) if not n]
    for i in ready:
        for x in followers[i]:
            level[x] = max(level[x], level[i] + 1)
            waiting[x] -= 1
            if not waiting[x]:
                ready.append(x)
    settled = set(ready)
    return table.append_column("level", pa.array([level[i] if i in settled else None for i in range(len(ids))], pa.int64()))


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level) for every call that no cycle holds up; without a column conv, (call_id, level).

    calls: (call_id, depends_on) and, if there are several conversations, conv and turn.
    """
    whole = calls
    for name, value in (("conv", F.lit("").cast("string")), ("turn", F.lit(0).cast("long"))):
        if name not in calls.columns:
            whole = whole.withColumn(name, value)
    kind = "conv string, call_id string, range long, part long, needs array<string>, base long, level long"
    blank = waits_of(whole.select("conv", "call_id", "turn", "depends_on"))
    still, found = stored(blank.select("conv", "call_id", "range", "part", "needs", "base"), "waits"), []
    while True:
        seen = stored(still.groupBy("conv", "range", "part").applyInArrow(levelled, kind), "levels")
        drop(still)
        fresh = seen.where("level IS NOT NULL").select("conv", "call_id", "level")
        found.append(fresh)
        left = seen.where("level IS NULL").drop("level")
        if fresh.isEmpty() or left.isEmpty():
            break
        answered = left.select("conv", "call_id", F.explode("needs").alias("needs")).join(
            fresh.select("conv", F.col("call_id").alias("needs"), F.col("level").alias("known")), ["conv", "needs"], "left"
        ).groupBy("conv", "call_id").agg(
            F.max(F.col("known") + 1).alias("more"),
            F.filter(F.collect_list(F.when(F.col("known").isNull(), F.col("needs"))), lambda x: x.isNotNull()).alias("open"))
        still = stored(left.join(answered, ["conv", "call_id"]).select(
            "conv", "call_id", "range", "part", F.col("open").alias("needs"),
            F.greatest("base", "more").alias("base")), "waits")
    every = functools.reduce(DataFrame.unionByName, found).withColumn("level", F.col("level").cast("int"))
    return every if "conv" in calls.columns else every.drop("conv")


@tidy
def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Per conversation and identifier: (conv_id, call_id, turn, name, level, status, n_calls, n_results, valid, errors, json).

    messages: (conv_id, turn, kind, call_id, name, arguments, depends_on, content); kind is `call` or
    `result`, depends_on an array of identifiers, arguments JSON text.
    """
    # Null conversations are one, whose name no other has.
    conv = F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("="), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    inner = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "kind", "call_id", "name",
                            "arguments", "depends_on", "content").withColumn("conv", conv)
    whole = inner.where("call_id IS NOT NULL")
    fields = ["conv_id", "turn", "name", "arguments", "depends_on"]
    calls = stored(whole.where("kind = 'call'").groupBy("conv", "call_id").agg(
        F.min(F.struct(by_turn(), *fields)).alias("first"), F.count("*").alias("n_calls")).select(
        "conv", "call_id", *(F.col(f"first.{c}").alias(c) for c in fields), "n_calls"), "calls")
    results = whole.where("kind = 'result'").groupBy("conv", "call_id").agg(
        F.min("conv_id").alias("answer_conv"), F.min("turn").alias("answer_turn"), F.count("*").alias("n_results"),
        F.array_sort(F.collect_list(F.struct(by_turn(), "content"))).alias("answers")).withColumn(
        "contents", F.col("answers.content")).drop("answers")
    depth = levels(calls.select("conv", "call_id", "turn", "depends_on"))
    joined = calls.join(depth, ["conv", "call_id"], "left").join(results, ["conv", "call_id"], "full")
    status = (F.when(F.col("n_calls").isNull(), "orphan").when(F.col("level").isNull(), "cyclic")
              .when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    rows = joined.select(
        F.coalesce("conv_id", "answer_conv").alias("conv_id"), "call_id", F.coalesce("turn", "answer_turn").alias("turn"),
        "name", "level", status.alias("status"), F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "arguments", "depends_on", "contents")
    call = F.col("kind") == "call"
    bare = inner.where("call_id IS NULL AND kind IN ('call', 'result')").select(
        "conv_id", "call_id", "turn", "name", F.lit(None).cast("int").alias("level"), F.lit("no id").alias("status"),
        call.cast("long").alias("n_calls"), (~call).cast("long").alias("n_results"), "arguments", "depends_on",
        F.array("content").alias("contents"))
    sent = ship(messages.sparkSession, schemas)
    keep = ["conv_id", "call_id", "turn", "name", "level", "status", "n_calls", "n_results"]

    def run(batches):
        known = sent()
        for batch in batches:
            rows = batch.to_pylist()
            checked = [line(row, known) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([not e for e, _ in checked], pa.bool_()),
                 pa.array([e for e, _ in checked], pa.list_(pa.string())), pa.array([j for _, j in checked], pa.string())],
                names=[*keep, "valid", "errors", "json"])

    both = rows.unionByName(bare)
    return both.mapInArrow(run, T.StructType([
        *(both.schema[c] for c in keep), T.StructField("valid", T.BooleanType()),
        T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("json", T.StringType())]))


def line(row: dict, schemas: dict[str, dict]) -> tuple[list[str], str]:
    """Errors of a row's arguments, and the row as canonical JSON."""
    errors, arguments = [], None
    if row["n_calls"]:
        try:
            arguments = json.loads(row["arguments"] or "", parse_constant=no_constant)
            arguments = arguments if math.isfinite(largest(arguments)) else no_constant("an infinite number")
            schema = schemas.get(row["name"])
            errors = [f"no tool named {row['name']}"] if schema is None else faults(arguments, schema)
        except (ValueError, RecursionError):
            errors, arguments = ["$: not JSON"], None
    contents = row["contents"] or [None]
    value = {"arguments": arguments, "id": row["call_id"], "name": row["name"],
             "result": contents[0] if len(contents) == 1 else contents,
             "depends_on": sorted({d for d in row["depends_on"] or () if d is not None})}
    return errors, canonical(value)


def largest(value) -> float:
    """Infinite if any number of the value is."""
    if isinstance(value, dict):
        return max((largest(v) for v in value.values()), default=0.0)
    if isinstance(value, list):
        return max((largest(v) for v in value), default=0.0)
    return abs(value) if isinstance(value, float) else 0.0


cloudpickle.register_pickle_by_value(sys.modules[__name__])
