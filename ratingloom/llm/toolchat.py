"""Chat formatting with tool calls: link, order, validate, serialise.

Calls and results meet in a hash join on conversation and call id. Calls may name calls
they depend on; a call's level is the length of the longest chain of calls before it,
so sorting a conversation by (level, turn) is a topological order. Chains of calls that
each depend on one are passed by doubling pointers, in rounds as many as the logarithm of
their length; calls with several dependencies are settled in rounds once all of those are.
Arguments are checked against the tool's schema, and every message becomes one line of
canonical JSON: keys sorted, no blanks, no ASCII escapes.

No step gathers a conversation: one of any length is spread over tasks, and a hot one is
dealt anew before each join.

Results, by ``status``: ``linked`` or ``unanswered`` calls; ``repeated`` for a call
whose id an earlier turn of the conversation has taken; ``cycle`` (level null) for calls
that wait on themselves; ``linked`` or ``orphan`` results. A dependency on an unknown
call is passed over. Null ids, names, arguments and contents are allowed: a call without
id is ``unanswered`` and a result without id an ``orphan``; null arguments are ``{}``;
arguments that are no JSON object are invalid and kept as text, and so is what only lenient
readers take for JSON (NaN, repeated keys, half surrogates, numbers beyond the doubles, endless
nesting). Rows that repeat give repeated rows. Other columns of the tables are not looked at.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import lookup_join, shared_root, written

#: Either parameter name to (type, required), or a JSON schema of the arguments. Of JSON
#: schema: type, properties, required, additionalProperties, items, enum, minimum, maximum.
Schema = Mapping[str, object]
_TYPES = {
    "string": str,
    "integer": int,
    "number": (int, float),
    "boolean": bool,
    "array": list,
    "object": dict,
    "null": type(None),
}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _finite(text: str) -> float:
    if not math.isfinite(value := float(text)):
        raise ValueError(f"{text} is no finite number")
    return value


def _refused(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


def _distinct(pairs: list[tuple[str, object]]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a key repeats")
    return found


def parsed(text: str) -> tuple[object, str]:
    """The value of strict JSON and its canonical form; ValueError for anything else.

    No NaN or infinity, no number beyond the doubles, no repeated key, no half of a
    surrogate pair, and no nesting deeper than Python can follow.
    """
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_refused, object_pairs_hook=_distinct)
        form = canonical(value)
    except RecursionError:
        raise ValueError("nested too deep") from None
    form.encode()
    return value, form


def _rule(schema: Schema) -> Mapping[str, object]:
    """The schema as JSON schema; names with (type, required) take no other names."""
    if not all(isinstance(value, tuple) for value in schema.values()):
        return schema
    return {
        "type": "object",
        "properties": {name: {"type": kind} for name, (kind, _) in schema.items()},
        "required": [name for name, (_, required) in schema.items() if required],
        "additionalProperties": False,
    }


def _is(value: object, kind: str) -> bool:
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind]) and (kind == "boolean" or not isinstance(value, bool))


def faults(value: object, rule: Mapping[str, object], at: str = "") -> list[str]:
    """What the rule finds wrong, with the place of each fault as a path."""
    name, kinds = at or "arguments", rule.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_is(value, kind) for kind in kinds):
            return [f"{name} is not {' or '.join(kinds)}"]
    found = []
    if "enum" in rule and canonical(value) not in map(canonical, rule["enum"]):
        found.append(f"{name} is not one of {canonical(rule['enum'])}")
    if _is(value, "number"):
        if "minimum" in rule and value < rule["minimum"]:
            found.append(f"{name} is below {rule['minimum']}")
        if "maximum" in rule and value > rule["maximum"]:
            found.append(f"{name} is above {rule['maximum']}")
    if isinstance(value, dict):
        known, below = rule.get("properties", {}), f"{at}." if at else ""
        for key in sorted({*known, *rule.get("required", ())}):
            if key in value:
                found += faults(value[key], known.get(key, {}), below + key)
            elif key in rule.get("required", ()):
                found.append(f"missing {below}{key}")
        others = rule.get("additionalProperties", True)
        for key in sorted(set(value) - set(known)):
            if others is False:
                found.append(f"unexpected {below}{key}")
            elif others is not True:
                found += faults(value[key], others, below + key)
    if isinstance(value, list) and "items" in rule:
        for i, item in enumerate(value):
            found += faults(item, rule["items"], f"{at}[{i}]")
    return found


def check_arguments(name: str | None, arguments: str | None, schemas: Mapping[str, Schema]) -> tuple[str, str]:
    """The arguments in canonical form and what is wrong with them (empty: nothing)."""
    try:
        value, form = parsed(arguments or "{}")
    except ValueError:
        return arguments or "", "not JSON"
    if not isinstance(value, dict):
        return form, "not an object"
    schema = schemas.get(name or "")
    if schema is None:
        return form, "unknown tool"
    return form, "; ".join(faults(value, _rule(schema)))


def _node(call_id: Column | str) -> Column:
    """One key for conversation and call id; null without an id."""
    call_id = F.col(call_id) if isinstance(call_id, str) else call_id
    return F.when(
        call_id.isNotNull(), F.to_json(F.array(F.col("conv_id").cast("string"), call_id.cast("string")))
    )


def _chains(single: DataFrame) -> DataFrame:
    """node, to, far and endless of nodes (node, needs) that each need just one other.

    ``to`` is the first node down the chain that does not need just one, ``far`` links away.
    Pointers double in each round, so a chain of n links takes log n of them. Where no
    fewer nodes move than in the round before, those that do are on, or behind, a cycle.
    """
    one = F.lit(1).cast("long")
    at = written(single.select("node", F.col("needs").alias("to"), one.alias("far")), "chains")
    before = None
    while True:
        ahead = at.select(
            F.col("node").alias("to"), F.col("to").alias("next"), F.col("far").alias("more")
        )
        at = written(
            lookup_join(at, ahead, "to", "node").select(
                "node",
                F.coalesce("next", "to").alias("to"),
                (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
                F.col("next").isNotNull().alias("endless"),
            ),
            "chains",
        )
        moved = at.where("endless").count()
        if moved in (0, before):
            return at
        before = moved


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node and level of every node that is not on, or behind, a cycle.

    ``nodes`` has distinct nodes; distinct ``edges`` (node, needs) point to some of them.
    Chains are passed at once. Then a round settles each node of several needs whose needs
    are settled; the rounds' results are one table, so the plan does not grow with them.
    """
    spark = nodes.sparkSession
    per = written(
        edges.groupBy("node").agg(F.count("*").alias("n"), F.min("needs").alias("needs")), "needs"
    )
    chains = _chains(per.where("n = 1"))
    ends = chains.where("NOT endless")
    many = per.where("n > 1").select("node", F.lit(True).alias("many"))
    past = ends.select(F.col("node").alias("needs"), "to", "far")
    waiting = written(
        lookup_join(
            lookup_join(edges, many, "node", "needs", how="inner").select("node", "needs"),
            past,
            "needs",
            "node",
        ).select(
            "node",
            F.coalesce("to", "needs").alias("needs"),
            (1 + F.coalesce("far", F.lit(0))).alias("far"),
        ),
        "waiting",
    )
    folder = f"{shared_root(spark)}/settled-{uuid.uuid4().hex}"
    form = f"node {nodes.schema['node'].dataType.simpleString()}, level long"

    def kept(found: DataFrame, round_: int) -> DataFrame:
        found.write.parquet(f"{folder}/{round_}")
        return spark.read.schema(form).parquet(f"{folder}/{round_}")

    start = F.lit(0).cast("long")
    settled = kept(nodes.join(per, "node", "left_anti").select("node", start.alias("level")), 0)
    best = settled.limit(0)  # the highest level so far of nodes that still wait
    round_ = 0
    while not waiting.isEmpty() and not settled.isEmpty():
        round_ += 1
        reached = settled.select(F.col("node").alias("needs"), "level")
        found = written(
            lookup_join(waiting, reached, "needs", "node").select(
                "node", "needs", "far", (F.col("level") + F.col("far")).alias("level")
            ),
            "found",
        )
        state = written(
            found.select("node", "level", F.col("level").isNull().alias("waits"))
            .unionByName(best.withColumn("waits", F.lit(False)))
            .groupBy("node")
            .agg(F.max("level").alias("level"), F.max("waits").alias("waits")),
            "state",
        )
        settled = kept(state.where("NOT waits").select("node", "level"), round_)
        best = state.where("waits AND level IS NOT NULL").select("node", "level")
        waiting = found.where("level IS NULL").select("node", "needs", "far")
    settled = spark.read.schema(form).option("recursiveFileLookup", True).parquet(folder)
    base = settled.select(F.col("node").alias("to"), "level")
    chained = lookup_join(ends, base, "to", "node", how="inner").select(
        "node", (F.col("level") + F.col("far")).alias("level")
    )
    return settled.unionByName(chained).withColumn("level", F.col("level").cast("int"))


def _lines(frame: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """The linked rows with arguments_error and json."""
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    kept = [c for c in frame.columns if c not in ("name", "arguments", "content", "role")]
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", arguments_error string, json string"

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, lines = [], []
            for row in batch.select(["kind", "role", "call_id", "name", "arguments", "content"]).to_pylist():
                error, line = None, {"role": row["role"], "content": row["content"]}
                if row["kind"] == "call":
                    text, error = check_arguments(row["name"], row["arguments"], schemas)
                    function = {"name": row["name"], "arguments": text}
                    call = {"id": row["call_id"], "type": "function", "function": function}
                    line = {"role": row["role"], "content": row["content"], "tool_calls": [call]}
                elif row["kind"] == "result":
                    line["tool_call_id"] = row["call_id"]
                errors.append(error)
                lines.append(canonical(line))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).columns, pa.array(errors, pa.string()), pa.array(lines, pa.string())],
                [*kept, "arguments_error", "json"],
            )

    return frame.mapInArrow(serialise, schema)


def format_messages(
    messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]
) -> DataFrame:
    """One row per message, call and result: conv_id, turn, kind, call_id, level, status,
    arguments_error and json. Sort a conversation by (level, turn, kind) to replay it.

    ``messages``: conv_id, turn, role, content. ``calls``: conv_id, turn, call_id, name,
    arguments, depends_on (array of call ids), content. ``results``: conv_id, turn,
    call_id, content. Messages take the level of their turn: null.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on", "content")
    calls = written(calls.withColumn("node", _node("call_id")), "calls")
    results = results.select("conv_id", "turn", "call_id", "content")
    results = written(results.withColumn("node", _node("call_id")), "results")
    known = written(
        calls.where("node IS NOT NULL").groupBy("node").agg(F.min("turn").alias("first_turn")), "known-calls"
    )
    asked = calls.where("node IS NOT NULL").select("node", "conv_id", F.explode("depends_on").alias("dep"))
    asked = asked.select("node", _node("dep").alias("needs")).where("needs IS NOT NULL AND needs != node")
    wanted = known.select(F.col("node").alias("needs"), F.lit(True).alias("there"))
    edges = lookup_join(asked.distinct(), wanted, "needs", "node", how="inner").select("node", "needs")
    own = asked_self(calls)
    if not own.isEmpty():
        edges = edges.unionByName(own)
    placed = known.join(written(levels(known.select("node"), edges), "levels"), "node", "left")
    answered = results.where("node IS NOT NULL").select("node").distinct()
    placed = written(
        placed.join(answered.withColumn("answered", F.lit(True)), "node", "left"), "placed-calls"
    )

    call_rows = lookup_join(calls, placed, "node", "turn")
    status = (
        F.when(F.col("node").isNull(), "unanswered")
        .when(F.col("turn") > F.col("first_turn"), "repeated")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("answered"), "linked")
        .otherwise("unanswered")
    )
    call_rows = call_rows.select(
        "conv_id",
        "turn",
        F.lit("call").alias("kind"),
        "call_id",
        "level",
        status.alias("status"),
        F.lit("assistant").alias("role"),
        "name",
        "arguments",
        "content",
    )
    none = F.lit(None).cast("string")
    result_rows = lookup_join(results, placed, "node", "turn").select(
        "conv_id",
        "turn",
        F.lit("result").alias("kind"),
        "call_id",
        "level",
        F.when(F.col("first_turn").isNull(), "orphan").otherwise("linked").alias("status"),
        F.lit("tool").alias("role"),
        none.alias("name"),
        none.alias("arguments"),
        "content",
    )
    message_rows = messages.select(
        "conv_id",
        "turn",
        F.lit("message").alias("kind"),
        none.alias("call_id"),
        F.lit(None).cast("int").alias("level"),
        none.alias("status"),
        "role",
        none.alias("name"),
        none.alias("arguments"),
        "content",
    )
    return _lines(message_rows.unionByName(call_rows).unionByName(result_rows), schemas)


def asked_self(calls: DataFrame) -> DataFrame:
    """Edges of calls that name themselves: they wait for ever."""
    return (
        calls.where("node IS NOT NULL AND array_contains(depends_on, call_id)")
        .select("node", F.col("node").alias("needs"))
        .distinct()
    )
