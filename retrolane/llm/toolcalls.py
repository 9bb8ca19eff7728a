"""Tool-call linking: calls and results joined by identifier, ordered, validated and serialised.

Calls and results are rows. A result finds its call by a hash join on (conversation, identifier).
Calls may name other calls whose results they need; a call's level is one more than the highest
level it waits for, found by rounds of joins over the calls that are still open, so (level, turn) is
a topological order. Calls of a cycle, or that wait for one, have no level. Arguments are held
against the schema of the tool's name; every row ends as canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.llm.common import stage

# How JSON Schema names the kinds of values.
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value: object) -> str:
    """JSON with sorted keys and no spaces; non-finite numbers become null."""

    def clean(x: object) -> object:
        if isinstance(x, float) and not math.isfinite(x):
            return None
        if isinstance(x, dict):
            return {str(k): clean(v) for k, v in x.items()}
        return [clean(v) for v in x] if isinstance(x, list) else x

    return json.dumps(clean(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _is(value: object, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, KINDS[kind])


def faults(value: object, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a schema: type, enum, const, properties, required, additionalProperties, items and bounds."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{at}: type"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        found.append(f"{at}: enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        found.append(f"{at}: const")
    if _is(value, "number"):
        found += [f"{at}: minimum"] * (value < schema.get("minimum", -math.inf))
        found += [f"{at}: maximum"] * (value > schema.get("maximum", math.inf))
    if isinstance(value, str):
        found += [f"{at}: minLength"] * (len(value) < schema.get("minLength", 0))
        found += [f"{at}: maxLength"] * (len(value) > schema.get("maxLength", math.inf))
    if isinstance(value, list):
        for i, item in enumerate(value) if isinstance(schema.get("items"), dict) else ():
            found += faults(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: required" for name in schema.get("required", []) if name not in value]
        for name, item in value.items():
            if name in known:
                found += faults(item, known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: additional")
    return found


def parsed(text: Column, role: Column) -> tuple[Column, Column]:
    """Calls and the answered identifier that a message's text names in JSON.

    A call message holds {"tool_calls": [{"id", "name", "arguments", "after"}]}, a result message
    {"tool_call_id", "content"}; other texts hold neither. arguments is JSON text or an object.
    """
    call = "array<struct<id:string,name:string,arguments:string,after:array<string>>>"
    shape = F.from_json(text, f"tool_calls {call}, tool_call_id string")
    return shape["tool_calls"], F.when(role == "tool", shape["tool_call_id"])


def calls_and_results(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The call and result rows of messages (conv_id, turn, role, text) whose texts are JSON."""
    calls, answered = parsed(F.col("text"), F.col("role"))
    calls = messages.select("conv_id", "turn", F.explode(calls).alias("c"))
    calls = calls.select("conv_id", "turn", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "c.after")
    results = messages.select("conv_id", "turn", answered.alias("call_id"), F.get_json_object("text", "$.content").alias("content"))
    return calls, results.where("call_id is not null")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id, after); level is null in and behind cycles.

    Identifiers named in `after` that no call has are ignored. The number of rounds is the length of the longest chain.
    """
    ids = calls.select("conv_id", "call_id").distinct()
    needs = calls.select("conv_id", "call_id", F.explode("after").alias("need")).where("need is not null").distinct()
    needs = needs.join(ids.withColumnRenamed("call_id", "need"), ["conv_id", "need"])
    needs = stage(needs, "needs")
    blocked = needs.select("conv_id", "call_id").distinct()
    done = stage(ids.join(blocked, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0)), "levels")
    open_, level = needs, 0
    found = [done]
    while not open_.isEmpty():
        last = found[-1].select("conv_id", F.col("call_id").alias("need"))
        met = open_.join(last.withColumn("met", F.lit(1)), ["conv_id", "need"], "left")
        met = stage(met, "needs")
        ready = met.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.count("met").alias("k")).where("n = k")
        level += 1
        ready = stage(ready.select("conv_id", "call_id", F.lit(level).alias("level")), "levels")
        if ready.isEmpty() and met.where("met is not null").isEmpty():
            break
        left = met.where("met is null").select("conv_id", "need", "call_id")
        open_ = stage(left, "needs")
        found.append(ready)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return ids.join(out, ["conv_id", "call_id"], "left")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call and per result, in an order that (level, turn, kind, call_id) sorts topologically.

    calls: conv_id, turn, call_id, name, arguments (JSON text), after (call_ids); results: conv_id, turn,
    call_id, content. Returns conv_id, turn, kind, call_id, level, linked, valid, faults, json.

    linked says whether a call has a result and a result has a call. A result has its call's level. Of calls
    that repeat an identifier in a conversation the one of the lowest turn (then name, arguments) counts, the
    others have the fault "repeated". Rows without conversation or identifier link with nothing; null or
    broken arguments have the fault "json", names without schema the fault "schema". Extra columns are ignored.
    """
    keys = ["conv_id", "call_id"]
    after = F.coalesce(F.col("after"), F.array().cast("array<string>"))
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", after.alias("after"))
    first = calls.where("conv_id is not null and call_id is not null").groupBy(*keys)
    first = stage(first.agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("first")), "calls")
    order = levels(first.select(*keys, "first.after"))
    answered = results.where("conv_id is not null and call_id is not null").groupBy(*keys).agg(F.count("*").alias("answers"))
    known = stage(first.join(order, keys, "left").join(answered, keys, "left"), "known")
    mine = calls.join(known, keys, "left")
    same = F.struct("turn", "name", "arguments", "after").eqNullSafe(F.col("first"))
    rows = mine.select(
        "conv_id",
        "turn",
        F.lit("call").alias("kind"),
        "call_id",
        F.col("level").cast("long"),
        (F.coalesce("answers", F.lit(0)) > 0).alias("linked"),
        F.coalesce(~same, F.lit(False)).alias("repeated"),
        F.col("name"),
        F.col("arguments").alias("body"),
    )
    told = results.join(known.select(*keys, F.col("level").cast("long"), F.col("first.name").alias("name")), keys, "left")
    rows = rows.unionByName(
        told.select(
            "conv_id",
            "turn",
            F.lit("result").alias("kind"),
            "call_id",
            "level",
            F.col("name").isNotNull().alias("linked"),
            F.lit(False).alias("repeated"),
            "name",
            F.col("content").alias("body"),
        )
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for row in batch.select(["kind", "call_id", "repeated", "name", "body"]).to_pylist():
                wrong = ["repeated"] if row["repeated"] else []
                said = {"id": row["call_id"], "name": row["name"]}
                if row["kind"] == "call":
                    try:
                        said["arguments"] = json.loads(row["body"] or "")
                        schema = schemas.get(row["name"])
                        wrong += ["schema"] if schema is None else faults(said["arguments"], schema)
                    except (ValueError, RecursionError):
                        said["arguments"] = row["body"]
                        wrong.append("json")
                else:
                    said["content"] = row["body"]
                texts.append(canonical(said))
                found.append(wrong)
            kept = [batch.column(name) for name in ("conv_id", "turn", "kind", "call_id", "level", "linked")]
            valid = pa.array([not wrong for wrong in found], pa.bool_())
            columns = [*kept, valid, pa.array(found, pa.list_(pa.string())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["conv_id", "turn", "kind", "call_id", "level", "linked", "valid", "faults", "json"]
    schema = "conv_id long, turn long, kind string, call_id string, level long, linked boolean, valid boolean"
    return rows.mapInArrow(written, f"{schema}, faults array<string>, json string")


# The schema that the registered query holds every derived call against.
REPLY = {
    "type": "object",
    "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 1500}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["text", "turn"],
    "additionalProperties": False,
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: a turn of the user asks, the assistant's next turn answers it.

    Each call needs the conversation's first user turn, if that is another one.
    """
    name = F.concat(F.lit("c"), F.col("turn"))
    asked = conversations.where("role = 'user'")
    opening = asked.groupBy("conv_id").agg(F.min("turn").alias("opening"))
    asked = asked.join(opening, "conv_id", "left")
    after = F.when(F.col("opening") < F.col("turn"), F.array(F.concat(F.lit("c"), F.col("opening"))))
    body = F.to_json(F.struct("text", "turn"), {"ignoreNullFields": "false"})
    calls = asked.select("conv_id", "turn", name.alias("call_id"), F.lit("reply").alias("name"), body.alias("arguments"), after.alias("after"))
    told = conversations.where("role = 'assistant'")
    results = told.select("conv_id", "turn", F.concat(F.lit("c"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


ORACLE = """
with asked as (
  select c.conv_id, turn, 'c' || turn as call_id, text, min(turn) over (partition by c.conv_id) as opening
  from conversations c where role = 'user'),
told as (select conv_id, turn, 'c' || (turn - 1) as call_id, text from conversations where role = 'assistant'),
answers as (select distinct conv_id, call_id from told)
select a.conv_id, a.turn, 'call' as kind, a.call_id, (a.turn > a.opening)::bigint as level, w.call_id is not null as linked,
  coalesce(length(a.text), 0) between 1 and 1500 and a.turn >= 0 as valid,
  '{"arguments":{"text":' || coalesce(to_json(a.text)::varchar, 'null') || ',"turn":' || a.turn || '},"id":"' || a.call_id
    || '","name":"reply"}' as json
from asked a left join answers w using (conv_id, call_id)
union all
select t.conv_id, t.turn, 'result', t.call_id, (a.turn > a.opening)::bigint, a.call_id is not null, true,
  '{"content":' || coalesce(to_json(t.text)::varchar, 'null') || ',"id":"' || t.call_id || '","name":'
    || case when a.call_id is null then 'null' else '"reply"' end || '}'
from told t left join asked a using (conv_id, call_id)
"""
