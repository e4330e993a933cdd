"""Chat formatting: tool-call linking with DataFrame operations only.

``link_tool_calls`` joins calls and results by identifier, checks arguments
against schemas, orders calls so that each follows the calls it depends on,
and writes canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import stage

#: A tool's parameters: name -> JSON type, and which of them are required.
SCHEMAS = {
    "search": {"types": {"query": "string", "limit": "integer", "filters": "object"}, "required": ["query"]},
    "translate": {"types": {"text": "string", "to": "string"}, "required": ["text", "to"]},
    "count": {"types": {"text": "string", "words": "array", "ratio": "number", "strict": "boolean"}, "required": ["text"]},
}


def quoted(text: Column) -> Column:
    """A JSON string."""
    own = F.to_json(F.array(text))
    return F.substring(own, F.lit(2), F.length(own) - 2)


def schema_table(spark: SparkSession, schemas: dict) -> DataFrame:
    """(name, types, required): one row for each tool of the catalogue."""
    kind = "map<string, struct<types: map<string, string>, required: array<string>>>"
    return (spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(schemas)), kind)).alias("name", "s"))
            .select("name", "s.types", "s.required"))


def _json_type(kind: Column) -> Column:
    """The JSON type of a variant's schema; whole numbers are integers."""
    return (F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
            .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
            .when((kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$"), "integer").otherwise("number"))


def _sorted_texts(column: Column) -> Column:
    return F.array_join(F.array_sort(column), ",")


def check_arguments(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``arguments`` in canonical form (null if they aren't a
    JSON object) and ``faults``: json, object, tool, missing:x, type:x and
    unknown:x.  An object with a repeated key isn't JSON here."""
    parsed = calls.withColumn("_v", F.try_parse_json("arguments"))
    parsed = parsed.withColumn("_m", F.expr("try_variant_get(_v, '$', 'map<string, variant>')"))
    given = F.transform(F.map_entries("_m"), lambda e: F.struct(e["key"].alias("key"), F.schema_of_variant(e["value"]).alias("kind")))
    joined = parsed.withColumn("_given", given).join(schemas, "name", "left")

    def fits(x: Column) -> Column:
        want, have = F.element_at("types", x["key"]), _json_type(x["kind"])
        return (want == have) | ((want == "number") & (have == "integer"))

    of_keys = F.concat(
        F.transform(F.filter("required", lambda r: ~F.exists("_given", lambda g: g["key"] == r)), lambda r: F.concat(F.lit("missing:"), r)),
        F.transform(F.filter("_given", lambda g: ~F.coalesce(F.map_contains_key("types", g["key"]), F.lit(False))), lambda g: F.concat(F.lit("unknown:"), g["key"])),
        F.transform(F.filter("_given", lambda g: F.map_contains_key("types", g["key"]) & ~fits(g)), lambda g: F.concat(F.lit("type:"), g["key"])))
    faults = (F.when(F.col("_v").isNull(), F.array(F.lit("json"))).when(F.col("_m").isNull(), F.array(F.lit("object")))
              .when(F.col("types").isNull(), F.array(F.lit("tool"))).otherwise(of_keys))
    return (joined.withColumn("faults", faults)
            .withColumn("arguments", F.when(F.col("_m").isNotNull(), F.to_json("_v")))
            .select(*calls.columns, "faults"))


def waves(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, wave): order by (wave, turn, call_index).

    ``edges`` (conv_id, call_id, after) lead from calls to calls they need.
    Where all needs of a conversation point to earlier calls, the given order
    will do: wave 0, and no work.  Elsewhere calls are peeled off in waves
    from 1, each when all it needs is done; what remains lies on or behind a
    cycle and gets a null wave.  Rounds are as many as the longest chain in a
    conversation out of order, each a pair of joins over what remains.
    """
    ids = ["conv_id", "call_id"]
    at = calls.select("conv_id", "call_id", F.struct("turn", "call_index").alias("at"))
    needs = (edges.join(at, ids).withColumnRenamed("at", "here")
             .join(at.withColumnRenamed("call_id", "after"), ["conv_id", "after"]))
    needs = stage(needs.select("conv_id", "call_id", "after", (F.col("at") >= F.col("here")).alias("late")), "tool-needs")
    odd = needs.filter("late").select("conv_id").distinct()
    rest = stage(at.join(odd, "conv_id", "left_semi").select(*ids), "tool-rest")
    open_needs = needs.join(odd, "conv_id", "left_semi").select("conv_id", "call_id", "after").distinct()
    done, wave = None, 0
    while True:
        wave += 1
        ready = stage(rest.join(open_needs, ids, "left_anti").withColumn("wave", F.lit(wave)), "tool-wave")
        if ready.isEmpty():
            break
        done = ready if done is None else done.unionByName(ready)
        rest = stage(rest.join(ready, ids, "left_anti"), "tool-rest")
        open_needs = stage(open_needs.join(ready.select("conv_id", F.col("call_id").alias("after")), ["conv_id", "after"], "left_anti")
                           .select("conv_id", "call_id", "after"), "tool-needs")
    left = rest.withColumn("wave", F.lit(None).cast("int"))
    done = left if done is None else done.unionByName(left)
    return at.select(*ids).join(done.withColumn("_odd", F.lit(True)), ids, "left").select(
        *ids, F.when(F.col("_odd"), F.col("wave")).otherwise(0).alias("wave"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row for each call and for each result without one.

    ``calls``: conv_id, turn, call_index, call_id, name, arguments (JSON
    text), after (ids of needed calls).  ``results``: conv_id, turn, call_id,
    content.  An id names the first call of its conversation that has it; a
    later one is a ``duplicate`` and gets no result; of several results the
    first (by turn, then content) counts.  Equal rows count once.  Null
    conversations or ids link nothing: such calls have status ``no_id``, such
    results are ``orphan``.  A null ``after`` needs nothing; ids in it that
    no call has are faults (after:x).

    Returns conv_id, turn, call_index, call_id, name, status (ok, no_result,
    invalid, cycle, duplicate, no_id, orphan: the last that holds in the order
    no_id, duplicate, invalid, cycle, no_result, ok counts first), errors
    (comma-joined, sorted), arguments, result_turn, wave and ``message``, the
    linked call as canonical JSON.  Empty tables give no rows.
    """
    spark = calls.sparkSession
    ids = ["conv_id", "call_id"]
    calls = check_arguments(calls.select("conv_id", "turn", "call_index", "call_id", "name", "arguments", "after").distinct(),
                            schema_table(spark, schemas))
    calls = stage(calls, "tool-calls")
    named = calls.filter("conv_id is not null and call_id is not null")
    key = F.struct("turn", "call_index", "name", "arguments", "faults", "after")
    first = stage(named.groupBy(*ids).agg(F.min(key).alias("f")).select(*ids, "f.*"), "tool-first")
    edges = first.select(*ids, F.explode(F.array_distinct("after")).alias("after")).filter("after is not null")
    known = edges.join(first.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known")), ["conv_id", "after"], "left")
    lost = (known.filter("known is null").groupBy(*ids)
            .agg(F.collect_list(F.concat(F.lit("after:"), F.col("after"))).alias("lost")))
    answers = (results.filter("conv_id is not null and call_id is not null").groupBy(*ids)
               .agg(F.min(F.struct(F.col("turn").alias("result_turn"), "content")).alias("r")).select(*ids, "r.*"))
    linked = (first.join(lost, ids, "left").join(waves(first, edges), ids, "left").join(answers.withColumn("answered", F.lit(True)), ids, "left")
              .withColumn("faults", F.concat("faults", F.coalesce("lost", F.array().cast("array<string>")))))
    status = (F.when(F.size("faults") > 0, "invalid").when(F.col("wave").isNull(), "cycle")
              .when(F.col("answered").isNull(), "no_result").otherwise("ok"))
    message = F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), quoted(F.col("call_id")),
                       F.lit(',"name":'), F.coalesce(quoted(F.col("name")), F.lit("null")),
                       F.lit(',"result":'), F.when(F.col("content").isNotNull(), quoted(F.col("content"))).otherwise("null"), F.lit("}"))
    columns = ["conv_id", "turn", "call_index", "call_id", "name", "status", "errors", "arguments", "result_turn", "wave", "message"]
    out = linked.withColumn("status", status).withColumn("errors", _sorted_texts(F.col("faults"))).withColumn("message", message).select(*columns)
    none = {"result_turn": F.lit(None).cast(results.schema["turn"].dataType), "wave": F.lit(None).cast("int"), "message": F.lit(None).cast("string")}
    again = (named.join(first.select(*ids, key.alias("f")), ids).filter(~key.eqNullSafe(F.col("f"))).withColumn("status", F.lit("duplicate")))
    nameless = calls.filter("conv_id is null or call_id is null").withColumn("status", F.lit("no_id"))
    other = (again.select(*calls.columns, "status").unionByName(nameless)
             .withColumn("errors", _sorted_texts(F.col("faults"))).withColumns(none).select(*columns))
    orphans = (results.select("conv_id", "turn", "call_id", "content").distinct().join(first.select(*ids), ids, "left_anti")
               .select("conv_id", "turn", F.lit(None).cast("int").alias("call_index"), "call_id", F.lit(None).cast("string").alias("name"),
                       F.lit("orphan").alias("status"), F.lit("").alias("errors"), F.lit(None).cast("string").alias("arguments"),
                       F.col("turn").alias("result_turn"), F.lit(None).cast("int").alias("wave"),
                       F.concat(F.lit('{"id":'), F.coalesce(quoted(F.col("call_id")), F.lit("null")), F.lit(',"result":'),
                                F.when(F.col("content").isNotNull(), quoted(F.col("content"))).otherwise("null"), F.lit("}")).alias("message")))
    return out.unionByName(other).unionByName(orphans)


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) derived from ``conversations`` (conv_id, turn, role, text).

    Each user turn asks for one tool, named and filled in by the length of
    its text, among them wrong types, missing and unknown parameters, broken
    JSON, unknown tools, needs that are lost, come later or form a cycle; an
    assistant turn is the result for the turn before it.
    """
    n, text = F.length("text"), quoted(F.col("text"))
    call_id = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    name = (F.when(n % 13 == 0, "lookup").when(n % 3 == 0, "search").when(n % 3 == 1, "translate").otherwise("count"))
    limit = F.when(n % 5 == 0, quoted((n % 50).cast("string"))).otherwise((n % 50).cast("string"))
    body = (F.when(n % 3 == 0, F.concat(F.when(n % 7 == 0, F.lit("{")).otherwise(F.concat(F.lit('{"query": '), text, F.lit(", "))), F.lit('"limit": '), limit,
                                        F.lit(', "filters": {"z": 1, "a": [true, null, {"y": "x", "b": -2}]}}')))
            .when(n % 3 == 1, F.concat(F.lit("{"), F.when(n % 4 == 0, F.lit('"tone":"x", ')).otherwise(""),
                                       F.when(n % 7 == 0, F.lit("")).otherwise(F.concat(F.lit('"text" : '), text, F.lit(","))), F.lit(' "to": "de"}')))
            .otherwise(F.concat(F.lit('{"words": [3, 1, "x"], "text": '), F.when(n % 8 == 0, F.lit("7")).otherwise(text), F.lit(', "strict": false}'))))
    body = F.when(n % 11 == 0, F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    none = F.array().cast("array<string>")
    after = (F.when(n % 9 == 0, F.array(call_id(F.col("turn") + 2))).when((n % 2 == 0) & (F.col("turn") >= 2), F.array(call_id(F.col("turn") - 2))).otherwise(none))
    users = conversations.filter("role = 'user' and text is not null")
    calls = users.select("conv_id", "turn", F.lit(0).alias("call_index"), call_id(F.col("turn")).alias("call_id"), name.alias("name"),
                         body.alias("arguments"), after.alias("after"))
    results = (conversations.filter("role = 'assistant'")
               .select("conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")))
    return calls, results
