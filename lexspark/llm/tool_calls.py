"""Tool calls of conversations: linked to results, ordered, validated and written as canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage
from lexspark.plans.order import with_position

CALL_TAG, RESULT_TAG = "tool_call", "tool_result"
#: Kinds of values of a parameter, and what the schema of a value begins with.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL)", "boolean": "BOOLEAN",
         "array": "ARRAY", "object": "OBJECT", "null": "VOID"}


def _blocks(messages: DataFrame, role: str, tag: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return messages.where(F.col("role") == role).select(
        "conv_id", "turn", F.posexplode(found).alias("part", "_json")
    ).withColumn("_v", F.try_parse_json("_json"))


def extracted(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) that ``messages`` (conv_id, turn, role, text) hold in tagged blocks of JSON.

    Calls are in ``<tool_call>`` blocks of assistant turns, with id, name, arguments and perhaps a list of ids
    in ``after``; results in ``<tool_result>`` blocks of tool turns, with id and content. A block that is not
    JSON has no id.
    """
    def field(name: str, kind: str = "string") -> Column:
        return F.try_variant_get("_v", f"$.{name}", kind)

    calls = _blocks(messages, "assistant", CALL_TAG).select(
        "conv_id", "turn", field("id").alias("call_id"), field("name").alias("name"),
        F.to_json(field("arguments", "variant")).alias("arguments"),
        F.coalesce(field("after", "array<string>"), F.array().cast("array<string>")).alias("after"))
    results = _blocks(messages, "tool", RESULT_TAG).select(
        "conv_id", "turn", field("id").alias("call_id"), field("content").alias("content"))
    return calls, results


def argument_errors(name: Column, arguments: Column, tools: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """array<string>: what is wrong with ``arguments``, JSON text, under the schemas of ``tools``.

    ``tools`` gives each tool's parameters as (type, whether required).
    """
    value = F.try_parse_json(arguments)
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    out = F.array(F.lit("unknown tool"))
    for tool, parameters in tools.items():
        checks = []
        for parameter, (kind, required) in parameters.items():
            path = f"$['{parameter}']"
            own = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
            there = F.array_contains(keys, parameter)
            checks.append(F.when(~there, F.lit(f"missing {parameter}") if required else F.lit(None)).when(
                ~F.coalesce(own, F.lit("VOID")).rlike(f"^{TYPES[kind]}"), F.lit(f"{parameter} is not {kind}")))
        unknown = F.transform(F.array_sort(F.array_except(keys, F.array(*[F.lit(p) for p in parameters]).cast("array<string>"))),
                              lambda k: F.concat(F.lit("unexpected "), k))
        found = F.concat(F.filter(F.array(*checks).cast("array<string>"), lambda e: e.isNotNull()), unknown)
        out = F.when(name == tool, found).otherwise(out)
    no_object = value.isNull() | ~F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return F.when(no_object, F.array(F.lit("arguments are not a JSON object"))).otherwise(out)


def chains(waits: DataFrame) -> DataFrame:
    """(conv, call_id, to, steps): for calls with one wait, the call at the end of their chain of such calls.

    Each round joins every open chain with the one it has come to, so its length doubles. Chains that close
    in a circle have no end and are left out.
    """
    one = waits.groupBy("conv", "call_id").agg(F.count(F.lit(1)).alias("n"), F.min("other").alias("to")).where("n = 1")
    left = cut_lineage(one.select("conv", "call_id", "to", F.lit(1).cast("bigint").alias("steps")))
    n, reach = left.count(), 1
    while True:
        # chains that have come to a call with a chain of its own go on by that one's steps
        on = left.select("conv", F.col("call_id").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        joined = cut_lineage(left.join(on, ["conv", "to"], "left"))
        if reach > n or joined.where("_to IS NOT NULL").isEmpty():
            return joined.where("_to IS NULL").select("conv", "call_id", "to", "steps")
        left = cut_lineage(joined.select(
            "conv", "call_id", F.coalesce("_to", "to").alias("to"),
            (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")))
        reach *= 2


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level): 0 for calls that wait for none, else one above the highest they wait for.

    Chains of calls with one wait are shortened to their ends. Of the rest, calls whose waits are over form a
    round; ids in ``after`` that no call has are no wait. Calls on a cycle, or behind one, have no level. Rounds
    grow with the logarithm of the longest chain and with the calls of several waits on one path.
    """
    key = ["conv", "call_id"]
    ids = cut_lineage(calls.select(*key).distinct())
    waits = cut_lineage(calls.select(*key, F.explode("after").alias("other")).distinct().join(
        ids.withColumnRenamed("call_id", "other"), ["conv", "other"], "left_semi"))
    ends = cut_lineage(chains(waits))
    several = waits.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    single = waits.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(
        "conv", F.col("call_id").alias("other"), F.lit(True).alias("single"))
    # a wait for a call without end leads nowhere: its value stays open
    left = cut_lineage(
        waits.join(several, key, "left_semi").join(single, ["conv", "other"], "left").join(
            ends.select("conv", F.col("call_id").alias("other"), "to", "steps"), ["conv", "other"], "left").select(
            *key, F.when(F.col("single"), F.col("to")).otherwise(F.col("other")).alias("to"),
            F.coalesce("steps", F.lit(0)).alias("steps"), F.lit(None).cast("int").alias("value")))
    ready = cut_lineage(ids.join(waits, key, "left_anti").withColumn("level", F.lit(0)))
    known = ready
    while not left.isEmpty():
        reached = left.join(ready.select("conv", F.col("call_id").alias("to"), "level"), ["conv", "to"], "left").select(
            *key, "to", "steps", F.coalesce("value", (F.col("level") + F.col("steps")).cast("int")).alias("value"))
        left = cut_lineage(reached)
        ready = cut_lineage(left.groupBy(*key).agg(
            F.max("value").alias("value"), F.count_if(F.col("value").isNull()).alias("open")).where("open = 0").select(
            *key, (F.col("value") + 1).alias("level")))
        if ready.isEmpty():
            break
        known = known.unionByName(ready)
        left = cut_lineage(left.join(ready, key, "left_anti"))
    behind = ends.join(known.withColumnRenamed("call_id", "to"), ["conv", "to"]).select(
        *key, (F.col("level") + F.col("steps")).cast("int").alias("level"))
    return known.unionByName(behind)


def linked_calls(
    calls: DataFrame, results: DataFrame, tools: dict[str, dict[str, tuple[str, bool]]]
) -> DataFrame:
    """One row per call, and one per result whose id no call of its conversation has: conv_id, call_id, name, turn, level, position, status, errors, canonical.

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON text) and after (ids of calls it waits for);
    ``results`` has conv_id, turn, call_id and content. A call meets the results of its id in its
    conversation. ``status`` is linked, repeated (more than one result; the first in order of turn
    counts), unanswered, or ambiguous (its id is missing or used by several calls). Results without a call, or without an id, have the
    status unmatched, their own turn and content, no name, level or position. ``position`` counts the calls
    of a conversation in topological order, from 0: by level, then turn and id; calls without level come last. ``errors``
    lists what the schema finds. ``canonical`` is JSON with sorted keys and without spaces; arguments that
    are no JSON are null in it. Long texts and long chains are taken as they are. A NULL conv_id is a conversation of its own. Repeated calls are ambiguous and
    each give a row. Other columns are not read; empty tables give an empty result.
    """
    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")))

    calls = cut_lineage(keyed(calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")))
    given = cut_lineage(keyed(results.select("conv_id", "turn", "call_id", "content")))
    answers = given.where("call_id IS NOT NULL").groupBy(
        "conv", "call_id").agg(
        F.count(F.lit(1)).alias("n_results"), F.min(F.struct("turn", "content"))["content"].alias("content"))
    same = calls.where("call_id IS NOT NULL").groupBy("conv", "call_id").agg(F.count(F.lit(1)).alias("n_calls"))
    known = calls.where("call_id IS NOT NULL")
    about = same.join(answers, ["conv", "call_id"], "left").join(levels(known), ["conv", "call_id"], "left")
    joined = calls.join(cut_lineage(about), ["conv", "call_id"], "left")
    status = F.when(F.coalesce("n_calls", F.lit(2)) > 1, "ambiguous").when(
        F.col("n_results").isNull(), "unanswered").when(F.col("n_results") > 1, "repeated").otherwise("linked")
    answered = F.when(status.isin("linked", "repeated"), F.col("content"))

    def canonical(arguments: Column, name: Column, result: Column) -> Column:
        return F.to_json(F.struct(
            F.try_parse_json(arguments).alias("arguments"), F.col("call_id").alias("id"), name.alias("name"),
            result.alias("result")), {"ignoreNullFields": "false"}).alias("canonical")

    rows = joined.select(
        "conv", "conv_id", "call_id", "name", "turn", "level", status.alias("status"),
        argument_errors(F.col("name"), F.col("arguments"), tools).alias("errors"),
        canonical(F.col("arguments"), F.col("name"), answered))
    order = [F.col("conv"), F.col("level").isNull(), *[F.col(c) for c in ("level", "turn", "call_id", "canonical")]]
    placed = cut_lineage(with_position(rows, order, "at"))
    firsts = placed.groupBy("conv").agg(F.min("at").alias("first"))
    linked = placed.join(firsts, "conv").select(
        "conv_id", "call_id", "name", "turn", "level", (F.col("at") - F.col("first")).alias("position"),
        "status", F.array_join("errors", "; ").alias("errors"), "canonical")
    none = F.lit(None).cast("string")
    unmatched = given.join(same.select("conv", "call_id"), ["conv", "call_id"], "left_anti").select(
        "conv_id", "call_id", none.alias("name"), "turn", F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("bigint").alias("position"), F.lit("unmatched").alias("status"), F.lit("").alias("errors"),
        canonical(none, none, F.col("content")))
    return linked.unionByName(unmatched)


#: Tools of the derived calls below.
TOOLS = {
    "search": {"limit": ("integer", True), "query": ("string", True)},
    "lookup": {"exact": ("boolean", False), "query": ("string", True)},
}


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made from plain conversations: an assistant turn is a call, and the user turn
    after it is its result.

    A call waits for that of half its exchange number. Every third is a search, a lookup, or of a tool that
    has no schema; the query is the text.
    """
    def named(turn: Column) -> Column:
        return F.concat_ws("-", "conv_id", turn)

    turn, size = F.col("turn"), F.length("text")
    exchange = F.floor(turn / 2)
    arguments = F.when(turn % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), size.alias("limit")))).when(
        turn % 3 == 1, F.to_json(F.struct(F.col("text").alias("query"), F.when(size % 2 == 0, "yes").alias("exact")))
    ).otherwise(F.to_json(F.struct(F.col("text").alias("query"))))
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", named(turn).alias("call_id"),
        F.when(turn % 3 == 0, "search").when(turn % 3 == 1, "lookup").otherwise("chat").alias("name"),
        arguments.alias("arguments"),
        F.when(exchange > 0, F.array(named(2 * F.floor(exchange / 2) + turn % 2))).otherwise(
            F.array().cast("array<string>")).alias("after"))
    results = conversations.where("role = 'user'").select(
        "conv_id", "turn", named(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS call_id, text,
    CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'chat' END AS name,
    CASE WHEN turn // 2 > 0 THEN conv_id || '-' || (2 * (turn // 2 // 2) + turn % 2) END AS other
  FROM conversations WHERE role = 'assistant'),
k AS (SELECT conv_id, call_id, count(*) AS n FROM c GROUP BY ALL),
l AS (
  SELECT c.conv_id, c.call_id, 0 AS level FROM c LEFT JOIN k ON k.conv_id = c.conv_id AND k.call_id = c.other
  WHERE k.call_id IS NULL
  UNION ALL
  SELECT c.conv_id, c.call_id, level + 1 FROM l JOIN c ON c.conv_id = l.conv_id AND c.other = l.call_id),
r AS (
  SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, count(*) AS n,
    arg_min(text, turn) AS content FROM conversations WHERE role = 'user' GROUP BY 1, 2),
j AS (
  SELECT c.*, level, CASE WHEN k.n > 1 THEN 'ambiguous' WHEN r.n IS NULL THEN 'unanswered'
    WHEN r.n > 1 THEN 'repeated' ELSE 'linked' END AS status, r.content
  FROM c JOIN k USING (conv_id, call_id) LEFT JOIN (SELECT DISTINCT * FROM l) USING (conv_id, call_id)
  LEFT JOIN r USING (conv_id, call_id)),
o AS (
  SELECT *, CASE WHEN name = 'chat' THEN 'unknown tool'
    WHEN name = 'lookup' AND length(text) % 2 = 0 THEN 'exact is not boolean' ELSE '' END AS errors,
    '{"arguments":{' || CASE name WHEN 'search' THEN '"limit":' || length(text) || ','
      WHEN 'lookup' THEN CASE WHEN length(text) % 2 = 0 THEN '"exact":"yes",' ELSE '' END ELSE '' END
    || '"query":' || to_json(text)::VARCHAR || '},"id":"' || call_id || '","name":"' || name || '","result":'
    || CASE WHEN status IN ('linked', 'repeated') THEN to_json(content)::VARCHAR ELSE 'null' END || '}' AS canonical
  FROM j)
SELECT conv_id, call_id, name, turn, level, row_number() OVER (
  PARTITION BY conv_id ORDER BY level NULLS LAST, turn, call_id, canonical) - 1 AS position,
  status, errors, canonical FROM o
UNION ALL
SELECT conv_id, call_id, NULL, turn, NULL, NULL, 'unmatched', '',
  '{"arguments":null,"id":"' || call_id || '","name":null,"result":' || to_json(text)::VARCHAR || '}'
FROM (SELECT conv_id, turn, conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'user')
ANTI JOIN k USING (conv_id, call_id)
"""
