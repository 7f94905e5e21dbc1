"""Tool-call linking: calls meet their results by identifier, in a valid order, checked and canonical.

Two readers give calls (conv, call_id, turn, name, arguments, after) and results (conv,
call_id, turn, content): `from_json` reads messages whose text is JSON (`tool_calls` of id,
name, arguments and after; or `tool_call_id` and content), `from_turns` reads all others as plain
talk, where a system or user turn is a call and the assistant's next turn its result. `link` joins them,
orders them, validates arguments against schemas, and writes each call as canonical JSON
(sorted keys, no spaces).

Order is by (level, turn, call_id). Where every call comes after those it waits for, turns are
a valid order already and levels are 0; other conversations get levels by peeling off, in
joins, the calls that wait for none left. Calls in or behind a cycle keep level -1 and say so.

Rules for odd input: calls without an identifier are named by their turn; calls that share an
identifier are rows of their own, each with the result and an error; of results for one call the
earliest (then smallest) is shown and `errors` tells of the others; a result without a call is a
row with an error and no name; a null conv_id is shown as "", and since nobody knows which of
these messages belong together, each is a row with an error and links to none; broken JSON and
JSON that neither calls a tool nor answers one is plain talk; null or broken arguments are `not an object`; other columns are ignored; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import table
from tagloom.session import materialise

#: For each tool: argument -> (type, required, least, most); of strings, least and most length.
SCHEMAS = {
    "ask": {"text": ("string", True, 1, 400), "n_words": ("integer", True, 3, None)},
    "set_context": {"text": ("string", True, 1, 2000), "n_words": ("integer", True, None, None)},
}
CALLS = "array<struct<id: string, name: string, arguments: string, after: array<string>>>"


def _messages(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _tool_message() -> Column:
    """Whether the text is valid JSON that calls tools or answers a call."""
    calls = F.size(F.from_json(F.get_json_object("text", "$.tool_calls"), CALLS)) > 0
    tells = calls | F.get_json_object("text", "$.tool_call_id").isNotNull()
    found = F.col("text").startswith("{") & F.try_parse_json("text").isNotNull() & tells
    return F.coalesce(F.when(F.col("text").startswith("{"), found), F.lit(False))


def from_json(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from messages whose text is JSON."""
    rows = _messages(messages).filter(_tool_message())
    calls = (
        rows.withColumn("c", F.explode(F.from_json(F.get_json_object("text", "$.tool_calls"), CALLS)))
        .select(
            "conv",
            F.coalesce("c.id", F.concat(F.lit("turn-"), "turn")).alias("call_id"),
            "turn",
            "c.name",
            "c.arguments",
            F.coalesce("c.after", F.array().cast("array<string>")).alias("after"),
        )
    )
    results = rows.select(
        "conv", F.get_json_object("text", "$.tool_call_id").alias("call_id"), "turn",
        F.get_json_object("text", "$.content").alias("content"),
    ).filter("call_id IS NOT NULL")
    return calls, results


def from_turns(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain talk: what is not the assistant's asks for the next turn."""
    rows = _messages(messages).filter(~_tool_message())

    def named(turn: Column) -> Column:
        return F.concat_ws("-", F.coalesce("conv", F.lit("")), turn)

    words = F.trim(F.translate("text", "\t\n\x0b\x0c\r", " " * 5))
    n_words = F.when(words == "", 0).otherwise(F.size(F.split(words, " +"))).cast("long")
    calls = rows.filter("role <> 'assistant'").select(
        "conv",
        named(F.col("turn")).alias("call_id"),
        "turn",
        F.when(F.col("role") == "system", "set_context").otherwise("ask").alias("name"),
        F.to_json(F.struct(n_words.alias("n_words"), "text")).alias("arguments"),
        F.when(F.col("turn") > 1, F.array(named(F.col("turn") - 2)))
        .otherwise(F.array().cast("array<string>"))
        .alias("after"),
    )
    results = rows.filter("role = 'assistant'").select(
        "conv", named(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results


def _levels(calls: DataFrame, ids: DataFrame) -> DataFrame:
    """conv, call_id, level for the conversations in which some call waits for a later one.

    `ids` has conv, call_id and turn (the first), once for each identifier of `calls`.
    """
    waits = (
        calls.select("conv", "call_id", "turn", F.explode(F.array_distinct("after")).alias("first"))
        .groupBy("conv", "call_id", "first")
        .agg(F.min("turn").alias("turn"))
    )
    firsts = ids.select("conv", F.col("call_id").alias("first"), F.col("turn").alias("first_turn"))
    edges = waits.join(firsts, ["conv", "first"])
    late = (F.col("first_turn") > F.col("turn")) | (
        (F.col("first_turn") == F.col("turn")) & (F.col("first") >= F.col("call_id"))
    )
    odd = materialise(edges.filter(late).select("conv").distinct(), "odd")
    if odd.isEmpty():
        return ids.select("conv", "call_id", F.lit(0).alias("level")).limit(0)
    left = materialise(edges.join(odd, "conv", "left_semi").select("conv", "call_id", "first"), "waits")
    waiting = materialise(ids.join(odd, "conv", "left_semi").select("conv", "call_id"), "waiting")
    placed, level = [], 0
    while True:
        ready = materialise(waiting.join(left, ["conv", "call_id"], "left_anti"), "ready")
        if ready.isEmpty():
            break
        placed.append(ready.withColumn("level", F.lit(level)))
        waiting = materialise(waiting.join(ready, ["conv", "call_id"], "left_anti"), "waiting")
        done = ready.withColumnRenamed("call_id", "first")
        left = materialise(left.join(done, ["conv", "first"], "left_anti"), "waits")
        level += 1
    out = waiting.withColumn("level", F.lit(-1))
    for rows in placed:
        out = out.unionByName(rows)
    return out


def violations(schemas: dict = SCHEMAS) -> Column:
    """What is wrong with the columns name and arguments, as an array of texts."""
    given = F.try_parse_json("arguments")
    kind = F.schema_of_variant(given)
    checks = [
        F.when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "arguments: not an object"),
        F.when(~F.coalesce(F.col("name").isin(list(schemas)), F.lit(False)), "name: unknown tool"),
    ]
    starts = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE|FLOAT",
              "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY"}
    for tool, arguments in schemas.items():
        own = F.col("name") == tool
        for argument, (wanted, required, least, most) in arguments.items():
            value = F.try_variant_get(given, f"$.{argument}", "variant")
            found = F.schema_of_variant(value)
            fits = F.coalesce(found.rlike(f"^(?:{starts[wanted]})"), F.lit(False))
            if required:
                checks.append(F.when(own & value.isNull(), f"{argument}: missing"))
            checks.append(F.when(own & value.isNotNull() & ~fits, f"{argument}: not of type {wanted}"))
            size = (
                F.length(F.try_variant_get(given, f"$.{argument}", "string"))
                if wanted == "string"
                else F.try_variant_get(given, f"$.{argument}", "double")
            )
            if least is not None:
                checks.append(F.when(own & fits & (size < least), f"{argument}: below {least}"))
            if most is not None:
                checks.append(F.when(own & fits & (size > most), f"{argument}: above {most}"))
        known = F.array(*[F.lit(a) for a in arguments])
        extra = F.size(F.array_except(F.json_object_keys("arguments"), known)) > 0
        checks.append(F.when(own & F.coalesce(extra, F.lit(False)), "unexpected argument"))
    return F.array_compact(F.array(*checks))


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """A row per call, and per result without one: conv, call_id, turn, name, level, linked,
    valid, errors, json."""
    key = ["conv", "call_id"]
    calls = materialise(calls, "calls")
    known, own = calls.filter("conv IS NOT NULL"), results.filter("conv IS NOT NULL")
    ids = materialise(
        known.groupBy(key).agg(F.count("*").alias("n_calls"), F.min("turn").alias("turn")), "ids"
    )
    answers = own.groupBy(key).agg(
        F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("r")
    )
    linked = (
        known.join(answers, key, "left")
        .join(ids.filter("n_calls > 1").select(*key, "n_calls"), key, "left")
        .join(_levels(known, ids), key, "left")
    )
    alone = own.join(ids, key, "left_anti").unionByName(results.filter("conv IS NULL"))
    alone = alone.select(*key, "turn", F.struct("turn", "content").alias("r"), F.lit(True).alias("no_call"))
    joined = (
        linked.unionByName(calls.filter("conv IS NULL"), allowMissingColumns=True)
        .unionByName(alone, allowMissingColumns=True)
        .withColumn("level", F.coalesce("level", F.lit(0)))
        .withColumn("no_call", F.coalesce("no_call", F.lit(False)))
    )
    more = F.array_compact(
        F.array(
            F.when(F.col("n_calls") > 1, "identifier: repeated by calls"),
            F.when(F.col("n_results") > 1, "identifier: repeated by results"),
            F.when(F.col("no_call"), "call: missing").when(F.col("n_results").isNull(), "result: missing"),
            F.when(F.col("r.turn") < F.col("turn"), "result: before its call"),
            F.when(F.col("level") < 0, "order: in or behind a cycle"),
            F.when(F.col("conv").isNull(), "conversation: missing"),
        )
    )
    wrong = F.when(F.col("no_call"), F.array().cast("array<string>")).otherwise(violations(schemas))
    checked = joined.withColumn("errors", F.concat(wrong, more)).withColumn("conv", F.coalesce("conv", F.lit("")))
    shown = F.to_json(
        F.struct(
            F.coalesce(F.try_parse_json("arguments"), F.parse_json(F.lit("null"))).alias("arguments"),
            "call_id",
            F.col("r.content").alias("content"),
            F.col("conv").alias("conv_id"),
            "errors",
            "name",
        )
    )
    return checked.select(
        "conv", "call_id", "turn", "name", "level", F.col("n_results").isNotNull().alias("linked"),
        (F.size("errors") == 0).alias("valid"), F.array_join("errors", "; ").alias("errors"),
        shown.alias("json"),
    )


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations")
    plain, said = from_turns(messages), from_json(messages)
    return link(plain[0].unionByName(said[0]), plain[1].unionByName(said[1]))


ORACLE_SQL = r"""
WITH message AS (
  SELECT conv_id::VARCHAR AS conv, turn, role, coalesce(text, '') AS text FROM conversations
), call AS (
  SELECT conv, conv || '-' || turn AS call_id, turn,
         CASE WHEN role = 'system' THEN 'set_context' ELSE 'ask' END AS name, text,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words
  FROM message WHERE role <> 'assistant'
), result AS (
  SELECT conv || '-' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n
  FROM message WHERE role = 'assistant' GROUP BY 1
), checked AS (
  SELECT *, result.n IS NOT NULL AS linked, list_filter([
    CASE WHEN length(text) < 1 THEN 'text: below 1' END,
    CASE WHEN length(text) > (CASE name WHEN 'ask' THEN 400 ELSE 2000 END)
         THEN 'text: above ' || (CASE name WHEN 'ask' THEN 400 ELSE 2000 END) END,
    CASE WHEN name = 'ask' AND n_words < 3 THEN 'n_words: below 3' END,
    CASE WHEN result.n > 1 THEN 'identifier: repeated by results' END,
    CASE WHEN result.n IS NULL THEN 'result: missing' END], lambda x: x IS NOT NULL) AS errors
  FROM call LEFT JOIN result USING (call_id)
)
SELECT conv, call_id, turn, name, 0 AS level, linked, len(errors) = 0 AS valid,
       array_to_string(errors, '; ') AS errors,
       CASE WHEN linked THEN json_object('arguments', json_object('n_words', n_words, 'text', text),
         'call_id', call_id, 'content', content, 'conv_id', conv, 'errors', errors, 'name', name)
       ELSE json_object('arguments', json_object('n_words', n_words, 'text', text),
         'call_id', call_id, 'conv_id', conv, 'errors', errors, 'name', name) END::VARCHAR AS json
FROM checked
"""
