"""Preference formatting of chosen and rejected conversations.

Both conversations are arrays of (role, text) turns. Their longest common turn prefix is rendered once as the prompt; what
follows is rendered as two completions, each with the character ranges that count in training: the bodies of assistant
turns with their end marker. Everything is built from array functions; conversations are only shuffled by their own id.

Defined results: null roles and texts are rendered as empty and equal each other; a null conversation counts as one
without turns; equal conversations give a whole prompt and two empty completions; turns without a conversation id belong
to none and are left out; equal turn numbers are ordered by role and text, exact repeats of a turn row count once; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
END = "<|end|>\n"
OUTPUTS = ("prompt", "n_prompt_turns", "chosen_completion", "rejected_completion", "chosen_spans", "rejected_spans")


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def trained_spans(turns: Column) -> Column:
    """array<struct<start,stop>>: half-open character ranges of the rendered text that are trained on."""
    none = F.lit(None).cast("array<struct<start:bigint,stop:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.coalesce(none, F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        first = acc["at"] + F.char_length(_head(t))
        stop = first + F.char_length(_body(t))
        span = F.struct(first.cast("bigint").alias("start"), stop.cast("bigint").alias("stop"))
        added = F.when(F.coalesce(t["role"] == "assistant", F.lit(False)), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(stop.cast("bigint").alias("at"), added.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def common_turns(a: str, b: str) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    n = f"least(size({a}), size({b}))"
    unequal = f"filter(sequence(1, {n}), i -> NOT (get({a}, i - 1) <=> get({b}, i - 1)))"
    return F.expr(f"CASE WHEN {n} = 0 THEN 0 ELSE coalesce(array_min({unequal}) - 1, {n}) END")


def format_pairs(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """df with OUTPUTS; columns of df named like an output give way."""
    df = df.drop(*[x for x in OUTPUTS if x not in (chosen, rejected)])
    none = F.array().cast(TURNS)
    df = df.withColumns({"__c": F.coalesce(F.col(chosen).cast(TURNS), none), "__r": F.coalesce(F.col(rejected).cast(TURNS), none)}).withColumn("__n", common_turns("__c", "__r"))
    df = df.withColumns({"__ct": F.expr("slice(__c, __n + 1, size(__c))"), "__rt": F.expr("slice(__r, __n + 1, size(__r))")})
    return df.withColumns(
        {
            "prompt": render(F.expr("slice(__c, 1, __n)")),
            "n_prompt_turns": F.col("__n").cast("long"),
            "chosen_completion": render(F.col("__ct")),
            "rejected_completion": render(F.col("__rt")),
            "chosen_spans": trained_spans(F.col("__ct")),
            "rejected_spans": trained_spans(F.col("__rt")),
        }
    ).drop("__c", "__r", "__n", "__ct", "__rt")


def conversations(turns: DataFrame) -> DataFrame:
    """Turn rows (conv_id, turn, role, text) as one row (conv_id, turns) per conversation."""
    rows = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("x"))
    return rows.select("conv_id", F.transform(F.array_distinct(F.array_sort("x")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _last_reply(turns: str) -> Column:
    return F.expr(f"coalesce(array_max(filter(sequence(1, size({turns})), i -> get({turns}, i - 1).role = 'assistant')), size({turns}) + 1)")


def reply_swaps(convs: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): rejected ends with the last assistant turn of the conversation whose id differs in the lowest bit (without such a turn, with none)."""
    convs = convs.withColumn("at", _last_reply("turns"))
    other = convs.select(F.expr("conv_id ^ 1").alias("conv_id"), F.expr("slice(turns, at, 1)").alias("reply"))
    both = convs.join(other, "conv_id", "left")
    return both.select("conv_id", F.col("turns").alias("chosen"), F.expr("concat(slice(turns, 1, at - 1), coalesce(reply, slice(turns, 1, 0)))").alias("rejected"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = format_pairs(reply_swaps(conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
    return pairs.select("conv_id", "n_prompt_turns", "prompt", "chosen_completion", "rejected_completion", *[spans_text(F.col(x)).alias(x) for x in ("chosen_spans", "rejected_spans")])


def sql() -> str:
    text = "concat('<|', coalesce(role, ''), '|>', chr(10), coalesce(text, ''), '<|end|>', chr(10))"
    side = """
 {s}r AS (SELECT *, sum(length(t)) OVER (PARTITION BY conv_id ORDER BY i) AS stop FROM (SELECT c.conv_id, i, role, {text} AS t, length(coalesce(text, '')) + 8 AS body FROM {s} c JOIN n USING (conv_id) WHERE i > k)),
 {s}o AS (SELECT conv_id, string_agg(t, '' ORDER BY i) AS completion, string_agg((stop - body)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY i) FILTER (role = 'assistant') AS spans FROM {s}r GROUP BY conv_id)"""
    return f"""
WITH u AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
 c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i, role, text FROM u),
 z AS (SELECT conv_id, coalesce(max(i) FILTER (role = 'assistant'), max(i) + 1) AS last FROM c GROUP BY conv_id),
 d AS (SELECT c.* FROM c JOIN z USING (conv_id) WHERE i < last UNION ALL
  SELECT z.conv_id, z.last, c.role, c.text FROM z JOIN z y ON y.conv_id = xor(z.conv_id, 1) JOIN c ON c.conv_id = y.conv_id AND c.i = y.last),
 e AS (SELECT coalesce(c.conv_id, d.conv_id) AS conv_id, coalesce(c.i, d.i) AS i, c.conv_id IS NOT NULL AND d.conv_id IS NOT NULL AND c.role IS NOT DISTINCT FROM d.role AND c.text IS NOT DISTINCT FROM d.text AS same
  FROM c FULL JOIN d ON c.conv_id = d.conv_id AND c.i = d.i),
 n AS (SELECT conv_id, coalesce(min(i) FILTER (NOT same) - 1, max(i)) AS k FROM e GROUP BY conv_id),
 p AS (SELECT conv_id, string_agg({text}, '' ORDER BY i) AS prompt FROM c JOIN n USING (conv_id) WHERE i <= k GROUP BY conv_id),{side.format(s="c", text=text)},{side.format(s="d", text=text)}
SELECT n.conv_id, k::BIGINT AS n_prompt_turns, coalesce(prompt, '') AS prompt, coalesce(co.completion, '') AS chosen_completion, coalesce(dox.completion, '') AS rejected_completion,
 coalesce(co.spans, '') AS chosen_spans, coalesce(dox.spans, '') AS rejected_spans
FROM n LEFT JOIN p USING (conv_id) LEFT JOIN co ON co.conv_id = n.conv_id LEFT JOIN "do" dox ON dox.conv_id = n.conv_id""".replace(" do AS", ' "do" AS')
