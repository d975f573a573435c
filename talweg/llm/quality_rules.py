"""Host-level quality rules.

Every document is measured by DataFrame functions alone. Rule failures are summed by host, each host's failure rates are
shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts themselves, and the hosts' verdicts are
joined back to the documents.

Defined results: a null text has no words and so fails; a null host has no verdict, its documents stand by the base rules
alone; repeated rows are judged row by row; an empty table gives an empty table; columns of the input stay, except that
those named like an output give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import _common as c

SYMBOLS = "#*$%&|<>"
#: Base rules: fewer words fail; so does a larger share of words (in percent) inside repeated 5-word windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Soft rules, which count against a host: symbols per hundred words, repeated lines in percent, mean word length.
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT, MAX_MEAN_WORD = 10, 30, 20
#: A document that fails a soft rule goes where its host's shrunk rate for this rule is at least SUSPECT; all documents of
#: a host go where the shrunk rate of base failures is at least BLOCKED.
SUSPECT, BLOCKED = 0.3, 0.8
#: Bounds of the prior's weight, in documents.
PRIOR_MIN, PRIOR_MAX = 1.0, 1000.0
#: Documents beyond one a host, about, from which the prior is fitted.
ROOM = 0.5
RULES = ("base", "symbols", "lines", "length")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bytes_of(text: str, chars: str) -> Column:
    """How often the single-byte characters occur."""
    t = F.col(text)
    return sum((F.octet_length(t) - F.octet_length(F.replace(t, F.lit(x), F.lit(""))) for x in chars), F.lit(0)).cast("long")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """df with MEASURES and `__fails`, an array of booleans in the order of RULES."""
    df = df.drop(*MEASURES, "base_failed").withColumn("__t", c.text_or_empty(text))
    df = df.withColumns({"__w": c.words(F.col("__t")), "__l": F.filter(c.line_array(F.col("__t")), lambda x: x.rlike(f"[^{c.SPACE}]"))})
    df = df.withColumn("__h", F.expr("CASE WHEN size(__w) < 5 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size(__w) - 5), i -> xxhash64(get(__w, i), get(__w, i + 1), get(__w, i + 2), get(__w, i + 3), get(__w, i + 4))) END"))
    # Sorted (hash, position): equal windows are neighbours. Texts without a repeated window skip the sort.
    df = df.withColumn("__s", F.expr("CASE WHEN size(array_distinct(__h)) < size(__h) THEN array_sort(transform(__h, (h, i) -> struct(h, i))) END"))
    df = df.withColumn("__p", F.expr("array_sort(transform(filter(__s, (x, i) -> x.h = get(__s, i - 1).h OR x.h = get(__s, i + 1).h), x -> x.i))"))
    df = df.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.char_length("__t").cast("long") - _bytes_of("__t", c.SPACE_CHARS),
            "n_symbols": _bytes_of("__t", SYMBOLS),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__n_lines": F.size("__l").cast("long"),
            # each repeated window covers five words, less what the next one covers too
            "n_repeat_words": F.expr("coalesce(aggregate(transform(__p, (p, i) -> least(5, coalesce(get(__p, i + 1) - p, 5))), 0, (a, x) -> a + x), 0)").cast("long"),
        }
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fails = F.array(
        base,
        100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
        100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("__n_lines"),
        F.col("word_chars") > MAX_MEAN_WORD * F.col("n_words"),
    )
    return df.withColumns({"base_failed": base, "__fails": fails}).drop("__t", "__w", "__l", "__h", "__s", "__p", "__n_lines")


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, and each rule's failures and shrunk rate.

    The prior is Beta(m*s, (1-m)*s): m the rate over all hosts, s = 1/r - 1 from the correlation r of documents of one
    host. With N documents, n_i of them on each of H hosts, sum n_i (p_i - m)^2 is expected to be
    m(1-m) (H - 1 + r (N - sum n_i^2 / N - H + 1)): what one finds, less what chance alone makes, gives r. Hosts of one
    document each say nothing about r; they are shrunk as much as PRIOR_MAX allows.
    """
    counts = c.cut(
        measured.filter(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("__host"))
        .agg(F.count("*").alias("n_docs"), *[F.sum(F.col("__fails")[i].cast("long")).alias(f"k_{r}") for i, r in enumerate(RULES)])
    )
    means = counts.agg(*[(F.sum(f"k_{r}") / F.sum("n_docs")).alias(r) for r in RULES]).first()
    if means[0] is None:
        return counts.select("*", *[F.lit(0.0).alias(f"rate_{r}") for r in RULES])
    spreads = [F.sum(F.col("n_docs") * F.pow(F.col(f"k_{r}") / F.col("n_docs") - F.lit(means[r]), F.lit(2.0))).alias(r) for r in RULES]
    room = (F.sum("n_docs") - F.sum(F.col("n_docs") * F.col("n_docs")) / F.sum("n_docs") - F.count("*") + 1).alias("room")
    spread = counts.agg(F.count("*").alias("hosts"), room, *spreads).first()

    def shrunk(r: str) -> Column:
        m = means[r]
        excess = spread[r] / (m * (1 - m)) - (spread["hosts"] - 1) if 0 < m < 1 else 0.0
        share = min(excess / spread["room"], 1.0) if spread["room"] > ROOM and excess > 0 else 0.0
        s = min(max(1 / share - 1, PRIOR_MIN), PRIOR_MAX) if share > 0 else PRIOR_MAX
        return ((F.col(f"k_{r}") + m * s) / (F.col("n_docs") + s)).alias(f"rate_{r}")

    return counts.select("*", *[shrunk(r) for r in RULES])


def judge(measured: DataFrame, rates: DataFrame, host: str = "source") -> DataFrame:
    """measured with `host_blocked` and `kept`; `__fails` goes."""
    soft = F.array(*[F.col(f"rate_{r}") >= SUSPECT for r in RULES[1:]])
    verdicts = rates.select("__host", (F.col("rate_base") >= BLOCKED).alias("host_blocked"), soft.alias("__suspect"))
    joined = c.lookup_join(measured.drop("host_blocked", "kept").withColumn("__host", F.col(host)), verdicts, "__host", rates.count())
    caught = F.coalesce(F.exists(F.arrays_zip(F.slice("__fails", 2, 3).alias("f"), F.col("__suspect").alias("s")), lambda x: x["f"] & x["s"]), F.lit(False))
    blocked = F.coalesce(F.col("host_blocked"), F.lit(False))
    return joined.withColumns({"host_blocked": blocked, "kept": ~F.col("base_failed") & ~blocked & ~caught}).drop("__host", "__suspect", "__fails")


def host_rules(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """df with its measures and verdicts. The texts are not shuffled: they are measured again in the second pass."""
    measured = measure(df, text)
    return judge(measured, host_rates(measured, host), host)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = c.cut(measure(c.documents(spark, sf_dir).select("doc_id", "text", "source")).drop("text"))
    return judge(measured, host_rates(measured)).select("doc_id", *MEASURES, "base_failed", "kept", "host_blocked")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, restore = c.hidden(docs, "text", "source")
    return restore(c.filter_settled(host_rules(own), F.col("kept")))


def sql(source: str = "documents") -> str:
    n = r"length(t) - length(replace(t, '%s', ''))"
    symbols = " + ".join(n % x for x in SYMBOLS)
    rules = {"base": "base_failed", "symbols": f"100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words", "lines": f"100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines", "length": f"word_chars > {MAX_MEAN_WORD} * n_words"}
    fails = ", ".join(f"{x} AS f_{r}" for r, x in rules.items())
    sums = ", ".join(f"sum(f_{r}::BIGINT) AS k_{r}" for r in rules)
    means = ", ".join(f"sum(k_{r}) / sum(n_docs) AS m_{r}" for r in rules)
    spread = ", ".join(f"sum(n_docs * pow(k_{r} / n_docs - m_{r}, 2)) AS v_{r}" for r in rules)
    excess = ", ".join(f"CASE WHEN m_{r} > 0 AND m_{r} < 1 THEN v_{r} / (m_{r} * (1 - m_{r})) - (hosts - 1) ELSE 0 END AS e_{r}" for r in rules)
    weight = ", ".join(f"CASE WHEN room > {ROOM} AND e_{r} > 0 THEN least(greatest(1 / least(e_{r} / room, 1.0::DOUBLE) - 1, {PRIOR_MIN}), {PRIOR_MAX}) ELSE {PRIOR_MAX} END AS s_{r}" for r in rules)
    rate = ", ".join(f"(k_{r} + m_{r} * s_{r}) / (n_docs + s_{r}) AS rate_{r}" for r in rules)
    caught = " OR ".join(f"(f_{r} AND coalesce(rate_{r} >= {SUSPECT}, false))" for r in RULES[1:])
    return rf"""
WITH t0 AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM {source}),
t1 AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t0),
g AS (SELECT r, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t1)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
p AS (SELECT r, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM d) GROUP BY r),
m AS (SELECT t1.r, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, ({symbols})::BIGINT AS n_symbols,
 (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM t1 LEFT JOIN p USING (r)),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m),
f AS (SELECT *, {fails} FROM b),
h AS (SELECT source, count(*) AS n_docs, {sums} FROM f WHERE source IS NOT NULL GROUP BY source),
a AS (SELECT {means} FROM h), v AS (SELECT count(*) AS hosts, sum(n_docs) - sum(n_docs * n_docs)::DOUBLE / sum(n_docs) - count(*) + 1 AS room, {spread} FROM h, a),
x AS (SELECT room, {excess} FROM a, v), s AS (SELECT {weight} FROM x),
k AS (SELECT source, {rate} FROM h, a, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND NOT coalesce(rate_base >= {BLOCKED}, false) AND NOT ({caught}) AS kept, coalesce(rate_base >= {BLOCKED}, false) AS host_blocked
FROM f LEFT JOIN k USING (source)"""
