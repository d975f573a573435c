"""Threshold-scaled document sketches.

A text's sketch holds every 64-bit hash of its 5-word shingles (A-Z lower-cased) that falls below FRACTION of the hash
range. Sketches of any two texts are samples of their shingle sets by the same rule, so the union of two sketches is the
sketch of the union, and shared hashes over the smaller sketch estimate containment even between a sentence and a book.
A text with shingles of which none falls below the threshold has an empty sketch; its least hash is held apart, so that
short texts can be compared without adding to the sketch what the rule leaves out.

The fingerprint is the sketch's hashes in ascending order, 16 hexadecimal digits each; where there are none, a tilde and
the least hash. `likeness` is the estimate of the Jaccard similarity, `containment` the share of the first sketch that the
second holds. Texts with empty sketches are alike (1.0) when they have the same least hash or both no shingles, else 0.

Defined results: null is an empty text with an empty fingerprint; of rows that repeat an id, the smallest text is the one
that the preceding id continues with, and each row is answered; rows with a null id have no next document; one document
alone is its own next; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.llm import _common as c

#: One shingle hash in SCALE is kept.
SCALE = 8


def with_sketch(df: DataFrame, text: str, out: str, scale: int = SCALE) -> DataFrame:
    """df with the sketch of the text column: struct of ascending distinct `hashes`, and the `least` hash where there are none."""
    limit = -(2**63) + 2**64 // scale
    df = df.withColumn("__w", c.words(c.lower_ascii(c.text_or_empty(text)))).withColumn("__h", c.window_hashes("__w"))
    df = df.withColumn("__k", F.filter("__h", lambda h: h < F.lit(limit)))
    least = F.when(F.size("__k") == 0, F.array_min("__h"))
    return df.withColumn(out, F.struct(F.sort_array(F.array_distinct("__k")).alias("hashes"), least.alias("least"))).drop("__w", "__h", "__k")


def _hex(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h)), 16, "0")


def fingerprint(sketch: Column) -> Column:
    hashes = F.array_join(F.transform(sketch["hashes"], _hex), "")
    return F.when(sketch["least"].isNotNull(), F.concat(F.lit("~"), _hex(sketch["least"]))).otherwise(hashes)


def likeness(a: Column, b: Column) -> Column:
    both, shared = F.size(F.array_union(a["hashes"], b["hashes"])), F.size(F.array_intersect(a["hashes"], b["hashes"]))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(both == 0, a["least"].eqNullSafe(b["least"]).cast("double")).otherwise(shared / both))


def containment(a: Column, b: Column) -> Column:
    own = F.size(a["hashes"])
    alone = F.when(a["least"].isNull(), F.lit(1.0)).otherwise((a["least"] == b["least"]).cast("double"))
    return F.when(own == 0, F.coalesce(alone, F.lit(0.0))).otherwise(F.size(F.array_intersect(a["hashes"], b["hashes"])) / own)


def merge(sketches: Column) -> Column:
    """The sketch of the union: for an array of sketches, as collect_list gives them."""
    hashes = F.sort_array(F.array_distinct(F.flatten(sketches["hashes"])))
    return F.struct(hashes.alias("hashes"), F.when(F.size(hashes) == 0, F.array_min(sketches["least"])).alias("least"))


def previous_ids(ids: DataFrame) -> DataFrame:
    """(id, n) with one row per id -> (id, prev_id, prev_n): the next larger id; for the largest the smallest.

    Ids are dealt out by range; the lag runs inside each range, and only the ranges' ends (one row per partition) meet in one task.
    """
    dealt = ids.repartitionByRange("id").withColumn("part", F.spark_partition_id())
    dealt = c.cut(dealt)
    ends = dealt.groupBy("part").agg(F.min(F.struct("id", "n")).alias("low"))
    above = Window.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lead("low").over(above), F.first("low").over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("over"))
    up = F.lead(F.struct("id", "n")).over(Window.partitionBy("part").orderBy("id"))
    joined = dealt.withColumn("up", up).join(ends, "part")
    return joined.select("id", F.coalesce("up", "over").alias("p")).select("id", F.col("p.id").alias("prev_id"), F.col("p.n").alias("prev_n"))


def edited_pairs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, sketch, edited, edited_sketch, next_sketch): each text, and the text whose last half is replaced by the head of the next document (ids descending)."""
    rows = df.select(F.col(id_col).alias("id"), c.text_or_empty(text).alias("t"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One shuffle of the texts serves both sides of the join: ids are filtered before it, or a filter pushed to one side would make two.
    base = with_sketch(rows.filter("id IS NOT NULL"), "t", "sketch").repartition(n, "id")
    links = previous_ids(rows.filter("id IS NOT NULL").groupBy("id").agg(F.max(F.char_length("t")).alias("n")))
    heads = base.groupBy("id").agg(F.min(F.struct("t", "sketch")).alias("x")).join(links.hint("merge"), "id")
    heads = heads.select(F.col("prev_id").alias("id"), F.expr("substring(x.t, 1, CAST(prev_n DIV 2 AS int))").alias("head"), F.col("x.sketch").alias("next_sketch"))
    both = base.join(heads.hint("merge"), "id", "left")
    both = both.unionByName(with_sketch(rows.filter("id IS NULL"), "t", "sketch"), allowMissingColumns=True)
    both = both.withColumn("half", F.expr("char_length(t) DIV 2").cast("int"))
    edited = F.concat(F.expr("substring(t, 1, char_length(t) - half)"), F.coalesce(F.expr("substring(head, 1, half)"), F.lit("")))
    return with_sketch(both.withColumn("edited", edited), "edited", "edited_sketch").drop("half", "head")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = edited_pairs(c.documents(spark, sf_dir))
    return pairs.select(
        F.col("id").alias("doc_id"),
        F.char_length("t").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        F.coalesce(likeness(F.col("sketch"), F.col("next_sketch")), F.lit(0.0)).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_contained"),
    )
