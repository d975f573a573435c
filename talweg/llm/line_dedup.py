"""Corpus-wide line dedup over levelled sorted runs.

Line keys are hashed to 128 bits. The index is a set of runs: tables bucketed and sorted by the hash, each run without keys
that an older run holds. A new batch of documents anti-joins the runs bucket by bucket (a merge join: only the batch is
shuffled and sorted; a run has one sorted file a bucket and is read in its order), keeps the first document of each key it
brings, and adds those keys as a run of level 0. When a level holds `fanout` runs they are merged into one of the next
level, so that few runs are live and each key is rewritten a logarithmic number of times; nothing is written after the
last batch. There are at least MIN_BATCHES batches, more than `fanout`, and none is much larger than `batch_bytes`.

A key is the line without ASCII white space at both ends and with A-Z lower-cased. Lines whose key has at least
`min_chars` code points stay in the first document that holds the key and go from all others; batches are ranges of
ascending ids, so the first document is the one with the smallest id.

Defined results: a null or empty text is one empty line and stays; rows with a null id are left as they are and keep
nothing else from staying; rows that repeat an id are the same document; an empty table gives an empty table; other
columns stay, except that those named like an output give way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import _common as c

MIN_CHARS = 10
MIN_BATCHES, BATCH_BYTES = 6, 256 << 30
#: Bucketed tables are read as they were written: by bucket, and each bucket in its order.
AS_WRITTEN = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return c.lower_ascii(F.btrim(line, F.lit(c.SPACE_CHARS)))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class LineRuns:
    """The levelled index of line hashes."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = 4):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, keys: DataFrame) -> DataFrame:
        name = f"talweg_run_{uuid.uuid4().hex}"
        with settings(self.spark, AS_WRITTEN):  # runs that are merged lie in the same buckets: no shuffle, and a sort of sorted pieces
            keys.select(*KEY).repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", c.fresh_path(self.spark, "run")).saveAsTable(name)
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay; the plan holds their buckets
        return run

    def absorb(self, keys: DataFrame, last: bool = False) -> DataFrame:
        """keys (h1, h2 and more, one row per key) with `seen`: whether an older batch holds the key. The unseen ones become a run, but for the last batch."""
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.hint("merge").select(*KEY, F.lit(True).alias(f"in{i}")), KEY, "left")
        flags = [F.col(f"in{i}") for i in range(len(self.runs()))]
        marked = keys.withColumn("seen", F.coalesce(*flags, F.lit(False))).drop(*[f"in{i}" for i in range(len(flags))])
        with settings(self.spark, AS_WRITTEN):
            marked = c.stored(marked, "batch")
        if not last:
            self._add(self._write(marked.filter("NOT seen")))
        return marked

    def _add(self, run: DataFrame, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            # Runs hold no key in common. The filter drops nothing: a union of rows keeps its sides' buckets together,
            # one of whole column batches does not.
            sides = [run.filter("h1 IS NOT NULL") for run in old]
            merged = sides[0]
            for side in sides[1:]:
                merged = merged.union(side)
            self._add(self._write(merged), level + 1)


def dropped_lines(df: DataFrame, id_col: str, text: str, batches: int | None, fanout: int, min_chars: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(__id, __row, __at): the lines that go, by id, hash of the text and array of positions."""
    spark = df.sparkSession
    lines = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text).alias("__t"))
    lines = lines.select("__id", F.xxhash64("__t").alias("__row"), F.posexplode(c.line_array(c.text_or_empty("__t"))).alias("__pos", "__line"))
    lines = lines.withColumn("__key", line_key(F.col("__line"))).filter(F.char_length("__key") >= min_chars)
    lines = c.stored(lines.select("__id", "__row", "__pos", F.xxhash64("__key").alias("h1"), F.xxhash64(F.lit(17), "__key").alias("h2")), "lines")
    if batches is None:
        total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
        batches = max(MIN_BATCHES, 1 + total // batch_bytes)
    cuts = [x / batches for x in range(1, batches)]
    bounds = sorted(set(lines.agg(F.percentile_approx("__id", cuts, 10_000)).first()[0] or [])) if cuts else []
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index, parts = LineRuns(spark, buckets, fanout), []
    for low, high in zip([None, *bounds], [*bounds, None]):
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("__id") > F.lit(low))
        if high is not None:
            batch = batch.filter(F.col("__id") <= F.lit(high))
        first = batch.groupBy(*KEY).agg(F.min("__id").alias("first"), F.max("__id").alias("last"))
        repeated = index.absorb(first, high is None).filter("seen OR first < last").select(*KEY, F.when(~F.col("seen"), F.col("first")).alias("first"))
        parts.append(batch.join(repeated, KEY).filter("first IS NULL OR __id > first").select("__id", "__row", "__pos"))
    dropped = parts[0]
    for part in parts[1:]:
        dropped = dropped.union(part)
    return dropped.groupBy("__id", "__row").agg(F.collect_set("__pos").alias("__at"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", batches: int | None = None, fanout: int = 4, min_chars: int = MIN_CHARS) -> DataFrame:
    """df with `kept_text`, `n_lines` (before) and `n_dropped`."""
    gone = dropped_lines(df, id_col, text, batches, fanout, min_chars)
    df = df.drop("kept_text", "n_lines", "n_dropped")
    rows = df.withColumns({"__id": F.col(id_col), "__row": F.xxhash64(text)}).join(gone, ["__id", "__row"], "left")
    rows = rows.withColumn("__lines", c.line_array(c.text_or_empty(text)))
    kept = F.expr("transform(array_except(sequence(0, size(__lines) - 1), __at), i -> get(__lines, i))")
    return rows.withColumns(
        {
            "kept_text": F.when(F.col("__at").isNull(), c.text_or_empty(text)).otherwise(F.array_join(kept, "\n")),
            "n_lines": F.size("__lines").cast("long"),
            "n_dropped": F.coalesce(F.size("__at"), F.lit(0)).cast("long"),
        }
    ).drop("__id", "__row", "__at", "__lines")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(c.documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines; a document that was nothing but such lines goes."""
    own, restore = c.hidden(docs, "doc_id", "text", "n_chars")
    done = dedup_lines(own).withColumn("text", F.when((F.col("n_dropped") > 0) | F.col("text").isNotNull(), F.col("kept_text")))
    kept = (F.col("n_dropped") == 0) | F.col("text").rlike(f"[^{c.SPACE}]")
    return restore(c.filter_settled(done, kept).withColumn("n_chars", F.char_length("text").cast("long")))


def sql(source: str = "documents") -> str:
    return rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {source}),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{c.UPPER}', '{c.LOWER}') AS key FROM x),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key),
j AS (SELECT k.*, coalesce(k.doc_id > f.first, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id"""
