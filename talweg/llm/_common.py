"""Parts that several text operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, as a class body, and as characters.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of a lookup table that may be broadcast; beyond it the join is shuffled and salted.
BROADCAST_ROWS = 100_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset, under a local master only, a folder of our own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="talweg-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/talweg-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: later plans start there and survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like cut, as a compressed columnar table; for rows that are many or wide."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words(c: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.filter(F.split(c, f"[{SPACE}]+"), lambda w: w != "")


def line_array(c: Column) -> Column:
    return F.split(c, "\n", -1)


def with_outputs(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns added; a column of df with the same name gives way."""
    return df.withColumns(columns)


def hidden(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with its other columns under private names, so that none clashes with an operator's, and what gives df's columns back."""
    other = {x: f"__own{i}" for i, x in enumerate(df.columns) if x not in needed}
    return df.withColumnsRenamed(other), lambda done: done.select(*[F.col(other.get(x, x)).alias(x) for x in df.columns])


def window_hashes(w: str, size: int = 5) -> Column:
    """64-bit hashes of the word windows of the array column w, one per position; a shorter array counts as one window, an empty one as none."""
    at = ", ".join(f"get({w}, i + {k})" for k in range(size))
    return F.expr(
        f"CASE WHEN size({w}) = 0 THEN CAST(array() AS array<bigint>) WHEN size({w}) < {size} THEN array(xxhash64(array_join({w}, ' ')))"
        f" ELSE transform(sequence(0, size({w}) - {size}), i -> xxhash64({at})) END"
    )


def filter_settled(df: DataFrame, condition: Column) -> DataFrame:
    """df.filter(condition), evaluated on df's columns as they are.

    The optimiser would move a plain filter below the projections that made those columns and write their expressions out
    in it; arrays that a lambda reads would then be built anew for every element. It moves none below a row number.
    """
    return df.withColumn("__at", F.monotonically_increasing_id()).filter(condition & (F.col("__at") >= 0)).drop("__at")


def lookup_join(df: DataFrame, small: DataFrame, key: str, rows: int, salts: int = 64) -> DataFrame:
    """Left join of df with a table that has one row per key, of which there are `rows`.

    Up to BROADCAST_ROWS the table is broadcast. Beyond that both sides are shuffled, and each key is spread over `salts`
    parts by a hash of the row, so that one key with a third of all rows does not land in one task.
    """
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(small), key, "left")
    salted = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = df.withColumn("__salt", F.pmod(F.xxhash64(*[c for c, t in df.dtypes if "map" not in t]), F.lit(salts)).cast("int"))
    return spread.join(salted, [key, "__salt"], "left").drop("__salt")
