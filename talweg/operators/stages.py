"""Cutting a long job into stages, and numbering rows without a task that sees them all."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Spark's estimate for a table of unknown size, in bytes; above it an estimate says no more.
UNKNOWN_BYTES = 2**63 - 1


def _unsized(df: DataFrame) -> DataFrame:
    """A checkpoint without Spark's estimate of its size, if that is above any real one.

    A checkpoint keeps the estimate of its plan, and a join multiplies those of its sides: over rounds that join what
    earlier rounds have cut, the number's digits double each time until it fills the driver's memory.
    """
    plan = df._jdf.queryExecution()
    if int(plan.optimizedPlan().stats().sizeInBytes()) <= UNKNOWN_BYTES:
        return df
    return DataFrame(df.sparkSession._jsparkSession.internalCreateDataFrame(plan.logical().rdd(), df._jdf.schema(), False), df.sparkSession)


def cut(df: DataFrame) -> DataFrame:
    """df evaluated into the shared checkpoint folder. Where none is set, only a local master may use a folder of its own."""
    context = df.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="talweg-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return _unsized(df.checkpoint(eager=True))


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """df with numbers from 0 in the given order: counted by range, so that no task sees all rows."""
    dealt = cut(df.repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").count()
    before = sizes.select("__part", (F.sum("count").over(Window.orderBy("__part")) - F.col("count")).alias("__before"))  # a row per partition
    own = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return dealt.withColumn("__own", own).join(before, "__part").withColumn(out, F.col("__before") + F.col("__own")).drop("__part", "__own", "__before")
