"""Declarative data checks. Each check is one aggregate; a report is their union, so Spark runs them side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("PASS", "WARN", "FAIL")


def _row(df: DataFrame, dataset: str, name: str, ok: Column, severity: str) -> DataFrame:
    return df.select(F.lit(dataset).alias("dataset"), F.lit(name).alias("check_name"), F.when(ok, "PASS").otherwise(severity).alias("status"))


def count_between(df: DataFrame, dataset: str, name: str, low: int, high: int, severity: str = "FAIL") -> DataFrame:
    return _row(df.agg(F.count("*").alias("n")), dataset, name, F.col("n").between(low, high), severity)


def all_true(df: DataFrame, dataset: str, name: str, condition: Column, severity: str = "FAIL") -> DataFrame:
    """Every row meets the condition; null does not."""
    return _row(df.agg(F.count_if(~F.coalesce(condition, F.lit(False))).alias("bad")), dataset, name, F.col("bad") == 0, severity)


def share(df: DataFrame, dataset: str, name: str, condition: Column, least: float, severity: str = "FAIL") -> DataFrame:
    met = F.avg(F.when(F.coalesce(condition, F.lit(False)), 1.0).otherwise(0.0))
    return _row(df.agg(met.alias("s")), dataset, name, F.coalesce(F.col("s") >= least, F.lit(False)), severity)


def unique(df: DataFrame, dataset: str, name: str, keys: list[str], severity: str = "FAIL") -> DataFrame:
    repeated = df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("n"))
    return _row(repeated, dataset, name, F.col("n") == 0, severity)


def total(df: DataFrame, dataset: str, name: str, value: Column, expected: float, tolerance: float = 0.0, severity: str = "FAIL") -> DataFrame:
    """The sum is within a relative tolerance of what it should be."""
    off = F.abs(F.col("s") - expected)
    return _row(df.agg(F.sum(value).alias("s")), dataset, name, F.coalesce(off <= tolerance * abs(expected), F.lit(False)), severity)


def no_orphans(left: DataFrame, right: DataFrame, keys: list[str], dataset: str, name: str, severity: str = "FAIL") -> DataFrame:
    return _row(left.join(right, keys, "left_anti").agg(F.count("*").alias("n")), dataset, name, F.col("n") == 0, severity)


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def guarded(sections: dict) -> list[tuple[str, str, str]]:
    """Runs sections (name -> function that returns a report); one that breaks gives one FAIL, the others go on."""
    out = []
    for name, section in sections.items():
        try:
            out += [tuple(r) for r in section().collect()]
        except Exception as broken:  # noqa: BLE001
            out.append((name, f"section broke: {type(broken).__name__}", "FAIL"))
    return out


def identity_disclosures(df: DataFrame, state: str = "state", name: str = "district", code: str = "district_code") -> DataFrame:
    """(kind, key): codes used in several states, and labels with several codes within a state. They are told, not repaired."""
    norm = lambda c: F.lower(F.trim(c))
    codes = df.filter(F.col(code).isNotNull()).groupBy(code).agg(F.count_distinct(norm(F.col(state))).alias("n")).filter("n > 1").select(F.lit("code in several states").alias("kind"), F.col(code).cast("string").alias("key"))
    labels = df.groupBy(norm(F.col(state)).alias("s"), norm(F.col(name)).alias("d")).agg(F.count_distinct(code).alias("n")).filter("n > 1").select(F.lit("label with several codes").alias("kind"), F.concat_ws("/", "s", "d").alias("key"))
    return codes.union(labels)
