"""Joins, dedupes and checks with the exact null, tie and uniqueness rules that the tables' contracts ask for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.operators.stages import numbered


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys of which nulls match each other; right's other columns are added."""
    other = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(other, condition, how).drop(*[f"__r_{k}" for k in keys])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def many_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join; a key that right holds twice is an error, raised while the join runs."""
    once = right.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in right.columns if c not in keys])
    checked = once.withColumn("__ok", F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.concat_ws(" ", F.lit("duplicate key"), *[F.col(k).cast("string") for k in keys])).cast("boolean")))
    return left.join(checked.filter("__ok").drop("__n", "__ok"), keys, "left")


def fallback_join(left: DataFrame, right: DataFrame, code: str, name: str, value: str) -> DataFrame:
    """left with `value`: by code; rows without a code by name, if the name is unique among right's rows without ambiguity."""
    by_code = right.filter(F.col(code).isNotNull()).groupBy(code).agg(F.first(value).alias("__c"))
    by_name = right.groupBy(name).agg(F.count("*").alias("__n"), F.first(value).alias("__v")).filter("__n = 1").drop("__n")
    joined = left.join(by_code, code, "left").join(by_name, name, "left")
    return joined.withColumn(value, F.when(F.col(code).isNotNull(), F.col("__c")).otherwise(F.col("__v"))).drop("__c", "__v")


def identity_lookup(rows: DataFrame, facts: DataFrame, value: str, state: str = "state", name: str = "district", code: str = "district_code") -> DataFrame:
    """rows with `value` from facts: by code where the code is in one state; by state and code where codes collide; rows without a code by state and name."""
    norm = lambda c: F.lower(F.trim(c))
    coded = facts.filter(F.col(code).isNotNull()).withColumn("__s", norm(F.col(state)))
    single = coded.groupBy(code).agg(F.countDistinct("__s").alias("__states"), F.min(value).alias("__one"), F.count("*").alias("__rows"))
    broken = F.when((F.col("__states") == 1) & (F.col("__rows") > 1), F.raise_error(F.lit("duplicate identity")).cast(dict(facts.dtypes)[value]))
    single = single.withColumn("__one", F.coalesce(broken, F.when(F.col("__states") == 1, F.col("__one"))))
    pair = coded.groupBy(F.col(code), F.col("__s")).agg(F.min(value).alias("__pair"))
    named = facts.filter(F.col(code).isNull()).groupBy(norm(F.col(state)).alias("__s"), norm(F.col(name)).alias("__d")).agg(F.count("*").alias("__k"), F.min(value).alias("__named")).filter("__k = 1").drop("__k")
    out = rows.withColumns({"__s": norm(F.col(state)), "__d": norm(F.col(name))})
    out = out.join(single.select(code, "__one"), code, "left").join(pair, [code, "__s"], "left").join(named, ["__s", "__d"], "left")
    found = F.when(F.col(code).isNotNull(), F.coalesce("__one", "__pair")).otherwise(F.col("__named"))
    return out.withColumn(value, found).drop("__s", "__d", "__one", "__pair", "__named")


def map_values(df: DataFrame, table: DataFrame, key: str, value: str, default=None) -> DataFrame:
    out = df.join(table.select(key, value), key, "left")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def orphans(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def keep_first(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__r = 1").drop("__r")


def keep_last(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return keep_first(df, keys, *[F.col(o).desc() for o in order])


def flag_duplicates(df: DataFrame, keys: list[str], out: str = "is_duplicate") -> DataFrame:
    return df.withColumn(out, F.count("*").over(Window.partitionBy(*keys)) > 1)


def mode_per_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The commonest value; of equals the smallest. Nulls do not count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).count()
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("count")).alias("__any"), F.min(F.struct((-F.col("count")).alias("n"), value)).alias("s")).select(*keys, F.col(f"s.{value}").alias(value), (-F.col("s.n")).alias("n"))


def runs(df: DataFrame, partition: list[str], order: str, value: str) -> DataFrame:
    """df with `run`: numbers of the stretches of equal neighbours, from 1."""
    w = Window.partitionBy(*partition).orderBy(order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("__new", new).withColumn("run", F.sum("__new").over(w)).drop("__new")


def not_falling(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys, monotonic): whether value never falls along order."""
    fall = F.col(value) < F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("__f", fall).groupBy(*keys).agg((~F.coalesce(F.bool_or("__f"), F.lit(False))).alias("monotonic"))


def systematic_positions(total: int, n: int) -> list[int]:
    """n positions spread evenly over 0 .. total - 1, both ends in."""
    if n <= 0 or total <= 0:
        return []
    return sorted({round(i * (total - 1) / (n - 1)) for i in range(n)}) if n > 1 else [0]


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows, the same for the same seed: those of smallest hash."""
    return df.withColumn("__h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)).orderBy("__h").limit(n).drop("__h")


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_default(df: DataFrame, column: str, value) -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def ordered(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in this order; missing ones are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])


def frame_difference(left: DataFrame, right: DataFrame, key: str, tolerance: float = 1e-9) -> DataFrame:
    """(key, problem): rows missing on one side, or with a value that differs (numbers by more than the tolerance)."""
    from talweg.functions.values import null_safe_equal_rows

    values = [c for c in left.columns if c != key]
    other = right.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__r_{c}") for c in values])
    both = left.join(other, F.col(key).eqNullSafe(F.col("__k")), "full")
    same = null_safe_equal_rows(both, tolerance, [(c, f"__r_{c}") for c in values])
    problem = F.when(F.col(key).isNull(), "missing left").when(F.col("__k").isNull(), "missing right").when(~same, "different")
    return both.select(F.coalesce(F.col(key), F.col("__k")).alias(key), problem.alias("problem")).filter("problem IS NOT NULL")


def content_hash(df: DataFrame, order: str, block: int = 10_000) -> DataFrame:
    """One row: a hash over all rows in order, of repeated orders by the row's own hash.

    A row's hash is over its values with their lengths, so that no two rows share it, and null is apart from empty. Rows
    are numbered by range and hashed a block at a time; the last hash is over one line for every block.
    """
    value = lambda c: F.concat(F.lit("V"), F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string"))
    line = F.concat(*[F.coalesce(value(c), F.lit("N")) for c in df.columns])
    rows = df.select(F.struct(F.col(order).alias("o"), F.sha2(line, 256).alias("h")).alias("s"))
    told = numbered(rows, "s", "n").groupBy(F.floor(F.col("n") / block).alias("b")).agg(F.sort_array(F.collect_list("s")).alias("s"))
    blocks = told.select("b", F.sha2(F.array_join("s.h", "\n"), 256).alias("h"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "h"))), lambda s: s["h"]), "\n")
    return blocks.agg(F.sha2(joined, 256).alias("content_hash"))


def unique_row(df: DataFrame, limit: int = 10) -> dict:
    """What a lookup found: {'status': 'found', 'row': ...}, 'missing', or 'ambiguous' with candidates."""
    rows = df.limit(limit).collect()
    if not rows:
        return {"status": "missing"}
    if len(rows) > 1:
        return {"status": "ambiguous", "candidates": [r.asDict() for r in rows]}
    return {"status": "found", "row": rows[0].asDict()}
