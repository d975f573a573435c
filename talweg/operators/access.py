"""Accessibility tables and area-weighted population."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.values import half_up

# Sliver bound, two-way overlap that counts as unchanged, weight of the area share, headroom over a parent's total.
SLIVER, UNCHANGED, AREA_WEIGHT, HEADROOM = 0.02, 0.97, 0.5, 1.02


def district_summary(base: DataFrame, keys: list[str], distances: dict[str, str], thresholds: tuple[float, ...]) -> DataFrame:
    """Per group: rows, and of each distance the median, the mean (two decimals) and the percentage within each threshold. A missing distance is not within."""
    out = [F.count("*").alias("villages")]
    for name, column in distances.items():
        out += [F.median(column).alias(f"{name}_median_km"), half_up(F.round(F.sum(column), 6) / F.count(column), 2).alias(f"{name}_mean_km")]
        out += [F.round(F.avg(F.when(F.col(column) <= x, 1.0).otherwise(0.0)) * 100, 4).alias(f"{name}_within_{x:g}km_pct") for x in thresholds]
    return base.groupBy(*keys).agg(*out)


def state_row(summary: DataFrame, base: DataFrame, distances: dict[str, str], thresholds: tuple[float, ...], people: str) -> DataFrame:
    """The state's row: means weighted by people (districts without them left out), medians null, shares over all villages."""
    weighted = summary.filter(F.col(people).isNotNull()).agg(*[(F.sum(F.col(f"{n}_mean_km") * F.col(people)) / F.sum(people)).alias(f"{n}_mean_km") for n in distances], F.sum(people).alias(people))
    shares = base.agg(F.count("*").alias("villages"), *[(F.avg(F.when(F.col(c) <= x, 1.0).otherwise(0.0)) * 100).alias(f"{n}_within_{x:g}km_pct") for n, c in distances.items() for x in thresholds])
    return shares.join(weighted).withColumns({f"{n}_median_km": F.lit(None).cast("double") for n in distances}).withColumn("district", F.lit("__STATE__"))


def area_shares(pairs: DataFrame, child: str, parent: str) -> DataFrame:
    """Overlay pairs (child, parent, people, area, parent_area) without slivers, with `pop_share`, `child_frac` and `exact`."""
    total = F.sum("area").over(Window.partitionBy(child))
    pairs = pairs.withColumn("__t", total).filter(~((F.col("area") / F.col("parent_area") < SLIVER) & (F.col("area") / F.col("__t") < SLIVER)))
    pairs = pairs.withColumns({"pop_share": F.col("people") * F.col("area") / F.col("parent_area"), "child_frac": F.col("area") / F.sum("area").over(Window.partitionBy(child))})
    back = F.sum("pop_share").over(Window.partitionBy(parent)) / F.col("people")
    return pairs.withColumn("exact", (F.col("child_frac") >= UNCHANGED) & (back >= UNCHANGED)).drop("__t")


def allocate(pairs: DataFrame, villages: DataFrame, caps: DataFrame, groups: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, people, method): area share; half of it from village counts where there are any; at most HEADROOM of the parent of the same name; scaled so that each group meets its total.

    pairs as area_shares returns them; villages (child, villages); caps (child, cap); groups (child, grp, target).
    """
    counted = pairs.join(villages, child, "left").withColumn("v", F.coalesce("villages", F.lit(0)) * F.col("child_frac"))
    share = F.try_divide(F.col("v"), F.sum("v").over(Window.partitionBy(parent))) * F.col("people")
    by_child = counted.withColumn("village_share", share).groupBy(child).agg(F.sum("pop_share").alias("area_people"), F.sum("village_share").alias("village_people"), F.max("exact").alias("exact"))
    blend = ~F.col("exact") & (F.coalesce("village_people", F.lit(0.0)) > 0)
    method = F.when(F.col("exact"), "census2011").when(blend, "blended").otherwise("area_share")
    people = F.when(blend, AREA_WEIGHT * F.col("area_people") + (1 - AREA_WEIGHT) * F.col("village_people")).otherwise(F.col("area_people"))
    capped = by_child.withColumns({"method": method, "raw": people}).join(caps, child, "left").withColumn("raw", F.least("raw", F.col("cap") * HEADROOM))
    grouped = capped.join(groups, child, "left").withColumn("sum", F.sum("raw").over(Window.partitionBy("grp")))
    scaled = F.when((F.col("sum") > 0) & (F.coalesce("target", F.lit(0.0)) > 0), F.col("raw") * F.col("target") / F.col("sum")).otherwise(F.col("raw"))
    return grouped.select(child, scaled.alias("people"), "method")
