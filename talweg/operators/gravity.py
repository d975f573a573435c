"""Gravity allocation of districts to ports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.values import finite, observation

# Ports in order (which breaks ties) with capacities in million tonnes a year; exponents; category bounds.
PORT_CAPACITIES = (
    ("Paradip Port", 145.38), ("Deendayal Port (Kandla)", 132.50), ("Jawaharlal Nehru Port (JNPT)", 86.00), ("Visakhapatnam Port", 81.00),
    ("Syama Prasad Mookerjee Port (Kolkata/Haldia)", 66.00), ("Mumbai Port", 65.00), ("Chennai Port", 54.50), ("Kamarajar Port (Ennore)", 48.00),
    ("New Mangalore Port", 46.00), ("V.O. Chidambaranar Port (Tuticorin)", 41.50), ("Cochin Port", 36.50), ("Mormugao Port", 20.50),
)
BATCH_EXPONENTS, LIVE_EXPONENTS = (1.2, 1.5), (0.85, 1.65)
CAPTIVE, DOMINANT = 0.75, 0.50
SCALE_HOURS = 5.0


def capacities(overrides: Mapping[str, float] | None = None) -> dict[str, float]:
    found = dict(PORT_CAPACITIES)
    for name, value in (overrides or {}).items():
        if name not in found:
            raise ValueError(f"unknown port {name!r}")
        if isinstance(value, bool) or not value > 0 or value == float("inf"):
            raise ValueError(f"capacity of {name!r} must be finite and positive")
        found[name] = float(value)
    return found


def _power(base: Column, exponent: float) -> Column:
    value = F.pow(base, F.lit(float(exponent)))
    return F.when(finite(value) & (value > 0), value).otherwise(F.raise_error(F.lit("gravity input exceeds the numerical range")))


def utilities(routes: DataFrame, alpha: float, beta: float) -> DataFrame:
    """routes (district, port, port_order, capacity, hours, km) with `utility`; null where there is no route or no time.

    A pair of which one is missing is an error; zero hours are left out, zero kilometres are not.
    """
    hours, km = observation(F.col("hours"), "port drive time"), observation(F.col("km"), "port road distance")
    half = hours.isNull() != km.isNull()
    routes = routes.withColumn("__h", F.when(half, F.raise_error(F.lit("distance and time must be missing together")).cast("double")).otherwise(hours))
    used = F.when(F.col("__h") > 0, F.col("__h"))
    return routes.withColumn("utility", F.when(used.isNotNull(), _power(F.col("capacity"), alpha) / _power(F.coalesce(used, F.lit(SCALE_HOURS)) / SCALE_HOURS, beta))).drop("__h")


def hinterland(routes: DataFrame, keys: list[str], alpha: float = BATCH_EXPONENTS[0], beta: float = BATCH_EXPONENTS[1], island: Column | None = None) -> DataFrame:
    """One row per keys: the two likeliest ports with rounded probabilities, the category, the contestability."""
    island = F.lit(False) if island is None else island
    rows = utilities(routes, alpha, beta).withColumn("__island", island)
    total = F.sum("utility").over(Window.partitionBy(*keys))
    rows = rows.withColumn("p", F.when(~F.col("__island"), F.col("utility") / total))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("p").desc_nulls_last(), "port_order"))
    pick = lambda c, n: F.max(F.when((F.col("rank") == n) & F.col("p").isNotNull(), F.col(c)))
    top = rows.withColumn("rank", rank).filter("rank <= 2").groupBy(*keys).agg(F.max("__island").alias("is_island"), *[pick(c, n).alias(f"{c}{n}") for n in (1, 2) for c in ("port", "p", "hours")])
    some = F.col("p1").isNotNull()
    p2 = F.coalesce("p2", F.lit(0.0))
    return top.select(
        *keys,
        "is_island",
        F.when(some, F.col("port1")).when(F.col("is_island"), "N/A (Island)").otherwise("N/A").alias("primary_port"),
        F.round(F.col("p1") * 100, 1).alias("primary_port_probability"),
        F.round("hours1", 2).alias("primary_port_drive_hours"),
        F.when(some, F.coalesce("port2", F.lit("None"))).otherwise("N/A").alias("secondary_port"),
        F.when(some, F.round(p2 * 100, 1)).alias("secondary_port_probability"),
        F.when(some, F.round(F.coalesce("hours2", F.lit(0.0)), 2)).alias("secondary_port_drive_hours"),
        F.when(F.col("is_island"), "Island / Isolated").when(~some, "Isolated").when(F.col("p1") >= CAPTIVE, "Captive Hinterland").when(F.col("p1") >= DOMINANT, "Dominant / Mildly Contested").otherwise("Highly Contested / Split Hinterland").alias("hinterland_category"),
        F.when(some, F.round(1.0 - (F.col("p1") - p2), 3)).alias("contestability_index"),
    )


def live_shares(routes: DataFrame, ports: DataFrame, key: str = "district_code", alpha: float = LIVE_EXPONENTS[0], beta: float = LIVE_EXPONENTS[1]) -> DataFrame:
    """Every port (port, port_order) with the districts and people it wins; a district goes to the port of largest utility."""
    # on the stored columns, so that the filter stays small; broken pairs stay in and raise
    rows = utilities(routes.filter("hours > 0 OR isnan(hours) OR (hours IS NULL) <> (km IS NULL)"), alpha, beta).filter("hours > 0")
    best = rows.groupBy(key).agg(F.max_by(F.struct("port", "population"), F.struct("utility", -F.col("port_order"))).alias("s"))
    won = best.groupBy(F.col("s.port").alias("port")).agg(F.count("*").alias("n"), F.sum(F.coalesce("s.population", F.lit(0))).alias("people"))
    all_ = Window.partitionBy()
    joined = ports.join(won, "port", "left")  # ports without a district stay; a handful of rows
    share = F.coalesce(F.round(F.col("n") / F.sum("n").over(all_) * 100.0, 1), F.lit(0.0))
    return joined.select(F.col("port").alias("port_name"), "port_order", F.coalesce("n", F.lit(0)).alias("captured_districts_count"), share.alias("market_share_districts_pct"), F.round(F.coalesce("people", F.lit(0)) / 1e7, 2).alias("captured_population_cr"))
