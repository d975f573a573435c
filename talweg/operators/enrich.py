"""Rows completed from rosters, state rows below district rows, route notes and list invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions import text
from talweg.operators.relational import keep_first, keep_last

STATE_ROW = "__STATE__"
HUB_ORDER = {"major_port": 0, "mmlp": 1}
FEEDER_EXCESS, LONG_FEEDER_KM = 3.0, 25.0


def access_with_state_rows(base: DataFrame, people: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """Villages, mean and median km, shares within thresholds and population by (state, district), and one row a state.

    base: state, district, km (null: no facility, within no threshold); people: state, district, population. A state's mean
    weighs the district means by population, leaving out districts without one; its median is null.
    """
    within = {f"within_{t:g}km_pct": t for t in thresholds}
    counts = [F.count_if(F.col("km") <= t).alias(name) for name, t in within.items()]
    rows = base.groupBy("state", "district").agg(F.count("*").alias("villages"), F.avg("km").alias("mean_km"), F.median("km").alias("median_km"), *counts)
    rows = rows.join(people, ["state", "district"], "left")
    weighted = F.sum(F.col("mean_km") * F.col("population")) / F.sum("population")
    states = rows.groupBy("state").agg(
        F.lit(STATE_ROW).alias("district"), F.sum("villages").alias("villages"), weighted.alias("mean_km"), F.lit(None).cast("double").alias("median_km"),
        *[F.sum(name).alias(name) for name in within], F.sum("population").alias("population"),
    )
    return rows.unionByName(states).withColumns({name: F.col(name) * 100 / F.col("villages") for name in within})


def with_roster_category(stations: DataFrame, roster: DataFrame, category: str, code: str = "station_code", order: str = "src_order") -> DataFrame:
    """Stations whose code the roster lists under the category, in any case, with the roster's first spelling of it."""
    listed = roster.filter((F.upper("category") == category.upper()) & F.col(code).isNotNull())
    listed = keep_first(listed.select(F.upper(code).alias("__code"), "category", order), ["__code"], order).drop(order)
    return stations.drop("category").withColumn("__code", F.upper(code)).join(listed, "__code").drop("__code")


def enriched(primary: DataFrame, facts: DataFrame, value: str) -> DataFrame:
    """primary (state, district, district_code) with facts' value and a status: found, missing or ambiguous.

    Rows with a code take the fact of that state, name and code. Rows without one take the fact of their state and name,
    if no other row of primary has that pair. Several facts that fit are ambiguous and give no value.
    """
    keys = {"__s": F.lower(F.trim("state")), "__d": F.lower("district")}
    facts = facts.select(*[c.alias(k) for k, c in keys.items()], F.col("district_code").cast("double").alias("__c"), value)
    coded = facts.filter("__c IS NOT NULL").groupBy("__s", "__d", "__c").agg(F.count("*").alias("__cn"), F.first(value).alias("__cv"))
    named = facts.groupBy("__s", "__d").agg(F.count("*").alias("__nn"), F.first(value).alias("__nv"))
    rows = primary.withColumns(keys | {"__c": F.col("district_code").cast("double")})
    twins = rows.groupBy("__s", "__d").agg(F.count("*").alias("__twins"))
    rows = rows.join(twins, ["__s", "__d"], "left").join(named, ["__s", "__d"], "left").join(coded, ["__s", "__d", "__c"], "left")
    n = F.coalesce(F.when(F.col("__c").isNotNull(), F.col("__cn")).when(F.col("__twins") == 1, F.col("__nn")), F.lit(0))
    found = F.when(F.col("__c").isNotNull(), F.col("__cv")).otherwise(F.col("__nv"))
    status = F.when(n == 1, "found").when(n == 0, "missing").otherwise("ambiguous")
    return rows.withColumns({value: F.when(n == 1, found), "status": status}).select(*primary.columns, value, "status")


def lookup_chain(rows: DataFrame, facts: DataFrame, value: str, cutoff: float = 0.7, order: str = "src_order") -> DataFrame:
    """rows (state, district, district_code) with facts' value: by code, else by name, else by the most alike name of the state.

    Of facts with one code or name the last counts. Alike names have a ratio of at least `cutoff`; ties go to the name that
    sorts last. Only distinct names that are still open are compared, and only with names of their own state.
    """
    keys = {"__s": F.lower("state"), "__d": text.access_key(F.col("district"))}
    facts = facts.withColumns(keys | {"__c": F.col("district_code").cast("double")}).select("__s", "__d", "__c", value, order)
    coded = keep_last(facts.filter("__c IS NOT NULL"), ["__s", "__c"], order).select("__s", "__c", F.col(value).alias("__cv"))
    named = keep_last(facts.filter("__d IS NOT NULL"), ["__s", "__d"], order).select("__s", "__d", F.col(value).alias("__nv"), F.lit(True).alias("__named"))
    keyed = rows.drop(value).withColumns(keys | {"__c": F.col("district_code").cast("double")})
    tried = keyed.join(coded, ["__s", "__c"], "left").join(named, ["__s", "__d"], "left")
    asked = tried.filter("__cv IS NULL AND __named IS NULL AND __d IS NOT NULL").select("__s", "__d").distinct()
    pairs = asked.join(named.select("__s", F.col("__d").alias("__name"), F.col("__nv").alias("__fv")), "__s")
    alike = pairs.withColumn("__score", text.similarity(F.col("__name"), F.col("__d"))).filter(F.col("__score") >= cutoff)
    best = keep_first(alike, ["__s", "__d"], F.desc("__score"), F.desc("__name")).select("__s", "__d", "__fv")
    done = tried.join(best, ["__s", "__d"], "left")
    return done.withColumn(value, F.coalesce("__cv", "__nv", "__fv")).select(*[c for c in rows.columns if c != value], value)


def collapsed(points: Column, digits: int = 5) -> Column:
    """Points (array of numbers) rounded, of which none equals the one before it."""
    rounded = F.transform(points, lambda p: F.transform(p, lambda v: F.round(v, digits)))
    return F.filter(rounded, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(rounded, i - 1)))


def route_notes(bridges: Column, bridge_km: Column, origin_km: Column, target_km: Column, direct_km: Column, same_node: Column, zero: Column) -> Column:
    """What a route's reader is to know, as an array of codes in a fixed order."""
    excess = ~zero & (origin_km + target_km > FEEDER_EXCESS * direct_km)
    crossed = F.format_string("bridges:%d:%.2f", bridges.cast("long"), bridge_km.cast("double"))
    notes = [F.when(zero, "zero_movement").when(same_node, "same_node"), F.when(excess, "feeders_exceed_direct"), F.when(bridges > 0, crossed)]
    for name, km in (("origin", origin_km), ("destination", target_km)):
        notes.append(F.when(km > LONG_FEEDER_KM, F.format_string(f"long_feeder:{name}:%.1f", km.cast("double"))))
    return F.array_compact(F.array(*notes))


def coverage_faults(entries: DataFrame, document: str, position: str) -> DataFrame:
    """(document, position, fault) of hub lists (hub_type, hub_order, hub_name); positions are unique in a document.

    unknown_type; duplicate_name: an earlier entry of the type has the name, whatever its case; type_order: the type comes
    after a later one; hub_order: the type's orders do not run from 0 without gaps.
    """
    index = F.try_element_at(F.create_map(*[F.lit(x) for pair in HUB_ORDER.items() for x in pair]), F.col("hub_type"))
    before = Window.partitionBy(document).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    named = Window.partitionBy(document, "hub_type", "__name").orderBy(position)
    rows = entries.withColumns({"__index": index, "__name": F.lower(F.trim("hub_name"))})
    ranked = F.col("__index").isNotNull() & F.col("hub_order").isNotNull()
    rows = rows.withColumn("__late", ranked & (F.col("__index") < F.coalesce(F.max(F.when(ranked, F.col("__index"))).over(before), F.lit(0))))
    rows = rows.withColumn("__last", F.last(F.when(ranked & ~F.col("__late"), F.struct("__index", "hub_order")), ignorenulls=True).over(before))
    due = F.when(F.col("__last.__index") == F.col("__index"), F.col("__last.hub_order") + 1).otherwise(0)
    faults = [
        F.when(F.col("__index").isNull(), "unknown_type"),
        F.when(F.col("__index").isNotNull() & (F.col("__name") != "") & (F.row_number().over(named) > 1), "duplicate_name"),
        F.when(F.col("__late"), "type_order").when(ranked & (F.col("hub_order") != due), "hub_order"),
    ]
    found = rows.withColumn("__faults", F.array_compact(F.array(*faults)))
    return found.select(document, position, F.explode("__faults").alias("fault"))
