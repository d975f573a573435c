"""Composite builders: boundary layers, station matching, toll plazas, facility tables, the district-by-hub matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.text import clean_state_name, highway_numbers, leading_code, lower_and, repair_glyphs, similarity, station_key
from talweg.operators.graph import clusters
from talweg.operators.relational import keep_first, keep_last, union_all
from talweg.operators.stages import cut


def standard_boundaries(raw: DataFrame, rename: dict[str, str], keep: list[str]) -> DataFrame:
    """A boundary layer under common names: disputed rows and rows without a state go, names are repaired, codes are numbers, the first of a repeated code stays."""
    df = raw.withColumnsRenamed(rename).select(*keep, "src_order")
    df = df.filter(F.col("state").isNotNull() & ~F.coalesce(F.upper("state").contains("DISPUTED"), F.lit(False)))
    names = [c for c in ("state", "district") if c in keep]
    df = df.withColumns({c: lower_and(F.initcap(repair_glyphs(F.trim(c)))) for c in names} | {c: leading_code(F.col(c)) for c in keep if c.endswith("_code")})
    coded = df.filter(F.col("district_code").isNotNull())
    return keep_first(coded, ["state", "district_code"], "src_order").unionByName(df.filter(F.col("district_code").isNull()))


def missing_districts(subdistricts: DataFrame, districts: DataFrame) -> DataFrame:
    """Districts that only sub-districts know: code, commonest name, states; `clash` where one code has several states."""
    lost = subdistricts.join(districts.select("district_code"), "district_code", "left_anti")
    names = lost.groupBy("district_code", "district").count().groupBy("district_code").agg(F.min(F.struct((-F.col("count")).alias("n"), "district")).alias("s"))
    states = lost.groupBy("district_code").agg(F.sort_array(F.collect_set("state")).alias("states"))
    return names.join(states, "district_code").select("district_code", F.col("s.district").alias("district"), F.array_join("states", ";").alias("states"), (F.size("states") > 1).alias("clash"))


def _grams(name: str, sizes: tuple[int, ...]) -> Column:
    """Rows of the distinct parts of a name with the given numbers of letters."""
    part = lambda n: F.transform(F.sequence(F.lit(1), F.length(name) - (n - 1)), lambda i: F.substring(F.col(name), i, F.lit(n)))
    none = F.array().cast("array<string>")
    return F.explode(F.array_distinct(F.concat(*[F.when(F.length(name) >= n, part(n)).otherwise(none) for n in sizes])))


def match_stations(wanted: DataFrame, stations: DataFrame, key: str, hubs: tuple[DataFrame, ...] = (), fuzzy: float = 0.82) -> DataFrame:
    """wanted (key, name, state) with its station (s_code, tier) among stations (code, name, state, src_order).

    Names are compared by their station key; what is asked for ends at a parenthesis or a dash. Tiers, the first that hits
    counts, and in it the first station of the source: 1 the same name in the state; 2 a name in the state that holds it;
    3 and 4 the same in any state; 5 the name that is most alike, at least `fuzzy`, the last in the alphabet of equally
    alike ones. Then hubs (name, src_order), one table after another: 6 and up, the first hub whose name holds the first
    word, given as s_hub. Names that are null or empty find nothing.

    No pair of names is formed that shares no letters: a name that holds another holds its first three letters, and two
    names that are alike to 0.82 share two neighbouring letters.
    """
    asked = F.split(F.split("name", r"\(", 2)[0], " - ", 2)[0]
    w = cut(wanted.select(F.monotonically_increasing_id().alias("__id"), F.col(key), F.nullif(station_key(asked), F.lit("")).alias("w"), F.lower("state").alias("ws"), *[F.col(c).alias(f"__k_{c}") for c in wanted.columns]))
    s = stations.select(F.col("code").alias("s_code"), station_key(F.col("name")).alias("s"), F.lower("state").alias("ss"), F.col("src_order").alias("s_order"))
    start = lambda c: F.substring(c, 1, 3)
    here = F.col("ws") == F.col("ss")
    exact = w.join(s, F.col("w") == F.col("s")).withColumn("tier", F.when(here, 1).otherwise(3))
    part = w.withColumn("g", start("w")).join(s.withColumn("g", _grams("s", (1, 2, 3))), "g").filter(F.col("s").contains(F.col("w"))).withColumn("tier", F.when(here, 2).otherwise(4))
    first = keep_first(union_all([x.select("__id", "s_code", "s_order", "tier") for x in (exact, part)]), ["__id"], "tier", "s_order")
    lost = w.join(first.select("__id"), "__id", "left_anti")
    names = s.filter("s <> ''").groupBy("s").agg(F.min(F.struct("s_order", "s_code")).alias("m"))
    near = lost.withColumn("g", _grams("w", (1, 2))).join(names.withColumn("g", _grams("s", (1, 2))), "g").drop("g").dropDuplicates(["__id", "s"])
    alike = near.withColumn("score", similarity("s", "w")).filter(F.col("score") >= fuzzy)
    alike = keep_first(alike, ["__id"], F.desc("score"), F.desc("s")).select("__id", "m.s_code", "m.s_order", F.lit(5).alias("tier"))
    found = first.unionByName(alike).withColumn("s_hub", F.lit(None).cast("string"))
    for i, hub in enumerate(hubs):
        word = F.split("w", r"\s+", 2)[0]
        h = hub.select(F.col("name").alias("s_hub"), station_key(F.lower("name")).alias("hn"), F.col("src_order").alias("s_order"))
        open_ = w.join(found.select("__id"), "__id", "left_anti").filter("w IS NOT NULL").withColumn("first", word).withColumn("g", start("first"))
        hit = open_.join(h.withColumn("g", _grams("hn", (1, 2, 3))), "g").filter(F.col("hn").contains(F.col("first")))
        hit = keep_first(hit, ["__id"], "s_order").select("__id", F.lit(None).cast(dict(found.dtypes)["s_code"]).alias("s_code"), "s_order", F.lit(6 + i).alias("tier"), "s_hub")
        found = found.unionByName(hit)
    kept = [F.col(f"__k_{c}").alias(c) for c in wanted.columns]
    return w.join(found.select("__id", "s_code", "tier", "s_hub"), "__id", "left").select(*kept, "s_code", "tier", "s_hub")


def plaza_clusters(points: DataFrame, key: str, radius: float = 150.0) -> DataFrame:
    """Toll plazas from points: those within the radius of each other, linked on, are one; first known name and ref, mean place, size."""
    labels = clusters(points, key, radius)
    joined = points.join(labels, points[key] == labels["node"])
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(key, c)))[c].alias(c)
    return joined.groupBy("component").agg(first("name"), first("ref"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("n"))


def highway_network(ways: DataFrame) -> DataFrame:
    """Ways (osm_id, ref, name, highway, points, src_order) that carry a highway number; the last of a repeated id stays."""
    numbered = ways.withColumn("nh", highway_numbers(F.col("ref"))).filter("nh <> '' AND size(points) >= 2")
    return keep_last(numbered, ["osm_id"], "src_order")


def facilities(tables: dict[str, DataFrame]) -> DataFrame:
    """One table (kind, label, x, y, source_order) of all facility kinds; unusable points stay with nulls."""
    out = []
    for kind, df in tables.items():
        good = F.col("x").isNotNull() & ~F.isnan("x") & F.col("y").isNotNull() & ~F.isnan("y")
        out.append(df.select(F.lit(kind).alias("kind"), F.col("label"), F.when(good, F.col("x")).alias("x"), F.when(good, F.col("y")).alias("y"), "source_order"))
    return union_all(out)


def village_access(villages: DataFrame, access: DataFrame) -> DataFrame:
    """villages with their access rows: by the code as text, of rows that share a code the least km, and where there is none by name."""
    coded = access.filter("code IS NOT NULL").groupBy(F.col("code").cast("string").alias("__c")).agg(F.min("km").alias("__by_code"))
    named = access.groupBy(F.col("name").alias("__n")).agg(F.count("*").alias("k"), F.first("km").alias("__by_name")).filter("k = 1").drop("k")
    joined = villages.join(coded, villages["code"].cast("string") == F.col("__c"), "left").join(named, villages["name"] == F.col("__n"), "left")
    return joined.withColumn("km", F.coalesce("__by_code", "__by_name")).drop("__c", "__n", "__by_code", "__by_name")


def winners_then_paths(times: DataFrame, keys: list[str]) -> DataFrame:
    """The first pass of the district-by-hub matrix: of each kind the hub of least total time, ties to the earlier source. Only these are given paths in the second pass."""
    best = F.struct("total_hours", "slot", "hub", "u", "v")
    return times.filter("total_hours IS NOT NULL").groupBy(*keys).agg(F.min(best).alias("s")).select(*keys, "s.hub", "s.total_hours", "s.u", "s.v")


def strata_sample(df: DataFrame, stratum: Column, order: str) -> DataFrame:
    """The first row of every stratum."""
    return keep_first(df.withColumn("stratum", stratum), ["stratum"], order)
