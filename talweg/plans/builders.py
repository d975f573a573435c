"""Queries of the composite builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.operators import access, builders, spatial
from talweg.plans import tables as t


def population_allocation(spark, sf):
    n = t.read(spark, sf, "nation")
    old = n.select(F.col("n_nationkey").alias("parent"), ((F.col("n_nationkey") % 5) * 10.0).alias("x0"), (F.floor(F.col("n_nationkey") / 5) * 10.0).alias("y0")).withColumns({"x1": F.col("x0") + 10, "y1": F.col("y0") + 10, "people": (F.col("parent") + 1) * 1000.0})
    new = n.select(F.col("n_nationkey").alias("child"), ((F.col("n_nationkey") % 5) * 9.5 + 1.3).alias("x0"), (F.floor(F.col("n_nationkey") / 5) * 9.8 + 0.1).alias("y0")).withColumns({"x1": F.col("x0") + 9.5, "y1": F.col("y0") + 9.8})
    pairs = access.area_shares(spatial.box_overlaps(new, old, 10.0).select("child", F.col("r_parent").alias("parent"), F.col("r_people").alias("people"), "area", F.lit(100.0).alias("parent_area")), "child", "parent")
    villages = t.read(spark, sf, "customer").filter("c_nationkey % 4 <> 0").groupBy(F.col("c_nationkey").alias("child")).agg(F.count("*").alias("villages"))
    caps = n.filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("child"), ((F.col("n_nationkey") + 1) * 900.0).alias("cap"))
    groups = n.select(F.col("n_nationkey").alias("child"), F.col("n_regionkey").alias("grp"), F.when(F.col("n_regionkey") != 2, 50_000.0).alias("target"))
    return access.allocate(pairs, villages, caps, groups).select("child", F.round("people", 3).alias("people"), "method")


def boundary_layer(spark, sf):
    s = t.read(spark, sf, "supplier").join(t.read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    raw = s.select(F.when(F.col("s_suppkey") % 11 == 0, "DISPUTED area").when(F.col("s_suppkey") % 13 != 0, F.col("n_name")).alias("STNAME"), F.concat(F.lit("d|st<"), (F.col("s_suppkey") % 20).cast("string")).alias("dtname"), F.concat((F.col("s_suppkey") % 20).cast("string"), F.lit("N04")).alias("dtcode"), F.col("s_suppkey").alias("src_order"))
    return builders.standard_boundaries(raw, {"STNAME": "state", "dtname": "district", "dtcode": "district_code"}, ["state", "district", "district_code"]).select("state", "district", "district_code", "src_order")


def missing_districts(spark, sf):
    sub = t.read(spark, sf, "customer").select((F.col("c_custkey") % 40).alias("district_code"), F.concat(F.lit("d"), (F.col("c_custkey") % 3).cast("string")).alias("district"), F.concat(F.lit("s"), (F.col("c_custkey") % 80 >= 60).cast("string")).alias("state"))
    known = t.read(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("district_code"))
    return builders.missing_districts(sub, known)


def station_waterfall(spark, sf):
    """Suppliers as terminals, named after nations in several ways; stations of the nations, hubs of the regions."""
    n = t.read(spark, sf, "nation")
    way, name = F.col("s_suppkey") % 6, F.col("n_name")
    asked = F.when(way == 0, F.concat(name, F.lit(" Junction (new)"))).when(way == 1, F.substring(name, 1, 4)).when(way == 2, F.concat(F.substring(name, 1, 5), F.lit("x"), F.substring(name, 6, 30)))
    asked = asked.when(way == 3, F.lit("Nowhere 12345")).when(way == 4, F.concat(F.initcap(F.substring(name, 1, 3)), F.lit(" - dock")))
    wanted = t.read(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", asked.alias("name"), F.when(F.col("s_suppkey") % 4 < 3, F.col("n_regionkey").cast("string")).otherwise("x").alias("state"))
    stations = n.select(F.col("n_nationkey").alias("code"), F.concat("n_name", F.lit(" Road")).alias("name"), F.col("n_regionkey").cast("string").alias("state"), ((F.col("n_nationkey") * 7) % 25).alias("src_order"))
    ports = t.read(spark, sf, "region").select(F.concat(F.lit("Port of nowhere "), "r_name").alias("name"), F.col("r_regionkey").alias("src_order"))
    return builders.match_stations(wanted, stations, "s_suppkey", (ports,)).select("s_suppkey", "s_code", "tier", "s_hub")


def plaza_clusters(spark, sf):
    pts = t.sites(spark, sf).select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("NH"), (F.col("c_custkey") % 9).cast("string"))).alias("ref"), "lat", "lon", "x", "y")
    return builders.plaza_clusters(pts, "c_custkey", 20_000.0).select("component", "name", "ref", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "n")


def village_access(spark, sf):
    v = t.read(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") % 100).alias("code"), F.concat(F.lit("v"), (F.col("c_custkey") % 150).cast("string")).alias("name"))
    a = t.read(spark, sf, "supplier").select(F.when(F.col("s_suppkey") % 10 != 0, F.col("s_suppkey") % 100).alias("code"), F.concat(F.lit("v"), (F.col("s_suppkey") + 100).cast("string")).alias("name"), F.round("s_acctbal", 1).alias("km"))
    return builders.village_access(v, a).select("c_custkey", "km")


def facility_table(spark, sf):
    h = t.hubs(spark, sf)
    part = lambda kind: h.filter(F.col("kind") == kind).select(F.col("s_name").alias("label"), F.when(F.col("s_suppkey") % 5 != 0, F.round("x", 2)).alias("x"), F.round("y", 2).alias("y"), F.col("s_suppkey").alias("source_order"))
    return builders.facilities({k: part(k) for k in ("rail", "port", "air")})


def first_pass_winners(spark, sf):
    m = t.matrix(spark, sf).select("district_code", (F.col("port_order") % 3).alias("kind"), F.col("hours").alias("total_hours"), F.col("port_order").alias("slot"), F.col("port").alias("hub"), F.lit(0).alias("u"), F.lit(0).alias("v"))
    return builders.winners_then_paths(m, ["district_code", "kind"]).select("district_code", "kind", "hub", "total_hours")


QUERIES = {f.__name__: f for f in (population_allocation, boundary_layer, missing_districts, station_waterfall, plaza_clusters, village_access, facility_table, first_pass_winners)}

_PAIRS = "o AS (SELECT n_nationkey AS parent, (n_nationkey % 5) * 10.0::DOUBLE AS x0, (n_nationkey // 5) * 10.0::DOUBLE AS y0, (n_nationkey + 1) * 1000.0::DOUBLE AS people FROM nation), c AS (SELECT n_nationkey AS child, (n_nationkey % 5) * 9.5::DOUBLE + 1.3::DOUBLE AS x0, (n_nationkey // 5) * 9.8::DOUBLE + 0.1::DOUBLE AS y0 FROM nation), i AS (SELECT child, parent, people, (least(c.x0 + 9.5::DOUBLE, o.x0 + 10) - greatest(c.x0, o.x0)) * (least(c.y0 + 9.8::DOUBLE, o.y0 + 10) - greatest(c.y0, o.y0)) AS area FROM c JOIN o ON c.x0 < o.x0 + 10 AND o.x0 < c.x0 + 9.5::DOUBLE AND c.y0 < o.y0 + 10 AND o.y0 < c.y0 + 9.8::DOUBLE), w AS (SELECT *, sum(area) OVER (PARTITION BY child) AS t FROM i), k AS (SELECT * FROM w WHERE NOT (area / 100 < 0.02 AND area / t < 0.02)), z AS (SELECT *, people * area / 100 AS share, area / sum(area) OVER (PARTITION BY child) AS frac, sum(people * area / 100) OVER (PARTITION BY parent) AS back FROM k)"
ORACLE_SQL = {
    "population_allocation": f"WITH {_PAIRS}, v AS (SELECT c_nationkey AS child, count(*) AS villages FROM customer WHERE c_nationkey % 4 <> 0 GROUP BY 1), y AS (SELECT z.*, coalesce(villages, 0) * frac AS v FROM z LEFT JOIN v USING (child)), x AS (SELECT *, v / nullif(sum(v) OVER (PARTITION BY parent), 0) * people AS vshare FROM y), a AS (SELECT child, sum(share) AS ap, sum(vshare) AS vp, bool_or(frac >= 0.97 AND back / people >= 0.97) AS exact FROM x GROUP BY child), b AS (SELECT child, CASE WHEN NOT exact AND coalesce(vp, 0) > 0 THEN 0.5 * ap + 0.5 * vp ELSE ap END AS raw, CASE WHEN exact THEN 'census2011' WHEN coalesce(vp, 0) > 0 THEN 'blended' ELSE 'area_share' END AS method FROM a), d AS (SELECT child, method, CASE WHEN child % 3 = 0 THEN least(raw, (child + 1) * 900.0::DOUBLE * 1.02) ELSE raw END AS raw, n_regionkey AS g FROM b JOIN nation ON n_nationkey = child) SELECT child, round(CASE WHEN g <> 2 THEN raw * 50000 / sum(raw) OVER (PARTITION BY g) ELSE raw END, 3) AS people, method FROM d",
    "boundary_layer": "WITH r AS (SELECT CASE WHEN s_suppkey % 13 <> 0 THEN n_name END AS s, s_suppkey % 20 AS c, s_suppkey AS o FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 11 <> 0), k AS (SELECT s, c, min(o) AS o FROM r WHERE s IS NOT NULL GROUP BY ALL) SELECT array_to_string(list_transform(string_split(s, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS state, 'Dista' || c AS district, c::BIGINT AS district_code, o AS src_order FROM k",
    "missing_districts": "WITH s AS (SELECT c_custkey % 40 AS c, 'd' || (c_custkey % 3) AS d, 's' || (c_custkey % 80 >= 60)::VARCHAR AS st FROM customer), l AS (SELECT * FROM s WHERE c NOT IN (SELECT n_nationkey FROM nation)), n AS (SELECT c, d, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, d) AS k FROM l GROUP BY c, d), z AS (SELECT c, string_agg(DISTINCT st, ';' ORDER BY st) AS states, count(DISTINCT st) > 1 AS clash FROM l GROUP BY c) SELECT c AS district_code, d AS district, states, clash FROM n JOIN z USING (c) WHERE k = 1",
    "village_access": "WITH a AS (SELECT CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey % 100 END AS code, 'v' || (s_suppkey + 100) AS name, round(s_acctbal, 1) AS km FROM supplier), v AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 100 END AS code, 'v' || (c_custkey % 150) AS name FROM customer), n AS (SELECT name, any_value(km) AS km FROM a GROUP BY name HAVING count(*) = 1), k AS (SELECT code, min(km) AS km FROM a WHERE code IS NOT NULL GROUP BY code) SELECT c_custkey, coalesce(k.km, n.km) AS km FROM v LEFT JOIN k ON k.code = v.code LEFT JOIN n ON n.name = v.name",
    "facility_table": t.with_("hub") + "SELECT kind, s_name AS label, CASE WHEN s_suppkey % 5 <> 0 THEN round(x, 2) END AS x, CASE WHEN s_suppkey % 5 <> 0 THEN round(y, 2) END AS y, s_suppkey AS source_order FROM hub WHERE kind IN ('rail', 'port', 'air')",
    "first_pass_winners": t.with_("matrix") + "SELECT district_code, kind, port AS hub, hours AS total_hours FROM (SELECT *, row_number() OVER (PARTITION BY district_code, kind ORDER BY hours, port_order) AS k FROM (SELECT *, port_order % 3 AS kind FROM matrix WHERE hours IS NOT NULL)) WHERE k = 1",
    "plaza_clusters": "WITH RECURSIVE " + t.CTE["site"] + ", e AS (SELECT a.c_custkey AS u, b.c_custkey AS v FROM site a JOIN site b ON a.c_custkey <> b.c_custkey AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 20000), r(node, c) USING KEY (node) AS (SELECT c_custkey, c_custkey FROM site UNION (SELECT e.v, min(r.c) FROM r JOIN e ON e.u = r.node JOIN recurring.r o ON o.node = e.v WHERE r.c < o.c GROUP BY e.v)) SELECT c AS component, arg_min(c_name, c_custkey) FILTER (c_custkey % 3 = 0) AS name, arg_min('NH' || (c_custkey % 9), c_custkey) FILTER (c_custkey % 5 = 0) AS ref, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, count(*) AS n FROM r JOIN site ON c_custkey = node GROUP BY c",
}
