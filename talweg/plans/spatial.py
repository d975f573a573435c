"""Queries of the spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.functions import geo
from talweg.operators import access, relational, spatial
from talweg.plans import tables as t

RADIUS, CELL = 60_000.0, 100_000.0
THRESHOLDS = (10.0, 25.0, 50.0)


def lcc_projection(spark, sf):
    return t.sites(spark, sf).select("c_custkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def snap_grid(spark, sf):
    return t.sites(spark, sf).select("c_custkey", geo.snap(F.round("x", 3)).alias("gx"), geo.snap(F.round("y", 3)).alias("gy"))


def geodesic_distance(spark, sf):
    s = t.sites(spark, sf)
    return s.select("c_custkey", F.round(geo.geodesic_km(F.col("lon"), F.col("lat"), F.lit(77.0), F.lit(20.0)), 1).alias("km"))


def radius_join(spark, sf):
    a = t.sites(spark, sf).select("c_custkey", "x", "y")
    b = t.hubs(spark, sf).select("s_suppkey", "x", "y")
    return spatial.radius_join(a, b, RADIUS).select("c_custkey", F.col("r_s_suppkey").alias("s_suppkey"), F.round("dist_m", 3).alias("dist_m"))


def self_radius_pairs(spark, sf):
    return spatial.self_pairs(t.hubs(spark, sf), "s_suppkey", 200_000.0).select("a", "b", F.round("dist_m", 3).alias("dist_m"))


def nearest_per_kind(spark, sf):
    a = t.sites(spark, sf).select("c_custkey", "x", "y")
    b = t.hubs(spark, sf).select("s_suppkey", "kind", "x", "y")
    found = spatial.nearest(a, b, "c_custkey", "s_suppkey", CELL, by="kind")
    return found.select("c_custkey", F.col("r_kind").alias("kind"), F.col("r_s_suppkey").alias("s_suppkey"), F.round("dist_m", 3).alias("dist_m"))


def knn_per_category(spark, sf):
    a = t.sites(spark, sf).select("c_custkey", "x", "y")
    b = t.hubs(spark, sf).select("s_suppkey", "kind", "x", "y")
    found = spatial.nearest(a, b, "c_custkey", "s_suppkey", CELL, k=2, by="kind")
    return found.select("c_custkey", F.col("r_kind").alias("kind"), "rank", F.col("r_s_suppkey").alias("s_suppkey"), F.round("dist_m", 3).alias("dist_m"))


def _boxes(spark, sf):
    n = t.read(spark, sf, "nation")
    lon, lat = F.lit(69.0) + (F.col("n_nationkey") % 5) * 5.4, F.lit(8.0) + F.floor(F.col("n_nationkey") / 5) * 5.6
    p = lambda dx, dy: F.struct((lon + dx).alias("x"), (lat + dy).alias("y"))
    return n.select(F.col("n_nationkey").alias("district_code"), F.array(F.array(p(0.013, 0.013), p(5.0, 0.013), p(5.0, 5.013), p(0.013, 5.013))).alias("rings"))


def pip_join(spark, sf):
    a = t.sites(spark, sf).select("c_custkey", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return spatial.points_in_polygons(a, _boxes(spark, sf), 2.0, "left").select("c_custkey", F.col("p_district_code").alias("district_code"))


def nearest_polygon(spark, sf):
    a = t.hubs(spark, sf).select("s_suppkey", F.col("lon").alias("x"), F.col("lat").alias("y"))
    boxes = _boxes(spark, sf)
    pairs = a.join(F.broadcast(boxes))  # 25 districts
    dist = F.when(spatial.inside_polygon(F.col("x"), F.col("y"), F.col("rings")), 0.0).otherwise(spatial.distance_to_rings(F.col("x"), F.col("y"), F.transform("rings", lambda r: F.concat(r, F.slice(r, 1, 1)))))
    return relational.keep_first(pairs.withColumn("dist", F.round(dist, 6)), ["s_suppkey"], "dist", "district_code").select("s_suppkey", "district_code", "dist")


def nearest_road(spark, sf):
    pts = t.read(spark, sf, "part").select("p_partkey", ((F.col("p_partkey") * 37) % 5700).cast("double").alias("x"), ((F.col("p_partkey") * 91) % 2700).cast("double").alias("y"))
    lines = t.road_lines(spark, sf).select("line", "road", F.col("points")[0]["x"].alias("ax"), F.col("points")[0]["y"].alias("ay"), F.col("points")[1]["x"].alias("bx"), F.col("points")[1]["y"].alias("by"))
    return spatial.nearest_segment(pts, lines, "p_partkey", "line", 400.0).select("p_partkey", F.col("s_line").alias("line"), F.round("dist_m", 6).alias("dist_m"))


def overlay_area_alloc(spark, sf):
    n = t.read(spark, sf, "nation")
    old = n.select(F.col("n_nationkey").alias("parent"), ((F.col("n_nationkey") % 5) * 10.0).alias("x0"), (F.floor(F.col("n_nationkey") / 5) * 10.0).alias("y0")).withColumns({"x1": F.col("x0") + 10, "y1": F.col("y0") + 10, "people": (F.col("parent") + 1) * 1000.0})
    new = n.select(F.col("n_nationkey").alias("child"), ((F.col("n_nationkey") % 5) * 9.5 + 1.3).alias("x0"), (F.floor(F.col("n_nationkey") / 5) * 9.8 + 0.1).alias("y0")).withColumns({"x1": F.col("x0") + 9.5, "y1": F.col("y0") + 9.8})
    pairs = spatial.box_overlaps(new, old, 10.0).select("child", F.col("r_parent").alias("parent"), F.col("r_people").alias("people"), "area", F.lit(100.0).alias("parent_area"))
    return access.area_shares(pairs, "child", "parent").groupBy("child").agg(F.round(F.sum("pop_share"), 4).alias("people"), F.count("*").alias("parents"), F.max("exact").alias("exact"))


def district_access_summary(spark, sf):
    return access.district_summary(_access(spark, sf), ["c_nationkey"], {"hub": "dist_km"}, THRESHOLDS)


def _access(spark, sf):
    a = t.sites(spark, sf).select("c_custkey", "c_nationkey", "x", "y")
    b = t.hubs(spark, sf).select("s_suppkey", "x", "y")
    return spatial.nearest(a, b, "c_custkey", "s_suppkey", CELL).withColumn("dist_km", F.round(F.col("dist_m") / 1000, 2)).drop("dist_m")


def state_access_rollup(spark, sf):
    base = _access(spark, sf)
    summary = access.district_summary(base, ["c_nationkey"], {"hub": "dist_km"}, THRESHOLDS).withColumn("population", F.when(F.col("c_nationkey") % 6 != 0, (F.col("c_nationkey") + 1) * 10))
    row = access.state_row(summary, base, {"hub": "dist_km"}, THRESHOLDS, "population")
    return row.select("villages", F.round("hub_mean_km", 6).alias("hub_mean_km"), *[F.round(f"hub_within_{x:g}km_pct", 4).alias(f"hub_within_{x:g}km_pct") for x in THRESHOLDS], "population")


def worst_n(spark, sf):
    return _access(spark, sf).orderBy(F.desc("dist_km"), "c_custkey").limit(8).select("c_custkey", "dist_km")


def demo_package(spark, sf):
    """Sites and hubs inside a district's bounding box, one table."""
    box = _boxes(spark, sf).filter("district_code = 12").select(F.array_min(F.transform(F.get("rings", 0), lambda p: p["x"])).alias("x0"), F.array_max(F.transform(F.get("rings", 0), lambda p: p["x"])).alias("x1"), F.array_min(F.transform(F.get("rings", 0), lambda p: p["y"])).alias("y0"), F.array_max(F.transform(F.get("rings", 0), lambda p: p["y"])).alias("y1"))
    rows = relational.union_all([t.sites(spark, sf).select(F.lit("site").alias("what"), F.col("c_custkey").alias("id"), "lon", "lat"), t.hubs(spark, sf).select(F.lit("hub").alias("what"), F.col("s_suppkey").alias("id"), "lon", "lat", "kind")])
    return rows.join(F.broadcast(box), F.col("lon").between(F.col("x0"), F.col("x1")) & F.col("lat").between(F.col("y0"), F.col("y1"))).select("what", "id", "lon", "lat", "kind")


QUERIES = {f.__name__: f for f in (lcc_projection, snap_grid, geodesic_distance, radius_join, self_radius_pairs, nearest_per_kind, knn_per_category, pip_join, nearest_polygon, nearest_road, overlay_area_alloc, district_access_summary, state_access_rollup, worst_n, demo_package)}

_D = "sqrt((s.x - h.x) * (s.x - h.x) + (s.y - h.y) * (s.y - h.y))"
_NEAR = f"n AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS k FROM (SELECT c_custkey, c_nationkey, s_suppkey, {_D} AS d FROM site s CROSS JOIN hub h)), b AS (SELECT c_custkey, c_nationkey, round(d / 1000, 2) AS dist_km FROM n WHERE k = 1)"
_BOX = "box AS (SELECT n_nationkey AS district_code, 69.0::DOUBLE + (n_nationkey % 5) * 5.4::DOUBLE + 0.013::DOUBLE AS x0, 69.0::DOUBLE + (n_nationkey % 5) * 5.4::DOUBLE + 5.0::DOUBLE AS x1, 8.0::DOUBLE + (n_nationkey // 5) * 5.6::DOUBLE + 0.013::DOUBLE AS y0, 8.0::DOUBLE + (n_nationkey // 5) * 5.6::DOUBLE + 5.013::DOUBLE AS y1 FROM nation)"
_WITHIN = lambda p: ", ".join(f"round(avg(CASE WHEN dist_km <= {x!r} THEN 1.0 ELSE 0.0 END) * 100, {p}) AS hub_within_{x:g}km_pct" for x in THRESHOLDS)
ORACLE_SQL = {
    "lcc_projection": t.with_("site") + "SELECT c_custkey, round(x, 3) AS x, round(y, 3) AS y FROM site",
    "snap_grid": t.with_("site") + f"SELECT c_custkey, {geo.snap_text('round(x, 3)')} AS gx, {geo.snap_text('round(y, 3)')} AS gy FROM site",
    "radius_join": t.with_("site", "hub") + f"SELECT c_custkey, s_suppkey, round({_D}, 3) AS dist_m FROM site s JOIN hub h ON {_D} <= {RADIUS}",
    "self_radius_pairs": t.with_("hub") + f"SELECT s.s_suppkey AS a, h.s_suppkey AS b, round({_D}, 3) AS dist_m FROM hub s JOIN hub h ON s.s_suppkey < h.s_suppkey AND {_D} <= 200000",
    "nearest_per_kind": t.with_("site", "hub") + f"SELECT c_custkey, kind, s_suppkey, round(d, 3) AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey, kind ORDER BY d, s_suppkey) AS k FROM (SELECT c_custkey, kind, s_suppkey, {_D} AS d FROM site s CROSS JOIN hub h)) WHERE k = 1",
    "knn_per_category": t.with_("site", "hub") + f"SELECT c_custkey, kind, k::INTEGER AS rank, s_suppkey, round(d, 3) AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey, kind ORDER BY d, s_suppkey) AS k FROM (SELECT c_custkey, kind, s_suppkey, {_D} AS d FROM site s CROSS JOIN hub h)) WHERE k <= 2",
    "pip_join": t.with_("site") + f", {_BOX} SELECT c_custkey, district_code FROM site LEFT JOIN box ON lon > x0 AND lon < x1 AND lat > y0 AND lat < y1",
    "nearest_polygon": t.with_("hub") + f", {_BOX} SELECT s_suppkey, district_code, d AS dist FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY d, district_code) AS k FROM (SELECT s_suppkey, district_code, round(sqrt(pow(greatest(x0 - lon, 0, lon - x1), 2) + pow(greatest(y0 - lat, 0, lat - y1), 2)), 6) AS d FROM hub CROSS JOIN box)) WHERE k = 1",
    "nearest_road": "WITH p AS (SELECT p_partkey, ((p_partkey * 37) % 5700)::DOUBLE AS x, ((p_partkey * 91) % 2700)::DOUBLE AS y FROM part), l AS (SELECT p_partkey * 2 AS line, (p_partkey % 20) * 300.0 AS ax, (p_partkey // 20) * 300.0 AS ay, (p_partkey + 1) % 20 * 300.0 AS bx, (p_partkey // 20) * 300.0 AS by_ FROM part WHERE p_partkey % 20 <> 19 UNION ALL SELECT p_partkey * 2 + 1, (p_partkey % 20) * 300.0, (p_partkey // 20) * 300.0, (p_partkey % 20) * 300.0, (p_partkey // 20 + 1) * 300.0 FROM part WHERE p_partkey % 17 <> 0) SELECT p_partkey, line, d AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, line) AS k FROM (SELECT p_partkey, line, round(sqrt(pow(greatest(ax - x, 0, x - bx), 2) + pow(greatest(ay - y, 0, y - by_), 2)), 6) AS d FROM p CROSS JOIN l) WHERE d <= 400) WHERE k = 1",
    "overlay_area_alloc": "WITH o AS (SELECT n_nationkey AS parent, (n_nationkey % 5) * 10.0::DOUBLE AS x0, (n_nationkey // 5) * 10.0::DOUBLE AS y0, (n_nationkey + 1) * 1000.0::DOUBLE AS people FROM nation), c AS (SELECT n_nationkey AS child, (n_nationkey % 5) * 9.5::DOUBLE + 1.3::DOUBLE AS x0, (n_nationkey // 5) * 9.8::DOUBLE + 0.1::DOUBLE AS y0 FROM nation), i AS (SELECT child, parent, people, (least(c.x0 + 9.5::DOUBLE, o.x0 + 10) - greatest(c.x0, o.x0)) * (least(c.y0 + 9.8::DOUBLE, o.y0 + 10) - greatest(c.y0, o.y0)) AS area FROM c JOIN o ON c.x0 < o.x0 + 10 AND o.x0 < c.x0 + 9.5::DOUBLE AND c.y0 < o.y0 + 10 AND o.y0 < c.y0 + 9.8::DOUBLE), w AS (SELECT *, sum(area) OVER (PARTITION BY child) AS t FROM i), k AS (SELECT * FROM w WHERE NOT (area / 100 < 0.02 AND area / t < 0.02)), z AS (SELECT *, people * area / 100 AS share, sum(area) OVER (PARTITION BY child) AS t2, sum(people * area / 100) OVER (PARTITION BY parent) AS back FROM k) SELECT child, round(sum(share), 4) AS people, count(*) AS parents, bool_or(area / t2 >= 0.97 AND back / people >= 0.97) AS exact FROM z GROUP BY child",
    "district_access_summary": t.with_("site", "hub") + f", {_NEAR} SELECT c_nationkey, count(*) AS villages, median(dist_km) AS hub_median_km, floor(round(sum(dist_km), 6) / count(dist_km) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS hub_mean_km, {_WITHIN(4)} FROM b GROUP BY c_nationkey",
    "state_access_rollup": t.with_("site", "hub") + f", {_NEAR}, d AS (SELECT c_nationkey, floor(round(sum(dist_km), 6) / count(dist_km) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS m, CASE WHEN c_nationkey % 6 <> 0 THEN (c_nationkey + 1) * 10 END AS p FROM b GROUP BY c_nationkey) SELECT (SELECT count(*) FROM b) AS villages, round(sum(m * p) / sum(p), 6) AS hub_mean_km, " + ", ".join(f"(SELECT round(avg(CASE WHEN dist_km <= {x!r} THEN 1.0 ELSE 0.0 END) * 100, 4) FROM b) AS hub_within_{x:g}km_pct" for x in THRESHOLDS) + ", sum(p)::BIGINT AS population FROM d WHERE p IS NOT NULL",
    "worst_n": t.with_("site", "hub") + f", {_NEAR} SELECT c_custkey, dist_km FROM b ORDER BY dist_km DESC, c_custkey LIMIT 8",
    "demo_package": t.with_("site", "hub") + f", {_BOX}, a AS (SELECT 'site' AS what, c_custkey AS id, lon, lat, NULL AS kind FROM site UNION ALL SELECT 'hub', s_suppkey, lon, lat, kind FROM hub) SELECT a.* FROM a JOIN box ON district_code = 12 AND lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1",
}
