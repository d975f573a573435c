"""The operators' input tables, derived from the driver's tables by integer arithmetic that any engine repeats exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.functions.geo import project_sql, project_x, project_y

KINDS = ("rail", "port", "icd", "mmlp", "fci", "air", "iwt", "icp", "toll")
PORTS = 12


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _projected(df: DataFrame) -> DataFrame:
    return df.withColumns({"x": project_x(F.col("lon"), F.col("lat")), "y": project_y(F.col("lon"), F.col("lat"))})


def sites(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer")
    return _projected(c.select("c_custkey", "c_nationkey", "c_name", "c_acctbal", (8.0 + ((F.col("c_custkey") * 7919) % 2800) / 100.0).alias("lat"), (69.0 + ((F.col("c_custkey") * 104729) % 2700) / 100.0).alias("lon")))


def hubs(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("s_suppkey") % 9 + 1).cast("int"))
    return _projected(s.select("s_suppkey", "s_nationkey", "s_name", "s_acctbal", kind.alias("kind"), (8.0 + ((F.col("s_suppkey") * 6131) % 2800) / 100.0).alias("lat"), (69.0 + ((F.col("s_suppkey") * 50021) % 2700) / 100.0).alias("lon")))


def districts(spark: SparkSession, sf: str) -> DataFrame:
    n, r = read(spark, sf, "nation"), read(spark, sf, "region")
    people = read(spark, sf, "customer").groupBy("c_nationkey").agg((F.count("*") * 1000).alias("population"))
    joined = n.join(r, n["n_regionkey"] == r["r_regionkey"]).join(people, n["n_nationkey"] == people["c_nationkey"], "left")
    return joined.select(F.col("n_nationkey").alias("district_code"), F.col("n_name").alias("district"), F.col("r_name").alias("state"), F.col("population"))


#: States of the routes, by nation.
ROUTE_STATES = ("Gujarat", "Kerala", "Punjab", "Assam", "Bihar")


def routes(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    line = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    km = ((F.col("o_orderkey") * 31) % 250000) / 100.0
    state = F.element_at(F.array(*[F.lit(s) for s in ROUTE_STATES]), (F.col("o_custkey") % 5 + 1).cast("int"))
    return line.join(o, line["l_orderkey"] == o["o_orderkey"]).select(
        "o_orderkey", "l_linenumber", "l_quantity", state.alias("state"), km.alias("road_km"),
        (km / (40 + F.col("l_partkey") % 30)).alias("hours"),
        F.when(F.col("l_suppkey") % 7 != 0, (F.col("l_suppkey") * 13 % 1500) / 10.0).alias("terminal_km"),
    )


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    """District by port: hours with zeros among them, both null where there is no route."""
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("district_code"), F.col("n_name").alias("district"))
    s = read(spark, sf, "supplier").filter(F.col("s_suppkey") < PORTS).select(F.col("s_suppkey").alias("port_order"), F.col("s_name").alias("port"))
    pairs = n.crossJoin(F.broadcast(s))  # twelve ports at most
    gap = (F.col("district_code") + F.col("port_order")) % 11 == 0
    hours = ((F.col("district_code") * 53 + F.col("port_order") * 17) % 300) / 10.0
    return pairs.select("district_code", "district", "port", "port_order", (10.0 + 7 * F.col("port_order")).alias("capacity"), F.when(~gap, hours).alias("hours"), F.when(~gap, hours * 48).alias("km"))


def road_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A lattice of roads: each part is a point, joined to the next in its row and to the one above."""
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.element_at(F.array(F.lit("motorway"), F.lit("trunk"), F.lit("primary"), F.lit("other")), (F.col("p_size") % 4 + 1).cast("int")).alias("road"))
    at = lambda k: F.struct(((k % 20) * 300.0).alias("x"), (F.floor(k / 20) * 300.0).alias("y"))
    right = p.filter("k % 20 <> 19").select((F.col("k") * 2).alias("line"), "road", F.array(at(F.col("k")), at(F.col("k") + 1)).alias("points"))
    up = p.filter("k % 17 <> 0").select((F.col("k") * 2 + 1).alias("line"), "road", F.array(at(F.col("k")), at(F.col("k") + 20)).alias("points"))
    return right.union(up)


X, Y = project_sql("lon", "lat")
_KIND = "CASE s_suppkey % 9 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
_STATE = "CASE o_custkey % 5 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(ROUTE_STATES)) + " END"
#: The same tables as SQL.
CTE = {
    "site": f"site AS (SELECT *, {X} AS x, {Y} AS y FROM (SELECT c_custkey, c_nationkey, c_name, c_acctbal, 8.0::DOUBLE + ((c_custkey * 7919) % 2800) / 100.0::DOUBLE AS lat, 69.0::DOUBLE + ((c_custkey * 104729) % 2700) / 100.0::DOUBLE AS lon FROM customer))",
    "hub": f"hub AS (SELECT *, {X} AS x, {Y} AS y FROM (SELECT s_suppkey, s_nationkey, s_name, s_acctbal, {_KIND} AS kind, 8.0::DOUBLE + ((s_suppkey * 6131) % 2800) / 100.0::DOUBLE AS lat, 69.0::DOUBLE + ((s_suppkey * 50021) % 2700) / 100.0::DOUBLE AS lon FROM supplier))",
    "district": "district AS (SELECT n_nationkey AS district_code, n_name AS district, r_name AS state, p.population FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT c_nationkey, count(*) * 1000 AS population FROM customer GROUP BY 1) p ON c_nationkey = n_nationkey)",
    "route": f"route AS (SELECT o_orderkey, l_linenumber, l_quantity, {_STATE} AS state, ((o_orderkey * 31) % 250000) / 100.0::DOUBLE AS road_km, ((o_orderkey * 31) % 250000) / 100.0::DOUBLE / (40 + l_partkey % 30) AS hours, CASE WHEN l_suppkey % 7 <> 0 THEN (l_suppkey * 13 % 1500) / 10.0::DOUBLE END AS terminal_km FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
    "matrix": f"matrix AS (SELECT n_nationkey AS district_code, n_name AS district, s_name AS port, s_suppkey AS port_order, 10.0::DOUBLE + 7 * s_suppkey AS capacity, CASE WHEN (n_nationkey + s_suppkey) % 11 <> 0 THEN ((n_nationkey * 53 + s_suppkey * 17) % 300) / 10.0::DOUBLE END AS hours, CASE WHEN (n_nationkey + s_suppkey) % 11 <> 0 THEN ((n_nationkey * 53 + s_suppkey * 17) % 300) / 10.0::DOUBLE * 48 END AS km FROM nation CROSS JOIN supplier WHERE s_suppkey < {PORTS})",
    "edge": "edge AS (SELECT k AS u, k + 1 AS v, sp FROM net WHERE k % 20 <> 19 UNION ALL SELECT k, k + 20, sp FROM net WHERE k % 17 <> 0)",
}
CTE["net"] = "net AS (SELECT p_partkey AS k, CASE p_size % 4 WHEN 0 THEN 90.0::DOUBLE WHEN 1 THEN 70.0::DOUBLE WHEN 2 THEN 55.0::DOUBLE ELSE 50.0::DOUBLE END AS sp FROM part)"


def with_(*names: str) -> str:
    return "WITH " + ", ".join(CTE[n] for n in names) + " "
