"""Queries of rows completed from rosters, state rows, route notes and list invariants."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.operators import enrich as e
from talweg.plans import tables as t


def access_state_rows(spark, sf):
    d = t.districts(spark, sf)
    km = F.when(F.col("c_custkey") % 9 != 0, F.abs("c_acctbal").cast("double") / 100)
    base = t.read(spark, sf, "customer").select("c_nationkey", km.alias("km")).join(d, F.col("c_nationkey") == F.col("district_code")).select("state", "district", "km")
    people = d.filter("district_code % 4 <> 3").select("state", "district", "population")
    rounded = {c: F.round(c, 6) for c in ("mean_km", "median_km", "within_20km_pct", "within_50km_pct")}
    return e.access_with_state_rows(base, people, (20.0, 50.0)).withColumns(rounded)


def station_categories(spark, sf):
    s = t.read(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("st"), (F.col("s_suppkey") % 400).cast("string")).alias("station_code"))
    c = t.read(spark, sf, "customer")
    code = F.when(F.col("c_custkey") % 6 != 0, F.concat(F.lit("ST"), (F.col("c_custkey") % 300).cast("string")))
    category = F.when(F.col("c_custkey") % 4 == 0, "nsg1").when(F.col("c_custkey") % 4 == 1, "NSG1").otherwise("hg")
    roster = c.select(code.alias("station_code"), category.alias("category"), F.col("c_custkey").alias("src_order"))
    return e.with_roster_category(s, roster, "Nsg1").select("s_suppkey", "station_code", "category")


def district_enrichment(spark, sf):
    k = F.col("c_custkey")
    code = F.when(k % 4 != 0, k % 50)
    rows = t.read(spark, sf, "customer").select("c_custkey", F.concat(F.lit(" S"), (k % 3).cast("string")).alias("state"), F.concat(F.lit("d"), (k % 900).cast("string")).alias("district"), code.alias("district_code"))
    k = F.col("s_suppkey")
    facts = t.read(spark, sf, "supplier").select(F.concat(F.lit("s"), (k % 3).cast("string")).alias("state"), F.concat(F.lit("D"), (k % 900).cast("string")).alias("district"), F.when(k % 7 != 0, k % 50).alias("district_code"), F.col("s_acctbal").cast("double").alias("balance"))
    return e.enriched(rows, facts, "balance").select("c_custkey", "balance", "status")


def population_chain(spark, sf):
    """Suppliers' misspelt nations, by code, name or the most alike name of their region."""
    n = t.districts(spark, sf)
    way, name = F.col("s_suppkey") % 4, F.col("n_name")
    typed = F.when(way == 0, name).when(way == 1, F.concat(F.substring(name, 1, 3), F.lit("x"), F.substring(name, 4, 30))).when(way == 2, "zzz")
    s = t.read(spark, sf, "supplier").join(t.read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t.read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = s.select("s_suppkey", F.col("r_name").alias("state"), typed.alias("district"), F.when(way == 3, F.col("n_nationkey")).alias("district_code"))
    facts = n.select("state", "district", "district_code", "population", F.col("district_code").alias("src_order"))
    return e.lookup_chain(rows, facts, "population").select("s_suppkey", "population")


def collapsed_paths(spark, sf):
    pair = F.struct(F.col("l_linenumber").alias("n"), F.array((F.col("l_suppkey") % 3) * 0.000004 + 70.0, F.lit(20.0)).alias("p"))
    paths = t.read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(pair)).alias("pairs"))  # at most seven lines an order
    points = e.collapsed(F.transform("pairs", lambda x: x["p"]))
    return paths.select("l_orderkey", F.size(points).cast("long").alias("points"), F.to_json(F.transform(points, lambda p: F.round(p[0] * 100000).cast("long"))).alias("path"))


def route_notes(spark, sf):
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    tenths = lambda m: (k % m) / 10.0
    notes = e.route_notes(k % 3, (k % 3) * 0.25, tenths(401), tenths(307), tenths(997), k % 11 == 0, k % 23 == 0)
    return t.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(notes, " ").alias("notes"))


def coverage_faults(spark, sf):
    """Each customer's orders as a list of hubs."""
    k = F.col("o_orderkey")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(k)) - 1
    kind = F.when(k % 31 == 0, "other").when(k % 9 == 0, "mmlp").otherwise("major_port")
    rows = t.read(spark, sf, "orders").select("o_custkey", k, kind.alias("hub_type"), F.when(k % 13 != 0, place).alias("hub_order"), F.concat(F.lit("h "), (k % 6).cast("string")).alias("hub_name"))
    return e.coverage_faults(rows, "o_custkey", "o_orderkey")


QUERIES = {f.__name__: f for f in (access_state_rows, station_categories, district_enrichment, population_chain, collapsed_paths, route_notes, coverage_faults)}
_K = "(l_orderkey * 7 + l_linenumber)"
ORACLE_SQL = {
    "access_state_rows": t.with_("district") + """
        , base AS (SELECT d.state, d.district, CASE WHEN c_custkey % 9 <> 0 THEN abs(c_acctbal)::DOUBLE / 100 END AS km
            FROM customer JOIN district d ON c_nationkey = d.district_code),
        rows AS (SELECT state, district, count(*) AS villages, avg(km) AS mean_km, median(km) AS median_km, count(*) FILTER (km <= 20) AS w20,
            count(*) FILTER (km <= 50) AS w50 FROM base GROUP BY ALL),
        named AS (SELECT r.*, p.population FROM rows r LEFT JOIN (SELECT * FROM district WHERE district_code % 4 <> 3) p USING (state, district)),
        both_ AS (SELECT * FROM named UNION ALL BY NAME SELECT state, '__STATE__' AS district, sum(villages) AS villages,
            sum(mean_km * population) / sum(population) AS mean_km, NULL AS median_km, sum(w20) AS w20, sum(w50) AS w50, sum(population) AS population
            FROM named GROUP BY state)
        SELECT state, district, villages::BIGINT AS villages, round(mean_km, 6) AS mean_km, round(median_km, 6) AS median_km,
            round(w20 * 100::DOUBLE / villages, 6) AS within_20km_pct, round(w50 * 100::DOUBLE / villages, 6) AS within_50km_pct,
            population::BIGINT AS population FROM both_""",
    "station_categories": """
        WITH listed AS (SELECT 'ST' || (c_custkey % 300) AS code, arg_min(CASE c_custkey % 4 WHEN 0 THEN 'nsg1' ELSE 'NSG1' END, c_custkey) AS category
            FROM customer WHERE c_custkey % 6 <> 0 AND c_custkey % 4 < 2 GROUP BY 1)
        SELECT s_suppkey, 'st' || (s_suppkey % 400) AS station_code, category FROM supplier JOIN listed ON code = 'ST' || (s_suppkey % 400)""",
    "district_enrichment": """
        WITH p AS (SELECT c_custkey, c_custkey % 3 AS s, c_custkey % 900 AS d, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 50 END AS c,
            count(*) OVER (PARTITION BY c_custkey % 3, c_custkey % 900) AS twins FROM customer),
        f AS (SELECT s_suppkey % 3 AS s, s_suppkey % 900 AS d, CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 50 END AS c, s_acctbal::DOUBLE AS v FROM supplier),
        m AS (SELECT c_custkey, count(v) AS n, min(v) AS v FROM p LEFT JOIN f ON p.s = f.s AND p.d = f.d AND (p.c = f.c OR p.c IS NULL AND p.twins = 1)
            GROUP BY c_custkey)
        SELECT c_custkey, CASE n WHEN 1 THEN v END AS balance, CASE n WHEN 1 THEN 'found' WHEN 0 THEN 'missing' ELSE 'ambiguous' END AS status FROM m""",
    "collapsed_paths": """
        WITH p AS (SELECT l_orderkey, l_linenumber, CASE l_suppkey % 3 WHEN 2 THEN 7000001 ELSE 7000000 END AS x FROM lineitem),
        q AS (SELECT *, lag(x) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, x) AS b FROM p)
        SELECT l_orderkey, count(*) AS points, '[' || string_agg(x::VARCHAR, ',' ORDER BY l_linenumber, x) || ']' AS path FROM q
        WHERE b IS NULL OR b <> x GROUP BY l_orderkey""",
    "route_notes": f"""
        WITH k AS (SELECT l_orderkey, l_linenumber, {_K} AS k FROM lineitem), v AS (SELECT *, (k % 401) / 10.0::DOUBLE AS o, (k % 307) / 10.0::DOUBLE AS d FROM k)
        SELECT l_orderkey, l_linenumber, concat_ws(' ', CASE WHEN k % 23 = 0 THEN 'zero_movement' WHEN k % 11 = 0 THEN 'same_node' END,
            CASE WHEN k % 23 <> 0 AND o + d > 3.0::DOUBLE * ((k % 997) / 10.0::DOUBLE) THEN 'feeders_exceed_direct' END,
            CASE WHEN k % 3 > 0 THEN printf('bridges:%d:%.2f', (k % 3)::BIGINT, (k % 3) * 0.25::DOUBLE) END,
            CASE WHEN o > 25 THEN printf('long_feeder:origin:%.1f', o) END, CASE WHEN d > 25 THEN printf('long_feeder:destination:%.1f', d) END) AS notes FROM v""",
    "coverage_faults": """
        WITH a AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS i, o_orderkey % 6 AS name,
            CASE WHEN o_orderkey % 13 <> 0 THEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 END AS o FROM orders),
        b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, i, name ORDER BY o_orderkey) AS nth, i IS NOT NULL AND o IS NOT NULL AND i <
            coalesce(max(CASE WHEN o IS NOT NULL THEN i END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS late FROM a),
        c AS (SELECT o_custkey, o_orderkey, i, o, lag(i) OVER w AS li, lag(o) OVER w AS lo FROM b WHERE i IS NOT NULL AND o IS NOT NULL AND NOT late
            WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
        SELECT o_custkey, o_orderkey, 'unknown_type' AS fault FROM b WHERE i IS NULL
        UNION ALL SELECT o_custkey, o_orderkey, 'duplicate_name' FROM b WHERE i IS NOT NULL AND nth > 1
        UNION ALL SELECT o_custkey, o_orderkey, 'type_order' FROM b WHERE late
        UNION ALL SELECT o_custkey, o_orderkey, 'hub_order' FROM c WHERE o <> CASE WHEN li = i THEN lo + 1 ELSE 0 END""",
}
