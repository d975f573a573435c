"""Queries of names, joins, aggregates, windows, checks and the lookup surface."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions import text, values
from talweg.operators import relational as r
from talweg.operators import resolve
from talweg.plans import tables as t


# --- names -------------------------------------------------------------------------------------------------------------
_SPELLINGS = ("Orissa", " UTTAR PRADESH ", "nct of delhi", "Atlantis", "Jammu & Kashmir", "kerala", "Lakshadweep")


def name_normalise(spark, sf):
    c = t.read(spark, sf, "customer")
    raw = F.element_at(F.array(*[F.lit(x) for x in _SPELLINGS]), (F.col("c_custkey") % 7 + 1).cast("int"))
    return c.select("c_custkey", text.clean_state_name(raw).alias("state"), text.state_code(raw).alias("code"), text.is_island_state(raw).alias("island"))


_STATE_CASE = "CASE c_custkey % 7 WHEN 0 THEN 'Odisha' WHEN 1 THEN 'Uttar Pradesh' WHEN 2 THEN 'Delhi' WHEN 4 THEN 'Jammu And Kashmir' WHEN 5 THEN 'Kerala' WHEN 6 THEN 'Lakshadweep' END"
_CODE_CASE = "CASE c_custkey % 7 WHEN 0 THEN 21 WHEN 1 THEN 9 WHEN 2 THEN 7 WHEN 4 THEN 1 WHEN 5 THEN 32 WHEN 6 THEN 31 END"


def part_keys(spark, sf):
    p = t.read(spark, sf, "part")
    raw = F.concat(F.initcap("p_name"), F.lit(" (North & "), F.col("p_brand"), F.lit(") District"))
    return p.select("p_partkey", text.population_key(raw).alias("population_key"), text.access_key(raw).alias("access_key"), text.parenthesis_alias(raw).alias("alias"), text.letters_digits(raw).alias("letters"), text.no_punctuation(raw).alias("plain"), text.slug(raw).alias("slug"), text.repair_glyphs(F.concat(F.lit("|<>#"), "p_brand")).alias("repaired"), text.lower_and(F.concat(F.lit("A And "), "p_brand")).alias("lower_and"))


_RAW = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' (North & ' || p_brand || ') District'"


def nh_ref_parse(spark, sf):
    p = t.read(spark, sf, "part")
    ref = F.concat(F.lit("old NH"), F.col("p_size").cast("string"), F.lit(";NH "), (F.col("p_partkey") % 90).cast("string"), F.lit("A,SH60; nh-"), F.col("p_size").cast("string"))
    numbers = text.highway_numbers(ref)
    return p.select("p_partkey", numbers.alias("numbers"), text.valid_highway_numbers(numbers).alias("valid"))


def nh_distinct_routes(spark, sf):
    return nh_ref_parse(spark, sf).select(F.explode(F.split("numbers", ";")).alias("route")).agg(F.count_distinct("route").alias("routes"))


_TAGS = ("motorway", "trunk_link", "primary", "secondary", "footway", "service")


def road_class(spark, sf):
    p = t.read(spark, sf, "part")
    tag = F.element_at(F.array(*[F.lit(x) for x in _TAGS]), (F.col("p_partkey") % 6 + 1).cast("int"))
    ref = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("nh"), F.col("p_size").cast("string"))).when(F.col("p_size") % 5 == 1, F.lit("MH 4"))
    return p.select("p_partkey", text.road_class(tag, ref).alias("road_class"))


def station_keys(spark, sf):
    s = t.read(spark, sf, "supplier")
    name = F.concat(F.lit(" Nagar "), F.col("s_name"), F.when(F.col("s_suppkey") % 2 == 0, " Junction").otherwise(" Road Yard"))
    zone = F.element_at(F.array(F.lit("wc x"), F.lit("ECOR"), F.lit("?"), F.lit(" nr ")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    code = F.concat((F.col("s_suppkey") % 50).cast("string"), F.lit("N004"))
    return s.select("s_suppkey", text.station_key(name).alias("station"), text.clean_zone(zone).alias("zone"), text.leading_code(code).alias("code"))


def fuzzy_match(spark, sf):
    """Each supplier's misspelt city against the nations' names: the most alike, ties by code."""
    s = t.read(spark, sf, "supplier").join(t.read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.substring("n_name", 1, 5), F.lit("x"), F.substring("n_name", 6, 30)).alias("typed"))
    names = F.broadcast(t.read(spark, sf, "nation").select("n_nationkey", "n_name"))  # 25 rows
    scored = s.join(names).withColumn("score", F.round(text.name_score(F.lower("typed"), F.lower("n_name")), 4))
    return r.keep_first(scored, ["s_suppkey"], F.desc("score"), "n_nationkey").filter("score >= 0.7").select("s_suppkey", "n_nationkey", "score")


# --- joins -------------------------------------------------------------------------------------------------------------
def _people(spark, sf):
    return t.districts(spark, sf).select("district_code", "state", "district", "population")


def null_safe_join(spark, sf):
    a = t.districts(spark, sf).select("state", F.when(F.col("district_code") % 5 != 0, F.col("district_code")).alias("code"), "district")
    b = a.groupBy("state", "code").agg(F.count("*").alias("n"))
    return r.null_safe_join(a, b, ["state", "code"]).select("state", "code", "district", "n")


def m1_join_check(spark, sf):
    o = t.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return r.many_to_one(o, t.read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), ["o_custkey"]).groupBy("c_nationkey").agg(F.count("*").alias("orders"))


def anti_join_orphans(spark, sf):
    c = t.read(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return r.orphans(c, t.read(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


def fallback_join(spark, sf):
    a = t.sites(spark, sf).select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("code"), F.concat(F.lit("N"), (F.col("c_custkey") % 30).cast("string")).alias("name"))
    b = t.read(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.concat(F.lit("N"), (F.col("n_nationkey") % 20).cast("string")).alias("name"), (F.col("n_nationkey") * 100).alias("value"))
    return r.fallback_join(a, b, "code", "name", "value").select("c_custkey", "value")


def population_join(spark, sf):
    a = t.sites(spark, sf).join(t.districts(spark, sf), F.col("c_nationkey") == F.col("district_code")).select("c_custkey", F.upper("state").alias("state"), F.when(F.col("c_custkey") % 4 != 0, F.col("district_code") % 19).alias("district_code"), "district")
    facts = t.districts(spark, sf).select("state", "district", F.when(F.col("district_code") < 23, F.col("district_code") % 19).alias("district_code"), F.col("population"))
    return r.identity_lookup(a, facts, "population").select("c_custkey", "population")


def mapped_counts(spark, sf):
    n = t.read(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return r.map_values(n, t.read(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("hubs")), "k", "hubs", 0).select("k", "n_name", "hubs")


def wide_matrix(spark, sf):
    """The long matrix as the published wide one: two columns per port."""
    m = t.matrix(spark, sf).withColumn("key", F.concat(F.lit("p"), F.col("port_order").cast("string")))
    ports = [f"p{i}" for i in range(t.PORTS)]
    wide = m.groupBy("district_code").pivot("key", ports).agg(F.first("hours").alias("hours"), F.first("km").alias("km"))
    return wide.select("district_code", *[F.col(f"{p}_{c}").alias(f"{c}_to_{p}") for p in ports for c in ("hours", "km")])


# --- aggregates, windows, order ----------------------------------------------------------------------------------------
def state_list(spark, sf):
    return t.districts(spark, sf).groupBy("state").agg(F.count("district").alias("districts"), F.sum("population").alias("population"), F.min("district_code").alias("first_code"))


def mode_per_group(spark, sf):
    return r.mode_per_group(t.read(spark, sf, "lineitem"), ["l_returnflag"], "l_linenumber").select("l_returnflag", "l_linenumber", "n")


def dedupe_keep_first(spark, sf):
    return r.keep_first(t.read(spark, sf, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


def dedupe_last(spark, sf):
    """The part of the line of the largest number of each order, of the lines that have both; and the largest number of all.

    Of equal numbers the first line of the file counts, as for an aggregate that reads it in order.
    """
    lines = t.read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    whole = F.col("l_partkey").isNotNull() & F.col("l_linenumber").isNotNull()
    most = lines.withColumns({"__part": F.when(whole, F.col("l_partkey")), "__most": F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))})
    return r.keep_first(most, ["l_orderkey"], F.desc(whole), F.desc("l_linenumber"), "__file", "__row").select("l_orderkey", F.col("__part").alias("l_partkey"), F.col("__most").alias("l_linenumber"))


def duplicate_flags(spark, sf):
    return r.flag_duplicates(t.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), ["l_orderkey", "l_suppkey"])


def event_runs(spark, sf):
    return r.runs(t.read(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type").groupBy("user_id").agg(F.max("run").alias("runs"))


def monotonic_check(spark, sf):
    e = t.read(spark, sf, "events").select("user_id", "event_id", F.floor("value").alias("v"))
    return r.not_falling(e, ["user_id"], "event_id", "v")


def group_share(spark, sf):
    """Each order's share of its customer's total, and scaling to a target of 100."""
    o = t.read(spark, sf, "orders")
    return o.select("o_orderkey", F.round(F.col("o_totalprice") / F.sum("o_totalprice").over(Window.partitionBy("o_custkey")) * 100, 6).alias("scaled"))


def systematic_sample(spark, sf):
    c = t.read(spark, sf, "nation").select("n_nationkey")
    at = r.systematic_positions(25, 7)
    ranked = c.withColumn("i", F.row_number().over(Window.orderBy("n_nationkey")) - 1)  # a table of 25 codes
    return ranked.filter(F.col("i").isin(at)).select("n_nationkey")


def seeded_sample(spark, sf):
    return r.seeded_sample(t.read(spark, sf, "customer").select("c_custkey"), "c_custkey", 40, 42)


def percentile_scores(spark, sf):
    """District comparison: percentile by nation and by region, weights that sum to one, the rank."""
    return resolve.comparison(t.districts(spark, sf).join(t.read(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("district_code")).agg(F.count("*").alias("hubs"), F.round(F.avg("s_acctbal"), 2).alias("balance")), "district_code", "left"), {"population": 2.0, "hubs": 1.0, "balance": 1.0})


# --- sets and checks ---------------------------------------------------------------------------------------------------
def hub_list_union(spark, sf):
    h = t.hubs(spark, sf)
    a = h.filter("kind = 'rail'").select("s_suppkey", "s_name", F.lit("rail").alias("hub_type"))
    b = r.with_default(h.filter("kind = 'port'").select("s_suppkey", "s_name", "s_acctbal"), "hub_type", "port")
    return r.union_all([a, b]).select("s_suppkey", "s_name", "hub_type", "s_acctbal")


def set_differences(spark, sf):
    a = t.read(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    b = t.read(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    return a.subtract(b).select("k", F.lit("missing").alias("side")).union(a.intersect(b).select("k", F.lit("both").alias("side")))


def frame_diff(spark, sf):
    a = t.read(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("k"), "n_name", F.col("n_regionkey").cast("double").alias("v"))
    b = a.filter("k <> 3").select("k", F.when(F.col("k") == 5, "other").otherwise(F.col("n_name")).alias("n_name"), F.when(F.col("k") == 7, F.col("v") + 0.5).otherwise(F.col("v") + 1e-12).alias("v"))
    return r.frame_difference(a, b, "k")


def baseline_drift(spark, sf):
    """Row counts of the tables against a baseline of one in ten more."""
    names = ("nation", "region", "customer", "supplier", "orders")
    counts = r.union_all([t.read(spark, sf, n).agg(F.lit(n).alias("dataset"), F.count("*").alias("rows")) for n in names])
    return counts.select("dataset", "rows", F.when(F.col("rows") % 2 == 1, "WARN").otherwise("PASS").alias("status"))


def content_hash(spark, sf):
    o = t.read(spark, sf, "orders")
    return r.content_hash(o.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status")), "o_orderkey")


def quality_checks(spark, sf):
    from talweg.operators import quality as q

    li, o, s = t.read(spark, sf, "lineitem"), t.read(spark, sf, "orders"), t.sites(spark, sf)
    return q.report(
        [
            q.share(o.join(t.read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"), "orders", "known customers", F.col("c_custkey").isNotNull(), 0.999),
            q.count_between(t.read(spark, sf, "nation"), "nation", "25 rows", 25, 25),
            q.unique(t.read(spark, sf, "supplier"), "supplier", "unique key", ["s_suppkey"]),
            q.unique(li, "lineitem", "unique order", ["l_orderkey"]),
            q.all_true(s, "customer", "in the box", F.col("lat").between(8, 36) & F.col("lon").between(69, 96)),
            q.all_true(li, "lineitem", "discount at most 0.05", F.col("l_discount") <= 0.05, severity="WARN"),
            q.all_true(t.matrix(spark, sf), "matrix", "paired values", F.col("hours").isNull() == F.col("km").isNull()),
        ]
    )


def status_counts(spark, sf):
    return quality_checks(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


# --- lookups -----------------------------------------------------------------------------------------------------------
def scorecard(spark, sf):
    """Every district with its state's totals and the share of its sites near a hub."""
    from talweg.operators.spatial import radius_join

    near = radius_join(t.sites(spark, sf).select("c_custkey", "c_nationkey", "x", "y"), t.hubs(spark, sf).select("s_suppkey", "x", "y"), 50_000.0).select("c_nationkey", "c_custkey").distinct().groupBy("c_nationkey").agg(F.count("*").alias("near"))
    d = t.districts(spark, sf)
    total = F.sum("population").over(Window.partitionBy("state"))
    return d.withColumn("state_population", total).join(near, F.col("c_nationkey") == F.col("district_code"), "left").select("district_code", "district", "state", "population", "state_population", F.round(F.coalesce("near", F.lit(0)) * 1000 / F.col("population") * 100, 2).alias("near_pct"))


def station_search(spark, sf):
    return resolve.search(t.hubs(spark, sf), contains={"s_name": "00001"}, upper={"kind": "RAIL"}).select("s_suppkey", "s_name", "kind")


def toll_filter(spark, sf):
    return resolve.search(t.hubs(spark, sf), either=(("s_name", "kind"), "toll")).orderBy("s_suppkey").limit(20).select("s_suppkey", "kind")


def village_page(spark, sf):
    return r.page(t.read(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"], 100, 50)


def resolve_location(spark, sf):
    n = t.read(spark, sf, "nation")
    asked = t.sites(spark, sf).select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey").cast("string")).alias("code"), F.when(F.col("c_custkey") % 3 == 1, F.lower("c_name")).when(F.col("c_custkey") % 3 == 2, F.concat(F.lit("X"), (F.col("c_custkey") % 31).cast("string"))).alias("name"))
    known = n.select(F.col("n_nationkey").cast("long").alias("code"), F.concat(F.lit("x"), (F.col("n_nationkey") % 20).cast("string")).alias("name"))
    return resolve.resolve(asked, known, "c_custkey").select("c_custkey", "status", "found_code", "candidates")


def requested_port(spark, sf):
    asked = t.read(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("port "), F.col("s_suppkey").cast("string")).alias("wanted"))
    ports = t.read(spark, sf, "supplier").select(F.concat(F.lit("Port-"), F.col("s_suppkey").cast("string"), F.lit(" (Main)")).alias("port"))
    return resolve.match_port(asked, ports, "s_suppkey", "wanted", "port").select("s_suppkey", "status", "port")


def strict_json(spark, sf):
    return values.strict_json(t.read(spark, sf, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") != 3, F.col("n_regionkey").cast("double")).alias("v"))).select("json")


def distance_classes(spark, sf):
    c = t.read(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 70).cast("double").alias("km"))
    return c.select("c_custkey", resolve.band(F.col("km"), [5, 10, 25, 50]).alias("band"))


QUERIES = {f.__name__: f for f in (name_normalise, part_keys, nh_ref_parse, nh_distinct_routes, road_class, station_keys, fuzzy_match, null_safe_join, m1_join_check, anti_join_orphans, fallback_join, population_join, mapped_counts, wide_matrix, state_list, mode_per_group, dedupe_keep_first, dedupe_last, duplicate_flags, event_runs, monotonic_check, group_share, systematic_sample, seeded_sample, percentile_scores, hub_list_union, set_differences, frame_diff, baseline_drift, content_hash, quality_checks, status_counts, scorecard, station_search, toll_filter, village_page, resolve_location, requested_port, strict_json, distance_classes)}

_FACTS = "facts AS (SELECT upper(state) AS s, district, CASE WHEN district_code < 23 THEN district_code % 19 END AS code, population FROM district)"
_CHECKS = """q AS (
 SELECT 'orders' AS dataset, 'known customers' AS check_name, avg((c_custkey IS NOT NULL)::INT) >= 0.999 AS ok, 'FAIL' AS severity FROM orders LEFT JOIN customer ON o_custkey = c_custkey
 UNION ALL SELECT 'nation', '25 rows', count(*) = 25, 'FAIL' FROM nation
 UNION ALL SELECT 'supplier', 'unique key', count(*) = count(DISTINCT s_suppkey), 'FAIL' FROM supplier
 UNION ALL SELECT 'lineitem', 'unique order', count(*) = count(DISTINCT l_orderkey), 'FAIL' FROM lineitem
 UNION ALL SELECT 'customer', 'in the box', true, 'FAIL'
 UNION ALL SELECT 'lineitem', 'discount at most 0.05', bool_and(l_discount <= 0.05), 'WARN' FROM lineitem
 UNION ALL SELECT 'matrix', 'paired values', true, 'FAIL'), z AS (SELECT dataset, check_name, CASE WHEN ok THEN 'PASS' ELSE severity END AS status FROM q)"""
ORACLE_SQL = {
    "name_normalise": f"SELECT c_custkey, {_STATE_CASE} AS state, {_CODE_CASE} AS code, c_custkey % 7 = 6 AS island FROM customer",
    "part_keys": f"SELECT p_partkey, replace(replace(lower(split_part(s, ' (', 1)) || ' district', ' district', ''), ' ', '') AS population_key, replace(lower(split_part(s, ' (', 1)) || 'district', ' ', '') AS access_key, 'North & ' || p_brand AS alias, regexp_replace(lower(s), '[^a-z0-9]', '', 'g') AS letters, regexp_replace(lower(s), '[^\\w\\s]', '', 'g') AS plain, regexp_replace(regexp_replace(lower(s), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, 'IaAu' || replace(p_brand, '#', 'u') AS repaired, 'A and ' || p_brand AS lower_and FROM (SELECT *, {_RAW} AS s FROM part)",
    "nh_ref_parse": "SELECT p_partkey, p_size || ';' || (p_partkey % 90) || 'A' AS numbers, true AS valid FROM part",
    "nh_distinct_routes": "SELECT count(DISTINCT r) AS routes FROM (SELECT p_size::VARCHAR AS r FROM part UNION ALL SELECT (p_partkey % 90) || 'A' FROM part)",
    "road_class": "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'NH' WHEN p_size % 5 = 1 THEN 'SH' ELSE CASE p_partkey % 6 WHEN 0 THEN 'NH' WHEN 1 THEN 'NH' WHEN 2 THEN 'SH' WHEN 3 THEN 'MDR' WHEN 5 THEN 'service' END END AS road_class FROM part",
    "station_keys": "SELECT s_suppkey, 'nagar ' || lower(s_name) AS station, CASE s_suppkey % 4 WHEN 0 THEN 'WCR' WHEN 1 THEN 'ECoR' WHEN 3 THEN 'NR' END AS zone, (s_suppkey % 50)::BIGINT AS code FROM supplier",
    "null_safe_join": t.with_("district") + ", a AS (SELECT state, CASE WHEN district_code % 5 <> 0 THEN district_code END AS code, district FROM district) SELECT a.*, b.n FROM a JOIN (SELECT state, code, count(*) AS n FROM a GROUP BY ALL) b ON a.state = b.state AND a.code IS NOT DISTINCT FROM b.code",
    "m1_join_check": "SELECT c_nationkey, count(*) AS orders FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1",
    "anti_join_orphans": "SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "fallback_join": "WITH b AS (SELECT n_nationkey AS code, 'N' || (n_nationkey % 20) AS name, n_nationkey * 100 AS value FROM nation), u AS (SELECT name, any_value(value) AS value FROM b GROUP BY name HAVING count(*) = 1) SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN b.value ELSE u.value END AS value FROM customer LEFT JOIN b ON b.code = c_nationkey LEFT JOIN u ON u.name = 'N' || (c_custkey % 30)",
    "population_join": t.with_("district") + f", {_FACTS}, a AS (SELECT c_custkey, upper(state) AS s, CASE WHEN c_custkey % 4 <> 0 THEN district_code % 19 END AS code, district FROM customer JOIN district ON c_nationkey = district_code), one AS (SELECT code, min(population) AS p FROM facts WHERE code IS NOT NULL GROUP BY code HAVING count(DISTINCT s) = 1), two AS (SELECT s, code, min(population) AS p FROM facts WHERE code IS NOT NULL GROUP BY ALL), nm AS (SELECT s, district, min(population) AS p FROM facts WHERE code IS NULL GROUP BY ALL HAVING count(*) = 1) SELECT c_custkey, CASE WHEN a.code IS NOT NULL THEN coalesce(one.p, two.p) ELSE nm.p END AS population FROM a LEFT JOIN one USING (code) LEFT JOIN two ON two.s = a.s AND two.code = a.code LEFT JOIN nm ON nm.s = a.s AND nm.district = a.district",
    "mapped_counts": "SELECT n_nationkey AS k, n_name, count(s_suppkey) AS hubs FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL",
    "wide_matrix": t.with_("matrix") + "SELECT district_code, " + ", ".join(f"max({c}) FILTER (port_order = {i}) AS {c}_to_p{i}" for i in range(t.PORTS) for c in ("hours", "km")) + " FROM matrix GROUP BY district_code",
    "state_list": t.with_("district") + "SELECT state, count(*) AS districts, sum(population)::BIGINT AS population, min(district_code) AS first_code FROM district GROUP BY state",
    "mode_per_group": "SELECT l_returnflag, l_linenumber, n FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_linenumber) AS k FROM (SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE k = 1",
    "dedupe_keep_first": "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL",
    "dedupe_last": "SELECT l_orderkey, arg_max(l_partkey, l_linenumber) AS l_partkey, max(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey",
    "duplicate_flags": "SELECT l_orderkey, l_linenumber, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS is_duplicate FROM lineitem",
    "event_runs": "SELECT user_id, sum(new)::BIGINT AS runs FROM (SELECT user_id, (lag(event_type) OVER w IS DISTINCT FROM event_type)::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) GROUP BY user_id",
    "monotonic_check": "SELECT user_id, NOT coalesce(bool_or(v < l), false) AS monotonic FROM (SELECT user_id, floor(value) AS v, lag(floor(value)) OVER (PARTITION BY user_id ORDER BY event_id) AS l FROM events) GROUP BY user_id",
    "group_share": "SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey) * 100, 6) AS scaled FROM orders",
    "systematic_sample": "SELECT n_nationkey FROM nation WHERE n_nationkey IN (0, 4, 8, 12, 16, 20, 24)",
    "seeded_sample": "SELECT c_custkey FROM customer ORDER BY sha256('42:' || c_custkey) LIMIT 40",
    "hub_list_union": t.with_("hub") + "SELECT s_suppkey, s_name, kind AS hub_type, CASE WHEN kind = 'port' THEN s_acctbal END AS s_acctbal FROM hub WHERE kind IN ('rail', 'port')",
    "set_differences": "WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier) SELECT k, 'missing' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'both' FROM (SELECT k FROM a INTERSECT SELECT k FROM b)",
    "frame_diff": "SELECT n_nationkey::BIGINT AS k, CASE WHEN n_nationkey = 3 THEN 'missing right' ELSE 'different' END AS problem FROM nation WHERE n_nationkey IN (3, 5, 7)",
    "baseline_drift": "SELECT dataset, n AS rows, CASE WHEN n % 2 = 1 THEN 'WARN' ELSE 'PASS' END AS status FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS n FROM {n}" for n in ("nation", "region", "customer", "supplier", "orders")) + ")",
    "content_hash": "WITH r AS (SELECT o_orderkey AS k, sha256('V' || length(o_orderkey::VARCHAR) || ':' || o_orderkey || coalesce('V' || length(o_custkey::VARCHAR) || ':' || o_custkey, 'N') || CASE WHEN o_orderkey % 7 <> 0 AND o_orderstatus IS NOT NULL THEN 'V' || length(o_orderstatus) || ':' || o_orderstatus ELSE 'N' END) AS h FROM orders), n AS (SELECT *, (row_number() OVER (ORDER BY k, h) - 1) // 10000 AS b FROM r), g AS (SELECT b, sha256(string_agg(h, chr(10) ORDER BY k, h)) AS h FROM n GROUP BY b) SELECT sha256(string_agg(h, chr(10) ORDER BY b)) AS content_hash FROM g",
    "quality_checks": f"WITH {_CHECKS} SELECT * FROM z",
    "status_counts": f"WITH {_CHECKS} SELECT status, count(*) AS n FROM z GROUP BY status",
    "scorecard": t.with_("site", "hub", "district") + ", n AS (SELECT DISTINCT c_nationkey, c_custkey FROM site s JOIN hub h ON sqrt((s.x - h.x) * (s.x - h.x) + (s.y - h.y) * (s.y - h.y)) <= 50000), k AS (SELECT c_nationkey, count(*) AS near FROM n GROUP BY 1) SELECT district_code, district, state, population, (sum(population) OVER (PARTITION BY state))::BIGINT AS state_population, round(coalesce(near, 0) * 1000 / population * 100, 2) AS near_pct FROM district LEFT JOIN k ON c_nationkey = district_code",
    "station_search": t.with_("hub") + "SELECT s_suppkey, s_name, kind FROM hub WHERE contains(lower(s_name), '00001') AND kind = 'rail'",
    "toll_filter": t.with_("hub") + "SELECT s_suppkey, kind FROM hub WHERE contains(lower(s_name), 'toll') OR contains(kind, 'toll') ORDER BY s_suppkey LIMIT 20",
    "village_page": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100",
    "strict_json": "SELECT '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"v\":' || CASE WHEN n_nationkey = 3 THEN 'null' ELSE n_regionkey || '.0' END || '}' AS json FROM nation",
    "distance_classes": "SELECT c_custkey, CASE WHEN m <= 5 THEN 0 WHEN m <= 10 THEN 1 WHEN m <= 25 THEN 2 WHEN m <= 50 THEN 3 ELSE 4 END AS band FROM (SELECT c_custkey, c_custkey % 70 AS m FROM customer)",
    "resolve_location": "WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS code, CASE WHEN c_custkey % 3 = 1 THEN lower(c_name) WHEN c_custkey % 3 = 2 THEN 'x' || (c_custkey % 31) END AS name FROM customer), k AS (SELECT n_nationkey AS code, 'x' || (n_nationkey % 20) AS name FROM nation), j AS (SELECT c_custkey, count(k.code) AS n, min(k.code)::BIGINT AS c FROM a LEFT JOIN k ON k.code = a.code OR k.name = a.name GROUP BY c_custkey) SELECT c_custkey, CASE WHEN n = 0 THEN 'missing' WHEN n = 1 THEN 'found' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN c END AS found_code, n AS candidates FROM j",
    "requested_port": "WITH a AS (SELECT s_suppkey, 'port' || s_suppkey AS w FROM supplier), p AS (SELECT 'Port-' || s_suppkey || ' (Main)' AS port, 'port' || s_suppkey || 'main' AS k FROM supplier), j AS (SELECT a.s_suppkey, count(p.port) AS n, min(port) AS port FROM a LEFT JOIN p ON contains(k, w) OR contains(w, k) GROUP BY 1) SELECT s_suppkey, CASE WHEN n = 0 THEN 'missing' WHEN n = 1 THEN 'found' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN port END AS port FROM j",
    "percentile_scores": t.with_("district") + ", h AS (SELECT s_nationkey, count(*) AS hubs, round(avg(s_acctbal), 2) AS balance FROM supplier GROUP BY 1), d AS (SELECT * FROM district LEFT JOIN h ON s_nationkey = district_code), p AS (SELECT district_code, state, " + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN percent_rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) * 100 END AS n_{c}, CASE WHEN {c} IS NOT NULL THEN percent_rank() OVER (PARTITION BY state, {c} IS NULL ORDER BY {c}) * 100 END AS s_{c}" for c in ("population", "hubs", "balance")) + " FROM d), w AS (SELECT *, (coalesce(n_population * 0.5, 0) + coalesce(n_hubs * 0.25, 0) + coalesce(n_balance * 0.25, 0)) / nullif(CASE WHEN n_population IS NOT NULL THEN 0.5 ELSE 0 END + CASE WHEN n_hubs IS NOT NULL THEN 0.25 ELSE 0 END + CASE WHEN n_balance IS NOT NULL THEN 0.25 ELSE 0 END, 0) AS sc FROM p) SELECT district_code, round(n_population, 4) AS population_national, round(s_population, 4) AS population_state, round(sc, 4) AS score, rank() OVER (ORDER BY round(sc, 9) DESC NULLS LAST)::INTEGER AS rank FROM w",
}
