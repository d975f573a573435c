"""Queries of the freight and gravity models."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.operators import freight, gravity
from talweg.plans import tables as t

P = freight.FreightParameters()


def freight_unit_cost(spark, sf):
    df = freight.unit_costs(t.routes(spark, sf))
    return df.select("o_orderkey", "l_linenumber", "optimal_mode", "break_even_km", "first_mile_km", *[F.col(c) for c in ("road_cost", "rail_cost", "dfc_cost", "rail_hours", "savings", "savings_pct")])


def _cost_sql(p: freight.FreightParameters = P, extra: str = "") -> str:
    corridor = ", ".join(f"'{s}'" for s in freight.CORRIDOR_STATES)
    band, low = [], 0.0
    for high, factor in freight.BANDS:
        inside = f"greatest(rail_km - {low!r}, 0.0)" if high == float("inf") else f"least(greatest(rail_km - {low!r}, 0.0), {high - low!r})"
        band.append(f"{inside} * {p.rail_base_class_rate * factor!r}::DOUBLE")
        low = high
    return t.with_("route") + f""", a AS (SELECT *, road_km * {p.rail_circuity_factor!r}::DOUBLE AS rail_km, CASE WHEN state IN ({corridor}) THEN road_km * {p.dfc_circuity_factor!r}::DOUBLE END AS dfc_km,
 coalesce(least(terminal_km, {freight.FIRST_MILE_CAP!r}::DOUBLE), {freight.FIRST_MILE_DEFAULT!r}::DOUBLE) AS first_mile_km,
 road_km * {p.road_linehaul_rate!r}::DOUBLE + road_km / {p.toll_spacing_km!r}::DOUBLE * {p.toll_cost_per_plaza / p.truck_payload_tons!r}::DOUBLE + hours * {p.inventory_holding_rate!r}::DOUBLE + {p.road_handling_cost!r}::DOUBLE AS road_cost FROM route),
 b AS (SELECT *, rail_km / {p.rail_commercial_speed_kmh!r}::DOUBLE + {p.rail_yard_detention_hours!r}::DOUBLE AS rail_hours, dfc_km / {p.dfc_commercial_speed_kmh!r}::DOUBLE + {p.dfc_yard_transfer_hours!r}::DOUBLE AS dfc_hours,
  first_mile_km * {p.rail_first_mile_rate!r}::DOUBLE + {p.rail_first_mile_handling!r}::DOUBLE AS feeder FROM a),
 c AS (SELECT *, feeder + ({' + '.join(band)}) + {p.rail_handling_and_siding!r}::DOUBLE + rail_hours * {p.inventory_holding_rate!r}::DOUBLE AS rail_cost,
  feeder + dfc_km * {p.dfc_linehaul_rate!r}::DOUBLE + {p.dfc_handling_cost!r}::DOUBLE + dfc_hours * {p.inventory_holding_rate!r}::DOUBLE AS dfc_cost FROM b),
 d AS (SELECT *, least(road_cost, rail_cost, coalesce(dfc_cost, rail_cost)) AS best FROM c),
 cost AS (SELECT *, CASE WHEN road_cost = best THEN '{freight.ROAD}' WHEN rail_cost = best THEN '{freight.RAIL}' ELSE '{freight.DFC}' END AS optimal_mode, greatest(road_cost - best, 0.0) AS savings,
  CASE WHEN road_cost > 0 THEN greatest(road_cost - best, 0.0) / road_cost * 100 ELSE 0.0 END AS savings_pct, CASE WHEN dfc_km IS NOT NULL THEN {freight.BREAK_EVEN_CORRIDOR!r}::DOUBLE ELSE {freight.BREAK_EVEN_RAIL!r}::DOUBLE END AS break_even_km FROM d) {extra}"""


def freight_summary(spark, sf):
    return freight.unit_costs(t.routes(spark, sf)).groupBy("state", "optimal_mode").agg(F.count("*").alias("n"), F.round(F.sum("savings"), 2).alias("savings"), F.round(F.avg("road_km"), 4).alias("mean_km"))


def freight_shipment_scale(spark, sf):
    df = freight.shipment(freight.unit_costs(t.routes(spark, sf).filter("l_quantity > 0")), F.col("l_quantity"))
    return df.select("o_orderkey", "l_linenumber", *[F.col(f"shipment_{c}") for c in ("road", "rail", "dfc", "savings")])


OVERRIDE = {"road_linehaul_rate": 2.9, "dfc_linehaul_rate": 1.4, "toll_spacing_km": None}


def freight_param_override(spark, sf):
    return freight.unit_costs(t.routes(spark, sf), OVERRIDE).groupBy("optimal_mode").agg(F.count("*").alias("n"), F.round(F.avg("savings"), 4).alias("mean_savings"))


def freight_modal_split(spark, sf):
    r = t.routes(spark, sf).select("o_orderkey", "l_linenumber", "state", "road_km", "hours", "terminal_km")
    lost = F.col("o_orderkey") % 13 == 0
    travel = r.select(
        F.when(F.col("o_orderkey") % 29 == 0, "Lakshadweep").otherwise(F.col("state")).alias("state"), F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("district"),
        (F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("district_code"), F.lit(0).cast("long").alias("pop_2011"), F.lit(False).alias("is_island"), F.lit("port").alias("target_port"),
        F.when(~lost, F.col("road_km")).alias("road_km"), F.when(~lost, F.col("hours")).alias("hours"), "terminal_km",
    )
    return freight.modal_split(travel).select("district_code", "state", "is_island", "road_distance_km", "road_drive_time_hours", "road_cost_per_ton_inr", "rail_cost_per_ton_inr", "dfc_cost_per_ton_inr", "optimal_mode", "modal_shift_savings_inr", "modal_shift_savings_pct", "break_even_distance_km")


_MODAL = f"""SELECT o_orderkey * 10 + l_linenumber AS district_code, CASE WHEN island THEN 'Lakshadweep' ELSE state END AS state, island AS is_island,
 CASE WHEN ok THEN floor(road_km * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE END AS road_distance_km, CASE WHEN ok THEN floor(hours * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE END AS road_drive_time_hours, CASE WHEN ok THEN floor(road_cost * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE END AS road_cost_per_ton_inr,
 CASE WHEN ok THEN floor(rail_cost * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE END AS rail_cost_per_ton_inr, CASE WHEN ok THEN floor(dfc_cost * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE END AS dfc_cost_per_ton_inr, CASE WHEN ok THEN optimal_mode ELSE '{freight.NONE}' END AS optimal_mode,
 CASE WHEN ok THEN floor(savings * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE END AS modal_shift_savings_inr, CASE WHEN ok THEN floor(savings_pct * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE END AS modal_shift_savings_pct, CASE WHEN ok THEN break_even_km END AS break_even_distance_km
FROM (SELECT *, o_orderkey % 29 = 0 AS island, o_orderkey % 29 <> 0 AND o_orderkey % 13 <> 0 AS ok FROM cost)"""


def toll_heuristic(spark, sf):
    o = t.read(spark, sf, "orders").select("o_orderkey", (((F.col("o_orderkey") * 31) % 250000) / 100.0).alias("km"), F.element_at(F.array(F.lit("LMV"), F.lit("MAV_20T"), F.lit("LCV")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("vehicle"))
    return o.select("o_orderkey", "vehicle", freight.toll_count(F.col("km")).alias("tolls"), (freight.toll_count(F.col("km")) * freight.toll_rate(F.col("vehicle"))).alias("toll_inr"))


def trip_time(spark, sf):
    o = t.read(spark, sf, "orders").select("o_orderkey", (((F.col("o_orderkey") * 31) % 250000) / 5000.0).alias("h"), ((F.col("o_orderkey") % 400) / 10.0).alias("km"), F.element_at(F.array(*[F.lit(v) for v in freight.VEHICLE_FACTORS]), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("vehicle"))
    hours = freight.trip_hours(F.col("h"), F.col("km"), F.col("vehicle"))
    from talweg.functions.text import duration_text

    return o.select("o_orderkey", F.round(hours, 9).alias("hours"), duration_text(F.floor(hours * 100) / 100.0).alias("text"))


_FACTOR = "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN {f!r}::DOUBLE" for i, f in enumerate(freight.VEHICLE_FACTORS.values())) + " END"


def route_plausible(spark, sf):
    r = t.routes(spark, sf)
    return r.select("o_orderkey", "l_linenumber", freight.plausible_rounded_route(F.round("road_km", 1), F.round(F.col("hours") / 1.2, 2)).alias("plausible"))


def gravity_batch(spark, sf):
    return gravity.hinterland(t.matrix(spark, sf), ["district_code"], island=F.col("district_code") == 7)


def _gravity_sql(alpha: float, beta: float) -> str:
    return t.with_("matrix") + f""", u AS (SELECT *, CASE WHEN hours > 0 THEN pow(capacity, {alpha!r}::DOUBLE) / pow(hours / 5.0::DOUBLE, {beta!r}::DOUBLE) END AS u, district_code = 7 AS island FROM matrix),
 p AS (SELECT *, CASE WHEN NOT island THEN u / sum(u) OVER (PARTITION BY district_code) END AS p FROM u),
 r AS (SELECT *, row_number() OVER (PARTITION BY district_code ORDER BY p DESC NULLS LAST, port_order) AS k FROM p),
 g AS (SELECT district_code, bool_or(island) AS is_island, max(port) FILTER (k = 1 AND p IS NOT NULL) AS port1, max(p) FILTER (k = 1) AS p1, max(hours) FILTER (k = 1 AND p IS NOT NULL) AS h1,
  max(port) FILTER (k = 2 AND p IS NOT NULL) AS port2, max(p) FILTER (k = 2) AS p2, max(hours) FILTER (k = 2 AND p IS NOT NULL) AS h2 FROM r GROUP BY district_code)
SELECT district_code, is_island, CASE WHEN p1 IS NOT NULL THEN port1 WHEN is_island THEN 'N/A (Island)' ELSE 'N/A' END AS primary_port, round(p1 * 100, 1) AS primary_port_probability, round(h1, 2) AS primary_port_drive_hours,
 CASE WHEN p1 IS NOT NULL THEN coalesce(port2, 'None') ELSE 'N/A' END AS secondary_port, CASE WHEN p1 IS NOT NULL THEN round(coalesce(p2, 0.0) * 100, 1) END AS secondary_port_probability, CASE WHEN p1 IS NOT NULL THEN round(coalesce(h2, 0.0), 2) END AS secondary_port_drive_hours,
 CASE WHEN is_island THEN 'Island / Isolated' WHEN p1 IS NULL THEN 'Isolated' WHEN p1 >= {gravity.CAPTIVE} THEN 'Captive Hinterland' WHEN p1 >= {gravity.DOMINANT} THEN 'Dominant / Mildly Contested' ELSE 'Highly Contested / Split Hinterland' END AS hinterland_category,
 CASE WHEN p1 IS NOT NULL THEN round(1.0 - (p1 - coalesce(p2, 0.0)), 3) END AS contestability_index FROM g"""


def gravity_sensitivity(spark, sf):
    return gravity.hinterland(t.matrix(spark, sf), ["district_code"], 2.0, 0.5, F.col("district_code") == 7)


def gravity_live_share(spark, sf):
    m = t.matrix(spark, sf).join(t.districts(spark, sf).select("district_code", "population"), "district_code")
    return gravity.live_shares(m, m.select("port", "port_order").distinct())


_LIVE = t.with_("matrix", "district") + f""", u AS (SELECT m.*, population, pow(capacity, {gravity.LIVE_EXPONENTS[0]!r}::DOUBLE) / pow(hours / 5.0::DOUBLE, {gravity.LIVE_EXPONENTS[1]!r}::DOUBLE) AS u FROM matrix m JOIN district USING (district_code) WHERE hours > 0),
 b AS (SELECT *, row_number() OVER (PARTITION BY district_code ORDER BY u DESC, port_order) AS k FROM u), w AS (SELECT port, count(*) AS n, sum(coalesce(population, 0)) AS people FROM b WHERE k = 1 GROUP BY port)
SELECT p.port AS port_name, p.port_order, coalesce(n, 0) AS captured_districts_count, coalesce(round(n / sum(n) OVER () * 100.0, 1), 0.0) AS market_share_districts_pct, round(coalesce(people, 0) / 1e7, 2) AS captured_population_cr
FROM (SELECT DISTINCT port, port_order FROM matrix) p LEFT JOIN w USING (port)"""

QUERIES = {
    "freight_unit_cost": freight_unit_cost, "freight_summary": freight_summary, "freight_shipment_scale": freight_shipment_scale, "freight_param_override": freight_param_override,
    "freight_modal_split": freight_modal_split, "toll_heuristic": toll_heuristic, "trip_time": trip_time, "route_plausible": route_plausible,
    "gravity_batch": gravity_batch, "gravity_sensitivity": gravity_sensitivity, "gravity_live_share": gravity_live_share,
}
ORACLE_SQL = {
    "freight_unit_cost": _cost_sql(extra="SELECT o_orderkey, l_linenumber, optimal_mode, break_even_km, first_mile_km, " + ", ".join(c for c in ("road_cost", "rail_cost", "dfc_cost", "rail_hours", "savings", "savings_pct")) + " FROM cost"),
    "freight_summary": _cost_sql(extra="SELECT state, optimal_mode, count(*) AS n, round(sum(savings), 2) AS savings, round(avg(road_km), 4) AS mean_km FROM cost GROUP BY ALL"),
    "freight_shipment_scale": _cost_sql(extra="SELECT o_orderkey, l_linenumber, road_cost * l_quantity AS shipment_road, rail_cost * l_quantity AS shipment_rail, dfc_cost * l_quantity AS shipment_dfc, savings * l_quantity AS shipment_savings FROM cost WHERE l_quantity > 0"),
    "freight_param_override": _cost_sql(freight.resolve_parameters(OVERRIDE), "SELECT optimal_mode, count(*) AS n, round(avg(savings), 4) AS mean_savings FROM cost GROUP BY ALL"),
    "freight_modal_split": _cost_sql(extra=_MODAL),
    "toll_heuristic": "SELECT o_orderkey, v AS vehicle, n AS tolls, n * CASE v WHEN 'MAV_20T' THEN 340.0::DOUBLE WHEN 'LMV' THEN 120.0::DOUBLE ELSE 220.0::DOUBLE END AS toll_inr FROM (SELECT *, CASE WHEN km >= 40 THEN greatest(round_even(km / 65.0::DOUBLE, 0), 1) ELSE 0 END::BIGINT AS n FROM (SELECT o_orderkey, ((o_orderkey * 31) % 250000) / 100.0::DOUBLE AS km, CASE o_orderkey % 3 WHEN 0 THEN 'LMV' WHEN 1 THEN 'MAV_20T' ELSE 'LCV' END AS v FROM orders))",
    "trip_time": f"SELECT o_orderkey, round(h, 9) AS hours, (m // 60)::VARCHAR || ' hrs ' || (m % 60)::VARCHAR || ' min' AS text FROM (SELECT *, round_even(floor(h * 100) / 100.0::DOUBLE * 60, 0)::BIGINT AS m FROM (SELECT o_orderkey, ((o_orderkey * 31) % 250000) / 5000.0::DOUBLE / f + (o_orderkey % 400) / 10.0::DOUBLE / (35.0::DOUBLE * f) AS h FROM (SELECT o_orderkey, {_FACTOR} AS f FROM orders)))",
    "route_plausible": t.with_("route") + "SELECT o_orderkey, l_linenumber, d + 0.05 + 1e-9 >= 35 * greatest(h - 0.005, 0) AND greatest(d - 0.05, 0) <= 90 * (h + 0.005) + 1e-9 AS plausible FROM (SELECT *, round(road_km, 1) AS d, round(hours / 1.2::DOUBLE, 2) AS h FROM route)",
    "gravity_batch": _gravity_sql(*gravity.BATCH_EXPONENTS), "gravity_sensitivity": _gravity_sql(2.0, 0.5), "gravity_live_share": _LIVE,
}
