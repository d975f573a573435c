"""Road, rail and corridor freight cost per tonne, as Columns over route rows."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions.text import clean_state_name, is_island_state
from talweg.functions.values import half_up, observation, strict_number


# The cost model's defaults (rupees per tonne, tonne-kilometre, plaza or tonne-hour; kilometres, hours, tonnes).
@dataclass(frozen=True)
class FreightParameters:
    road_linehaul_rate: float = 3.30
    road_handling_cost: float = 140.0
    toll_cost_per_plaza: float = 340.0
    truck_payload_tons: float = 20.0
    toll_spacing_km: float = 65.0
    rail_base_class_rate: float = 1.55
    rail_first_mile_rate: float = 4.20
    rail_first_mile_handling: float = 120.0
    rail_handling_and_siding: float = 220.0
    rail_commercial_speed_kmh: float = 25.0
    rail_yard_detention_hours: float = 12.0
    rail_circuity_factor: float = 1.08
    dfc_linehaul_rate: float = 1.12
    dfc_handling_cost: float = 180.0
    dfc_commercial_speed_kmh: float = 60.0
    dfc_yard_transfer_hours: float = 3.0
    dfc_circuity_factor: float = 1.02
    inventory_holding_rate: float = 7.50


MUST_BE_POSITIVE = ("truck_payload_tons", "toll_spacing_km", "rail_commercial_speed_kmh", "dfc_commercial_speed_kmh", "rail_circuity_factor", "dfc_circuity_factor")
# Tariff bands (upper kilometre, factor on the base rate), corridor states, first-mile bounds, break-even marks.
BANDS = ((100.0, 1.35), (500.0, 1.10), (1000.0, 0.90), (math.inf, 0.75))
CORRIDOR_STATES = ("Uttar Pradesh", "Haryana", "Rajasthan", "Gujarat", "Maharashtra", "Punjab", "Bihar", "Jharkhand", "West Bengal")
FIRST_MILE_DEFAULT, FIRST_MILE_CAP = 50.0, 100.0
BREAK_EVEN_CORRIDOR, BREAK_EVEN_RAIL = 210.0, 380.0
ROAD, RAIL, DFC, NONE = "Road Trucking", "Conventional Rail", "Dedicated Freight Corridor (DFC)", "N/A (Island / Isolated)"


class ParameterError(ValueError):
    pass


def resolve_parameters(overrides: FreightParameters | Mapping | None = None) -> FreightParameters:
    """Defaults with overrides: None keeps a default, unknown names and numbers out of range are errors."""
    if isinstance(overrides, FreightParameters):
        found = overrides
    else:
        given = dict(overrides or {})
        if unknown := given.keys() - {f.name for f in fields(FreightParameters)}:
            raise ParameterError(f"unknown freight parameters: {sorted(unknown)}")
        found = replace(FreightParameters(), **{k: v for k, v in given.items() if v is not None})
    for name, value in asdict(found).items():
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value) or value < 0 or (value == 0 and name in MUST_BE_POSITIVE):
            raise ParameterError(f"{name} is out of range: {value!r}")
    return FreightParameters(**{k: float(v) for k, v in asdict(found).items()})


def tariff(km: Column, base_rate: float) -> Column:
    """Telescopic tariff: every kilometre costs its band's rate."""
    total, low = F.lit(0.0), 0.0
    for high, factor in BANDS:
        inside = F.greatest(km - low, F.lit(0.0)) if math.isinf(high) else F.least(F.greatest(km - low, F.lit(0.0)), F.lit(high - low))
        total, low = total + inside * (base_rate * factor), high
    return total


def unit_costs(df: DataFrame, parameters: FreightParameters | Mapping | None = None, road_km: str = "road_km", hours: str = "hours", terminal_km: str = "terminal_km", state: str = "state") -> DataFrame:
    """df with costs, hours and distances by mode, the winner and its savings.

    road_km and hours must be finite and not negative, terminal_km may be missing; state must be canonical.
    """
    p = resolve_parameters(parameters)
    km, drive = strict_number(F.col(road_km), road_km), strict_number(F.col(hours), hours)
    first_mile = F.coalesce(F.least(observation(F.col(terminal_km), terminal_km), F.lit(FIRST_MILE_CAP)), F.lit(FIRST_MILE_DEFAULT))
    df = df.withColumns({"__km": km, "__h": drive, "first_mile_km": first_mile, "first_mile_defaulted": observation(F.col(terminal_km), terminal_km).isNull(), "dfc_eligible": F.coalesce(F.col(state).isin(*CORRIDOR_STATES), F.lit(False))})
    feeder = F.col("first_mile_km") * p.rail_first_mile_rate + p.rail_first_mile_handling
    df = df.withColumns(
        {
            "rail_km": F.col("__km") * p.rail_circuity_factor,
            "dfc_km": F.when(F.col("dfc_eligible"), F.col("__km") * p.dfc_circuity_factor),
            "road_cost": F.col("__km") * p.road_linehaul_rate + F.col("__km") / p.toll_spacing_km * (p.toll_cost_per_plaza / p.truck_payload_tons) + F.col("__h") * p.inventory_holding_rate + p.road_handling_cost,
        }
    )
    df = df.withColumns({"rail_hours": F.col("rail_km") / p.rail_commercial_speed_kmh + p.rail_yard_detention_hours, "dfc_hours": F.col("dfc_km") / p.dfc_commercial_speed_kmh + p.dfc_yard_transfer_hours})
    df = df.withColumns(
        {
            "rail_cost": feeder + tariff(F.col("rail_km"), p.rail_base_class_rate) + p.rail_handling_and_siding + F.col("rail_hours") * p.inventory_holding_rate,
            "dfc_cost": feeder + F.col("dfc_km") * p.dfc_linehaul_rate + p.dfc_handling_cost + F.col("dfc_hours") * p.inventory_holding_rate,
        }
    )
    best = F.least("road_cost", "rail_cost", "dfc_cost")  # skips the null of a state off the corridor; ties go to road, then rail
    df = df.withColumns({"optimal_mode": F.when(F.col("road_cost") == best, ROAD).when(F.col("rail_cost") == best, RAIL).otherwise(DFC), "savings": F.greatest(F.col("road_cost") - best, F.lit(0.0))})
    return df.withColumns(
        {
            "savings_pct": F.when(F.col("road_cost") > 0, F.col("savings") / F.col("road_cost") * 100).otherwise(F.lit(0.0)),
            "break_even_km": F.when(F.col("dfc_eligible"), BREAK_EVEN_CORRIDOR).otherwise(BREAK_EVEN_RAIL),
        }
    ).drop("__km", "__h")


def shipment(df: DataFrame, tons: Column) -> DataFrame:
    """Costs of a shipment: unit costs times a positive quantity."""
    q = strict_number(tons, "shipment_tons", positive=True)
    return df.withColumns({f"shipment_{x}": F.col(y) * q for x, y in (("road", "road_cost"), ("rail", "rail_cost"), ("dfc", "dfc_cost"), ("savings", "savings"))})


def modal_split(travel: DataFrame, parameters: FreightParameters | Mapping | None = None) -> DataFrame:
    """The published table: rounded costs by district; islands and unreachable districts have nulls and a mode of their own.

    travel: state, district, district_code, pop_2011, is_island, target_port, road_km, hours, terminal_km. A half-null
    pair of distance and time is an error.
    """
    km, hours = observation(F.col("road_km"), "road distance"), observation(F.col("hours"), "drive time")
    half = km.isNull() != hours.isNull()
    canonical = clean_state_name(F.col("state"))
    travel = travel.withColumns({"__dist": F.when(half, F.raise_error(F.lit("distance and time must be missing together")).cast("double")).otherwise(km), "__time": hours, "__state": F.when(canonical.isNotNull(), canonical).otherwise(F.raise_error(F.lit("unknown state"))), "is_island": F.coalesce(F.col("is_island"), F.lit(False)) | is_island_state(F.col("state"))})
    open_ = ~F.col("is_island") & F.col("__dist").isNotNull()
    filled = travel.withColumns({"__k0": F.coalesce("__dist", F.lit(0.0)), "__h0": F.coalesce("__time", F.lit(0.0))})
    costed = unit_costs(filled, parameters, "__k0", "__h0", "terminal_km", "__state")
    known = lambda c: F.when(open_, c)
    return costed.select(
        "state", "district", "district_code", "pop_2011", "is_island", "target_port",
        known(half_up(F.col("__dist"), 1)).alias("road_distance_km"), known(half_up(F.col("__time"), 2)).alias("road_drive_time_hours"),
        known(half_up(F.col("road_cost"), 1)).alias("road_cost_per_ton_inr"), known(half_up(F.col("rail_cost"), 1)).alias("rail_cost_per_ton_inr"),
        known(half_up(F.col("dfc_cost"), 1)).alias("dfc_cost_per_ton_inr"), F.when(open_, F.col("optimal_mode")).otherwise(NONE).alias("optimal_mode"),
        known(half_up(F.col("savings"), 1)).alias("modal_shift_savings_inr"), known(half_up(F.col("savings_pct"), 1)).alias("modal_shift_savings_pct"),
        known(F.col("break_even_km")).alias("break_even_distance_km"),
    )


# Toll estimate.
TOLL_SPACING_KM, TOLL_FROM_KM = 65.0, 40.0
TOLL_RATES = {"MAV_20T": 340.0, "LMV": 120.0}
TOLL_OTHER = 220.0


def toll_count(km: Column) -> Column:
    return F.when(km >= TOLL_FROM_KM, F.greatest(F.bround(km / TOLL_SPACING_KM), F.lit(1.0))).otherwise(F.lit(0.0)).cast("long")


def toll_rate(vehicle: Column) -> Column:
    out = F.lit(TOLL_OTHER)
    for name, rate in TOLL_RATES.items():
        out = F.when(vehicle == name, rate).otherwise(out)
    return out


# Speed factors of vehicle classes, feeder speed.
VEHICLE_FACTORS = {"LMV": 1.0, "LCV": 0.95, "TRUCK_2AXLE": 0.85, "MAV_20T": 0.80, "MAV_7AXLE": 0.65}
FEEDER_KMH = 35.0


def trip_hours(network_hours: Column, feeder_km: Column, vehicle: Column) -> Column:
    """Network time over the vehicle's factor, feeders at the factor's share of the feeder speed."""
    factor = F.lit(0.80)
    for name, value in VEHICLE_FACTORS.items():
        factor = F.when(vehicle == name, value).otherwise(factor)
    return network_hours / factor + feeder_km / (FEEDER_KMH * factor)


def plausible_rounded_route(km: Column, hours: Column) -> Column:
    """Whether some route of 35 to 90 km/h rounds to these values; both missing is fine, one missing is not."""
    d, t = F.greatest(km - 0.05, F.lit(0.0)), F.greatest(hours - 0.005, F.lit(0.0))
    both = (km >= 0) & (hours >= 0) & (km + 0.05 + 1e-9 >= 35 * t) & (d <= 90 * (hours + 0.005) + 1e-9)
    return F.when(km.isNull() & hours.isNull(), F.lit(True)).otherwise(F.coalesce(both, F.lit(False)))
