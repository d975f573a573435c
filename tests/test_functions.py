import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from talweg.functions import geo, geometry, text, values
from talweg.operators import freight, gravity


def one(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], list(given)).select(column.alias("x")).first()[0] if given else spark.range(1).select(column.alias("x")).first()[0]


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(77.2, 28.6), (72.8, 18.9), (92.7, 11.7), (80.0, 24.0)], "lon double, lat double")
    got = df.select("lon", "lat", geo.project_x(F.col("lon"), F.col("lat")).alias("x"), geo.project_y(F.col("lon"), F.col("lat")).alias("y")).toPandas()
    lon, lat = geo.unproject(got.x, got.y)
    assert np.allclose(lon, got.lon, atol=1e-9) and np.allclose(lat, got.lat, atol=1e-9)
    assert got.iloc[3].x == pytest.approx(4_000_000) and got.iloc[3].y == pytest.approx(4_000_000)


def test_geodesic_known_lengths():
    # a degree of longitude on the equator; a quarter meridian
    assert geo.geodesic_m([0], [0], [1], [0])[0] == pytest.approx(111319.4908, abs=1e-3)
    assert geo.geodesic_m([0], [0], [0], [90])[0] == pytest.approx(10001965.7293, abs=1e-3)
    assert geo.geodesic_m([5], [5], [5], [5])[0] == 0


def test_snap_halves_to_even(spark):
    assert [one(spark, geo.snap(F.lit(v))) for v in (7.5, 22.5, 8.0, -7.5)] == [0.0, 30.0, 15.0, 0.0]


def test_states_and_districts(spark):
    assert one(spark, text.clean_state_name(F.lit(" ORISSA "))) == "Odisha"
    assert one(spark, text.clean_state_name(F.lit("nowhere"))) is None
    assert one(spark, text.clean_district_name(F.lit("Saran (Chhapra)"))) == "saran"
    assert one(spark, text.clean_district_name(F.lit("Marigaon"))) == "morigaon"
    assert one(spark, text.population_key(F.lit("North & Middle  Andaman (x) District"))) == "northandmiddleandaman"
    with pytest.raises(PySparkException):
        one(spark, text.required_state(F.lit("nowhere")))


def test_roads(spark):
    assert one(spark, text.highway_numbers(F.lit("NH44;old NH7,SH1;NH 44"))) == "44;7"
    assert one(spark, text.highway_numbers(F.lit(None).cast("string"))) == ""
    assert one(spark, text.road_class(F.lit("primary_link"), F.lit(None).cast("string"))) == "SH"
    assert one(spark, text.road_class(F.lit(None).cast("string"), F.lit("nh 8"))) == "NH"
    assert one(spark, text.duration_text(F.lit(2.51))) == "2 hrs 31 min"


def test_names_alike(spark):
    row = spark.createDataFrame([("puri", "pury"), (None, "x")], "a string, b string").select(text.similarity("a", "b")).collect()
    assert row[0][0] == 0.75 and row[1][0] is None
    assert one(spark, text.name_variants(F.lit("Khandwa (East Nimar)"))) == ["KHANDWAEASTNIMAR", "KHANDWA", "EASTNIMAR"]


def test_guards(spark):
    assert one(spark, values.observation(F.lit(float("nan")), "x")) is None
    assert one(spark, values.strict_number(F.lit(0.0), "x")) == 0
    for bad in (-1.0, float("inf")):
        with pytest.raises(PySparkException):
            one(spark, values.observation(F.lit(bad), "x"))
    with pytest.raises(PySparkException):
        one(spark, values.strict_number(F.lit(0.0), "x", positive=True))


def test_parameters():
    assert freight.resolve_parameters({"road_linehaul_rate": 4, "dfc_linehaul_rate": None}).road_linehaul_rate == 4.0
    for bad in ({"unknown": None}, {"truck_payload_tons": 0}, {"road_linehaul_rate": float("nan")}, {"road_linehaul_rate": True}):
        with pytest.raises(freight.ParameterError):
            freight.resolve_parameters(bad)
    with pytest.raises(ValueError):
        gravity.capacities({"Atlantis": 1.0})


def test_tariff_bands(spark):
    base = 1.55
    expected = {50: 50 * base * 1.35, 300: 100 * base * 1.35 + 200 * base * 1.1, 1200: 100 * base * 1.35 + 400 * base * 1.1 + 500 * base * 0.9 + 200 * base * 0.75}
    for km, value in expected.items():
        assert one(spark, freight.tariff(F.lit(float(km)), base)) == pytest.approx(value)


def test_half_null_route_is_an_error(spark):
    df = spark.createDataFrame([("Bihar", "d", 1, 0, False, "p", 5.0, None, None)], "state string, district string, district_code long, pop_2011 long, is_island boolean, target_port string, road_km double, hours double, terminal_km double")
    with pytest.raises(PySparkException):
        freight.modal_split(df).collect()


SQUARE = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]
HOLED = [*SQUARE, [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]]


def test_areas():
    assert geometry.polygon_area(HOLED) == 12
    shifted = [[(x + 2, y + 1) for x, y in SQUARE[0]]]
    assert geometry.overlap_area(SQUARE, shifted) == pytest.approx(6)
    assert geometry.overlap_area(HOLED, SQUARE) == pytest.approx(12)
    assert geometry.symmetric_difference_area(SQUARE, shifted) == pytest.approx(20)
    triangle = [[(0, 0), (4, 0), (0, 4)]]
    assert geometry.overlap_area(SQUARE, triangle) == pytest.approx(8)
    assert geometry.overlap_area(SQUARE, [[(2, -1), (5, 2), (2, 5), (-1, 2)]]) == pytest.approx(14)


def test_points_and_lines():
    assert geometry.inside([2, 0.5, 5], [2, 0.5, 2], HOLED).tolist() == [False, True, False]
    x, y = geometry.interior_point(HOLED)
    assert geometry.inside(x, y, HOLED)[0]
    assert geometry.along([(0, 0), (4, 0), (4, 4)], 0.75) == (4, 2)
    assert geometry.simplify([(0, 0), (1, 0.1), (2, 0), (3, 5)], 0.5) == [(0, 0), (2, 0), (3, 5)]
    assert len(geometry.convex_hull([(0, 0), (1, 1), (2, 0), (1, 0.2), (2, 2), (0, 2)])) == 4
    ring = geometry.buffer_convex([(0, 0)], 1.0)
    assert abs(geometry.ring_area(ring)) == pytest.approx(math.pi, rel=0.01)
    assert geometry.hausdorff([(0, 0)], [(3, 4)]) == 5


def test_wkb_round_trip():
    for kind, coordinates in (("Point", [1.0, 2.0]), ("LineString", [[0.0, 0.0], [1.0, 1.0]]), ("MultiPolygon", [[[list(map(float, p)) for p in r] for r in HOLED]])):
        assert geometry.decode_wkb(geometry.encode_wkb(kind, coordinates)) == (kind, coordinates)


def test_stitch_and_dissolve():
    rings = geometry.stitch([[(0, 0), (1, 0)], [(1, 1), (1, 0)], [(1, 1), (0, 0)], [(9, 9), (8, 8)]])
    assert len(rings) == 1 and rings[0][0] == rings[0][-1]
    outline = geometry.dissolve([[[(0, 0), (1, 0), (1, 1), (0, 1)]], [[(1, 0), (2, 0), (2, 1), (1, 1)]]])
    assert len(outline) == 1 and abs(geometry.ring_area(outline[0])) == 2
