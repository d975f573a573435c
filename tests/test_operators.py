import json
import sqlite3
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from talweg.functions.geometry import encode_wkb
from talweg.operators import access, graph, quality, relational, spatial
from talweg.sources import readers, sinks


def test_fastest_path_is_not_the_shortest(spark):
    edges = spark.createDataFrame([(1, 2, 1.0, 2.0, False), (2, 3, 1.0, 2.0, False), (1, 4, 5.0, 1.0, True), (4, 3, 5.0, 1.0, False), (8, 9, 1.0, 1.0, False)], "u long, v long, km double, hours double, is_bridge boolean")
    pairs = spark.createDataFrame([(1, 3), (1, 1), (1, 9)], "u long, v long")
    got = {r.v: r for r in graph.fastest_paths(edges, pairs).collect()}
    assert (got[3].hours, got[3].km, got[3].bridges, got[3].nodes) == (2.0, 10.0, 1, [1, 4, 3])
    assert (got[1].hours, got[1].km) == (0.0, 0.0)
    assert got[9].hours is None and got[9].nodes is None


def test_relaxation_agrees_with_search(spark):
    edges = spark.createDataFrame([(i, (i * 7 + 3) % 20, 1.0, 1.0 + i % 3, False) for i in range(20)], "u long, v long, km double, hours double, is_bridge boolean").filter("u <> v")
    sources = spark.createDataFrame([(0,), (5,)], "u long")
    a = {(r.u, r.node): r.hours for r in graph.relaxed_hours(edges, sources).collect()}
    b = {(r.u, r.node): r.hours for r in graph.reached(edges, sources, 1e9).collect()}
    assert a == b


def test_thresholds_are_checked(spark):
    hours = spark.createDataFrame([(1, 1, 0.5)], "u long, node long, hours double")
    for bad in ([], [1.0, 1.0], [0.0], [float("inf")]):
        with pytest.raises(ValueError):
            graph.reach_counts(hours, bad)
    assert graph.reach_counts(hours, [0.5]).first()["nodes"] == 1  # inclusive


def test_radius_is_inclusive_and_complete(spark):
    a = spark.createDataFrame([(i, float(i * 37 % 500), float(i * 91 % 500)) for i in range(120)], "id long, x double, y double")
    got = {(r.a, r.b) for r in spatial.self_pairs(a, "id", 50.0).collect()}
    rows = a.collect()
    expected = {(p.id, q.id) for p in rows for q in rows if p.id < q.id and ((p.x - q.x) ** 2 + (p.y - q.y) ** 2) ** 0.5 <= 50.0}
    assert got == expected


def test_nearest_by_rings_equals_all_pairs(spark):
    a = spark.createDataFrame([(i, float(i * 37 % 1000), float(i * 91 % 1000)) for i in range(60)], "id long, x double, y double")
    b = spark.createDataFrame([(i, "k%d" % (i % 2), float(i * 311 % 9000), float(i * 17 % 9000)) for i in range(20)], "h long, kind string, x double, y double")
    got = {(r.id, r.r_kind, r["rank"]): r.r_h for r in spatial.nearest(a, b, "id", "h", 100.0, k=2, by="kind").collect()}
    rows = b.collect()
    for p in a.collect():
        for kind in ("k0", "k1"):
            best = sorted((((p.x - q.x) ** 2 + (p.y - q.y) ** 2) ** 0.5, q.h) for q in rows if q.kind == kind)[:2]
            assert [got[p.id, kind, i + 1] for i in range(2)] == [h for _, h in best]


def test_many_to_one_refuses_duplicates(spark):
    left = spark.createDataFrame([(1,)], "k long")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(PySparkException):
        relational.many_to_one(left, right, ["k"]).collect()


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(None, "x"), (1, "y")], "k long, a string")
    b = spark.createDataFrame([(None, "n"), (2, "m")], "k long, b string")
    assert sorted((r.a, r.b) for r in relational.null_safe_join(a, b, ["k"]).collect()) == [("x", "n"), ("y", None)]


def test_allocation_meets_totals(spark):
    pairs = access.area_shares(spark.createDataFrame([("c1", "p", 100.0, 60.0, 100.0), ("c2", "p", 100.0, 40.0, 100.0)], "child string, parent string, people double, area double, parent_area double"), "child", "parent")
    none = spark.createDataFrame([], "child string, villages long"), spark.createDataFrame([], "child string, cap double")
    groups = spark.createDataFrame([("c1", "g", 200.0), ("c2", "g", 200.0)], "child string, grp string, target double")
    got = {r.child: (r.people, r.method) for r in access.allocate(pairs, *none, groups).collect()}
    assert got["c1"][0] == pytest.approx(120) and got["c2"][0] == pytest.approx(80)


def test_broken_section_does_not_stop_the_audit(spark):
    def broken():
        raise RuntimeError

    good = lambda: quality.report([quality.count_between(spark.range(3), "t", "three", 3, 3)])
    assert quality.guarded({"a": broken, "b": good}) == [("a", "section broke: RuntimeError", "FAIL"), ("t", "three", "PASS")]


# --- sources and sinks -------------------------------------------------------------------------------------------------
def test_strict_json():
    assert readers.strict_json('{"a": [1.5, null]}') == {"a": [1.5, None]}
    for bad in ('{"a": 1, "a": 2}', '{"a": NaN}', '{"a": 1e999}'):
        with pytest.raises(ValueError):
            readers.strict_json(bad)


def test_geojson_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 77.123456, 20.0), (2, None, 78.0, 21.0)], "id long, name string, lon double, lat double")
    path = str(tmp_path / "x.geojson")
    assert sinks.write_geojson(sinks.features(df, "Point", sinks.rounded_point(F.col("lon"), F.col("lat"), 3), ["id", "name"]), path) == 2
    back = readers.read_geojson(spark, path, "id bigint, name string").orderBy("id")
    assert [tuple(r) for r in back.select("id", "name", *readers.point_columns(F.col("coordinates"))).collect()] == [(1, "a", 77.123, 20.0), (2, None, 78.0, 21.0)]


def test_geopackage(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "x.gpkg")
    db.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT)")
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    db.execute("CREATE TABLE layer (name TEXT, geom BLOB)")
    db.execute("INSERT INTO gpkg_contents VALUES ('layer', 'features')")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('layer', 'geom')")
    db.execute("INSERT INTO layer VALUES ('a', ?)", (b"GP\x00\x01" + struct.pack("<i", 4326) + encode_wkb("Point", (1.0, 2.0)),))
    db.commit()
    db.close()
    readers.register(spark)
    df = spark.read.format("geopackage").schema("name string, geometry binary").load(str(tmp_path / "x.gpkg"))
    assert [tuple(r) for r in df.select("name", readers.wkb_geometry("geometry").alias("g")).select("name", "g.*").collect()] == [("a", "Point", "[1.0, 2.0]")]


def test_shapefile(spark, tmp_path):
    body = struct.pack("<I2d", 1, 5.0, 6.0)
    record = struct.pack(">II", 1, len(body) // 2) + body
    (tmp_path / "x.shp").write_bytes(b"\0" * 100 + record)
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5, 0]) + b"\0" * 14
    (tmp_path / "x.dbf").write_bytes(struct.pack("<BBBBIHH20x", 3, 0, 0, 0, 1, 65, 6) + field + b"\r" + b" abc  ")
    readers.register(spark)
    df = spark.read.format("shapefile").schema("NAME string, geometry binary").load(str(tmp_path / "x.shp"))
    assert [tuple(r) for r in df.select("NAME", readers.wkb_geometry("geometry").alias("g")).select("NAME", "g.coordinates").collect()] == [("abc", "[5.0, 6.0]")]


def test_optional_and_text_sources(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), "a long", "csv").count() == 0
    (tmp_path / "t.csv").write_text("a,b\n1,\nNA,055\n")
    assert [tuple(r) for r in readers.read_csv_text(spark, str(tmp_path / "t.csv"), ["a", "b"]).collect()] == [("1", ""), ("NA", "055")]


def test_promotion_rolls_back(tmp_path):
    stage, target = tmp_path / "stage", tmp_path / "target"
    for folder, text in ((stage, "new"), (target, "old")):
        folder.mkdir()
        (folder / "a.csv").write_text(text)
        (folder / "manifest.json").write_text(json.dumps(text))
    sinks.promote(str(stage), str(target), str(tmp_path / "b1"), ["a.csv"], lambda p: None)
    assert (target / "a.csv").read_text() == "new"
    (stage / "a.csv").write_text("newer")
    (stage / "manifest.json").unlink()
    with pytest.raises(FileNotFoundError):
        sinks.promote(str(stage), str(target), str(tmp_path / "b2"), ["a.csv"], lambda p: None)
    assert (target / "a.csv").read_text() == "new" and json.loads((target / "manifest.json").read_text()) == "new"


def test_streamed_costs(spark, tmp_path):
    from talweg.streaming.scoring import score_routes

    source = str(tmp_path / "in")
    spark.createDataFrame([("Bihar", 100.0, 2.0, None)], "state string, road_km double, hours double, terminal_km double").write.parquet(source)
    stream = spark.readStream.schema("state string, road_km double, hours double, terminal_km double").parquet(source)
    score_routes(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
