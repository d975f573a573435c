"""Queries over all rows of their tables, held against plain versions on small fixtures."""

import math

import pytest

from talweg.plans import builders, relational, spatial
from talweg.plans import tables as t


@pytest.fixture(scope="module")
def write(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole"))

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{root}/{name}.parquet")
        return root

    return put


def test_every_event_is_checked_for_order(spark, write):
    events = [(i, i * 7 % 5, float(i * i % 83) if i % 5 < 3 else i / 3) for i in range(90)] + [(90, 9, 2.0), (91, 9, 1.5), (92, 8, 1.5), (93, 8, 1.2)]
    expected = {}
    for user in {u for _, u, _ in events}:
        seen = [math.floor(v) for _, u, v in sorted(events) if u == user]
        expected[user] = all(a <= b for a, b in zip(seen, seen[1:]))
    assert set(expected.values()) == {True, False}
    got = relational.monotonic_check(spark, write("events", events, "event_id long, user_id long, value double")).collect()
    assert {r.user_id: r.monotonic for r in got} == expected and len(got) == len(expected)


def test_every_site_has_neighbours(spark, write):
    write("customer", [(i, i % 25, f"c{i}", 1.0) for i in range(23)], "c_custkey long, c_nationkey long, c_name string, c_acctbal double")
    sf = write("supplier", [(i, i % 25, f"s{i}", 1.0) for i in range(30)], "s_suppkey long, s_nationkey long, s_name string, s_acctbal double")
    hubs = t.hubs(spark, sf).collect()
    expected = {}
    for s in t.sites(spark, sf).collect():
        for kind in t.KINDS:
            best = sorted((math.hypot(s.x - h.x, s.y - h.y), h.s_suppkey) for h in hubs if h.kind == kind)[:2]
            expected |= {(s.c_custkey, kind, i + 1): key for i, (_, key) in enumerate(best)}
    got = spatial.knn_per_category(spark, sf).collect()
    assert {(r.c_custkey, r.kind, r["rank"]): r.s_suppkey for r in got} == expected and len(got) == len(expected)


def test_every_point_finds_its_road(spark, write):
    parts = 430
    sf = write("part", [(k, k * 7 % 50) for k in range(parts)], "p_partkey long, p_size long")
    lines = []
    for k in range(parts):
        x, y = k % 20 * 300.0, k // 20 * 300.0
        lines += [(2 * k, x, y, x + 300, y)] * (k % 20 != 19) + [(2 * k + 1, x, y, x, y + 300)] * (k % 17 != 0)
    expected = {}
    for k in range(parts):
        x, y = k * 37 % 5700, k * 91 % 2700
        d, line = min((round(math.hypot(max(ax - x, 0, x - bx), max(ay - y, 0, y - by)), 6), n) for n, ax, ay, bx, by in lines)
        if d <= 400:
            expected[k] = (line, d)
    assert {r.p_partkey: (r.line, r.dist_m) for r in spatial.nearest_road(spark, sf).collect()} == expected and max(expected) >= 400


SUPPLIERS, CUSTOMERS = 130, 310


@pytest.fixture(scope="module")
def trade(write):
    write("nation", [(i, f"N{i}") for i in range(25)], "n_nationkey long, n_name string")
    write("customer", [(i, i % 25, f"c{i}", 1.0) for i in range(CUSTOMERS)], "c_custkey long, c_nationkey long, c_name string, c_acctbal double")
    return write("supplier", [(i, 24 if i == 125 else i % 24, f"s{i}", float(i * 37 % 101)) for i in range(SUPPLIERS)], "s_suppkey long, s_nationkey long, s_name string, s_acctbal double")


def test_all_that_is_asked_is_answered(spark, trade):
    got = {r.c_custkey: (r.status, r.found_code) for r in relational.resolve_location(spark, trade).collect()}
    known = [(n, f"x{n % 20}") for n in range(25)]
    for c in range(CUSTOMERS):
        hits = [n for n, name in known if (n == c % 25 if c % 3 == 0 else c % 3 == 2 and name == f"x{c % 31}")]
        assert got.pop(c) == (("missing", "found", "ambiguous")[min(len(hits), 2)], hits[0] if len(hits) == 1 else None)
    assert not got
    ports = {r.s_suppkey: (r.status, r.port) for r in relational.requested_port(spark, trade).collect()}
    for s in range(SUPPLIERS):
        hits = [p for p in range(SUPPLIERS) if f"port{s}" in f"port{p}main"]
        assert ports.pop(s) == (("missing", "found", "ambiguous")[min(len(hits), 2)], f"Port-{hits[0]} (Main)" if len(hits) == 1 else None)
    assert not ports


def test_later_suppliers_count(spark, trade):
    assert {(r.k, r.side) for r in relational.set_differences(spark, trade).collect()} == {(k, "both") for k in range(25)}


def test_wide_matrix_has_every_port(spark, trade):
    got = {r.district_code: r for r in relational.wide_matrix(spark, trade).collect()}
    for n in range(25):
        assert [got[n][f"hours_to_p{p}"] for p in range(t.PORTS)] == [None if (n + p) % 11 == 0 else (n * 53 + p * 17) % 300 / 10 for p in range(t.PORTS)]


def test_coded_access_of_all_suppliers(spark, trade):
    rows = [(s % 100 if s % 10 else None, f"v{s + 100}", round(float(s * 37 % 101), 1)) for s in range(SUPPLIERS)]
    got = builders.village_access(spark, trade).collect()
    for r in got:
        c = r.c_custkey
        coded = [km for code, _, km in rows if c % 4 and code == c % 100]
        named = [km for _, name, km in rows if name == f"v{c % 150}"]
        assert r.km == (min(coded) if coded else named[0] if named else None)
    assert len(got) == CUSTOMERS
