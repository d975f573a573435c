"""Queries whose cost or ties showed on larger tables only, held against plain versions."""

import math

from oracle import compare
from pyspark.sql import functions as F

from talweg.operators import graph, resolve, spatial, stages
from talweg.plans import relational


def test_pairs_are_decided_where_they_are_formed(spark):
    feeders = lambda mul: [(i, c, i * mul % 7 + 10 * c, float(i * mul % 5)) for i in range(60) for c in range(4) if i * mul % (c + 2) == 0]
    a, b = feeders(3), feeders(5)
    origins, hubs = spark.createDataFrame(a, "origin long, component long, node long, dist_m double"), spark.createDataFrame(b, "hub long, component long, node long, dist_m double")
    expected = {}
    for o, c, u, x in a:
        for h, d, v, y in b:
            if c == d:
                expected[o, h] = min(expected.get((o, h), (99.0,)), (x + y, u, v, c, x, y))
    found = graph.compatible_pairs(origins, hubs)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = [((r.origin, r.hub), (r.origin_m + r.hub_m, r.u, r.v, r.component, r.origin_m, r.hub_m)) for r in found.collect()]
    assert dict(got) == expected and len(got) == len(expected)


def test_of_equal_lines_the_first_of_the_file_stays(spark, tmp_path):
    # the second file is larger, so Spark reads it first
    rows = [(k, 7, 1000 + k) for k in range(500)], [(k % 500, 7, 5000 + k) for k in range(20_000)]
    for i, part in enumerate(rows):
        spark.createDataFrame(part, "l_orderkey long, l_linenumber long, l_partkey long").coalesce(1).write.parquet(f"{tmp_path}/tmp{i}")
        (tmp_path / "lineitem.parquet").mkdir(exist_ok=True)
        next((tmp_path / f"tmp{i}").glob("part-*.parquet")).rename(tmp_path / "lineitem.parquet" / f"part-{i}.parquet")
    got = {r.l_orderkey: r.l_partkey for r in relational.dedupe_last(spark, str(tmp_path)).collect()}
    assert got == {k: 1000 + k for k in range(500)}


def test_lines_without_part_or_number_do_not_count_as_last(spark, tmp_path):
    rows = [(1, None, 3), (1, 5, 2), (1, 6, 1), (2, 7, None), (3, None, None), (4, 8, None), (4, None, 1), (None, 3, 1), (None, 4, 1), (5, 9, 4), (5, 10, 4), (6, None, 7), (6, 11, 7)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    compare(relational.dedupe_last, relational.ORACLE_SQL["dedupe_last"], spark, str(tmp_path))


def test_ports_are_found_without_pairs(spark):
    wanted = ["Port 1", "port", "", None, "1", "Great Port-12 of all", "x", "ports", "aaa"]
    ports = ["Port-1", "port-1 ", "Port 12", "", None, "--", "aaaa", "aa", "Port-1"]
    plain = lambda s: None if s is None else "".join(c for c in s.lower() if c.isalnum())
    expected = {}
    for i, w in enumerate(wanted):
        hits = sorted(p for p in ports if None not in (w, p) and (plain(w) in plain(p) or plain(p) in plain(w)))
        expected[i] = (("missing", "found", "ambiguous")[min(len(hits), 2)], hits[0] if len(hits) == 1 else None)
    found = resolve.match_port(spark.createDataFrame(list(enumerate(wanted)), "id long, w string"), spark.createDataFrame([(p,) for p in ports], "port string"), "id", "w", "port")
    assert {r.id: (r.status, r.port) for r in found.collect()} == expected
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_blocks_give_the_paths_of_the_whole_graph(spark, monkeypatch):
    """A lattice with many equally fast ways, edges that take no time and a part that is not reached, in blocks of twenty nodes."""
    rows = [(k, k + s, 1.0 + k % 3, 0.0 if k % 11 == 5 else 0.25 * (1 + k % 2), k % 5 == 0) for k in range(60) for s in (1, 6) if k * s % 7 != 4]
    edges = spark.createDataFrame([*rows, (500, 501, 1.0, 1.0, False)], "u long, v long, km double, hours double, is_bridge boolean")
    pairs = spark.createDataFrame([(u, v) for u in (0, 17, 900) for v in [*range(66), 500, 900]], "u long, v long")
    whole = {(r.u, r.v): r.hours for r in graph.fastest_paths(edges, pairs).collect()}
    monkeypatch.setattr(graph, "BLOCK_NODES", 20)
    assert {(r.u, r.v): r.hours for r in graph.fastest_paths(edges, pairs, False).collect()} == whole
    assert {(r.u, r.node) for r in graph.reached(edges, pairs.select("u"), 1.5).collect()} == {k for k, h in whole.items() if h is not None and h <= 1.5}


def test_sums_of_blocks_are_those_of_the_shipped_graph(spark, monkeypatch):
    rows = [(k, k + s, 1.0 + k % 3, 0.25 * (1 + k % 2), k % 5 == 0) for k in range(60) for s in (1, 6) if k * s % 7 != 4]
    edges = spark.createDataFrame(rows, "u long, v long, km double, hours double, is_bridge boolean")
    pairs = spark.createDataFrame([(u, v) for u in (0, 17, 60) for v in range(66)], "u long, v long")
    whole = {tuple(r)[:8] for r in graph.fastest_paths(edges, pairs).collect()}
    monkeypatch.setattr(graph, "BLOCK_NODES", 20)
    assert {tuple(r)[:8] for r in graph.fastest_paths(edges, pairs, False).collect()} == whole


def test_copies_are_searched_once_and_places_are_not_lost(spark, monkeypatch):
    left = [(i, float(i % 4), float(i % 3)) for i in range(600)] + [(600, None, 1.0), (601, float("nan"), 1.0), (602, 900.0, 900.0)]
    right = [(i, ("a", "b", None)[i % 3], float(i % 5), float(i % 7) / 2) for i in range(700)]
    met = []
    around = spatial._around
    monkeypatch.setattr(spatial, "_around", lambda df, *a: met.append(df.count()) or around(df, *a))
    a, b = spark.createDataFrame(left, "id long, x double, y double"), spark.createDataFrame(right, "key long, kind string, x double, y double")
    found = spatial.nearest(a, b, "id", "key", 50.0, k=2, by="kind").collect()
    assert met[0] == 13 * 3
    expected = set()
    for i, x, y in left:
        for kind in ("a", "b", None):
            best = sorted((math.hypot(x - rx, y - ry), key) for key, k, rx, ry in right if k == kind)[:2] if x is not None and x == x else [(None, None)]
            expected |= {(i, kind, n + 1 if key is not None else None, key, d) for n, (d, key) in enumerate(best)}
    assert {(r.id, r.r_kind, r["rank"], r.r_key, r.dist_m) for r in found} == expected and len(found) == len(expected)


def _places(n):
    return [(i, float(i * 37 % 23) * 9, float(i * 11 % 7) * 13) for i in range(n)]


def test_clusters_link_cells_not_copies(spark):
    rows = [*_places(150), (150, 900.0, 900.0), (151, 906.0, 908.0), (152, None, 1.0), (153, float("nan"), 1.0), (154, 900.0, 911.0)]
    label = {i: i for i, _, _ in rows}
    for _ in rows:
        for i, x, y in rows:
            label[i] = min([label[i], *(label[j] for j, a, b in rows if None not in (x, a) and math.hypot(x - a, y - b) <= 10.0)])
    assert label[154] == 150 and len(set(label.values())) > 5
    got = graph.clusters(spark.createDataFrame(rows, "id long, x double, y double"), "id", 10.0).collect()
    assert {r.node: r.component for r in got} == label and len(got) == len(rows)


def _reach(nodes, links):
    label = {n: n for n in nodes}
    while True:
        before = dict(label)
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
        if label == before:
            return label


def test_long_ways_are_contracted_in_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK_LINKS", 300, raising=False)
    calls, cut = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: calls.append(1) or cut(df))
    links = [(k, k + 1) for k in range(1500) if k % 500 != 499]
    nodes, edges = spark.createDataFrame([(k,) for k in range(1502)], "node long"), spark.createDataFrame(links, "u long, v long")
    got = graph.components(nodes, edges).collect()
    assert {r.node: r.component for r in got} == {k: k // 500 * 500 if k < 1500 else k for k in range(1502)} and len(got) == 1502
    assert len(calls) <= 8


def test_blocks_of_any_links_give_the_components(spark, monkeypatch):
    """Far numbers, so that blocks take little away; repeated links, loops, nulls and names; each block holds a few links."""
    monkeypatch.setattr(graph, "BLOCK_LINKS", 25, raising=False)
    links = [(k * 37 % 211, k * k * 53 % 197) for k in range(150)]
    expected = _reach(range(211), links)
    assert 5 < len(set(expected.values())) < 150
    name = lambda k: f"é{k:03}"
    for kind, f in (("long", int), ("string", name)):
        nodes = spark.createDataFrame([(f(k),) for k in range(211)], f"node {kind}")
        edges = spark.createDataFrame([*[(f(u), f(v)) for u, v in links for _ in range(2)], (f(3), None)], f"u {kind}, v {kind}")
        got = graph.components(nodes, edges).collect()
        assert {r.node: r.component for r in got} == {f(k): f(c) for k, c in expected.items()} and len(got) == 211


def test_faults_of_a_bad_graph(spark):
    nodes = spark.createDataFrame([(0, 0.0, 0.0), (1, 1000.0, 0.0), (2, 1000.0, 500.0)], "node long, x double, y double")
    edges = spark.createDataFrame([(0, 1, 1.0, 0.1, False), (1, 1, 0.0, 0.1, False), (1, 2, 0.5, -1.0, True), (0, 2, 3.0, 0.1, False), (2, 9, 1.0, 0.1, False)], "u long, v long, km double, hours double, is_bridge boolean")
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (9, 2)], "node long, component long")
    got = {r.fault: r.n for r in graph.graph_faults(nodes, edges, labels).collect()}
    assert got == {"self_loop": 1, "bad_weight": 2, "wrong_km": 1, "long_bridge": 1, "split_component": 2, "unknown_node": 1}


def test_full_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(spatial, "TASK_PAIRS", 500, raising=False)
    monkeypatch.setattr(spatial, "CELL_PAIRS", 50, raising=False)
    rows = [*_places(120), (120, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    found = spatial.radius_join(df, df, 30.0)
    assert found.select("id").rdd.getNumPartitions() > 4
    got = [(r.id, r.r_id) for r in found.collect()]
    assert set(got) == {(i, j) for i, x, y in rows for j, a, b in rows if None not in (x, a) and math.hypot(x - a, y - b) <= 30.0} and len(got) == len(set(got))


def test_segments_are_compared_with_places(spark):
    points = [(i, float(i % 5), float(i % 3)) for i in range(90)] + [(90, None, 1.0), (91, 500.0, 2.0)]
    lines = [(i, float(i % 4) * 3, i * 2.0 - 8, float(i % 4) * 3 + 2, i * 2.0 - 8) for i in range(12)]
    found = spatial.nearest_segment(spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(lines, "line long, ax double, ay double, bx double, by double"), "id", "line", 4.0)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    expected = {}
    for i, x, y in points:
        near = [(math.hypot(max(ax - x, 0, x - bx), ay - y), n) for n, ax, ay, bx, _ in lines] if x is not None else []
        if near and min(near)[0] <= 4.0:
            expected[i] = min(near)
    assert {r.id: (r.dist_m, r.s_line) for r in found.collect()} == expected


def test_estimates_do_not_grow_over_rounds(spark):
    rows = spark.createDataFrame([(k, "a" if k % 2 else None, [k]) for k in range(9)], "k long, s string, a array<long>")
    df = stages.cut(rows)
    for _ in range(12):
        df = stages.cut(df.join(df.select("k", F.col("s").alias("t")), "k").select("k", "s", "a"))
        assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**64
    assert df.dtypes == rows.dtypes and sorted(df.collect()) == sorted(rows.collect())
