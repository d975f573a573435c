"""Lookup by code, name or likeness against a plain version; notes and lists on odd rows."""

import difflib

from pyspark.sql import functions as F

from talweg.operators import enrich


def test_lookup_chain_equals_plain(spark):
    facts = [("A", "north vale", 1.0, 10, 0), ("a", "north vole", None, 20, 1), ("A", "south", 1.0, 30, 2), ("B", "eastern", 3.0, 40, 3), ("A", "west", 4.0, None, 4), ("A", "north vole", 9.0, 50, 5)]
    rows = [(0, "a", "anything", 1.0), (1, "A", "north val", None), (2, "A", "north vxle", None), (3, "A", "eastern", 7.0), (4, "B", "eastern", 7.0), (5, "A", "west", 4.0), (6, "A", "", None), (7, None, None, None), (8, "A", "north vole", 5.0), (8, "A", "north vole", 5.0)]
    f = spark.createDataFrame(facts, "state string, district string, district_code double, people int, src_order int")
    r = spark.createDataFrame(rows, "k int, state string, district string, district_code double")
    got = sorted((x.k, x.people) for x in enrich.lookup_chain(r, f, "people").collect())
    wanted = []
    for k, state, name, code in rows:
        mine = [x for x in facts if state and x[0].lower() == state.lower()]
        codes, names = {x[2]: x[3] for x in mine if x[2] is not None}, {x[1]: x[3] for x in mine}
        found = codes.get(code)
        if found is None and name is not None:
            found = names.get(name)
            if name not in names and (near := difflib.get_close_matches(name, list(names), n=1, cutoff=0.7)):
                found = names[near[0]]
        wanted.append((k, found))
    assert got == sorted(wanted)


def test_collapsed_points_of_odd_lists(spark):
    rows = [([[1.0, 2.0], [1.0000001, 2.0], [1.0, 3.0], [1.0, 2.0]],), ([],), (None,), ([None, None, [1.0, None]],)]
    df = spark.createDataFrame(rows, "p array<array<double>>")
    got = [x.c for x in df.select(enrich.collapsed(F.col("p")).alias("c")).collect()]
    assert got == [[[1.0, 2.0], [1.0, 3.0], [1.0, 2.0]], [], None, [None, [1.0, None]]]


def test_coverage_faults_of_an_empty_and_a_good_list(spark):
    df = spark.createDataFrame([(1, 0, "major_port", 0, "a"), (1, 1, "major_port", 1, "b"), (1, 2, "mmlp", 0, "a"), (2, 0, "mmlp", 0, "x"), (2, 1, "major_port", 0, "X "), (2, 2, "mmlp", 1, "X")], "d int, i int, hub_type string, hub_order int, hub_name string")
    assert enrich.coverage_faults(df.limit(0), "d", "i").collect() == []
    assert {tuple(r) for r in enrich.coverage_faults(df, "d", "i").collect()} == {(2, 1, "type_order"), (2, 2, "duplicate_name")}
