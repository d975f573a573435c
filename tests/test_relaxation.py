import pytest

from talweg.operators import graph


@pytest.fixture(scope="module")
def chain(spark):
    """A chain of six edges, and an edge to its end that is slower than the chain."""
    rows = [(i, i + 1, 1.0, 1.0, False) for i in range(6)] + [(0, 6, 1.0, 9.0, False)]
    return spark.createDataFrame(rows, "u long, v long, km double, hours double, is_bridge boolean"), spark.createDataFrame([(0,)], "u long")


def test_unfinished_relaxation_is_an_error(chain):
    with pytest.raises(ValueError, match="after 2 rounds"):
        graph.relaxed_hours(*chain, rounds=2).collect()


def test_relaxation_goes_on_to_the_end(chain):
    expected = {i: float(i) for i in range(7)}
    for found in (graph.relaxed_hours(*chain), graph.relaxed_hours(*chain, rounds=6), graph.all_hours(*chain)):
        assert {r.node: r.hours for r in found.collect()} == expected


def test_negative_hours_are_refused(spark):
    edges = spark.createDataFrame([(0, 1, 1.0, -1.0, False)], "u long, v long, km double, hours double, is_bridge boolean")
    with pytest.raises(ValueError, match="negative"):
        graph.relaxed_hours(edges, spark.createDataFrame([(0,)], "u long"))
