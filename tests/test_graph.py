import itertools
import random
from collections import Counter

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.operators import graph
from sheaf.plans import tables as t

QUIET = dict(deadline=None, max_examples=4, suppress_health_check=list(HealthCheck))
DDL = "src string, dst string"


def plain_paths(edges):
    return [(b, a, d) for a, b in edges for c, d in edges if b == c]


def made_up_edges(seed, vertices=9, n=30):
    rng = random.Random(seed)
    return [(f"v{rng.randrange(vertices)}", f"v{rng.randrange(vertices)}") for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_a_graph_step_by_step(frame, partitions):
    data = made_up_edges(partitions)
    df = frame(data, DDL, partitions)
    proper = [(a, b) for a, b in data if a != b]
    assert rows(graph.drop_self_edges(df)) == sorted(proper)
    both = sorted({e for a, b in proper for e in ((a, b), (b, a))})
    redundant = graph.redundant_edges(graph.drop_self_edges(df))
    assert rows(redundant) == both
    assert rows(graph.canonical_edges(df)) == [e for e in both if e[0] < e[1]]
    paths = plain_paths(both)
    found = graph.two_hop_paths(redundant)
    assert rows(found) == sorted(paths)
    assert rows(graph.two_hop_paths(redundant, include_degenerate=False)) == sorted(p for p in paths if p[1] != p[2])
    closed = sorted((a, b, mid) for mid, a, b in paths if (a, b) in both)
    assert rows(graph.close_paths(redundant, found)) == closed == rows(graph.closed_paths(df))
    corners = {frozenset(c) for c in closed}
    assert rows(graph.count_triangles(df)) == [(len(corners),)] and len(closed) == 6 * len(corners)
    assert {frozenset(t) for t in rows(graph.triangles(df))} == corners


def test_closing_given_paths(frame):
    paths = frame([("m", "v1", "v2"), ("n", "v2", "v1"), ("m", "v1", "v2"), ("m", "v3", "v4")], "mid string, src string, dst string")
    closed = graph.close_paths(frame([("v1", "v2"), ("v4", "v3")], DDL), paths)
    assert rows(closed) == [("v1", "v2", "m"), ("v1", "v2", "m")]


def test_no_edges(frame):
    empty = frame([], DDL)
    assert rows(graph.count_triangles(empty)) == [(0,)] and rows(graph.closed_paths(empty)) == []
    assert rows(graph.two_hop_counts(empty)) == []


pairs = st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=40)


@settings(**QUIET)
@given(pairs)
def test_counts_on_any_graph(frame, data):
    df = frame(data, "src int, dst int")
    present = {frozenset(p) for p in data if p[0] != p[1]}
    expected = {
        frozenset(t) for t in itertools.combinations(range(8), 3)
        if all(frozenset(p) in present for p in itertools.combinations(t, 2))
    }
    found = rows(graph.triangles(df))
    assert len(found) == len(expected) and {frozenset(t) for t in found} == expected
    assert rows(graph.count_triangles(df)) == [(len(expected),)]
    for degenerate in (True, False):
        listed = graph.two_hop_paths(df, degenerate).groupBy("mid").count()
        counted = graph.two_hop_counts(df, degenerate).select("mid", F.col("paths").cast("bigint"))
        assert rows(counted) == rows(listed)


ends = st.one_of(st.none(), st.integers(0, 5))


@settings(**QUIET)
@given(st.lists(st.tuples(ends, ends), min_size=1, max_size=30))
def test_paths_leave_out_edges_with_missing_ends(frame, data):
    df = frame(data, "src int, dst int")
    whole = [(a, b) for a, b in data if a is not None and b is not None]
    for degenerate in (True, False):
        paths = [p for p in plain_paths(whole) if degenerate or p[1] != p[2]]
        assert rows(graph.two_hop_paths(df, degenerate)) == sorted(paths, key=lambda p: tuple(map(str, p)))
        counted = graph.two_hop_counts(df, degenerate).select("mid", F.col("paths").cast("bigint"))
        assert dict(rows(counted)) == dict(Counter(p[0] for p in paths))


def wheel(spark, spokes=200):
    """A hub joined to all, each of the others joined to the next one."""
    hub = spark.range(1, spokes).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"))
    ring = spark.range(1, spokes).select(F.col("id").alias("src"), ((F.col("id") % (spokes - 1)) + 1).alias("dst"))
    return hub.union(ring)


def clique(spark, n=60):
    numbers = spark.range(n).select(F.col("id").alias("src"))
    return numbers.join(numbers.select(F.col("src").alias("dst")), F.col("src") < F.col("dst"))


@pytest.mark.parametrize("sizes", [{}, dict(edges_per_task=500), dict(edges_per_task=300)])
def test_slices_and_parts_do_not_change_triangles(spark, sizes):
    assert rows(graph.count_triangles(wheel(spark), **sizes)) == [(199,)]
    # cliques of different size that share vertices, some of the same colours
    edges = clique(spark).union(clique(spark, 90).select(F.col("src") + 50, F.col("dst") + 50)).union(wheel(spark, 80))
    expected = rows(graph.count_triangles(edges))
    assert rows(graph.count_triangles(edges, **sizes)) == expected
    assert expected[0][0] >= 60 * 59 * 58 / 6 + 90 * 89 * 88 / 6 - 10 * 9 * 8 / 6


def test_no_task_gets_many_edges(spark):
    edges = clique(spark, 120).union(wheel(spark, 3000).select(F.col("src") + 1000, F.col("dst") + 1000))
    total = graph.canonical_edges(edges).count()
    for per_task in (2000, 4000):
        sent = graph._edges_by_colours(edges, per_task)
        sizes = [r["count"] for r in sent.groupBy("x", "y", "z").count().collect()]
        colours = sent.agg(F.max("z")).first()[0] + 1
        assert max(sizes) <= 2 * per_task and sum(sizes) == colours * total
    ((most,),) = rows(graph.canonical_edges(wheel(spark, 3000)).select(graph.colour_count(wheel(spark, 3000), 100)).distinct())
    assert most >= 2 * 2999 / 100


def test_pairs_are_looked_up_in_stretches(spark, monkeypatch):
    found = graph._edges_by_colours(clique(spark, 40), 10**6).toPandas()
    monkeypatch.setattr(graph, "PAIRS", 50)
    _, parts = graph._triangles_of(found)
    assert len(parts) > 100 and sum(len(p[0]) for p in parts) == 40 * 39 * 38 / 6


def test_edges_are_scanned_once_with_hot_keys(spark):
    edges = t.part_supplier_edges(spark, "/root/testdata/sf0.001")
    frame = graph.count_triangles(edges, edges_per_task=100)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the subquery that counts the edges comes first and takes them from the shuffle of the other use
    assert "ReusedExchange" in final and "FileScan parquet" not in final


def test_orientation_bounds_outgoing_edges(spark):
    """A star with a third of all edges, next to a dense part: nothing points out of the star's centre."""
    star = spark.range(1, 301).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"))
    dense = spark.range(900).select((F.col("id") % 30 + 1000).alias("src"), (F.floor(F.col("id") / 30) + 1000).alias("dst"))
    edges = star.union(dense)
    total = graph.canonical_edges(edges).count()
    outgoing = graph.oriented_edges(edges).groupBy("src").count()
    assert outgoing.agg(F.max("count")).first()[0] <= (2 * total) ** 0.5
    assert outgoing.where("src = 0").count() == 0


def cliques(spark, copies):
    """Cliques of 12 vertices around a hub each, side by side."""
    ring = clique(spark, 12).union(wheel(spark, 60).select(F.col("src") + 11, F.col("dst") + 11))
    at = spark.range(copies).select((F.col("id") * 1000).alias("at"))
    return ring.crossJoin(at).select((F.col("src") + F.col("at")).alias("src"), (F.col("dst") + F.col("at")).alias("dst"))


@pytest.mark.parametrize("listed", [0, 4, 20, 10**6])
def test_lists_and_colours_share_the_triangles(spark, listed):
    edges = cliques(spark, 2)
    expected = 2 * (12 * 11 * 10 // 6 + 59)
    assert rows(graph.count_triangles(edges, edges_per_task=100, listed=listed)) == [(expected,)]
    found = [frozenset(t) for t in rows(graph.triangles(edges, 100, listed))]
    assert len(found) == len(set(found)) == expected


def test_what_triangles_send_grows_with_the_edges(spark):
    """Eight times the graph sends eight times the rows; by colours alone it was some 23 times."""

    def sent(copies):
        crowded, lists = graph._parts(cliques(spark, copies), 100, graph.LISTED)
        return crowded.count() + lists.count()

    assert sent(8) == 8 * sent(1)


def test_paths_that_no_edge_closes_are_left_out_early(frame):
    data = [(a, b) for a, b in made_up_edges(5, vertices=60, n=300) if a < b] + [("v1", None), (None, "v2")]
    edges = frame(data, DDL).distinct()
    every, fewer = graph.two_hop_paths(edges), graph.two_hop_paths(edges, closing=edges)
    assert fewer.columns == every.columns and fewer.count() < every.count() / 2
    closed = rows(graph.close_paths(edges, every))
    assert closed and rows(graph.close_paths(edges, fewer)) == closed
    assert rows(graph.close_paths(edges, graph.two_hop_paths(edges, False, 2, edges))) == closed


def test_redundant_edges_meet_once_for_both_directions(frame):
    data = [("a", "b"), ("b", "a"), ("a", "b"), ("c", "c"), ("c", "c"), ("d", None), (None, "d"), (None, "a"), (None, None), (None, None)]
    result = graph.redundant_edges(frame(data, DDL))
    expected = {e for a, b in data for e in ((a, b), (b, a))}
    assert rows(result) == sorted(expected, key=lambda e: tuple(map(str, e)))
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    # directions are told apart after the rows are distinct, not before
    assert plan.index("Generate") < plan.index("Aggregate")
