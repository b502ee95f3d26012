"""Edge lists ``(src, dst)``: clean-up, paths of length two and triangles.

Paths of length two outnumber the edges by far once a few vertices have many neighbours. Triangles are therefore found
without shuffling paths. Edges point from the end with fewer neighbours to the end with more, which leaves at most
sqrt(2 * edges) outgoing ones at any vertex. A triangle is found from its corner with the fewest neighbours:

* with up to ``LISTED`` neighbours, that corner sends each neighbour ahead the list of those further ahead, which is
  intersected there with that neighbour's own list. What is sent grows with the edges.
* otherwise all three corners have more, and few vertices do. These have colours, given by a hash, and an edge between
  two of them is sent once for each colour that the third can have. The edges among three colours meet in one task, which
  keeps them as sorted arrays and looks triangles up in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.operators.skew import SLICE_ROWS, balanced_join, hot_keys

# A vertex with more neighbours sends no lists. Edges of such vertices alone go by colours, where each is sent about
# sqrt(9 * edges / EDGES_PER_TASK) times.
LISTED = 1_000
# Edges among three colours, about, that a task looks at, at some 100 bytes each; the number of colours follows from it.
EDGES_PER_TASK = 1_000_000
# One in so many of EDGES_PER_TASK is where the edges of one vertex are cut for the joins.
EDGES_PER_SLICE = 100
# Words of 64 bits in a Bloom filter of the neighbours of a vertex. Vertices with hundreds of neighbours fill it and drop
# no path.
FILTER_WORDS = 4
# Pairs of neighbours that a task looks up at a time.
PAIRS = 2_000_000


def drop_self_edges(edges: DataFrame) -> DataFrame:
    """Edges between two different vertices."""
    return edges.where(F.col("src") != F.col("dst"))


def redundant_edges(edges: DataFrame) -> DataFrame:
    """Every edge once in each direction, without repetition."""
    # one row for both directions until they are distinct; a missing end comes first
    ends = [F.struct(F.col(end).alias("v")) for end in ("src", "dst")]
    pair = F.when(ends[0] <= ends[1], F.struct("src", "dst")).otherwise(_edge("dst", "src"))
    once = edges.select(pair.alias("edge")).select("edge.src", "edge.dst").distinct()
    is_loop = F.col("src").eqNullSafe(F.col("dst"))
    both = F.when(is_loop, F.array(F.struct("src", "dst"))).otherwise(F.array(F.struct("src", "dst"), _edge("dst", "src")))
    return once.select(F.explode(both).alias("edge")).select("edge.src", "edge.dst")


def _edge(src: str, dst: str) -> Column:
    return F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Every undirected edge once, smaller vertex first, self-edges left out."""
    return (
        drop_self_edges(edges)
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .transform(_present, "src", "dst")
        .distinct()
    )


def two_hop_paths(
    edges: DataFrame, include_degenerate: bool = True, slice_rows: int = SLICE_ROWS, closing: DataFrame | None = None
) -> DataFrame:
    """All paths of two edges as ``(mid, src, dst)``; degenerate ones return to where they start.

    The result holds, for every vertex, each incoming with each outgoing edge; a vertex with more than ``slice_rows`` of
    either is cut into slices. Edges with a missing end are left out. Where only the number of paths matters use
    :func:`two_hop_counts`, and for triangles :func:`triangles`, which list no paths.

    For paths that :func:`close_paths` takes next, name its edges as ``closing``: paths are then left out where a Bloom
    filter of the vertices that ``src`` points to in ``closing`` lacks ``dst``, which no edge of it can close.
    """
    edges = _present(edges, "src", "dst")
    incoming = edges.select(F.col("dst").alias("mid"), "src")
    outgoing = edges.select(F.col("src").alias("mid"), "dst")
    if closing is not None:
        filters = _present(closing, "src", "dst").groupBy("src").agg(*_filter_words("dst"))
        incoming = balanced_join(incoming, filters, ["src"], ["mid"], slice_rows=slice_rows)
    paths = balanced_join(incoming, outgoing, ["mid"], ["src"], lookup_spread=["dst"], slice_rows=slice_rows)
    if closing is not None:
        paths = paths.where(_in_filter("dst")).select("mid", "src", "dst")
    return paths if include_degenerate else paths.where(F.col("src") != F.col("dst"))


def _filter_place(column: str) -> tuple[Column, Column]:
    """Which word of a filter, and which bit of it, stands for a value."""
    place = F.pmod(F.xxhash64(column), F.lit(64 * FILTER_WORDS))
    return F.floor(place / 64).cast("int"), (place % 64).cast("int")


def _filter_words(column: str) -> list[Column]:
    word, bit = _filter_place(column)
    own = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return [F.coalesce(F.bit_or(F.when(word == i, own)), F.lit(0).cast("bigint")).alias(f"_word_{i}") for i in range(FILTER_WORDS)]


def _in_filter(column: str) -> Column:
    word, bit = _filter_place(column)
    own = F.col("_word_0")
    for i in range(1, FILTER_WORDS):
        own = F.when(word == i, F.col(f"_word_{i}")).otherwise(own)
    return F.call_function("shiftright", own, bit).bitwiseAND(F.lit(1).cast("bigint")) == 1


def two_hop_counts(edges: DataFrame, include_degenerate: bool = True) -> DataFrame:
    """``(mid, paths)``: the number of paths of two edges through each vertex that has any.

    It is incoming times outgoing edges, so the work grows with the edges and not with the paths. Edges with a missing
    end are left out.
    """
    edges = _present(edges, "src", "dst")
    forward = (F.col("src") <= F.col("dst")).cast("bigint")
    pairs = edges.groupBy(F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high")).agg(
        F.sum(forward).alias("up"), F.sum(1 - forward).alias("down")
    )
    is_loop = F.col("low") == F.col("high")

    def end(vertex: str, arriving: Column, leaving: Column) -> Column:
        return F.struct(F.col(vertex).alias("mid"), arriving.alias("arriving"), leaving.alias("leaving"))

    ends = F.when(is_loop, F.array(end("low", F.col("up"), F.col("up")))).otherwise(
        F.array(end("low", F.col("down"), F.col("up")), end("high", F.col("up"), F.col("down")))
    )
    at_vertex = pairs.select(F.explode(ends).alias("end")).select("end.*")
    returning = F.col("arriving") * F.col("leaving")
    counted = at_vertex.groupBy("mid").agg(
        F.sum("arriving").cast("decimal(19,0)").alias("arriving"),
        F.sum("leaving").cast("decimal(19,0)").alias("leaving"),
        F.sum(returning).cast("decimal(19,0)").alias("returning"),
    )
    paths = F.col("arriving") * F.col("leaving")
    if not include_degenerate:
        paths = paths - F.col("returning")
    return counted.select("mid", paths.cast("decimal(38,0)").alias("paths")).where(F.col("paths") > 0)


def close_paths(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """``(src, dst, mid)``: the paths of two edges whose ends are joined by an edge."""
    return edges.select("src", "dst").join(paths, ["src", "dst"], "inner").select("src", "dst", "mid")


def oriented_edges(edges: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Undirected edges pointing to the end with more neighbours: ``src, src_degree, dst, dst_degree``."""
    once = canonical_edges(edges)
    degrees = _degrees(once)
    hot = hot_keys(degrees, ["vertex"], "degree", slice_rows)

    def with_degree(df: DataFrame, end: str, other_end: str) -> DataFrame:
        known = degrees.select(F.col("vertex").alias(end), F.col("degree").alias(f"{end}_degree"))
        return balanced_join(df, known, [end], [other_end], hot.withColumnRenamed("vertex", end))

    ranked = with_degree(with_degree(once, "src", "dst"), "dst", "src")
    in_order = F.struct("src_degree", "src") < F.struct("dst_degree", "dst")
    return ranked.select(
        F.when(in_order, F.col("src")).otherwise(F.col("dst")).alias("src"),
        F.least("src_degree", "dst_degree").alias("src_degree"),
        F.when(in_order, F.col("dst")).otherwise(F.col("src")).alias("dst"),
        F.greatest("src_degree", "dst_degree").alias("dst_degree"),
    )


def neighbours_ahead(edges: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``vertex, degree, ahead``: the vertices that a vertex points to in :func:`oriented_edges`, fewest neighbours first."""
    in_order = F.sort_array(F.collect_list(F.struct("dst_degree", "dst")))
    lists = oriented_edges(edges, slice_rows).transform(_present, "src").groupBy(F.col("src").alias("vertex"))
    return lists.agg(F.max("src_degree").alias("degree"), in_order.getField("dst").alias("ahead"))


def triangles(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK, listed: int = LISTED) -> DataFrame:
    """Every triangle of the undirected graph once, as ``(a, b, c)``."""
    crowded, sent = _parts(edges, edges_per_task, listed)
    kind = edges.select(F.least("src", "dst").alias("v")).schema["v"].dataType.simpleString()

    def list_triangles(found: pd.DataFrame) -> pd.DataFrame:
        vertices, parts = _triangles_of(found)
        corners = np.concatenate([np.stack(p) for p in parts], axis=1) if parts else np.zeros((3, 0), dtype=np.int64)
        return pd.DataFrame(dict(zip("abc", (vertices[c] for c in corners))))

    by_colours = crowded.groupBy("x", "y", "z").applyInPandas(list_triangles, f"a {kind}, b {kind}, c {kind}")
    return by_colours.union(sent.select("a", "b", F.explode(_shared()).alias("c")))


def count_triangles(
    edges: DataFrame, name: str = "triangles", edges_per_task: int = EDGES_PER_TASK, listed: int = LISTED
) -> DataFrame:
    """Number of triangles of the undirected graph, as a frame of one row."""
    crowded, sent = _parts(edges, edges_per_task, listed)

    def count(found: pd.DataFrame) -> pd.DataFrame:
        _, parts = _triangles_of(found)
        return pd.DataFrame({"n": [sum(len(first) for first, _, _ in parts)]})

    by_colours = crowded.groupBy("x", "y", "z").applyInPandas(count, "n bigint")
    counts = by_colours.union(sent.select(F.size(_shared()).cast("bigint").alias("n")))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias(name))


def _parts(edges: DataFrame, edges_per_task: int, listed: int) -> tuple[DataFrame, DataFrame]:
    """The edges among vertices with more than ``listed`` neighbours by colours, and ``a, b, further, ahead`` for the others.

    ``a`` has up to ``listed`` neighbours, ``b`` is one ahead of it, ``further`` are those ahead of ``a`` after ``b``.
    """
    slice_rows = max(1, edges_per_task // EDGES_PER_SLICE)
    # all uses ask for the degree, so that the lists are shuffled once
    lists = neighbours_ahead(edges, slice_rows).where("degree > 0")
    crowded = lists.where(F.col("degree") > listed).select(F.col("vertex").alias("src"), F.explode("ahead").alias("dst"))
    each = lists.where(F.col("degree") <= listed).select("vertex", "ahead", F.posexplode("ahead").alias("at", "b"))
    left = F.size("ahead") - F.col("at") - 1
    sent = each.where(left > 0).select(F.col("vertex").alias("a"), "b", F.slice("ahead", F.col("at") + 2, left).alias("further"))
    hot = hot_keys(_degrees(canonical_edges(edges)), ["vertex"], "degree", slice_rows)
    own = lists.select(F.col("vertex").alias("b"), "ahead")
    return _edges_by_colours(crowded, edges_per_task), balanced_join(sent, own, ["b"], ["a"], hot.withColumnRenamed("vertex", "b"))


def _shared() -> Column:
    return F.array_intersect("further", "ahead")


def closed_paths(edges: DataFrame) -> DataFrame:
    """``(src, dst, mid)``: the closed paths of the redundant edge list, six for every triangle.

    The same rows as ``close_paths(e, two_hop_paths(e))`` with ``e`` the redundant edges, without the open paths.
    """

    def path(src: str, dst: str, mid: str) -> Column:
        return F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(mid).alias("mid"))

    orders = [("a", "b", "c"), ("a", "c", "b"), ("b", "a", "c"), ("b", "c", "a"), ("c", "a", "b"), ("c", "b", "a")]
    walks = F.array(*[path(*order) for order in orders])
    return triangles(edges).select(F.explode(walks).alias("path")).select("path.*")


def _present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without missing values.

    The joins further on imply this filter, but not for every use of the frame. Stating it gives all uses the
    same plan, so that Spark shuffles the frame once.
    """
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def _degrees(once: DataFrame) -> DataFrame:
    """``vertex, degree``: the number of neighbours in a canonical edge list."""
    ends = once.select(F.explode(F.array("src", "dst")).alias("vertex")).transform(_present, "vertex")
    return ends.groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"))


def colour_count(once: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> Column:
    """How many colours the vertices of a canonical edge list need, as a scalar subquery.

    With k colours, three of them have about 9 / k^2 of all edges between them, and up to 2 / k of those of one vertex.
    """
    degrees = _degrees(once)
    edges = F.coalesce(F.sum("degree"), F.lit(0)) / 2
    by_edges = F.ceil(F.sqrt(9 * edges / edges_per_task))
    by_vertex = F.ceil(2 * F.coalesce(F.max("degree"), F.lit(0)) / edges_per_task)
    return degrees.agg(F.greatest(by_edges, by_vertex, F.lit(1)).cast("bigint").alias("colours")).scalar()


def _edges_by_colours(edges: DataFrame, edges_per_task: int) -> DataFrame:
    """``x, y, z, src, dst, of_src, of_dst``: each edge for every three colours ``x <= y <= z`` that include its own two."""
    once = canonical_edges(edges)
    colours = colour_count(once, edges_per_task)
    every = F.sequence(F.lit(0).cast("bigint"), F.col("colours") - 1)
    own = [F.pmod(F.xxhash64(end), F.col("colours")).alias(f"of_{end}") for end in ("src", "dst")]
    sent = once.withColumn("colours", colours).select("src", "dst", *own, F.explode(every).alias("third"))
    of_three = [F.col("of_src"), F.col("of_dst"), F.col("third")]
    low, high = F.least(*of_three), F.greatest(*of_three)
    middle = of_three[0] + of_three[1] + of_three[2] - low - high
    return sent.select(low.alias("x"), middle.alias("y"), high.alias("z"), "src", "dst", "of_src", "of_dst")


def _triangles_of(found: pd.DataFrame) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Vertices, and the triangles among them that have the three colours of this group, in parts.

    Vertices are numbered by their neighbours here, so an edge points to the larger number, and the pairs of larger
    neighbours of a vertex are looked up among all edges by binary search.
    """
    ends = np.concatenate([found["src"].to_numpy(), found["dst"].to_numpy()])
    colours = np.concatenate([found["of_src"].to_numpy(), found["of_dst"].to_numpy()])
    vertices, first, number = np.unique(ends, return_index=True, return_inverse=True)
    order = np.argsort(np.bincount(number), kind="stable")
    vertices, colours = vertices[order], colours[first[order]]
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    a, b = rank[number].reshape(2, -1)
    n = len(vertices)
    edges = np.sort(np.minimum(a, b) * n + np.maximum(a, b))
    low, high = edges // n, edges % n
    # after an edge come those of its lower end to larger neighbours
    last = np.searchsorted(low, np.arange(n), "right")[low]
    pairs = last - 1 - np.arange(len(edges))
    wanted = [found[c].iloc[0] for c in ("x", "y", "z")]
    parts = []
    for begin, end in _stretches(pairs):
        of_edge = np.repeat(np.arange(begin, end), pairs[begin:end])
        ahead = np.arange(len(of_edge)) - np.repeat(np.cumsum(pairs[begin:end]) - pairs[begin:end], pairs[begin:end])
        u, v, w = low[of_edge], high[of_edge], high[of_edge + 1 + ahead]
        keys = v * n + w
        closed = edges[np.minimum(np.searchsorted(edges, keys), len(edges) - 1)] == keys
        u, v, w = u[closed], v[closed], w[closed]
        right = (np.sort(np.stack([colours[u], colours[v], colours[w]]), axis=0) == np.array(wanted)[:, None]).all(axis=0)
        parts.append((u[right], v[right], w[right]))
    return vertices, parts


def _stretches(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of places with sizes of about ``PAIRS`` in all."""
    sums = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        done = sums[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sums, done + PAIRS, "right")))
        yield begin, end
        begin = end
