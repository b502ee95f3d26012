"""Near-duplicate embeddings by lattice hashing.

A vector of length one is projected to eight dimensions by random directions, several times over; each projection is
decoded to the nearest point of the E8 lattice, the cell, and to its nearest neighbouring cells. A key of a table combines
the cells of two or three independent projections, neighbours in all combinations; how many follows from the number of
vectors, since unrelated ones meet by chance in a share of all pairs. Vectors that share a key of some table are compared
by cosine in double precision.

Members of a key are tied to the smallest one; the vectors tied to one centre form a group, so any two that share a
key are together in a group. Groups are compared in blocks. A pair that meets in several groups counts in the one with
the smallest centre. Blocks give numbers of links and a forest, no list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm import linkage
from sheaf.llm.common import settle

# Cells that a key combines up to so many vectors, and the tables for that; beyond the last, the longest key stays. As
# measured, two vectors with a cosine of 0.98 share a key of two cells in one table with probability 0.74 (0.86 a cell), and
# none of 8 tables in 2 of 100,000 cases; unrelated ones share one with probability 8e-8 a table.
KEYS = ((10_000_000, 2, 8), (1 << 62, 3, 11))
# Neighbouring cells that a vector is entered in besides its own, for each projection.
PROBES = 2
SCALE = 1.0
# Vectors of a group that are compared at once.
BLOCK = 1000


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of 1 or -1, or all of 1/2 or -1/2 with an even number of minuses."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = a, b
            found.append(v)
    found += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(found)


def _even_sum(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    off = x - near
    rows = np.flatnonzero(near.sum(axis=1).astype(np.int64) % 2)
    worst = np.abs(off[rows]).argmax(axis=1)
    near[rows, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: the nearer one of the even-sum points and those moved by 1/2."""
    a, b = _even_sum(x), _even_sum(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def key_shape(n_vectors: int) -> tuple[int, int]:
    """How many cells a key combines and how many tables there are, for so many vectors."""
    return next((points, tables) for most, points, tables in KEYS if n_vectors <= most)


def cells(units: np.ndarray, points: int, tables: int, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Keys of unit vectors, one row each: in every table, the cells of ``points`` projections in all combinations."""
    short = shortest_vectors()
    keys = []
    for table in range(tables):
        key = np.full((len(units), 1), table + 1, dtype=np.uint64)
        for point in range(points):
            directions = np.random.default_rng([table, point, units.shape[1]]).normal(size=(units.shape[1], 8)) * scale
            y = units @ directions
            own = nearest_point(y)
            # |y - (own + v)|^2 is smallest where v points along y - own
            along = (y - own) @ short.T
            near = np.argpartition(along, len(short) - probes, axis=1)[:, len(short) - probes :]
            found = np.concatenate([own[:, None, :], own[:, None, :] + short[near]], axis=1)
            doubled = np.rint(2 * found).astype(np.int64).astype(np.uint64)
            key = np.repeat(key, 1 + probes, axis=1)
            doubled = np.tile(doubled, (1, key.shape[1] // (1 + probes), 1))
            for i in range(8):
                key = (key ^ doubled[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
        keys.append(key)
    return np.concatenate(keys, axis=1)


def _classes(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``vec_id, node, unit``: unit vectors, and a hash of label and vector; NULL for vectors that link with nothing."""

    def units(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for vector, label in batches:
            rows = []
            for v, name in zip(vector, label):
                if v is None or name is None:
                    rows.append((None, None))
                    continue
                x = np.array([np.nan if c is None else c for c in v] if isinstance(v, list) or getattr(v, "dtype", None) == object else v, dtype=np.float64)
                largest = np.abs(x).max(initial=0.0)
                if not len(x) or not np.isfinite(x).all() or largest == 0:
                    rows.append((None, None))
                    continue
                x = x / largest  # no square leaves the range
                unit = x / np.sqrt((x * x).sum())
                node = xxhash.xxh3_64_intdigest(name.encode() + b"\0" + np.asarray(v, dtype=np.float64).tobytes())
                rows.append((node - (1 << 64) if node >> 63 else node, unit.astype("<f8").tobytes()))
            frame = pd.DataFrame(rows, columns=["node", "unit"])
            frame["node"] = pd.array([r[0] for r in rows], dtype="Int64")
            yield frame

    made = F.pandas_udf(units, "node bigint, unit binary")
    return vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        made(F.col(vector_column).cast("array<double>"), F.col(label_column).cast("string")).alias("m"),
    ).select("vec_id", "label", "m.node", "m.unit")


def _centres(classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of vectors that share a key, each with the key's smallest vector."""
    n_vectors = classes.count()
    points, tables = key_shape(n_vectors)
    n_keys = tables * (1 + PROBES) ** points

    def keys(batch: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(batch), n_keys), dtype=np.uint64)
        # vectors of different dimensions never meet
        for size, at in batch.groupby(batch["unit"].str.len()).indices.items():
            units = np.frombuffer(b"".join(batch["unit"].iloc[at]), dtype="<f8").reshape(len(at), -1)
            label = [xxhash.xxh3_64_intdigest(f"{size} {x}") for x in batch["label"].iloc[at]]
            out[at] = cells(units, points, tables) ^ np.array(label, dtype=np.uint64)[:, None]
        return out.view(np.int64)

    rows = classes.select(F.col("node").alias("id"), F.lit(0).cast("bigint").alias("tag"), "unit", "label")
    return linkage.stars(rows, n_vectors, keys, n_keys).select("a", "b")


def _compared(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Blocks of sorted rows, one after the other; only the rows of a block that goes on are held between batches."""
    held: pd.DataFrame | None = None
    for batch in batches:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        block = batch[["a", "i", "j"]].to_numpy()
        first = np.append(0, np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1)
        held = batch.iloc[first[-1] :]
        yield _links_of_blocks(batch, first[:-1], first[1:], threshold)
    if held is not None:
        yield _links_of_blocks(held, np.array([0]), np.array([len(held)]), threshold)


def _links_of_blocks(rows: pd.DataFrame, starts: np.ndarray, ends: np.ndarray, threshold: float) -> pd.DataFrame:
    """``id, n_links, root`` for the vectors of each block that have links; a block has one or two chunks of its group."""
    centre, i, j, chunk, ids, weights = (rows[c].to_numpy() for c in ("a", "i", "j", "chunk", "id", "n"))
    units, centres, found = rows["unit"].tolist(), rows["centres"].tolist(), []
    for start, end in zip(starts.tolist(), ends.tolist()):
        x = np.frombuffer(b"".join(units[start:end]), dtype="<f8").reshape(end - start, -1)
        inside = chunk[start:end]
        left, right = (np.flatnonzero(inside == c[start]) for c in (i, j))
        close = x[left] @ x[right].T >= threshold
        if i[start] == j[start]:
            np.fill_diagonal(close, False)
        if not close.any():
            continue
        counted = close & ~_met_before(centres[start:end], centre[start], left, right)
        own_weights = weights[start:end]
        n_links = np.zeros(end - start, dtype=np.int64)
        n_links[left] += counted @ own_weights[right]
        if i[start] != j[start]:
            n_links[right] += counted.T @ own_weights[left]
        pairs = np.argwhere(close)
        # ids ascend within a block's chunk, not over both
        order = np.argsort(ids[start:end], kind="stable")
        rank = np.argsort(order)
        roots = linkage.roots_of(end - start, rank[np.stack([left[pairs[:, 0]], right[pairs[:, 1]]], axis=1)])
        own = ids[start:end]
        found.append((own, n_links, own[order][roots[rank]]))
    if not found:
        return pd.DataFrame({"id": [], "n_links": [], "root": []}, dtype="int64")
    return pd.DataFrame({name: np.concatenate([f[k] for f in found]) for k, name in enumerate(("id", "n_links", "root"))})


def _met_before(centres: list, centre: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether two rows are also together in the group of a smaller centre."""
    earlier = [[c for c in found if c < centre] for found in centres]
    number = {c: k for k, c in enumerate(dict.fromkeys(c for found in earlier for c in found))}
    was_in = np.zeros((len(earlier), len(number)), dtype=np.float32)
    for k, found in enumerate(earlier):
        was_in[k, [number[c] for c in found]] = 1
    return was_in[left] @ was_in[right].T > 0


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vectors``.

    Two rows are linked if their labels are equal and not NULL, their vectors have the same dimension, share a key and
    have a cosine of at least ``threshold``. Vectors that are NULL, empty, zero, or hold NULL or a non-finite number link
    with nothing. ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the smallest
    ``vec_id`` reachable; ``kept`` marks the rows that bear it. Rows with the same ``vec_id`` are one vertex. Rows without
    ``vec_id`` count as links, have the component they are linked with, and are kept if there is none. An empty table gives an
    empty result; other columns are left out.
    """
    made = settle(_classes(vectors, id_column, vector_column, label_column))
    # copies are one class with a number of rows
    classes = settle(
        made.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit"), F.first("label").alias("label"))
    )
    pairs = settle(_centres(classes))
    in_group = pairs.select("a", F.col("b").alias("id")).unionByName(pairs.select("a", F.col("a").alias("id"))).distinct()
    # the other centres of a vector tell where a pair has met before
    centres = in_group.groupBy("id").agg(F.sort_array(F.collect_set("a")).alias("centres"))
    sizes = in_group.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / float(BLOCK)).cast("bigint").alias("chunks"))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    rows = (
        in_group.join(sizes, "a")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .select("a", "id", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    )
    known = classes.select(F.col("node").alias("id"), "n", "unit").join(centres, "id")

    blocks = settle(
        rows.join(known, "id")
        .repartition("a", "i", "j")
        .sortWithinPartitions("a", "i", "j", "id")
        .mapInPandas(lambda batches: _compared(batches, threshold), "id bigint, n_links bigint, root bigint")
    )
    counts = blocks.groupBy("id").agg(F.sum("n_links").alias("n_links")).withColumnRenamed("id", "node")
    links = blocks.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    in_class = made.where("node IS NOT NULL").select(F.col("vec_id").alias("id"), "node")
    named = linkage.smallest_ids(in_class, links)
    copies = classes.select("node", F.col("n").alias("copies"))
    return (
        made.select("vec_id", "node")
        .join(copies, "node", "left")
        .join(counts, "node", "left")
        .join(named, "node", "left")
        .select(
            "vec_id",
            (F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.col("component_id").isNull()).alias("kept"),
        )
    )
