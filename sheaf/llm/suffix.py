"""Suffix-array dedup on sparse suffixes.

Kept are the suffixes that start at minimisers: positions whose ``GRAM`` words hash lowest among ``REACH`` neighbouring
ones, chosen by content alone. They are sorted by their words, as hashes of the first ``GRAM`` and the first ``SHARED``
words, and neighbours are compared: a suffix that shares ``SHARED`` words with any other one shares them with a
neighbour. Such matches are extended left and right to whole windows, see :mod:`sheaf.llm.repeats`.

``GRAM + REACH - 1 + SHARED - 1 <= SIZE`` makes this complete: every window of ``SIZE`` words holds a minimiser that
depends on the window alone and is followed by ``SHARED`` words of the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm import repeats
from sheaf.llm.common import hand_back, settle
from sheaf.llm.repeats import SIZE, UNBOUNDED, window_hashes, word_hashes

GRAM = 5
SHARED = 12
# Runs of equal suffixes longer than this, or cut by a partition, get no upper bound on their length.
RUN_ROWS = 10_000


def reach(size: int) -> int:
    return size - SHARED - GRAM + 2


def minimiser_of(grams: np.ndarray, n_windows: int, size: int) -> np.ndarray:
    """For each of the first ``n_windows`` windows of a text, the start of its minimiser; ``grams`` hashes its GRAMs.

    It is the lowest of the window's first ``reach`` grams, the leftmost of equal ones, so it depends on the window alone.
    """
    width = reach(size)
    picked = [np.zeros(0, dtype=np.int64)]
    for at in range(0, n_windows, 1 << 16):
        part = grams[at : min(at + (1 << 16), n_windows) + width - 1]
        # the place in the low bits makes the leftmost of equal ones the lowest
        low = (part >> np.uint64(17) << np.uint64(17)) | np.arange(len(part), dtype=np.uint64)
        covered = 1
        while covered < width:
            step = min(covered, width - covered)
            low = np.minimum(low[:-step], low[step:])
            covered += step
        picked.append(at + (low & np.uint64((1 << 17) - 1)).astype(np.int64))
    return np.concatenate(picked)


def sparse_suffixes(docs_in_groups: DataFrame, size: int) -> DataFrame:
    """``k1, k2, row, pos, doc, g``: the kept suffixes with the hashes of their first words."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, k1, k2, docs, groups = [], [], [], [], [], []
            texts = word_hashes(batch.column("text").to_pylist())
            for g, row, doc, hashes in zip(*(batch.column(c).to_pylist() for c in ("g", "row", "doc")), texts):
                if len(hashes) < size:
                    continue
                grams = window_hashes(hashes[:, :1], GRAM)[:, 0]
                found = np.unique(minimiser_of(grams, len(hashes) - size + 1, size))
                at.append(found)
                k1.append(grams[found])
                k2.append(window_hashes(hashes[:, 1:], SHARED)[found, 0])
                rows.append(np.full(len(found), row))
                docs.append(np.full(len(found), doc))
                groups.append(np.full(len(found), g, dtype=np.int32))
            if at:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(k1).view(np.int64)),
                        pa.array(np.concatenate(k2).view(np.int64)),
                        pa.array(np.concatenate(rows).astype(np.int64)),
                        pa.array(np.concatenate(at).astype(np.int32)),
                        pa.array(np.concatenate(docs).astype(np.int64)),
                        pa.array(np.concatenate(groups)),
                    ],
                    ["k1", "k2", "row", "pos", "doc", "g"],
                )
            hand_back()

    return docs_in_groups.select("g", "row", "doc", "text").mapInArrow(
        suffixes, "k1 bigint, k2 bigint, row bigint, pos int, doc bigint, g int"
    )


def compare_neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one sorted stretch of suffixes, those equal to a neighbour, with the length of their run as ``bound``.

    The first and the last run of the stretch may go on in the next one: they are handed on without a bound, single
    suffixes with ``edge`` set.
    """
    held: pd.DataFrame | None = None
    opening = True

    def runs(part: pd.DataFrame, closing: bool) -> pd.DataFrame:
        nonlocal opening
        k1, k2 = part["k1"].to_numpy(), part["k2"].to_numpy()
        first = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        sizes = np.diff(np.append(first, len(part)))
        bound = sizes.astype(np.int64)
        at_edge = np.zeros(len(sizes), dtype=bool)
        at_edge[0] = opening
        at_edge[-1] |= closing
        opening = False
        bound[at_edge | (sizes >= RUN_ROWS)] = UNBOUNDED
        wanted = (sizes > 1) | at_edge
        chosen = part[np.repeat(wanted, sizes)]
        return chosen.assign(
            bound=np.repeat(bound[wanted], sizes[wanted]), edge=np.repeat((at_edge & (sizes == 1))[wanted], sizes[wanted])
        )

    for batch in batches:
        if not len(batch):
            continue
        part = batch if held is None else pd.concat([held, batch], ignore_index=True)
        k1, k2 = part["k1"].to_numpy(), part["k2"].to_numpy()
        # the last run waits for the next batch
        breaks = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        cut = int(breaks[-1]) + 1 if len(breaks) else 0
        if cut:
            yield runs(part.iloc[:cut], False)
        held = part.iloc[cut:].reset_index(drop=True)
        if len(held) > RUN_ROWS:
            # a crowded run: all but the last row are known to have a neighbour, and so has that
            yield held.iloc[:-2].assign(bound=UNBOUNDED, edge=False)
            held = held.iloc[-2:].reset_index(drop=True)
            opening = True  # what is left of the run gets no bound
    if held is not None:
        yield runs(held, True)


def suffix_dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, spans``, one row per row of ``docs`` (``doc_id``, ``text``).

    Removed is each word inside a passage of at least ``size`` words that also occurs in a document with a smaller
    ``doc_id``. NULL and short texts keep all their words; rows without ``doc_id`` count as the last document; rows with
    the same ``doc_id`` do not remove each other's words. Other columns are left out; an empty table gives an empty
    result. Texts are read whole, however long.
    """
    if reach(size) < 1:
        raise ValueError(f"windows need at least {SHARED + GRAM - 1} words")
    in_groups = repeats.grouped(docs, repeats.group_count(repeats.text_bytes(docs)))
    # the sort looks at its input twice, once for the ranges
    suffixes = settle(sparse_suffixes(in_groups, size))
    in_order = ["k1", "k2", "row", "pos"]
    matches = settle(
        suffixes.repartitionByRange(*in_order)
        .sortWithinPartitions(*in_order)
        .mapInPandas(compare_neighbours, "k1 bigint, k2 bigint, row bigint, pos int, doc bigint, g int, bound bigint, edge boolean")
    )
    # a single suffix at the end of a stretch is matched if another stretch ends on the same words
    ends = matches.where("bound = 2147483647").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    single = matches.where("edge").join(ends, ["k1", "k2"], "left_semi")
    columns = ["g", "row", "doc", "pos", "bound"]
    found = matches.where("NOT edge").select(*columns).unionByName(single.select(*columns))

    def prepare(known: pd.DataFrame):
        own = repeats.rows_of(known, "pos", "bound")

        def mark(row: int, doc: int, hashes: np.ndarray, windows: np.ndarray) -> np.ndarray:
            bound = np.zeros(len(windows), dtype=np.int64)
            if (row, doc) in own:
                # a window is a candidate if its own minimiser is matched; every occurrence has one in that run
                at = minimiser_of(window_hashes(hashes[:, :1], GRAM)[:, 0], len(windows), size)
                matched, first = np.unique(own[row, doc][0].astype(np.int64), return_index=True)
                k = np.minimum(np.searchsorted(matched, at), len(matched) - 1)
                bound = np.where(matched[k] == at, own[row, doc][1][first][k], 0)
            return bound

        return mark

    return repeats.without_repeats(in_groups, found, prepare, size)
