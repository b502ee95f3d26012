"""Substring dedup with a count-min prefilter.

First pass: every group of documents lists fingerprints of its windows with their counts; these are the cells that its
sketch has counts in. Sketches of a block of the hash range are merged by adding counts; a block has ``DEPTH`` rows of
counters of fixed width, and there are as many blocks as the text needs, so each merge is bounded and none goes to the
driver. An estimate is the least of a window's counters and never too low. Second pass: only windows estimated to occur
twice or more are grouped exactly, see :mod:`sheaf.llm.repeats`.

Both ways there is one row per group and block, and a fingerprint is in it once, however often it occurs: the rows do
not depend on how the input is dealt to tasks, and a passage common to all documents costs a block one entry a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

from sheaf.llm import repeats
from sheaf.llm.common import hand_back
from sheaf.llm.repeats import SIZE, UNBOUNDED, window_hashes, word_hashes

# Bytes of text per block of the sketch, and counters per row of a block: about six for each window of usual text.
BLOCK_BYTES = 32_000_000
WIDTH_BITS = 25
DEPTH = 2
# Windows that a group gathers before it hands on a sketch; only groups with very long texts have more.
GATHER = 2_000_000
_FULL = 65535


def squeezed(values: np.ndarray) -> bytes:
    """Compressed bytes of 32-bit numbers, byte planes apart."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def place(windows: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and 32-bit fingerprint of windows; the cells are taken from the fingerprint."""
    return windows[:, 1] % np.uint64(blocks), (windows[:, 0] >> np.uint64(32)).astype(np.uint32)


def cells(fingerprints: np.ndarray, row: int) -> np.ndarray:
    """Counter of each fingerprint in one row of the sketch."""
    odd = np.uint32((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)[row])
    return (fingerprints * odd) >> np.uint32(32 - WIDTH_BITS)


def partition_sketches(docs_in_groups: DataFrame, blocks: int, size: int) -> DataFrame:
    """``block, g, cells, times``: the different fingerprints of the windows of each group in order, and how often each
    occurs, NULL if all do once."""

    def sketch(texts: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        g, out = int(texts["g"].iloc[0]), []
        held: list[np.ndarray] = []
        gathered = 0

        def flush() -> None:
            packed, times = np.unique(np.concatenate(held), return_counts=True)
            block, finger = (packed >> np.uint64(32)).astype(np.int64), packed.astype(np.uint32)
            first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            for b, part, n in zip(block[first].tolist(), np.split(finger, first[1:]), np.split(times, first[1:])):
                cells = squeezed(np.diff(part, prepend=np.uint32(0)))
                out.append((b, g, cells, squeezed(np.minimum(n, _FULL)) if n.max() > 1 else None))

        for hashes in word_hashes(texts["text"].tolist()):
            windows = window_hashes(hashes, size)
            if not len(windows):
                continue
            block, finger = place(windows, blocks)
            held.append((block << np.uint64(32)) | finger)
            gathered += len(block)
            if gathered >= GATHER:
                flush()
                held, gathered = [], 0
        if held:
            flush()
        return pd.DataFrame(out, columns=["block", "g", "cells", "times"])

    # dealt like the texts of the later passes, so that all read one shuffle
    return docs_in_groups.groupBy("g").applyInPandas(sketch, "block bigint, g int, cells binary, times binary")


def merged(sketches: pd.DataFrame) -> pd.DataFrame:
    """Add up the sketches of one block; per group of documents, the fingerprints estimated to occur twice or more.

    Without ``times``, each fingerprint of a row of ``sketches`` occurs once.
    """
    hand_back()
    parts = [np.cumsum(unsqueezed(c), dtype=np.uint32) for c in sketches["cells"]]
    ends = np.cumsum([len(part) for part in parts])
    fingers = np.concatenate(parts)
    times = np.ones(len(fingers), dtype=np.float32)
    for end, part, n in zip(ends, parts, sketches.get("times", [None] * len(parts))):
        if n is not None:
            times[end - len(part) : end] = unsqueezed(n)
    estimate = np.full(len(fingers), _FULL, dtype=np.float32)
    for r in range(DEPTH):
        at = cells(fingers, r)
        # such sums are exact up to 2^24, far beyond what an estimate can tell, and never wrap around
        counts = np.zeros(1 << WIDTH_BITS, dtype=np.float32)
        np.add.at(counts, at, times)
        np.minimum(estimate, counts[at], out=estimate)
    often = np.flatnonzero(estimate >= 2)
    cuts = np.searchsorted(often, ends[:-1])
    block, out = int(sketches["block"].iloc[0]), []
    for g, chosen, n in zip(sketches["g"], np.split(fingers[often], cuts), np.split(estimate[often], cuts)):
        if len(chosen):
            out.append((int(g), block, squeezed(np.diff(chosen, prepend=np.uint32(0))), squeezed(n)))
    return pd.DataFrame(out, columns=["g", "block", "cells", "estimates"])


def substring_dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, spans``, one row per row of ``docs`` (``doc_id``, ``text``).

    Removed is each word covered by a window of ``size`` words whose word sequence also starts in a document with a
    smaller ``doc_id``. NULL and short texts keep all their words; rows without ``doc_id`` count as the last document;
    rows with the same ``doc_id`` do not remove each other's words. Other columns are left out; an empty table gives an
    empty result. Texts are read whole, however long.
    """
    n_bytes = repeats.text_bytes(docs)
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    in_groups = repeats.grouped(docs, repeats.group_count(n_bytes))
    heavy = (
        partition_sketches(in_groups, blocks, size)
        .groupBy("block")
        .applyInPandas(merged, "g int, block bigint, cells binary, estimates binary")
    )

    def prepare(known: pd.DataFrame):
        keys, estimates = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for block, found, n in zip(known["block"], known["cells"], known["estimates"]):
            fingers = np.cumsum(unsqueezed(found), dtype=np.uint32).astype(np.uint64)
            keys.append((np.uint64(block) << np.uint64(32)) | fingers)
            estimates.append(unsqueezed(n).astype(np.int64))
        key, estimate = np.concatenate(keys), np.concatenate(estimates)
        # sketches handed on at different times may name a cell twice
        key, first = np.unique(key, return_index=True)
        estimate = estimate[first]
        estimate[estimate >= _FULL] = UNBOUNDED

        # most windows fail here, at the price of one look at a small table
        some = np.zeros(1 << 22, dtype=bool)
        some[key & np.uint64(len(some) - 1)] = True

        def mark(row: int, doc: int, hashes: np.ndarray, windows: np.ndarray) -> np.ndarray:
            block, finger = place(windows, blocks)
            wanted = (block << np.uint64(32)) | finger
            bound = np.zeros(len(wanted), dtype=np.int64)
            maybe = np.flatnonzero(some[wanted & np.uint64(len(some) - 1)])
            if len(maybe):
                at = np.minimum(np.searchsorted(key, wanted[maybe]), len(key) - 1)
                bound[maybe] = np.where(key[at] == wanted[maybe], estimate[at], 0)
            return bound

        return mark

    return repeats.without_repeats(in_groups, heavy, prepare, size)
