"""Words covered by passages that also start in an earlier document: the part that both substring operators share.

A window is ``size`` consecutive words. An operator names candidate windows, those that may occur several times, with an
upper bound on how often; the exact work is done here:

1. Runs of candidates are cut into segments at windows chosen by content, so equal passages give equal segments. Of the
   segments with the same words, the one in the smallest document stays, the others are covered whole.
2. In the segments that stay, single windows may still occur in other segments, also of documents that have this one.
   Where a segment occurs as often as its windows can at most, there are none; the windows of the others are compared
   one by one.

Documents are dealt to groups of some megabytes by a hash of the row. A group sends one row per segment or window, so
what a passage common to all documents sends grows with the groups, not with the documents. Words and windows are told
apart by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back

SIZE = 50
# Bytes of text in a group of documents.
GROUP_BYTES = 8_000_000
# One in so many windows ends a segment; no segment is longer than the second number.
SEGMENT_WINDOWS = 16
LONGEST_SEGMENT = 4096
UNBOUNDED = 2**31 - 1
LAST_ID = 2**63 - 1

_CHUNK = 1 << 16
# Texts of so many bytes in all are hashed together.
_TOGETHER = 1_000_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BYTE_POWERS = [_powers(b, _CHUNK + 1) for b in _BASES]
_BYTE_INVERSES = [_powers(pow(b, -1, 2**64), _CHUNK + 1) for b in _BASES]
_POWERS = _powers(_BASES[0], _CHUNK + 1024)
_INVERSE = _powers(pow(_BASES[0], -1, 2**64), _CHUNK + 1024)
# A random number for each byte value, one set for each half of a hash.
_BYTES = np.random.default_rng(21).integers(0, 2**64, (2, 256), dtype=np.uint64)
_IS_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: Sequence[bytes | None], halves: int = 2, lower: bool = False) -> Iterator[np.ndarray]:
    """For each text (UTF-8) the 128-bit hashes of its words, one row each, in two columns or only the first half.
    With ``lower``, A-Z are taken in lower case.

    A word's hash is a polynomial of its bytes, taken as a difference of running sums, so that no word is touched on
    its own; those too long for a running sum are hashed directly.
    """
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < _TOGETHER):
            size += len(texts[end] or b"") + 1
            end += 1
        group = [text or b"" for text in texts[at:end]]
        whole = b"\n".join(group).lower() if lower else b"\n".join(group)
        starts, hashes = _words_of(whole, halves)
        offsets = np.cumsum([len(text) + 1 for text in group])[:-1]
        yield from np.split(hashes, np.searchsorted(starts, offsets))
        at = end


def _words_of(text: bytes, halves: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and their hashes."""
    data = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_IS_BLANK[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = np.empty((len(starts), halves), dtype=np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        stop = int(np.searchsorted(ends, begin + _CHUNK, side="right"))
        if stop <= at:
            out[at] = np.frombuffer(xxhash.xxh3_128_digest(text[begin : ends[at]]), dtype="<u8")[:halves]
            at += 1
            continue
        part = data[begin : ends[stop - 1]]
        a, b = starts[at:stop] - begin, ends[at:stop] - begin
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        for half in range(halves):
            np.cumsum(_BYTES[half][part] * _BYTE_POWERS[half][: len(part)], out=sums[1:])
            length = (b - a).astype(np.uint64) * np.uint64(0x165667B19E3779F9)
            out[at:stop, half] = mixed((sums[b] - sums[a]) * _BYTE_INVERSES[half][a] + length)
        at = stop
    return starts, out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words, one row per start, a column for each of ``hashes``."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros((0, hashes.shape[1]), dtype=np.uint64)
    out = np.empty((n, hashes.shape[1]), dtype=np.uint64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK + size - 1]
        sums = np.zeros((len(part) + 1, hashes.shape[1]), dtype=np.uint64)
        np.cumsum(part * _INVERSE[: len(part), None], axis=0, out=sums[1:])
        m = len(part) - size + 1
        out[at : at + m] = mixed((sums[size:] - sums[:-size]) * _POWERS[:m, None])
    return out


def segments(windows: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``starts, lengths, keys, bounds`` of the segments of the candidate windows, those with ``bound`` above 0."""
    is_candidate = bound > 0
    at = np.flatnonzero(is_candidate)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros((0, 2), dtype=np.uint64), none
    fresh = ~is_candidate[at - 1]
    fresh[0] = True  # also where at[0] is 0 and at - 1 is the last window
    fresh |= windows[at, 0] % np.uint64(SEGMENT_WINDOWS) == 0
    first = np.flatnonzero(fresh)
    inside = at - np.repeat(at[first], np.diff(np.append(first, len(at))))
    fresh |= inside % LONGEST_SEGMENT == 0
    first = np.flatnonzero(fresh)
    lengths = np.diff(np.append(first, len(at)))
    inside = at - np.repeat(at[first], lengths)
    keys = np.add.reduceat(windows[at] * _POWERS[inside, None], first, axis=0)
    keys = mixed(keys + lengths[:, None].astype(np.uint64))
    return at[first], lengths, keys, np.maximum.reduceat(bound[at], first)


def grouped(docs: DataFrame, groups: int) -> DataFrame:
    """``g, row, doc, doc_id, text``: rows with group, hash and UTF-8 text; ``doc`` orders them, those without id last."""
    row = F.xxhash64("doc_id", "text")
    return docs.select(
        F.pmod(row, F.lit(groups)).cast("int").alias("g"),
        row.alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]


def group_count(n_bytes: int) -> int:
    return max(1, -(-n_bytes // GROUP_BYTES))


def rows_of(frame: pd.DataFrame, *columns: str) -> dict[tuple[int, int], tuple[np.ndarray, ...]]:
    """The values of ``columns`` for each ``(row, doc)`` of a frame."""
    if not len(frame):
        return {}
    row, doc = frame["row"].to_numpy(), frame["doc"].to_numpy()
    order = np.lexsort((doc, row))
    row, doc = row[order], doc[order]
    ends = np.flatnonzero((row[1:] != row[:-1]) | (doc[1:] != doc[:-1])) + 1
    parts = [np.split(frame[c].to_numpy()[order], ends) for c in columns]
    first = np.append(0, ends)
    return dict(zip(zip(row[first].tolist(), doc[first].tolist()), zip(*parts)))


def _smallest_per_key(parts: list[tuple], g: int) -> pd.DataFrame:
    """Rows of a group: those whose key a smaller document has are ``gone``; ``weight`` holds each key's count once.

    Each part is ``row, doc, starts, lengths, keys, bounds`` of one row; parts come in the order of ``doc`` and ``row``.
    """
    parts = [part for part in parts if len(part[2])]
    if not parts:
        return pd.DataFrame(columns=_COLUMNS)
    sizes = [len(part[2]) for part in parts]
    row, doc = (np.repeat(np.array([part[i] for part in parts], dtype=np.int64), sizes) for i in (0, 1))
    start, n, keys, bound = (np.concatenate([part[i] for part in parts]) for i in (2, 3, 4, 5))
    keys = keys.view(np.int64)
    order = np.argsort(keys[:, 0], kind="stable")
    same = keys[order[1:], 0] == keys[order[:-1], 0]
    if (same & (keys[order[1:], 1] != keys[order[:-1], 1])).any():
        order = np.lexsort((np.arange(len(keys)), keys[:, 1], keys[:, 0]))
    row, doc, start, n, bound, keys = (x[order] for x in (row, doc, start, n, bound, keys))
    fresh = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
    first = np.flatnonzero(fresh)
    counts = np.diff(np.append(first, len(keys)))
    return pd.DataFrame(
        {
            "g": g,
            "row": row,
            "doc": doc,
            "start": start,
            "n": n,
            "k1": keys[:, 0],
            "k2": keys[:, 1],
            "bound": bound,
            "gone": doc > np.repeat(doc[first], counts),
            "weight": np.where(fresh, np.repeat(counts, counts), 0),
        }
    )


ROWS = "g int, row bigint, doc bigint, start bigint, n bigint, k1 bigint, k2 bigint, bound bigint, gone boolean, weight bigint"
_COLUMNS = [c.split()[0] for c in ROWS.split(",")]


def _spread(condition: Column) -> list[Column]:
    """Rows that are decided already go where their row hash leads instead of to their crowded key."""
    return [
        F.when(condition, F.col("row")).otherwise(F.col("k1")).alias("k1"),
        F.when(condition, F.col("start")).otherwise(F.col("k2")).alias("k2"),
    ]


def _decided(rows: DataFrame) -> DataFrame:
    """Add ``state``: 2 or more if the passage starts in a smaller document, odd if its windows can occur nowhere else.

    One number, so that all uses need the same columns and Spark shuffles them once.
    """
    dealt = rows.select("g", "row", "doc", "start", "n", "bound", "gone", "weight", *_spread(F.col("gone")))
    same = Window.partitionBy("k1", "k2")
    covered = F.col("gone") | (F.min("doc").over(same) < F.col("doc"))
    alone = F.sum("weight").over(same) >= F.col("bound")
    return dealt.select("g", "row", "doc", "start", "n", (2 * covered.cast("int") + alone.cast("int")).alias("state"))


def without_repeats(docs_in_groups: DataFrame, info: DataFrame, prepare, size: int = SIZE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, spans`` of the frame from :func:`grouped`, one row per row.

    ``info`` has a column ``g`` and whatever ``prepare`` needs: ``prepare(info_of_group)`` returns a function of
    ``(row, doc, word hashes, window hashes)`` that gives every window its bound, 0 for no candidate. ``spans`` are the
    removed stretches as ``(start, end)`` in words, end excluded; ``kept_text`` joins the other words by one space.
    """

    def in_order(texts: pd.DataFrame) -> Iterator[tuple[int, int, np.ndarray]]:
        order = np.lexsort((texts["row"].to_numpy(), texts["doc"].to_numpy()))
        row, doc, text = (texts[c].to_numpy()[order].tolist() for c in ("row", "doc", "text"))
        return zip(row, doc, word_hashes(text))

    def cut(texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        mark, parts = prepare(known), []
        for row, doc, hashes in in_order(texts):
            windows = window_hashes(hashes, size)
            if len(windows):
                parts.append((row, doc, *segments(windows, mark(row, doc, hashes, windows))))
        return _smallest_per_key(parts, int(texts["g"].iloc[0]))

    def single(texts: pd.DataFrame, open_segments: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        parts = []
        wanted = rows_of(open_segments, "start", "n")
        has_some = [key in wanted for key in zip(texts["row"].tolist(), texts["doc"].tolist())]
        for row, doc, hashes in in_order(texts[has_some]):
            starts, lengths = wanted[row, doc]
            windows = window_hashes(hashes, size)
            at = np.unique(np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum()))
            parts.append((row, doc, at, np.ones_like(at), windows[at], np.full(len(at), UNBOUNDED)))
        return _smallest_per_key(parts, int(texts["g"].iloc[0]))

    def cover(texts: pd.DataFrame, covered: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        gone = rows_of(covered, "start", "n")
        ids: list[int | None] = []
        out = []
        for row, doc, doc_id, text in zip(*(texts[c].tolist() for c in ("row", "doc", "doc_id", "text"))):
            words = (text or b"").split()
            spans, removed, kept = [], 0, words
            if (row, doc) in gone:
                starts, lengths = gone[row, doc]
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, np.minimum(starts + lengths + size - 1, len(words)), -1)
                inside = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                removed = int(inside.sum())
                kept = list(compress(words, (~inside).tolist()))
            ids.append(None if doc == LAST_ID and pd.isna(doc_id) else doc)
            out.append((len(words), removed, b" ".join(kept).decode("utf-8", "replace"), spans))
        frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text", "spans"])
        frame.insert(0, "doc_id", pd.array(ids, dtype="Int64"))
        return frame

    def with_texts(other: DataFrame, function, schema: str) -> DataFrame:
        return docs_in_groups.groupBy("g").cogroup(other.groupBy("g")).applyInPandas(function, schema)

    whole = _decided(with_texts(info, cut, ROWS))
    open_segments = whole.where("state = 0").select("g", "row", "doc", "start", "n")
    windows = _decided(with_texts(open_segments, single, ROWS))
    covered = whole.where("state > 1").unionByName(windows.where("state > 1")).select("g", "row", "doc", "start", "n")
    return with_texts(
        covered,
        cover,
        "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, spans array<struct<start:bigint,end:bigint>>",
    )
