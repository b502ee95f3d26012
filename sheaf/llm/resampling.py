"""Importance resampling towards a target: documents drawn by how much their words and word pairs look like the target's.

Features are words and pairs of neighbouring words, hashed to buckets. A document's weight is the mean of its features'
gains, the logarithm of how much more frequent a bucket is in the target; Gumbel noise from the id turns the highest
scores into a draw in proportion to the weights.

Counting goes by segments: newlines cut texts into lines. Equal lines are counted first, then the features of each
distinct line are found once and multiplied by its occurrences; pairs across lines are counted and added in the same way.
Lines beyond ``SEGMENT_BYTES`` are cut at a blank like at a newline, which changes no sum since pairs across cuts count.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back, settle, spare_name

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
SEGMENT_BYTES = 65_536
# Bytes of distinct segments that a task gathers before it sends their counts; bytes that are hashed together.
GATHER_BYTES = 16_000_000
TOGETHER = 2_000_000
# Words up to this length are hashed side by side, byte by byte.
SIDE_BY_SIDE = 32

# Bytes of words: digits, letters in lower case, and all of characters beyond ASCII; newlines stay, others are blanks.
_LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 or b == 10 else 0x20
    for b in range(256)
)


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


_CRC = _crc_table()


def segments_of(text: str | None) -> list[bytes]:
    """Segments of a text that have a word, blanks at their ends taken off."""
    found = []
    for line in (text or "").encode("utf-8", "replace").translate(_LOWER).split(b"\n"):
        line = line.strip()
        while len(line) > SEGMENT_BYTES:
            end = line.find(b" ", SEGMENT_BYTES)
            if end < 0:
                break
            found.append(line[:end])
            line = line[end:].lstrip()
        if line:
            found.append(line)
    return found


class Words:
    """The words of some segments, and CRC-32 states of them and of pairs of them."""

    def __init__(self, segments: Sequence[bytes]):
        self.whole = b"\n".join(segments)
        self.data = np.frombuffer(self.whole, dtype=np.uint8)
        inside = np.zeros(len(self.data) + 2, dtype=bool)
        inside[1:-1] = self.data > 0x20
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.lengths = edges[::2], edges[1::2] - edges[::2]
        offsets = np.cumsum([0, *(len(segment) + 1 for segment in segments)])
        # words of segment k: first[k] to first[k + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self.segment = np.repeat(np.arange(len(segments)), np.diff(self.first))

    def extended(self, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        """States after the bytes of the given words."""
        starts, lengths = self.starts[words], self.lengths[words]
        order = np.argsort(-lengths, kind="stable")
        out, at, size = state[order], starts[order], lengths[order]
        long = int(np.searchsorted(-size, -SIDE_BY_SIDE, "left"))
        for k in range(long):
            word = self.whole[at[k] : at[k] + size[k]]
            out[k] = zlib.crc32(word, int(out[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        rest, at, size = out[long:], at[long:], size[long:]
        n = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left").tolist()
        for k, m in enumerate(n):
            rest[:m] = _CRC[(rest[:m] ^ self.data[at[:m] + k]) & 0xFF] ^ (rest[:m] >> np.uint32(8))
        back = np.empty_like(out)
        back[order] = out
        return back

    def states(self, words: np.ndarray) -> np.ndarray:
        return self.extended(np.full(len(words), 0xFFFFFFFF, dtype=np.uint32), words)

    def paired(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """States of words already read, a space, and the given words."""
        spaced = _CRC[(states ^ np.uint32(0x20)) & 0xFF] ^ (states >> np.uint32(8))
        return self.extended(spaced, words)

    def features(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """``buckets, segments`` of all words and all pairs inside segments."""
        n = len(self.starts)
        states = self.states(np.arange(n))
        second = np.flatnonzero(self.segment[1:] == self.segment[:-1]) + 1
        pairs = self.paired(states[second - 1], second)
        bucket = bucket_of(np.concatenate([states, pairs]), buckets)
        return bucket, np.concatenate([self.segment, self.segment[second]])

    def across(self, left: np.ndarray, right: np.ndarray, buckets: int) -> np.ndarray:
        """Buckets of the pairs of the last word of a segment ``left`` and the first of a segment ``right``."""
        last = self.first[left + 1] - 1
        return bucket_of(self.paired(self.states(last), self.first[right]), buckets)


def bucket_of(states: np.ndarray, buckets: int) -> np.ndarray:
    return ((states ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)


def _segment_counts(docs: DataFrame) -> DataFrame:
    """``segment, n, across``: distinct segments, or first and last words around a cut, with their occurrences."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines: Counter[bytes] = Counter()
        pairs: Counter[bytes] = Counter()
        size = 0

        def sent() -> Iterator[pd.DataFrame]:
            for found, across in ((lines, False), (pairs, True)):
                if found:
                    yield pd.DataFrame({"segment": list(found), "n": list(found.values()), "across": across})
                found.clear()

        for batch in batches:
            for text in batch["text"]:
                found = segments_of(text)
                size += sum(len(line) for line in found if line not in lines)
                lines.update(found)
                for x, y in zip(found, found[1:]):
                    pairs[x[x.rfind(b" ") + 1 :] + b" " + y.split(b" ", 1)[0]] += 1
                if size > GATHER_BYTES:
                    yield from sent()
                    size = 0
            del batch
            hand_back()
        yield from sent()
        hand_back()

    counted = docs.select("text").mapInPandas(count, "segment binary, n bigint, across boolean")
    return counted.groupBy("across", "segment").agg(F.sum("n").alias("n"))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of all texts are in each bucket; buckets without any are left out."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            segments, n, across = batch["segment"].tolist(), batch["n"].to_numpy(), batch["across"].to_numpy()
            for part in _parts([len(segment) for segment in segments]):
                words, times, pairs = Words(segments[part]), n[part], across[part]
                bucket, segment = words.features(buckets)
                # of first and last words around a cut only the pair counts, not the words
                own = ~pairs[segment] | (np.arange(len(bucket)) >= len(words.starts))
                np.add.at(total, bucket[own], times[segment[own]])
            hand_back()
        filled = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": filled, "n": total[filled]})

    parts = _segment_counts(docs).mapInPandas(count, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _parts(sizes: Sequence[int]) -> Iterator[slice]:
    """Stretches of about ``TOGETHER`` bytes."""
    begin, held = 0, 0
    for at, size in enumerate(sizes):
        held += size
        if held > TOGETHER:
            yield slice(begin, at + 1)
            begin, held = at + 1, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, both smoothed by one."""
    s, t = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array(
        [math.floor(1000 * math.log((target.get(b, 0) + 1) * s / ((source.get(b, 0) + 1) * t))) for b in range(buckets)],
        dtype=np.int64,
    )


def weights(docs: DataFrame, gain: np.ndarray, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``, the floored mean gain of its features (none: 0).

    Columns of these names are replaced, others passed on.
    """
    known = docs.sparkSession.sparkContext.broadcast(gain)
    buckets = len(gain)

    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            stretches = _parts([len(text or "") for text in texts])
            parts = [_weighed([segments_of(text) for text in texts.iloc[at]], known.value, buckets) for at in stretches]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=["n_words", "n_features", "weight"])
            del texts, parts
            hand_back()

    found = F.pandas_udf(weigh, "n_words bigint, n_features bigint, weight bigint")
    name = spare_name(docs, "_found")
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "n_features", "weight")]
    return docs.withColumn(name, found(text_column)).select(*kept, f"{name}.*")


def _weighed(docs: list[list[bytes]], gain: np.ndarray, buckets: int) -> pd.DataFrame:
    """Sums of gains of distinct segments, added up per document, and those of pairs across segments."""
    number = {segment: i for i, segment in enumerate(dict.fromkeys(s for segments in docs for s in segments))}
    words = Words(list(number))
    bucket, segment = words.features(buckets)
    sums = np.zeros(len(number), dtype=np.int64)
    np.add.at(sums, segment, gain[bucket])
    sizes = np.diff(words.first)
    own = np.array([number[s] for segments in docs for s in segments], dtype=np.int64)
    doc = np.repeat(np.arange(len(docs)), [len(segments) for segments in docs])
    n_words, total = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
    np.add.at(n_words, doc, sizes[own])
    np.add.at(total, doc, sums[own])
    cut = np.flatnonzero(doc[1:] == doc[:-1])
    np.add.at(total, doc[cut], gain[words.across(own[cut], own[cut + 1], buckets)])
    n_features = n_words + np.maximum(n_words - 1, 0)
    return pd.DataFrame({"n_words": n_words, "n_features": n_features, "weight": total // np.maximum(n_features, 1)})


def noise(doc_id: Column | str = "doc_id", seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise that depends on the id and the seed only."""
    named = F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``; other columns are not used. Of the N rows with an id
    and at least ``least_words`` words, ``floor(percent * N / 100)`` with the highest scores are drawn, ties to the
    smaller id, then by features, weight and text; ``rank`` counts them from 1 and is NULL for the others. Rows without
    an id are counted as source text and have no score and no rank. NULL texts and those without a word have no features
    and a weight of 0. Repeated rows count as often as they are there and have ranks of their own. Empty tables give
    gains from the smoothing alone, or no rows. Texts of any length are read whole.
    """
    counted = [dict(map(tuple, bucket_counts(df, buckets).collect())) for df in (docs, target)]
    gain = gains(*counted, buckets)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_text"))
    scored = weights(narrow, gain).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise(seed=seed)).alias("score"), "_text"
    )
    return ranked(settle(scored), percent, least_words).drop("_text")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``.

    Rows are counted per score first. Scores are whole thousandths of logarithms, so there are some ten thousand of them
    at any number of rows, and a running sum over the counts gives each its first rank. Inside a score ids decide.
    """
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    per_score = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("n").over(Window.partitionBy())
    places = per_score.select(
        F.col("score").alias("_score"),
        (F.sum("n").over(above) - F.col("n")).alias("_before"),
        F.floor(F.lit(percent) * total / 100).cast("bigint").alias("_drawn"),
    )
    # a row that is not in the draw has a partition of its own
    own = F.when(eligible, F.lit(0)).otherwise(F.xxhash64("doc_id", "_text"))
    inside = Window.partitionBy("score", own).orderBy("doc_id", "n_features", "weight", "_text")
    joined = scored.join(F.broadcast(places), eligible & (F.col("score") == F.col("_score")), "left")
    rank = F.col("_before") + F.row_number().over(inside)
    return joined.withColumn("rank", rank).select(
        *scored.columns, F.when(F.col("rank") <= F.col("_drawn"), F.col("rank")).cast("bigint").alias("rank")
    )
