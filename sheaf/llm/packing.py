"""Packing tokenized documents into sequences of a fixed window.

A document is cut into whole windows and a rest. The histogram of the rests is matched with shallow combinations of
lengths that fill the window: how often to use each combination is a non-negative least squares problem. Its rounded
solution is taken first, what is left of the histogram is packed greedily. Both work on the histogram, which has at
most one bin per length, so the driver's work does not grow with the documents. Pieces then find their place by rank
within their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import filterfalse
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back, settle

WINDOW = 2048
# Combinations are enumerated on lengths rounded up to multiples of this; at most so many tokens a piece are padding.
GRAIN = 4
DEPTH = 3
END_ID = 1
# Runs that a task remembers before it drops those it has not met since the last time.
MEMO = 400_000
# Pieces per bucket when ranks are given out.
RANK_ROWS = 50_000


class TextIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, each distinct run of characters encoded once.

    For tokenizers that lower-case, drop blanks and cut words into runs of letters, single digits and runs of symbols
    that are encoded apart, each closed by a token with the word-end mark: the ids of a text are then those of its
    runs. Text of printable ASCII and common Latin letters is cut into runs here, other words and those with a special
    token's brackets are encoded whole. The tests hold the result against texts encoded whole.
    """

    # Fixed value: how this family of tokenizers cuts lower-case words, for the characters in PLAIN.
    LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
    RUNS = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\t-\r 0-9{LETTERS}]+"
    # Characters that normal forms leave alone and whose lower case is one of them.
    PLAIN = r"[\t-\r -~\u00c0-\u012f\u0131-\u017f]*"

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the cores to tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.runs = re.compile(self.RUNS).findall
        self.plain = re.compile(self.PLAIN).fullmatch
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # run, or word to encode whole with a blank in front, to ids; the older half is dropped when the newer is full
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Runs of a text, and words to encode whole marked by a blank in front."""
        if "<|" not in text and self.plain(text):
            return self.runs(text.lower())
        found = []
        for word in text.encode("utf-8", "replace").split():
            word = word.decode()
            if "<|" not in word and self.plain(word):
                found += self.runs(word.lower())
            else:
                found.append(" " + word)
        return found

    def learn(self, missing: set[str]) -> None:
        """Remember pieces that are not in the newer memory; runs are encoded many in one go."""
        memo, old = self.memo, self.old
        memo.update({piece: old[piece] for piece in missing if piece in old})
        new = missing.difference(old)
        whole = [piece for piece in new if piece[0] == " "]
        runs = [piece for piece in new if piece[0] != " "]
        parts = [runs[at : at + 64] for at in range(0, len(runs), 64)]
        encoded = self.tokenizer.encode_batch_fast([" ".join(part) for part in parts], add_special_tokens=False)
        for part, e in zip(parts, encoded):
            ids = np.array(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                data, start = ids.tobytes(), 0
                for run, end in zip(part, (4 * ends).tolist()):
                    memo[run] = data[start:end]
                    start = end
            else:
                whole += part
        for piece, e in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            memo[piece] = np.array(e.ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; the pieces of some megabytes of text are looked up together."""
        at = 0
        while at < len(texts):
            if len(self.memo) > MEMO:
                self.memo, self.old = {}, self.memo
            memo = self.memo
            size, found, missing = 0, [], set()
            while at < len(texts) and (not found or size < 2_000_000):
                found.append(self.pieces(texts[at]))
                missing.update(filterfalse(memo.__contains__, found[-1]))
                size += len(texts[at])
                at += 1
            self.learn(missing)
            for pieces_of_text in found:
                yield b"".join(map(memo.__getitem__, pieces_of_text))


def cut(ids: bytes, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """``(start, length, crc32)`` of the pieces of a document: whole windows and a rest."""
    step = 4 * window
    return [(at // 4, len(part) // 4, zlib.crc32(part)) for at in range(0, len(ids), step) if (part := ids[at : at + step])]


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: every document tokenized whole, closed by id 1 and cut.

    A NULL or empty text is the closing id alone. The tokenizer file is read by the driver and sent with the tasks.
    """
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ids_of = TextIds(definition.value)
        for texts in batches:
            rows = []
            for ids in ids_of([text or "" for text in texts]):
                ids += end
                starts, lengths, crcs = zip(*cut(ids, window))
                rows.append((list(starts), list(lengths), list(crcs), len(ids) // 4))
            yield pd.DataFrame(rows, columns=["start", "length", "crc", "tokens"])
            del texts, rows
        del ids_of
        hand_back()

    cut_texts = F.pandas_udf(
        cut_batches, "start array<bigint>, length array<bigint>, crc array<bigint>, tokens bigint"
    )
    return (
        docs.select("doc_id", cut_texts("text").alias("p"))
        .select("doc_id", F.col("p.tokens").alias("doc_tokens"), F.explode(F.arrays_zip("p.start", "p.length", "p.crc")).alias("p"))
        .select("doc_id", F.col("p.start").alias("start"), F.col("p.length").alias("length"), F.col("p.crc").alias("ids_crc32"), "doc_tokens")
    )


def combinations(bins: int, depth: int = DEPTH) -> np.ndarray:
    """Multisets of up to ``depth`` lengths out of 1..``bins`` that add up to ``bins``, one per row, filled up by 0."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int) -> None:
        """``parts`` in ascending order, ``left`` is the window not filled yet and goes to one more part or several."""
        if left >= parts[-1]:
            found.append([*parts, left] + [0] * (depth - len(parts) - 1))
        if len(parts) + 2 <= depth:
            for part in range(parts[-1], left // 2 + 1):
                extend([*parts, part], left - part)

    if depth >= 2:
        for first in range(1, bins // 2 + 1):
            extend([first], bins - first)
    found.append([bins] + [0] * (depth - 1))
    return np.array(found, dtype=np.int64)


def solve_counts(histogram: np.ndarray, columns: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations that come near the histogram: least squares by projected gradient.

    ``histogram[k]`` counts pieces of length k (0 unused). A column uses at most ``DEPTH`` bins, so both products
    with the sparse matrix are gathers. Nesterov steps; deterministic.
    """
    bins = len(histogram) - 1
    used = (columns > 0).astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.zeros(bins + 1)
        for j in range(columns.shape[1]):
            out += np.bincount(columns[:, j], weights=x * used[:, j], minlength=bins + 1)
        return out

    def backward(r: np.ndarray) -> np.ndarray:
        return (r[columns] * used).sum(axis=1)

    v = np.ones(len(columns))
    for _ in range(20):  # largest eigenvalue, for the step
        w = backward(forward(v))
        size = np.linalg.norm(w)
        v = w / size
    step = 1.0 / (1.05 * size)
    x = np.zeros(len(columns))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * backward(forward(y) - histogram), 0.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan_sequences(histogram: dict[int, int], window: int = WINDOW, grain: int = GRAIN) -> list[tuple[list[int], int]]:
    """``(lengths, times)``: how to put all pieces of a histogram of lengths into windows; every piece is used once.

    Lengths are those of the histogram. First whole windows, then the rounded least squares solution over
    combinations of rounded-up lengths, then greedy: the largest piece left, filled up with the largest that fit.
    """
    left = {k: n for k, n in histogram.items() if n}
    plan: list[tuple[list[int], int]] = []
    if left.get(window):
        plan.append(([window], left.pop(window)))
    if not left:
        return plan
    bins = window // grain
    coarse = np.zeros(bins + 1)
    members: dict[int, list[int]] = {}
    for k in sorted(left, reverse=True):
        b = -(-k // grain)
        coarse[b] += left[k]
        members.setdefault(b, []).append(k)
    columns = combinations(bins)
    columns = columns[((columns == 0) | (coarse[columns] > 0)).all(axis=1)]
    if len(columns):
        counts = np.floor(solve_counts(coarse, columns) + 0.5).astype(np.int64)
        order = np.argsort(-counts, kind="stable")
        room = coarse.astype(np.int64)
        for i in order[counts[order] > 0]:
            parts = [int(b) for b in columns[i] if b]
            times = min(int(counts[i]), *[int(room[b]) // parts.count(b) for b in parts])
            for b in parts:
                room[b] -= times
            # a bin holds up to `grain` lengths: hand them out longest first
            while times > 0:
                lengths, need = [], {}
                for b in parts:
                    k = next(k for k in members[b] if left[k] > need.get(k, 0))
                    need[k] = need.get(k, 0) + 1
                    lengths.append(k)
                n = min(times, *[left[k] // c for k, c in need.items()])
                for k, c in need.items():
                    left[k] -= n * c
                plan.append((lengths, n))
                times -= n
    rest = sorted((k for k, n in left.items() if n), reverse=True)
    while rest:
        gap, lengths, need = window, [], {}
        for k in rest:
            fit = min(gap // k, left[k])
            if fit:
                need[k] = fit
                lengths += [k] * fit
                gap -= fit * k
        n = min(left[k] // c for k, c in need.items())
        for k, c in need.items():
            left[k] -= n * c
        plan.append((lengths, n))
        rest = [k for k in rest if left[k]]
    return plan


def ranked(df: DataFrame, key: str, order: list[str], rows: int) -> DataFrame:
    """``df`` with ``_rank`` from 0 within ``key``; ``rows`` is the known number of rows.

    Rows of a key are dealt to buckets by a hash of ``order``, numbered there, and shifted by the sizes of the
    buckets before: no task holds a key that most rows share.
    """
    buckets = max(1, -(-rows // RANK_ROWS))
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        bucketed.groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    here = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        bucketed.withColumn("_here", F.row_number().over(here) - 1)
        .join(shifts, [key, "_bucket"])
        .withColumn("_rank", F.col("_here") + F.col("_shift"))
        .drop("_here", "_shift", "_bucket")
    )


def pack(cut_pieces: DataFrame, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces ``(doc_id, start, length, ids_crc32, doc_tokens)``.

    Repeated rows are pieces of their own. Sequences hold at most ``window`` tokens, without gaps from offset 0. An
    empty frame stays empty. Same pieces, same result, whatever the partitions.
    """
    spark = cut_pieces.sparkSession
    held = settle(cut_pieces)
    histogram = {int(r[0]): int(r[1]) for r in held.groupBy("length").count().collect()}  # at most `window` rows
    plan = plan_sequences(histogram, window, grain)
    places, taken, base = [], {}, 0
    for recipe, (lengths, times) in enumerate(plan):
        slots: dict[int, list[int]] = {}
        for slot, length in enumerate(lengths):
            slots.setdefault(length, []).append(slot)
        for length, own in slots.items():
            first = taken.get(length, 0)
            places.append((length, first, first + times * len(own), len(own), own[0], base))
            taken[length] = first + times * len(own)
        base += times
    # bounded by the number of lengths and combinations, not by the documents
    table = spark.createDataFrame(
        places, "length bigint, _from bigint, _to bigint, _per bigint, _slot bigint, _base bigint"
    )
    fits = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    inside = F.col("_rank") - F.col("_from")
    placed = (
        ranked(held, "length", ["doc_id", "start", "ids_crc32"], sum(histogram.values()))
        .join(F.broadcast(table), "length")
        .where(fits)
        .withColumn("sequence_id", F.col("_base") + F.floor(inside / F.col("_per")).cast("bigint"))
        .withColumn("_slot", F.col("_slot") + F.pmod(inside, F.col("_per")))
    )
    before = (
        Window.partitionBy("sequence_id").orderBy("_slot", "length").rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """Tokenize, cut and pack ``docs`` (``doc_id``, ``text``; other columns are left out): see :func:`pieces`, :func:`pack`."""
    return pack(pieces(docs, tokenizer_path, window), window, grain)
