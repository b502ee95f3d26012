"""MinHash near-dedup by a multi-index Hamming join.

A document is its set of five-word shingles. ``SYMBOLS`` MinHash values of ``BITS`` bits each are its signature; two
signatures differ in few symbols if the sets are alike: the distance follows from the similarity asked for, see
:func:`signature_distance`. Signatures are cut into more chunks than half of that. If two differ in no more symbols, some
chunk has at most one of them (pigeonhole), so the keys of a document are its chunks with each symbol left out in turn:
all pairs under the distance share a key. Links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm import linkage
from sheaf.llm.common import hand_back, settle, spare_name
from sheaf.llm.repeats import mixed, window_hashes, word_hashes

SHINGLE = 5
SYMBOLS = 64
BITS = 16
# Share of pairs at the very similarity asked for whose signatures differ more than is searched.
MISSED = 1e-5
# Documents that are compared with each other at once.
BLOCK = 500
# Ids may be broadcast up to this number (16 MB).
ID_ROWS = 1_000_000

_FACTORS = (np.random.default_rng(11).integers(0, 2**31, SYMBOLS, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_MASKS = np.random.default_rng(12).integers(0, 2**32, SYMBOLS, dtype=np.uint64).astype(np.uint32)


def shingle_sets(texts: Sequence[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text (UTF-8), A-Z lower-cased; all its words as one if fewer."""
    for hashes in word_hashes(texts, halves=1, lower=True):
        n = min(SHINGLE, len(hashes))
        yield np.unique(window_hashes(hashes, n)[:, 0] + np.uint64(n)) if n else np.zeros(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``SYMBOLS`` MinHash values of ``BITS`` bits."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SYMBOLS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        part = (x[at : at + 2048, None] ^ _MASKS[None, :]) * _FACTORS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.uint16)


def signature_distance(percent: int) -> int:
    """The least number of symbols that more than differ in at most ``MISSED`` of the pairs of that similarity.

    A symbol differs with the chance that the sets' similarity leaves, so the number is binomial: 23 of 64 for 85, 28 for 80.
    """
    apart = 1 - min(max(percent, 0), 100) / 100
    beyond, distance = 1.0, -1
    while beyond > MISSED and distance < SYMBOLS:
        distance += 1
        beyond = sum(comb(SYMBOLS, k) * apart**k * (1 - apart) ** (SYMBOLS - k) for k in range(distance + 1, SYMBOLS + 1))
    return distance


def chunk_keys(signatures: np.ndarray, distance: int) -> np.ndarray:
    """Keys of signatures, one row each: two with at most ``distance`` different symbols share one."""
    keys = []
    chunks = min(distance // 2 + 1, signatures.shape[1])
    errors = distance // chunks
    for number, chunk in enumerate(np.array_split(np.arange(signatures.shape[1]), chunks)):
        for left_out in combinations(chunk, min(errors, len(chunk))):
            kept = [i for i in chunk if i not in left_out]
            key = np.full(len(signatures), number * 1_000_003 + sum(1 << int(i - chunk[0]) for i in left_out), dtype=np.uint64)
            for i in kept:
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, i].astype(np.uint64) + np.uint64(1))
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, s1, s2, sig`` for each row; ``s1, s2`` are a 128-bit hash of the set."""

    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for found in shingle_sets(texts.tolist()):
                s1, s2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype="<i8")
                rows.append((len(found), int(s1), int(s2), signature(found).astype("<u2").tobytes() if len(found) else None))
            yield pd.DataFrame(rows, columns=["n_shingles", "s1", "s2", "sig"])
            hand_back()

    signed = F.pandas_udf(sign, "n_shingles bigint, s1 bigint, s2 bigint, sig binary")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), signed(F.col("text").cast("binary")).alias("s")).select("doc_id", "s.*")


def _centres(classes: DataFrame) -> DataFrame:
    """Pairs of classes that share a key, each with the key's smallest class; tags are the sizes of their sets.

    The metadata of ``sig`` name the ``distance`` within which signatures share a key.
    """
    distance = classes.schema["sig"].metadata["distance"]

    def keys(batch: pd.DataFrame) -> np.ndarray:
        return chunk_keys(np.frombuffer(b"".join(batch["sig"]), dtype="<u2").reshape(len(batch), -1), distance)

    rows = classes.select("id", F.col("n_shingles").alias("tag"), "sig")
    return linkage.stars(rows, classes.count(), keys, chunk_keys(np.zeros((1, SYMBOLS), dtype=np.uint16), distance).shape[1])


def _sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """``id, sig, shingles`` of the given classes, the full sets from their whole texts."""
    wanted = classes.join(small_ids(ids, n_ids), "id", "left_semi").select("id", "of_doc", "s2", "sig")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, s2, sig, found in zip(*(batch[c] for c in ("id", "s2", "sig")), shingle_sets(batch["text"].tolist())):
                data = found.tobytes()
                if (i, s2) == tuple(np.frombuffer(xxhash.xxh3_128_digest(data), dtype="<i8")):  # else another text of that id
                    rows.append((i, sig, data))
            yield pd.DataFrame(rows, columns=["id", "sig", "shingles"])
            hand_back()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("of_doc"), F.col("text").cast("binary").alias("text"))
    joined = texts.join(small_ids(wanted, 16 * n_ids), "of_doc")
    return joined.mapInPandas(sets, "id bigint, sig binary, shingles binary").dropDuplicates(["id"])


def small_ids(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it is no larger than so many ids may be."""
    return F.broadcast(df) if rows <= ID_ROWS else df


def _alike(n_a: int, n_b: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (n_a + n_b - common)


def block_links(left: pd.DataFrame, right: pd.DataFrame, percent: int, distance: int | None = None) -> pd.DataFrame:
    """Links between ``left`` and ``right`` (``id, sig, shingles``), reduced to a forest of stars ``a, b``.

    Pairs within the signature distance are confirmed on the full sets. Intersections come from products of 0/1
    matrices over a few thousand shingles at a time, so memory is bounded however long the texts are.
    """
    distance = signature_distance(percent) if distance is None else distance
    everything = pd.concat([left, right], ignore_index=True).drop_duplicates("id", ignore_index=True)
    sets = [np.frombuffer(s, dtype="<u8") for s in everything["shingles"]]
    place = {i: k for k, i in enumerate(everything["id"])}
    rows, columns = [place[i] for i in left["id"]], [place[i] for i in right["id"]]
    sigs = np.frombuffer(b"".join(everything["sig"]), dtype="<u2").reshape(len(everything), -1)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    differ = np.zeros((len(rows), len(columns)), dtype=np.int16)
    for s in range(sigs.shape[1]):
        differ += sigs[rows, s][:, None] != sigs[columns, s][None, :]
    low = np.minimum(sizes[rows][:, None], sizes[columns][None, :])
    high = np.maximum(sizes[rows][:, None], sizes[columns][None, :])
    open_pairs = (differ <= distance) & (100 * low >= percent * high)
    if open_pairs.any():
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        shared, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        use = count[inverse] > 1
        number = np.cumsum(count > 1) - 1
        column, owner = number[inverse[use]], owner[use]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        common = np.zeros((len(rows), len(columns)), dtype=np.float64)
        total = int(column[-1]) + 1 if len(column) else 0
        for at in range(0, total, 4096):
            a, b = np.searchsorted(column, (at, at + 4096))
            has = np.zeros((len(sets), 4096), dtype=np.float32)
            has[owner[a:b], column[a:b] - at] = 1
            common += has[rows] @ has[columns].T
        union = sizes[rows][:, None] + sizes[columns][None, :] - common
        open_pairs &= 100 * common >= percent * union
    found = np.argwhere(open_pairs)
    links = np.stack([np.array(rows)[found[:, 0]], np.array(columns)[found[:, 1]]], axis=1) if len(found) else np.zeros((0, 2), dtype=int)
    ids = everything["id"].to_numpy()
    ranks = np.argsort(np.argsort(ids))
    by_rank = np.sort(ids)
    roots = linkage.roots_of(len(ids), ranks[links])
    own = roots != np.arange(len(ids))
    return pd.DataFrame({"a": by_rank[own], "b": by_rank[roots[own]]})


def links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between classes, enough of them to connect all that links connect.

    Every document is compared with the centres of its keys. In the groups where that leaves documents unlinked, these
    are compared with all others of the group that are near in size, in blocks of bounded size.
    """
    distance = signature_distance(percent)
    pairs = settle(_centres(classes.withMetadata("sig", {"distance": distance})))
    fit = pairs.where(100 * F.least("a_tag", "b_tag") >= percent * F.greatest("a_tag", "b_tag")).select("a", "b")
    sig = classes.select("id", "sig")

    @F.pandas_udf("int")
    def differing(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="int32")
        x, y = (np.frombuffer(b"".join(s), dtype="<u2").reshape(len(s), -1) for s in (a, b))
        return pd.Series((x != y).sum(axis=1).astype("int32"))

    with_a = fit.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    with_both = with_a.join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
    near = settle(with_both.where(differing("sig_a", "sig_b") <= distance).select("a", "b"))
    ids = settle(near.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    sets = settle(_sets(docs, classes, ids, ids.count()))

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
            common = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
            out.append(_alike(len(x), len(y), common, percent))
        return pd.Series(out, dtype=bool)

    b_sets = sets.select(F.col("id").alias("b"), F.col("shingles").alias("shingles_b"))
    a_sets = sets.select(F.col("id").alias("a"), F.col("shingles").alias("shingles_a"))
    to_centre = settle(
        near.join(b_sets, "b").join(a_sets, "a").where(linked("shingles_a", "shingles_b")).select("a", "b")
    )
    return to_centre.unionByName(_other_links(docs, classes, pairs.select("a", "b", "b_tag"), to_centre, percent))


def _other_links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, to_centre: DataFrame, percent: int) -> DataFrame:
    """Links between members of a group of which at least one is not linked to the centre.

    ``pairs`` are all members ``b`` of a group ``a`` with their sizes, also those whose size rules out a link to the centre:
    they may link with each other. Members are compared by size bands, so that sets of far sizes do not meet.
    """
    marked = pairs.join(to_centre.withColumn("_in", F.lit(True)), ["a", "b"], "left")
    marked = marked.select("a", F.col("b").alias("id"), F.col("b_tag").alias("size"), F.coalesce("_in", F.lit(False)).alias("held"))
    # sets that link have sizes of the same band or of two neighbouring ones; a member is in its own band and the next
    step = F.log(F.lit(100.0 / max(percent, 1))) + 1e-9 if percent < 100 else F.lit(1e-9)
    band = F.floor(F.log(F.col("size").cast("double")) / step).cast("bigint")
    marked = marked.withColumn("own", band).withColumn("band", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    counts = marked.groupBy("a", "band").agg(
        F.count(F.when(~F.col("held"), 1)).alias("loose"), F.count(F.when(F.col("held"), 1)).alias("tied")
    )
    todo = counts.where("loose > 0 AND loose + tied > 1")
    chunks = lambda n: F.ceil(F.col(n) / float(BLOCK)).cast("bigint")
    rows = settle(
        marked.join(todo, ["a", "band"]).select(
            "a",
            "band",
            "id",
            "held",
            F.pmod(F.xxhash64("id"), F.greatest(F.when(F.col("held"), chunks("tied")).otherwise(chunks("loose")), F.lit(1))).alias("chunk"),
            chunks("loose").alias("n_loose"),
            chunks("tied").alias("n_tied"),
        )
    )
    ids = settle(rows.select("id").distinct())
    sets = _sets(docs, classes, ids, ids.count())
    first = F.lit(0).cast("bigint")
    # a block pair is two loose chunks, smaller number first, or a loose and a tied one
    with_loose = F.transform(
        F.sequence(first, F.col("n_loose") - 1),
        lambda j: F.struct(F.lit(False).alias("to_tied"), F.least("chunk", j).alias("i"), F.greatest("chunk", j).alias("j")),
    )
    with_tied = F.when(
        F.col("n_tied") > 0,
        F.transform(
            F.sequence(first, F.greatest(F.col("n_tied") - 1, first)),
            lambda j: F.struct(F.lit(True).alias("to_tied"), F.col("chunk").alias("i"), j.alias("j")),
        ),
    ).otherwise(F.array().cast("array<struct<to_tied:boolean,i:bigint,j:bigint>>"))
    from_tied = F.transform(
        F.sequence(first, F.col("n_loose") - 1),
        lambda i: F.struct(F.lit(True).alias("to_tied"), i.alias("i"), F.col("chunk").alias("j")),
    )
    tasks = F.when(F.col("held"), from_tied).otherwise(F.concat(with_loose, with_tied))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        to_tied, i, j = (block[c].iloc[0] for c in ("to_tied", "i", "j"))
        if to_tied:
            left, right = block[~block["held"]], block[block["held"]]
        else:
            left, right = block[block["chunk"] == i], block[block["chunk"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        return block_links(left, right, percent)

    return (
        rows.withColumn("task", F.explode(tasks))
        .select("a", "band", "id", "held", "chunk", "task.*")
        .join(sets, "id")
        .groupBy("a", "band", "to_tied", "i", "j")
        .applyInPandas(compare, "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs`` (``doc_id``, ``text``).

    Documents are linked if their shingle sets have a Jaccard similarity of at least ``percent`` hundredths.
    ``component_id`` is the smallest ``doc_id`` reachable by links, ``kept`` marks the document that bears it. Texts
    without a word have an empty set, are linked with nothing and kept. Rows with the same ``doc_id`` are one document
    with several texts. Rows without ``doc_id`` have no component and are kept. Other columns are left out; an empty
    table gives an empty result. Texts are read whole.
    """
    signed = settle(signatures(docs))
    known = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    # copies of a set are one class, named by half of the set's hash
    classes = settle(
        known.groupBy("s1").agg(
            F.min(F.struct("doc_id", "s2")).alias("_r"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")
        ).select(F.col("s1").alias("id"), F.col("_r.doc_id").alias("of_doc"), F.col("_r.s2").alias("s2"), "n_shingles", "sig")
    )
    in_class = known.select(F.col("doc_id").alias("id"), F.col("s1").alias("node"))
    named = linkage.smallest_ids(in_class, links(docs, classes, percent))
    linkable = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("s1"))
    return (
        signed.select("doc_id", "n_shingles", linkable.alias("node"))
        .join(named, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def distinct_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id, all columns unchanged.

    Rows without a word and rows without ``doc_id`` stay. Rows alike in ``doc_id`` and ``text`` are all kept or all
    dropped, as :func:`near_duplicates` judges ids.
    """
    node = spare_name(docs, "_node")
    judged = near_duplicates(docs.select("doc_id", "text"), percent).where("NOT kept").select(F.col("doc_id").alias(node)).distinct()
    return docs.join(judged, F.col("doc_id").cast("bigint") == F.col(node), "left_anti")
