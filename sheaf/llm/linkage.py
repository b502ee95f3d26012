"""Groups of rows that share a key, and connected components of the links between them.

Pairs are not listed per key. The members of a key are tied to its smallest member, its centre; operators compare
members with their centre first and look at other pairs of a centre's group only where that leaves members unlinked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back, settle
from sheaf.llm.repeats import mixed
from sheaf.llm.substring import squeezed, unsqueezed

# Rows that a task gathers before it ties them, times keys of a row; members in a bucket, about.
GATHER = 500_000
BUCKET_MEMBERS = 500_000
# Rows of a group that lists its keys together, about; keys that are counted together, about.
GROUP_ROWS = 40_000
BLOCK_KEYS = 4_000_000
# Members of a key that are compared with each other to leave out those that share it by chance.
SIFTED = 64
_PAIRS = "key bigint, a bigint, a_tag bigint, b bigint, b_tag bigint"
_LOCAL = f"bucket bigint, crowded boolean, members binary, {_PAIRS}"


def _tied(key: np.ndarray, member: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, ...]:
    """Members in the order of key and id, and for each the place of its key's first, smallest member."""
    order = np.argsort(member, kind="stable")
    order = order[np.argsort(key[order], kind="stable")]
    key, member, tag = key[order], member[order], tag[order]
    fresh = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, dtype=bool)
    return key, member, tag, np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))


def _pairs(key: np.ndarray, member: np.ndarray, tag: np.ndarray, centre: np.ndarray, centre_tag: np.ndarray) -> pd.DataFrame:
    other = member != centre
    return pd.DataFrame(
        {"key": key[other], "a": centre[other], "a_tag": centre_tag[other], "b": member[other], "b_tag": tag[other]}
    )


def _run_sizes(centre: np.ndarray) -> np.ndarray:
    """For each member in order, how many have its key."""
    return np.bincount(centre, minlength=len(centre))[centre] if len(centre) else centre


def stars(
    rows: DataFrame,
    n_rows: int,
    keys_of: Callable[[pd.DataFrame], np.ndarray],
    keys_per_row: int,
) -> DataFrame:
    """``a, a_tag, b, b_tag`` without repetition: every member ``b`` of a key with the key's smallest member ``a``.

    ``rows`` has ``id`` and ``tag``, bigint and not NULL, and what ``keys_of`` needs to give an array of 64-bit keys, one
    line per row. A task ties the members of a key that it has itself, so it sends one member of a key however many
    rows share it; packed members of a range of keys then meet in a bucket, of which there are as many as ``n_rows``
    needs. Where several tasks had members of a key, their centres are replaced by the key's.
    """
    buckets = max(1, -(-n_rows * keys_per_row // BUCKET_MEMBERS))
    gather = max(1, GATHER // keys_per_row)

    def tie_own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= gather:
                yield from tie(pd.concat(held, ignore_index=True))
                held, size = [], 0
                hand_back()
        if size:
            yield from tie(pd.concat(held, ignore_index=True))
        hand_back()

    def tie(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        keys = keys_of(batch)
        n = keys.shape[1]
        key, member, tag, centre = _tied(keys.ravel(), np.repeat(batch["id"].to_numpy(), n), np.repeat(batch["tag"].to_numpy(), n))
        bound = centre != np.arange(len(centre))
        pairs = _pairs(key[bound], member[bound], tag[bound], member[centre[bound]], tag[centre[bound]])
        yield pairs.assign(bucket=pd.array([None], dtype="Int64")[0], crowded=None, members=None)
        sent = np.stack([x[~bound] for x in (key, member, tag)], axis=1)
        bucket = (mixed(sent[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
        packed = [part.tobytes() for part in np.split(sent[order], at[1:])]
        none = pd.array([None] * len(at), dtype="Int64")
        to = bucket[order][at]
        yield pd.DataFrame({"bucket": to, "crowded": False, "members": packed} | dict.fromkeys(("key", "a", "a_tag", "b", "b_tag"), none))

    def tie_bucket(sent: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        members = np.frombuffer(b"".join(sent["members"]), dtype="<i8").reshape(-1, 3)
        key, member, tag, centre = _tied(members[:, 0], members[:, 1], members[:, 2])
        return _pairs(key, member, tag, member[centre], tag[centre])

    local = rows.mapInPandas(tie_own, _LOCAL)
    over_tasks = settle(
        local.where("bucket IS NOT NULL").select("bucket", "crowded", "members").groupBy("bucket").applyInPandas(tie_bucket, _PAIRS)
    )
    moved = over_tasks.select("key", F.col("b").alias("a"), F.struct("a", "a_tag").alias("_centre"))
    of_tasks = local.where("bucket IS NULL").select("key", "a", "a_tag", "b", "b_tag").join(moved, ["key", "a"], "left")
    of_tasks = of_tasks.select(
        F.coalesce("_centre.a", "a").alias("a"), F.coalesce("_centre.a_tag", "a_tag").alias("a_tag"), "b", "b_tag"
    )
    return of_tasks.unionByName(over_tasks.select("a", "a_tag", "b", "b_tag")).distinct()


def _named(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Names of mixed keys: the block of the hash range, then 32 bits."""
    return (((keys >> np.uint64(32)) * np.uint64(blocks)) & ~np.uint64(0xFFFFFFFF)) | (keys & np.uint64(0xFFFFFFFF))


def _squeezed(names: np.ndarray) -> bytes:
    return squeezed(np.diff(names & np.uint64(0xFFFFFFFF), prepend=np.uint64(0)))


def _unsqueezed(block: int, data: bytes) -> np.ndarray:
    return (np.uint64(block) << np.uint64(32)) | np.cumsum(unsqueezed(data), dtype=np.uint64)


def _among(names: np.ndarray, shared: pd.DataFrame) -> np.ndarray:
    """Which names are in the lists ``keys`` of the blocks ``block`` of ``shared``."""
    known = [_unsqueezed(block, keys) for block, keys in zip(shared["block"], shared["keys"])]
    known = np.sort(np.concatenate(known)) if known else np.zeros(0, dtype=np.uint64)
    if not len(known):
        return np.zeros(names.shape, dtype=bool)
    some = np.zeros(1 << 22, dtype=bool)  # most names fail here, at the price of one look at a small table
    some[known & np.uint64(len(some) - 1)] = True
    out = some[names & np.uint64(len(some) - 1)]
    at = np.minimum(np.searchsorted(known, names[out]), len(known) - 1)
    out[out] = known[at] == names[out]
    return out


def _shared(in_groups: DataFrame, blocks: int, members_of: Callable) -> DataFrame:
    """``g, block, keys``: the keys of each group that more than one row has, in any group.

    A group sends names of its keys, in order and as differences, once or, if it has several rows with the key, twice; so
    a key that a third of all rows share costs two numbers a group. They meet in ``blocks``, ranges of the hash, of about
    ``BLOCK_KEYS`` keys each. Keys alike in block and name only are sent on for nothing, none is lost.
    """

    def listed(g: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        found, n = np.unique(_named(members_of(parts["members"])[2].ravel(), blocks), return_counts=True)
        found = np.repeat(found, np.minimum(n, 2))
        block = (found >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.append(True, np.diff(block) != 0))
        return pd.DataFrame({"g": g[0], "block": block[at], "keys": [_squeezed(part) for part in np.split(found, at[1:])]})

    def counted(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        parts = [_unsqueezed(key[0], x) for x in sent["keys"]]
        every = np.sort(np.concatenate(parts))
        often = every[1:][every[1:] == every[:-1]]
        out = []
        for g, part in zip(sent["g"], parts if len(often) else []):
            own = np.unique(part[often[np.minimum(np.searchsorted(often, part), len(often) - 1)] == part])
            if len(own):
                out.append((g, key[0], _squeezed(own)))
        return pd.DataFrame(out, columns=["g", "block", "keys"])

    lists = in_groups.groupBy("g").applyInPandas(listed, "g bigint, block bigint, keys binary")
    return lists.groupBy("block").applyInPandas(counted, "g bigint, block bigint, keys binary")


def near_pairs(
    rows: DataFrame,
    n_rows: int,
    keys_per_row: int,
    close: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    more: Sequence[str] = ("more",),
) -> DataFrame:
    """``a, a_tag, a_more, b, b_tag, b_more, hub`` without repetition: pairs of rows that share a key, and have close tags.

    ``rows`` has ``id``, ``tag`` and ``more``, bigint and not NULL, and ``keys``, ``keys_per_row`` keys of 32 bits each; rows
    may be repeated. ``more`` names columns like ``more``, if there are several. ``close`` is given two arrays of tags and the
    bits in which their ``more`` differ, a line of several for each pair if ``more`` names several. Pairs of a hub have
    their tags, other pairs have zeros. Rows meet once, in groups by ``id``, where repeated ones are dropped. Each group then lists its keys, which
    are counted, and only members of keys that some other row has are sent on; see :func:`_shared`. Members of a key are
    compared with each other where they meet. Those of a key with more than ``SIFTED`` members, in a group or a bucket,
    are not: they are tied to its smallest member ``a`` however far their tags are, marked by ``hub``, and pairs among
    them are left to the caller. Members take 28 bytes, 8 more for each further column, on their way to the buckets. What a group has tied itself goes
    through other buckets, dealt by member.
    """
    buckets = max(1, -(-n_rows * keys_per_row // BUCKET_MEMBERS))
    blocks = max(1, -(-n_rows * keys_per_row // BLOCK_KEYS))
    groups = max(1, -(-n_rows // GROUP_ROWS))
    gather = max(1, GATHER // keys_per_row)
    tags = ["tag", *more]
    near_names = ["key", "a", *(f"a_{name}" for name in tags), "b", *(f"b_{name}" for name in tags)]
    before_keys = 2 + 2 * len(tags)
    width = before_keys + keys_per_row  # numbers of 32 bits that a row takes
    in_bucket = 3 + 2 * len(tags)  # and a member with its key, or numbers of 64 bits of a pair

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= gather:
                yield in_groups(pd.concat(held, ignore_index=True))
                held, size = [], 0
                hand_back()
        if size:
            yield in_groups(pd.concat(held, ignore_index=True))
        hand_back()

    def in_groups(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.drop_duplicates("id")
        ends = [batch[name].to_numpy().view(np.uint32).reshape(-1, 2) for name in ("id", *tags)]
        member = batch["id"].to_numpy()
        keys = np.frombuffer(b"".join(batch["keys"]), dtype="<u4").reshape(len(batch), keys_per_row)
        sent = np.column_stack([*ends, keys])
        g = (mixed(member.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(g, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(g[order]) != 0))
        return pd.DataFrame({"g": g[order][at], "members": [part.tobytes() for part in np.split(sent[order], at[1:])]})

    def members_of(parts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, tags with what more there is, and mixed 64-bit keys, a line for each different row of a group."""
        held = np.frombuffer(b"".join(parts), dtype="<u4").reshape(-1, width)
        member = np.ascontiguousarray(held[:, :2]).view(np.int64).ravel()
        member, first = np.unique(member, return_index=True)
        held = held[first]
        places = np.arange(keys_per_row, dtype=np.uint64) << np.uint64(32)
        keys = mixed((held[:, before_keys:].astype(np.uint64) + places) * np.uint64(0x9E3779B97F4A7C15))
        return member, np.ascontiguousarray(held[:, 2:before_keys]).view(np.int64), keys

    def tie(g: tuple, parts: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        if not len(parts):
            return packed(np.zeros((0, in_bucket), dtype=np.int32), np.zeros(0, dtype=np.int64), False)
        member, tag, keys = members_of(parts["members"])
        row, column = np.nonzero(_among(_named(keys, blocks), shared))
        chosen = keys[row, column]
        key = (((chosen % np.uint64(buckets)) << np.uint64(32)) | (chosen >> np.uint64(32))).view(np.int64)
        key, member, tag, centre = _tied(key, member[row], tag[row])
        crowded = _run_sizes(centre) > SIFTED
        bound = crowded & (centre != np.arange(len(centre)))
        own = np.column_stack([x[bound] for x in (key, member[centre], tag[centre], member, tag)])
        out = [packed(own, -1 - (mixed(np.ascontiguousarray(own[:, 2 + len(tags)]).view(np.uint64)) % np.uint64(buckets)).astype(np.int64), True)]
        key, member, tag, crowded = (x[~bound] for x in (key, member, tag, crowded))
        sent = np.column_stack([key.astype(np.int32), member.view(np.int32).reshape(-1, 2), tag.view(np.int32)])
        for of_crowd in (False, True):
            chosen = crowded == of_crowd
            out.append(packed(sent[chosen], key[chosen] >> 32, of_crowd))
        return pd.concat(out, ignore_index=True)

    def packed(sent: np.ndarray, to: np.ndarray, crowded: bool) -> pd.DataFrame:
        order = np.argsort(to, kind="stable")
        to = to[order]
        at = np.flatnonzero(np.append(True, np.diff(to) != 0)) if len(to) else np.zeros(0, dtype=np.int64)
        parts = [part.tobytes() for part in np.split(sent[order], at[1:])] if len(at) else []
        return pd.DataFrame({"bucket": to[at], "crowded": crowded, "members": parts})

    def tie_bucket(sent: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        if sent["bucket"].iloc[0] < 0:
            own = np.frombuffer(b"".join(sent["members"]), dtype="<i8").reshape(-1, in_bucket)
            return pd.DataFrame(own, columns=near_names).assign(hub=True, own=True)

        def unpacked(parts: pd.Series) -> np.ndarray:
            return np.frombuffer(b"".join(parts), dtype="<i4").reshape(-1, in_bucket)

        members = unpacked(sent["members"])
        high = np.int64(sent["bucket"].iloc[0]) << 32
        key = high | members[:, 0].view(np.uint32).astype(np.int64)
        member, tag = np.ascontiguousarray(members[:, 1:3]).view(np.int64).ravel(), np.ascontiguousarray(members[:, 3:]).view(np.int64)
        key, member, tag, _ = _tied(key, member, tag)
        fresh = np.append(True, (key[1:] != key[:-1]) | (member[1:] != member[:-1]))
        key, member, tag, centre = _tied(key[fresh], member[fresh], tag[fresh])
        of_crowd = high | np.ascontiguousarray(unpacked(sent.loc[sent["crowded"], "members"])[:, 0]).view(np.uint32).astype(np.int64)
        crowd = (_run_sizes(centre) > SIFTED) | np.isin(key, of_crowd)
        other = crowd & (member != member[centre])
        hub = np.column_stack([x[other] for x in (key, member[centre], tag[centre], member, tag)])
        out = [pd.DataFrame(hub, columns=near_names).assign(hub=True)]
        near = [np.zeros((0, 2), dtype=np.int64)]
        at = np.flatnonzero(~crowd)
        for step in range(1, SIFTED):
            at = at[at + step < len(centre)]
            at = at[centre[at + step] == centre[at]]
            if not len(at):
                break
            differing = tag[at, 1:] ^ tag[at + step, 1:]
            x = at[close(tag[at, 0], tag[at + step, 0], differing if len(more) > 1 else differing[:, 0])]
            near.append(np.column_stack([member[x], member[x + step]]))
        near = np.unique(np.concatenate(near), axis=0)
        out.append(pd.DataFrame(dict.fromkeys(near_names, 0) | {"a": near[:, 0], "b": near[:, 1], "hub": False}))
        return pd.concat(out, ignore_index=True).assign(own=False)

    packed_rows = rows.mapInPandas(pack, "g bigint, members binary").repartition("g")
    shared = _shared(packed_rows, blocks, members_of)
    sent = packed_rows.groupBy("g").cogroup(shared.groupBy("g")).applyInPandas(tie, "bucket bigint, crowded boolean, members binary")
    tied = settle(sent.groupBy("bucket").applyInPandas(tie_bucket, f"{' bigint, '.join(near_names)} bigint, hub boolean, own boolean"))
    over_tasks = tied.where("NOT own")
    of_a = near_names[1 : 2 + len(tags)]
    moved = over_tasks.where("hub").select("key", F.col("b").alias("a"), F.struct(*of_a).alias("_centre")).distinct()
    of_tasks = tied.where("own").select(*near_names).join(moved, ["key", "a"], "left")
    of_centre = [F.coalesce(f"_centre.{name}", name).alias(name) for name in of_a]
    of_tasks = of_tasks.select(*of_centre, *near_names[2 + len(tags) :], F.lit(True).alias("hub"))
    # a member may be a task's centre in one place and tied to itself as the key's centre in another
    return of_tasks.unionByName(over_tasks.select(*near_names[1:], "hub")).where("a <> b").distinct()


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one task as a forest of stars: every vertex with the smallest one it is tied to here."""
    parts = [batch for batch in batches if len(batch)]
    if not parts:
        return
    links = pd.concat(parts, ignore_index=True)
    vertices, ends = np.unique(links[["a", "b"]].to_numpy(), return_inverse=True)
    roots = roots_of(len(vertices), ends.reshape(-1, 2))
    own = np.arange(len(vertices)) != roots
    yield pd.DataFrame({"a": vertices[own], "b": vertices[roots[own]]})


def roots_of(n: int, links: np.ndarray) -> np.ndarray:
    """Smallest vertex reachable from each of ``0..n-1`` by links, one link per row."""
    roots = np.arange(n)
    while len(links):
        low, high = np.minimum(roots[links[:, 0]], roots[links[:, 1]]), np.maximum(roots[links[:, 0]], roots[links[:, 1]])
        links = links[low != high]
        np.minimum.at(roots, high, low)
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots = up
    return roots


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every vertex that is tied to a smaller one: the smallest vertex reachable by ``(a, b)``.

    Each task first reduces its links to a forest. Then, until nothing changes, every vertex passes its smallest
    neighbour on to its larger ones (large star) and to its smaller ones (small star); each round at least halves
    the way to the smallest vertex in practice. Minima are combined before the shuffle and joined back, so a vertex
    with very many neighbours is only a skewed join key. Every round is checkpointed.
    """
    down = lambda df, a, b: df.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = settle(down(links.select("a", "b").mapInPandas(_forest, "a bigint, b bigint"), "a", "b"))
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = state
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = settle(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("_m"))
        tied = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))).alias("e"))
        edges = settle(tied.select("e.a", "e.b").where("a <> b").distinct())


def smallest_ids(in_class: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component_id``: the smallest id in the component of each node, by ``links`` ``(a, b)`` between nodes.

    ``in_class`` has ``id, node``: what each id stands for. An id with several nodes ties them; a missing id ties nothing,
    and a component of nodes without ids has none.
    """
    pairs = settle(in_class.select("id", "node").distinct())
    several = pairs.where("id IS NOT NULL").groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("_last")).where("b < _last")
    tied = pairs.join(several, "id").select(F.col("node").alias("a"), "b").where("a <> b")
    found = components(links.select("a", "b").unionByName(tied)).withColumnRenamed("id", "node")
    nodes = pairs.groupBy("node").agg(F.min("id").alias("_first")).join(found, "node", "left")
    nodes = settle(nodes.select("node", "_first", F.coalesce("component", "node").alias("component")))
    smallest = nodes.groupBy("component").agg(F.min("_first").alias("component_id"))
    return nodes.join(smallest, "component").select("node", "component_id")
