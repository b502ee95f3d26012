"""Equi-joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is split into slices of about this many rows. All operators that slice take it as an
# argument. The list of such keys is broadcast and has at most one entry per so many rows, and never more than HOT_KEYS,
# the largest; further keys are left to adaptive execution.
SLICE_ROWS = 1_000_000
HOT_KEYS = 100_000
# Keys that a sketch of heavy hitters follows at once, and how many it names at most. A key that holds more than about
# a four-thousandth of the rows is found; rarer ones are left to adaptive execution.
TRACKED_KEYS = 20_000
NAMED_KEYS = 2_000


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: str = "rows", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The keys worth splitting and into how many slices: ``keys, slices``.

    ``counts`` has one line per key with its number of rows. Which keys are named decides only where rows are sent,
    not what is joined, so a list of at most ``HOT_KEYS`` changes no result.
    """
    largest = counts.where(F.col(rows) > slice_rows).orderBy(F.desc(rows), *keys).limit(HOT_KEYS)
    return largest.select(*keys, F.ceil(F.col(rows) / slice_rows).alias("slices"))


def count_rows_by(df: DataFrame, keys: Sequence[str], rows: str = "rows") -> DataFrame:
    """Number of rows per key; partial counts are made before the shuffle, so a hot key costs nothing extra."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows))


def heavy_keys(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    slice_rows: int = SLICE_ROWS,
    tracked: int = TRACKED_KEYS,
    named: int = NAMED_KEYS,
) -> list[DataFrame]:
    """For each set of keys, ``_key, slices`` of its heavy hitters, ``_key`` being :func:`key_hash` of the keys.

    One pass over ``df`` builds a mergeable sketch of bounded size per set and task; only sketches are shuffled, never a
    row or a count per key. Counts are estimates, which is enough to decide where rows go. Keys with a missing part join
    nothing and are not named.
    """
    found = df.select(
        *[F.when(~_any_missing(keys), key_hash(keys)).alias(f"_key_{i}") for i, keys in enumerate(key_sets)]
    ).agg(*[F.expr(f"approx_top_k(_key_{i}, {named}, {tracked})").alias(f"_top_{i}") for i in range(len(key_sets))])
    # one array, so that all sets come from the same pass
    tops = F.concat(*[F.transform(f"_top_{i}", _of_set(i)) for i in range(len(key_sets))])
    heavy = found.select(F.inline(tops)).where((F.col("n") > slice_rows) & F.col("_key").isNotNull())
    slices = F.ceil(F.col("n") / slice_rows).alias("slices")
    return [heavy.where(F.col("set") == i).select("_key", slices) for i in range(len(key_sets))]


def _of_set(i: int):
    return lambda top: F.struct(F.lit(i).alias("set"), top["item"].alias("_key"), top["count"].alias("n"))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _any_missing(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def balanced_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    hot: DataFrame | None = None,
    lookup_spread: Sequence[str] = (),
    lookup_hot: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
    hot_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join on ``keys`` in which the rows of a hot key are spread over many tasks.

    Rows of a hot key of ``large`` get a slice number from a hash of the ``spread`` columns, and the rows of ``lookup``
    with that key are repeated once per slice. With ``lookup_spread``, the keys hot in ``lookup`` are cut likewise, and
    the rows of ``large`` are repeated: a key hot on both sides becomes a grid of slices. All other rows have slice 0.
    A slice depends on the row's content only, so a task that is run again sends its rows to the same place. ``spread``
    should tell the rows of one key apart; combine copies first. Pass ``hot`` and ``lookup_hot`` where row counts are at
    hand, it saves counting; ``hot_by`` names the columns that identify a key in them if not all of ``keys`` do. Columns of
    ``large`` come first.
    """
    keys = list(keys)
    names = list(hot_by or keys)
    if hot is None:
        hot = hot_keys(count_rows_by(large, keys), keys, slice_rows=slice_rows)
    one = F.lit(1).cast("bigint")
    cuts = hot.select(*names, F.col("slices").alias("_slices"), one.alias("_lookup_slices"))
    if lookup_spread:
        if lookup_hot is None:
            lookup_hot = hot_keys(count_rows_by(lookup, keys), keys, slice_rows=slice_rows)
        both = cuts.unionByName(lookup_hot.select(*names, one.alias("_slices"), F.col("slices").alias("_lookup_slices")))
        cuts = both.groupBy(*names).agg(
            F.max("_slices").alias("_slices"), F.max("_lookup_slices").alias("_lookup_slices")
        )
    cuts = F.broadcast(cuts)

    first = F.lit(0).cast("bigint")

    def of_row(columns: Sequence[str], slices: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.coalesce(slices, one)) if columns else first

    def every(slices: str) -> Column:
        return F.explode(F.sequence(first, F.coalesce(slices, one) - 1))

    left = (
        large.join(cuts, names, "left")
        .withColumn("_slice", of_row(spread, "_slices"))
        .withColumn("_lookup_slice", every("_lookup_slices") if lookup_spread else first)
    )
    right = (
        lookup.join(cuts, names, "left")
        .withColumn("_slice", every("_slices"))
        .withColumn("_lookup_slice", of_row(lookup_spread, "_lookup_slices"))
    )
    return left.join(right, [*keys, "_slice", "_lookup_slice"], "inner").select(
        *large.columns, *[c for c in lookup.columns if c not in keys]
    )
