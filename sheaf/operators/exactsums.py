"""Sums of doubles and of their products that do not depend on the order or the partitions of the rows.

A double is a whole number of at most 54 bits times a power of two. Whole numbers of one power are added exactly, as
DECIMAL(38,0), so Spark can combine them before and after the shuffle in any order; per key there are at most some two
thousand powers (four thousand for products). Only when all rows are in, one Neumaier sum per key, largest power first,
turns them into a double again.

Missing values are passed over. Infinities and NaN give what plain addition gives. A sum too long for DECIMAL(38,0)
(some 10^10 rows of one key and power for positions, far more otherwise) is an error, never a wrong number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import _col

# Bits of a double's significand, and of the halves that are multiplied.
SIGNIFICAND_BITS = 53
HALF_BITS = 27
# Where a sum is cut in three before it becomes doubles: each part is exact as a double.
LIMB_BITS = 40

Merged = tuple[Callable[[str], Column], Column | str]


def is_floating(df: DataFrame, *values: Column | str) -> bool:
    """Whether any of the columns is FLOAT or DOUBLE."""
    kinds = df.select(*[_col(value).alias(f"v{i}") for i, value in enumerate(values)]).schema
    return any(field.dataType.typeName() in ("float", "double") for field in kinds)


def is_finite(number: Column) -> Column:
    return ~F.isnan(number) & (F.abs(number) != float("inf"))


def power_of(number: Column) -> Column:
    """Power of two of a double; NULL for zero and what is not finite."""
    return F.when(is_finite(number) & (number != 0), F.floor(F.log2(F.abs(number)))).cast("int")


def whole_of(number: Column, power: Column) -> Column:
    """The whole number that, times two to the ``power - SIGNIFICAND_BITS``, is the double."""
    return times_power(number, SIGNIFICAND_BITS - power).cast("bigint")


def times_power(number: Column, exponent: Column) -> Column:
    """Number times a power of two, in two steps so that the power itself cannot overflow."""
    half = F.shiftright(exponent, 1)
    return number * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def neumaier_fold(numbers: Column) -> Column:
    """Neumaier sum of a short array of doubles, in the order of the array."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("sum"), zero.alias("lost"))

    def add(so_far: Column, x: Column) -> Column:
        raw = so_far["sum"]
        new = raw + x
        rounding = F.when(F.abs(raw) >= F.abs(x), (raw - new) + x).otherwise((x - new) + raw)
        return F.struct(new.alias("sum"), (so_far["lost"] + rounding).alias("lost"))

    return F.aggregate(numbers, start, add, lambda result: result["sum"] + result["lost"])


def rounded(sums: DataFrame, keys: Sequence[str], name: str, also: Mapping[str, Callable] | None = None) -> DataFrame:
    """``keys, name``: one double per key of ``keys, _exponent, _whole, _endless``, the exact sums per exponent.

    ``_whole`` times two to the ``_exponent`` is a part of the key's sum; both are NULL where there is none. Columns named
    in ``also`` are merged by their functions.
    """

    def times(number: Column, bits: int) -> Column:
        return (number.cast("decimal(20,0)") * F.lit(str(2**bits)).cast("decimal(25,0)")).cast("decimal(38,0)")

    # integer division gives BIGINT, which the upper part fits
    cut = (
        sums.withColumn("_high", F.expr(f"_whole div CAST('{2 ** (2 * LIMB_BITS)}' AS DECIMAL(38,0))"))
        .withColumn("_rest", F.col("_whole") - times(F.col("_high"), 2 * LIMB_BITS))
        .withColumn("_middle", F.expr(f"_rest div CAST('{2**LIMB_BITS}' AS DECIMAL(38,0))"))
        .withColumn("_low", F.col("_rest") - times(F.col("_middle"), LIMB_BITS))
    )
    exponent = F.col("_exponent")
    part = F.struct(
        times_power(F.col("_high").cast("double"), exponent + 2 * LIMB_BITS).alias("high"),
        times_power(F.col("_middle").cast("double"), exponent + LIMB_BITS).alias("middle"),
        times_power(F.col("_low").cast("double"), exponent).alias("low"),
    )
    collected = cut.groupBy(*keys).agg(
        F.collect_list(F.when(exponent.isNotNull(), part)).alias("_parts"),
        F.sum("_endless").alias("_endless"),
        *[merge(column).alias(column) for column, merge in (also or {}).items()],
    )
    # the powers of a key overlap: all parts are added by size
    flat = F.concat(*[F.col("_parts")[which] for which in ("high", "middle", "low")])
    by_size = F.array_sort(flat, _larger_first)
    return collected.select(*keys, F.coalesce("_endless", neumaier_fold(by_size)).alias(name), *(also or {}))


def _larger_first(x: Column, y: Column) -> Column:
    # of equal size, the negative one: the order does not depend on how the parts came in
    smaller = F.abs(x) < F.abs(y)
    return F.when(F.abs(x) > F.abs(y), -1).when(smaller, 1).when(x < y, -1).when(x > y, 1).otherwise(0)


def exact_totals(
    df: DataFrame,
    values: Mapping[str, Column | str],
    by: Sequence[str] = (),
    also: Mapping[str, Merged] | None = None,
) -> DataFrame:
    """``by`` and one DOUBLE sum per name of ``values``, 0.0 for nothing; the same bits however the rows are dealt.

    ``also`` names further aggregates of the same pass, each a function that merges its own results (``F.max``,
    ``F.min``, ``F.sum``) and its column.
    """
    keys, names, also = list(by), list(values), dict(also or {})
    terms = F.array(
        *[
            F.struct(
                F.lit(i).alias("measure"),
                _col(value).cast("double").alias("value"),
                *[(_col(c) if i == 0 else F.lit(None)).alias(extra) for extra, (_, c) in also.items()],
            )
            for i, value in enumerate(values.values())
        ]
    )
    value = F.col("_value")
    sums = (
        df.select(*keys, F.explode(terms).alias("_term"))
        .select(*keys, F.col("_term.measure").alias("_measure"), F.col("_term.value").alias("_value"), *[f"_term.{x}" for x in also])
        .withColumn("_power", power_of(value))
        .groupBy(*keys, "_measure", "_power")
        .agg(
            F.sum(whole_of(value, F.col("_power")).cast("decimal(20,0)")).cast("decimal(38,0)").alias("_whole"),
            F.sum(F.when(~is_finite(value), value)).alias("_endless"),
            *[merge(extra).alias(extra) for extra, (merge, _) in also.items()],
        )
        .withColumn("_exponent", F.col("_power") - SIGNIFICAND_BITS)
    )
    merges = {extra: merge for extra, (merge, _) in also.items()}
    each = rounded(sums, [*keys, "_measure"], "_total", merges)
    return each.groupBy(*keys).agg(
        *[F.coalesce(F.max(F.when(F.col("_measure") == i, F.col("_total"))), F.lit(0.0)).alias(n) for i, n in enumerate(names)],
        *[merge(extra).alias(extra) for extra, merge in merges.items()],
    )


def exact_dot(
    df: DataFrame, first: Column | str, second: Column | str, by: Sequence[str] = (), name: str = "dot"
) -> DataFrame:
    """Sum of the products of two columns as DOUBLE, without rounding a product or a partial sum.

    Both significands are cut in halves, whose products are whole numbers below 2^56 and added exactly per power. Nothing
    can overflow or vanish on the way; rows in which either number is missing are passed over.
    """
    keys = list(by)
    a, b = F.col("_a"), F.col("_b")
    both = is_finite(a) & is_finite(b)
    rows = (
        df.select(*keys, _col(first).cast("double").alias("_a"), _col(second).cast("double").alias("_b"))
        .withColumn("_power_a", F.when(both, power_of(a)))
        .withColumn("_power_b", F.when(both, power_of(b)))
        .withColumn("_whole_a", whole_of(a, F.col("_power_a")))
        .withColumn("_whole_b", whole_of(b, F.col("_power_b")))
        .withColumn("_power", F.col("_power_a") + F.col("_power_b"))
    )

    def upper(whole: str) -> Column:
        return F.shiftright(whole, HALF_BITS)

    def lower(whole: str) -> Column:
        return F.col(whole).bitwiseAND(F.lit(2**HALF_BITS - 1))

    def added(products: Column) -> Column:
        return F.sum(products.cast("decimal(20,0)")).cast("decimal(38,0)")

    sums = rows.groupBy(*keys, "_power").agg(
        added(upper("_whole_a") * upper("_whole_b")).alias("_upper"),
        added(upper("_whole_a") * lower("_whole_b") + lower("_whole_a") * upper("_whole_b")).alias("_cross"),
        added(lower("_whole_a") * lower("_whole_b")).alias("_lower"),
        F.sum(F.when(~both, a * b)).alias("_endless"),
    )
    least = F.col("_power") - 2 * SIGNIFICAND_BITS
    parts = F.array(
        F.struct((least + 2 * HALF_BITS).alias("e"), F.col("_upper").alias("w"), F.col("_endless").alias("x")),
        F.struct((least + HALF_BITS).alias("e"), F.col("_cross").alias("w"), F.lit(None).cast("double").alias("x")),
        F.struct(least.alias("e"), F.col("_lower").alias("w"), F.lit(None).cast("double").alias("x")),
    )
    spread = sums.select(*keys, F.explode(parts).alias("_p")).select(
        *keys, F.col("_p.e").alias("_exponent"), F.col("_p.w").alias("_whole"), F.col("_p.x").alias("_endless")
    )
    return rounded(spread, keys, name)
