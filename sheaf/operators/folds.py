"""Folds as aggregates over a column, for the whole frame or per key.

Without keys the result has one row, which holds the identity of the fold when there is no input. Missing values
are passed over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.functions.numbers import exact, exact_sum, log_or_limit
from sheaf.functions.text import _col
from sheaf.operators.exactsums import (
    SIGNIFICAND_BITS,
    exact_totals,
    is_finite,
    is_floating,
    neumaier_fold,
    power_of,
    rounded,
    times_power,
    whole_of,
)

# Rows per stretch of a task in position_weighted_sum, as a power of two: small positions keep sums of doubles accurate.
STRETCH_BITS = 18
# Fixed value: bits of a place that number the rows of a partition in monotonically_increasing_id.
PLACE_BITS = 33
# Where compensated_sum cuts a sum of significands in two.
CUT_BITS = 50


def squares(df: DataFrame, value: Column | str, name: str = "value") -> DataFrame:
    """The squares of a column of whole numbers, as DECIMAL(38,0)."""
    number = _col(value).cast("decimal(19,0)")
    return df.select((number * number).cast("decimal(38,0)").alias(name))


def square_roots(df: DataFrame, value: Column | str, name: str = "value") -> DataFrame:
    """The square roots of a column."""
    return df.select(F.sqrt(_col(value)).alias(name))


def first_numbers(spark: SparkSession, n: int) -> DataFrame:
    """1, 2, ... n in column ``id``."""
    return spark.range(1, n + 1)


def total(df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "total") -> DataFrame:
    """Sum; that of whole numbers is DECIMAL(38,0), that of doubles does not depend on how rows are dealt."""
    if is_floating(df, value):
        return exact_totals(df, {name: value}, by)
    return df.groupBy(*by).agg(F.coalesce(exact_sum(df, value), F.lit(0)).alias(name))


def product(df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "product") -> DataFrame:
    """Product, as DOUBLE."""
    return df.groupBy(*by).agg(F.coalesce(F.product(_col(value)), F.lit(1.0)).alias(name))


def log_total(df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "log_total") -> DataFrame:
    """Sum of natural logarithms; a zero gives -Infinity and a negative number NaN."""
    return exact_totals(df, {name: log_or_limit(value)}, by)


def pair_total(
    df: DataFrame, first: Column | str, second: Column | str, by: Sequence[str] = (), names=("first", "second")
) -> DataFrame:
    """Sums of both members of a pair; those of doubles do not depend on how rows are dealt."""
    doubles = {n: v for n, v in zip(names, (first, second)) if is_floating(df, v)}
    if doubles:
        others = {n: (F.sum, exact(df, v)) for n, v in zip(names, (first, second)) if n not in doubles}
        sums = exact_totals(df, doubles, by, others)
        return sums.select(*by, *[n if n in doubles else _or_zero(sums, n) for n in names])
    return df.groupBy(*by).agg(
        F.coalesce(exact_sum(df, first), F.lit(0)).alias(names[0]),
        F.coalesce(exact_sum(df, second), F.lit(0)).alias(names[1]),
    )


def _or_zero(df: DataFrame, name: str) -> Column:
    whole = df.schema[name].dataType.typeName() == "decimal" and df.schema[name].dataType.scale == 0
    found = F.coalesce(name, F.lit(0))
    return (found.cast("decimal(38,0)") if whole else found).alias(name)


def total_and_max(
    df: DataFrame, first: Column | str, second: Column | str, by: Sequence[str] = (), names=("total", "max")
) -> DataFrame:
    """Sum of the first and maximum of the second member of a pair; the maximum of nothing is -Infinity."""
    if is_floating(df, first):
        both = exact_totals(df, {names[0]: first}, by, {names[1]: (F.max, _col(second).cast("double"))})
        return both.withColumn(names[1], F.coalesce(names[1], F.lit(float("-inf"))))
    return df.groupBy(*by).agg(
        F.coalesce(exact_sum(df, first), F.lit(0)).alias(names[0]),
        F.coalesce(F.max(_col(second)).cast("double"), F.lit(float("-inf"))).alias(names[1]),
    )


def total_and_product(
    df: DataFrame, value: Column | str, by: Sequence[str] = (), names=("total", "product")
) -> DataFrame:
    """Sum and product of one column."""
    return df.groupBy(*by).agg(
        F.coalesce(exact_sum(df, value), F.lit(0)).alias(names[0]),
        F.coalesce(F.product(_col(value)), F.lit(1.0)).alias(names[1]),
    )


def range_total_and_product(spark: SparkSession, n: int) -> DataFrame:
    """Sum and product of 1 .. n; the product is a DOUBLE, so it does not wrap around."""
    return total_and_product(first_numbers(spark, n), "id")


def even_square_total(df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "total") -> DataFrame:
    """Sum of the squares of the even numbers, as DECIMAL(38,0)."""
    number = _col(value).cast("bigint")
    exact_number = number.cast("decimal(19,0)")
    squared = F.sum(F.when(number % 2 == 0, (exact_number * exact_number).cast("decimal(38,0)")))
    return df.groupBy(*by).agg(F.coalesce(squared, F.lit(0)).cast("decimal(38,0)").alias(name))


def position_weighted_sum(
    df: DataFrame,
    value: Column | str,
    order_by: Sequence[str],
    by: Sequence[str] = (),
    name: str = "weighted",
    unique_order: bool = False,
) -> DataFrame:
    """Sum of value times position, positions 1, 2, ... following ``order_by`` (per key when ``by`` is given).

    Rows that tie in ``order_by`` go by value. No task sees a whole key: rows are range-partitioned by key and
    order, so a large key spans many tasks. Each stretch of a key is added up with positions counted from its own
    start, and then shifted by the number of rows in the stretches before: first those of its partition, then those of
    the partitions before, so that the last step sees one row per key and partition.

    A range cannot be cut between rows alike in key, order and value. Such rows are counted and given numbers, by which
    they can be told apart. ``unique_order`` saves that shuffle where no two rows of a key share their place. Sums of
    whole numbers are DECIMAL(38,0). Sums of doubles are exact until they are rounded once, so they have the same bits
    however the rows are dealt.
    """
    keys, order = list(by), [c for c in order_by if c not in by]
    rows = df.select(*keys, *order, _col(value).alias("_value"))
    sorted_by = [*keys, *order]
    if not unique_order:
        alike = [*sorted_by, "_value"]
        copies = F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))
        rows = rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_copy", F.explode(copies))
        sorted_by = [*alike, "_copy"]
    placed = (
        rows.repartitionByRange(*sorted_by)
        .sortWithinPartitions(*sorted_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_stretch", F.shiftright("_place", STRETCH_BITS))
        .withColumn("_at", F.col("_place").bitwiseAND(F.lit(2**STRETCH_BITS - 1)).cast("int"))
    )
    if is_floating(placed, "_value"):
        return _weighted_doubles(placed, keys, name)
    number = exact(placed, "_value")
    whole = placed.select(number.alias("v")).schema["v"].dataType.typeName() == "decimal"
    kind = "decimal(38,0)" if whole else "double"
    none = F.lit(0).cast(kind)
    stretches = placed.groupBy(*keys, "_stretch").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_at").alias("_first"),
        F.coalesce(F.sum(number), none).cast(kind).alias("_sum"),
        F.coalesce(F.sum(number * F.col("_at")), none).cast(kind).alias("_inner"),
    )

    def earlier(*partition: str, by: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(window), F.lit(0).cast("bigint"))

    # the number of the partition is in the high bits of a place
    parts = (
        stretches.withColumn("_part", F.shiftright("_stretch", PLACE_BITS - STRETCH_BITS))
        .withColumn("_shift", earlier(*keys, "_part", by="_stretch") + 1 - F.col("_first"))
        .groupBy(*keys, "_part")
        .agg(
            F.sum("_rows").alias("_rows"),
            F.sum("_sum").cast(kind).alias("_sum"),
            F.sum((F.col("_inner") + F.col("_sum") * F.col("_shift")).cast(kind)).cast(kind).alias("_inner"),
        )
        .withColumn("_weighted", (F.col("_inner") + F.col("_sum") * earlier(*keys, by="_part")).cast(kind))
    )
    return parts.groupBy(*keys).agg(F.coalesce(F.sum("_weighted"), none).cast(kind).alias(name))


def _weighted_doubles(placed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The sum of value times position over rows ``_value, _place, _stretch, _at``, as whole numbers per power of two.

    Works like the sum of whole numbers, but a stretch has a row per power, so that rows before it are counted over the
    stretches with a smaller number. A stretch adds up less than 2^90, a key about 2^124 for 6 * 10^10 rows.
    """
    value = F.col("_value").cast("double")
    whole = whole_of(value, F.col("_power")).cast("decimal(20,0)")
    sums = (
        placed.withColumn("_power", power_of(value))
        .groupBy(*keys, "_stretch", "_power")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("_at").alias("_first"),
            F.sum(whole).cast("decimal(38,0)").alias("_sum"),
            F.sum(whole * F.col("_at").cast("decimal(10,0)")).cast("decimal(38,0)").alias("_inner"),
            F.sum(F.when(~is_finite(value), value)).alias("_endless"),
        )
    )

    def before(*partition: str, by: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(by).rangeBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(window), F.lit(0).cast("bigint"))

    def shifted(by: Column) -> Column:
        return F.col("_inner") + (F.col("_sum") * by.cast("decimal(18,0)")).cast("decimal(38,0)")

    first = F.min("_first").over(Window.partitionBy(*keys, "_stretch"))
    parts = (
        sums.withColumn("_part", F.shiftright("_stretch", PLACE_BITS - STRETCH_BITS))
        .withColumn("_shift", before(*keys, "_part", by="_stretch") + 1 - first)
        .groupBy(*keys, "_part", "_power")
        .agg(
            F.sum("_rows").alias("_rows"),
            F.sum("_sum").cast("decimal(38,0)").alias("_sum"),
            F.sum(shifted(F.col("_shift")).cast("decimal(38,0)")).cast("decimal(38,0)").alias("_inner"),
            F.sum("_endless").alias("_endless"),
        )
        .withColumn("_weighted", shifted(before(*keys, by="_part")).cast("decimal(38,0)"))
    )
    per_power = parts.groupBy(*keys, "_power").agg(
        F.sum("_weighted").cast("decimal(38,0)").alias("_whole"), F.sum("_endless").alias("_endless")
    )
    return rounded(per_power.withColumn("_exponent", F.col("_power") - SIGNIFICAND_BITS), keys, name)


def compensated_sum(df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "total") -> DataFrame:
    """Sum of doubles without the rounding losses of plain addition, the same for every order of the rows.

    A double is a whole number times a power of two. The whole numbers are added exactly per key and power, which
    Spark can do in part before the shuffle. That leaves at most one sum per power, some two thousand per key,
    and a Neumaier sum over those, largest power first, gives the result.
    """
    keys = list(by)
    number = _col(value).cast("double")
    finite = ~F.isnan("_value") & (F.abs("_value") != float("inf"))
    power = F.when(finite & (F.col("_value") != 0), F.floor(F.log2(F.abs("_value")))).cast("int")
    sums = (
        df.select(*keys, number.alias("_value"))
        .withColumn("_power", power)
        .withColumn("_whole", times_power(F.col("_value"), SIGNIFICAND_BITS - F.col("_power")).cast("bigint"))
        .groupBy(*keys, "_power")
        .agg(
            F.sum(F.col("_whole").cast("decimal(20,0)")).alias("_whole"),
            F.sum(F.when(~finite, F.col("_value"))).alias("_endless"),
        )
    )
    high = F.expr(f"_whole div {2**CUT_BITS}L")
    low = F.col("_whole") - high.cast("decimal(20,0)") * F.lit(2**CUT_BITS)
    exponent = F.col("_power") - SIGNIFICAND_BITS
    parts = F.struct(
        F.col("_power").alias("power"),
        times_power(high.cast("double"), exponent + CUT_BITS).alias("high"),
        times_power(low.cast("double"), exponent).alias("low"),
    )
    collected = sums.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("_power").isNotNull(), parts)), asc=False).alias("_parts"),
        F.sum("_endless").alias("_endless"),
    )
    flat = F.flatten(F.transform("_parts", lambda part: F.array(part["high"], part["low"])))
    return collected.select(*keys, F.coalesce("_endless", neumaier_fold(flat)).alias(name))
