"""Grouped measures. All of them combine rows before the shuffle, so a hot key reaches its task as partial sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.numbers import exact, flag
from sheaf.functions.text import _col, strip, token_count
from sheaf.sources.lines import RETAIL_FIELDS, RETAIL_HEADER, Records, drop_header, parse_records


def measures(
    df: DataFrame,
    keys: Sequence[str],
    count: str | None = None,
    sums: Mapping[str, Column | str] | None = None,
    maxima: Mapping[str, Column | str] | None = None,
    means: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Row count, sums, maxima and means per key in one pass; each mapping goes from result name to expression."""
    found = [F.count(F.lit(1)).alias(count)] if count else []
    found += [F.sum(_col(c)).alias(name) for name, c in (sums or {}).items()]
    found += [F.max(_col(c)).alias(name) for name, c in (maxima or {}).items()]
    found += [F.avg(_col(c)).alias(name) for name, c in (means or {}).items()]
    return df.groupBy(*keys).agg(*found)


def sum_by(df: DataFrame, keys: Sequence[str], value: Column | str, name: str = "total") -> DataFrame:
    """One sum per key (chosen measure for invoices: total quantity)."""
    return measures(df, keys, sums={name: value})


def sum_and_count_by(
    df: DataFrame, keys: Sequence[str], value: Column | str, total: str = "total", count: str = "n"
) -> DataFrame:
    """Sum and number of rows per key (chosen pair of measures)."""
    return measures(df, keys, count=count, sums={total: value}).select(*keys, total, count)


def pair_sums_by(
    df: DataFrame, keys: Sequence[str], first: Column | str, second: Column | str, names=("first", "second")
) -> DataFrame:
    """Element-wise sum of a pair of numbers per key."""
    return measures(df, keys, sums={names[0]: first, names[1]: second})


def product_sums_by(df: DataFrame, keys: Sequence[str], left: Column | str, right: Column | str) -> DataFrame:
    """``(keys, total, n)``: per key, the sum of a product and the number of rows.

    Products of whole numbers and their sum are DECIMAL(38,0), which does not overflow where BIGINT would.
    """
    product = exact(df, left) * exact(df, right)
    whole = df.select(product.alias("p")).schema["p"].dataType.typeName() == "decimal"
    found = sum_and_count_by(df, keys, product)
    return found.withColumn("total", F.col("total").cast("decimal(38,0)")) if whole else found


def ratio_by(df: DataFrame, keys: Sequence[str], value: Column | str, name: str = "ratio") -> DataFrame:
    """Total of a value over its number of rows, as DOUBLE, per key (chosen ratio: the mean)."""
    return df.groupBy(*keys).agg((F.sum(_col(value)).cast("double") / F.count(F.lit(1))).alias(name))


def mean_and_max_by(
    df: DataFrame, keys: Sequence[str], mean_of: Column | str, max_of: Column | str, names=("mean", "max")
) -> DataFrame:
    """Mean of one expression and maximum of another per key."""
    return measures(df, keys, means={names[0]: mean_of}, maxima={names[1]: max_of}).select(*keys, *names)


def state_profile(cities: DataFrame) -> DataFrame:
    """``(state, avg_population, max_zips)`` of the cities of each state."""
    return mean_and_max_by(cities, ["state"], "population", token_count("zips"), ("avg_population", "max_zips"))


def city_measures(cities: DataFrame) -> DataFrame:
    """``(state, num_cities, population, max_zips)`` (chosen triple of measures)."""
    return measures(
        cities,
        ["state"],
        count="num_cities",
        sums={"population": "population"},
        maxima={"max_zips": token_count("zips")},
    )


def two_step_totals(
    df: DataFrame, outer: Sequence[str], inner: Sequence[str], value: Column | str, total: str, count: str
) -> DataFrame:
    """Sum per (outer, inner) key, then per outer key the sum of the sums and the number of inner keys."""
    per_inner = df.groupBy(*outer, *inner).agg(F.sum(_col(value)).alias(total))
    return per_inner.groupBy(*outer).agg(F.sum(total).alias(total), F.count(F.lit(1)).alias(count))


def sales_records(lines: DataFrame, column: str = "value") -> Records:
    """Retail lines without headers: sales with a whole quantity, and the rejects with a reason."""
    body = drop_header(lines, RETAIL_HEADER, column)
    return parse_records(body, RETAIL_FIELDS, ("quantity",), column=column, required=("quantity",))


def customer_totals(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(customer, total_quantity, num_orders)`` of retail lines; headers are skipped.

    Lines that :func:`sales_records` rejects do not count. A blank customer is a customer like any other.
    """
    sales = sales_records(lines, column).good.select(strip("customer").alias("customer"), "invoice", "quantity")
    return two_step_totals(sales, ["customer"], ["invoice"], "quantity", "total_quantity", "num_orders")


def small_member_report(
    df: DataFrame,
    outer: str,
    inner: str,
    size: Column | str,
    is_small: Column,
    max_small: int = 2,
    names=("members", "total_size", "inner_groups_with_few_small"),
) -> DataFrame:
    """Two-level report: per outer group its rows, their total size and the inner groups with few small rows.

    Rows without outer key, inner key or size are left out. An inner group counts when at most ``max_small`` of
    its rows are small.
    """
    members, total_size, few_small = names
    rows = df.select(F.col(outer), F.col(inner), _col(size).alias("_size"), flag(is_small).alias("_small"))
    per_inner = (
        rows.dropna(subset=[outer, inner, "_size"])
        .groupBy(outer, inner)
        .agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_size"), F.sum("_small").alias("_small")
        )
    )
    return per_inner.groupBy(outer).agg(
        F.sum("_rows").alias(members),
        F.sum("_size").alias(total_size),
        F.sum(flag(F.col("_small") <= max_small).cast("bigint")).alias(few_small),
    )


def small_county_report(cities: DataFrame, max_zips: int = 1, max_small: int = 2) -> DataFrame:
    """``(state, num_cities, total_population, num_counties_le_2_small)``.

    A city is small with at most ``max_zips`` zip codes; no zip codes at all counts as small.
    """
    return small_member_report(
        cities,
        "state",
        "county",
        "population",
        token_count("zips") <= max_zips,
        max_small,
        ("num_cities", "total_population", "num_counties_le_2_small"),
    )


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without repetition."""
    return df.select(*columns).distinct() if columns else df.distinct()


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Number of rows, as a frame of one row."""
    return df.agg(F.count(F.lit(1)).alias(name))
