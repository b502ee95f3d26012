"""Joins on named keys, null-key normalisation and the country order report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.numbers import exact
from sheaf.functions.text import _col
from sheaf.operators.skew import SLICE_ROWS, balanced_join, heavy_keys, hot_keys, key_hash

# Fixed value: what a missing key is replaced by.
BLANK_KEY = "blank"


def join_chain(first: DataFrame, *others: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Inner joins one after the other, each on its own named keys, which appear once in the result."""
    joined = first
    for other, keys in others:
        joined = joined.join(other, list(keys), "inner")
    return joined


def join_skewed_chain(
    first: DataFrame,
    *others: tuple[DataFrame, Sequence[str]],
    spread: Sequence[str],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """:func:`join_chain` in which rows of heavy keys of ``first`` are spread over many tasks.

    One pass over ``first`` sketches the heavy hitters of every key set that it has (:func:`skew.heavy_keys`), without
    shuffling or counting its rows by key. In each join, the rows of a heavy key get a slice from a hash of ``spread``,
    columns of ``first`` that tell the rows of one key apart, and the other side's rows are repeated per slice. Keys that
    a later table brings in are left to adaptive execution. The rows are those of :func:`join_chain`; missing keys match
    nothing.
    """
    known = {c.lower() for c in first.columns}
    own = [list(keys) for _, keys in others if known >= {k.lower() for k in keys}]
    heavy = dict(zip(map(tuple, own), heavy_keys(first, own, slice_rows))) if own else {}
    joined = first
    for other, keys in others:
        hot = heavy.get(tuple(keys))
        if hot is None:
            joined = joined.join(other, list(keys), "inner")
            continue
        hashed = [frame.withColumn("_key", key_hash(keys)) for frame in (joined, other)]
        columns = [*joined.columns, *[c for c in other.columns if c not in keys]]
        sliced = balanced_join(*hashed, ["_key", *keys], spread, hot, hot_by=["_key"], slice_rows=slice_rows)
        order = [*keys, *[c for c in columns if c not in keys]]
        joined = sliced.select(*order)
    return joined


def fill_null_keys(df: DataFrame, keys: Sequence[str], fill: str = BLANK_KEY) -> DataFrame:
    """Replace missing keys by a fixed text."""
    return df.na.fill(fill, list(keys))


def join_filled_keys(
    large: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    fill: str = BLANK_KEY,
    other_spread: Sequence[str] = (),
    hot: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Inner join in which a missing key matches a missing key and the literal fill text.

    All missing keys become one key, which is why its rows are spread (:func:`balanced_join`), on both sides if
    ``other_spread`` is given. Every row with that key on one side meets every such row on the other: combine rows
    first where only totals are needed. ``hot`` names the hot keys of the filled ``large``.
    """
    return balanced_join(
        fill_null_keys(large, keys, fill),
        fill_null_keys(other, keys, fill),
        keys,
        spread,
        hot,
        other_spread,
        slice_rows=slice_rows,
    )


def order_totals(items: DataFrame, amount: Column | None = None) -> DataFrame:
    """``(invoice_no, order_total)``: quantity times unit price, summed per invoice."""
    if amount is None:
        amount = F.col("quantity") * F.col("unit_price")
    return items.groupBy("invoice_no").agg(F.sum(amount).alias("order_total"))


def country_order_report(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    amount: Column | None = None,
    fill: str = BLANK_KEY,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``(country, num_orders, avg_order_amount)`` of orders that have both a customer and items.

    Missing customer ids on either side become one key. Several customers with one id each count the order
    towards the average, while ``num_orders`` counts invoices once per country.

    Rows are combined before they meet: customers per (id, country), and orders per customer, so that the blank
    key is one row against one row per country. Only an invoice listed under several customers could be counted
    twice that way; those invoices are joined customer by customer, invoices and customers with more than
    ``slice_rows`` rows cut into slices.
    """
    people = (
        fill_null_keys(customers, ["customer_id"], fill)
        .groupBy("customer_id", "country")
        .agg(F.count(F.lit(1)).alias("people"))
    )
    listed = (
        fill_null_keys(orders, ["customer_id"], fill)
        .where(F.col("invoice_no").isNotNull())
        .groupBy("invoice_no", "customer_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    per_invoice = listed.groupBy("invoice_no").agg(
        F.min("customer_id").alias("low"), F.count(F.lit(1)).alias("owners"), F.sum("rows").alias("rows")
    )
    # Always true: it keeps all three columns in use, so that the branches below share one shuffle.
    per_invoice = per_invoice.where(F.col("low").isNotNull() & (F.col("rows") >= F.col("owners")))
    invoices = per_invoice.join(order_totals(items, amount), ["invoice_no"], "inner")
    total = exact(invoices, "order_total")
    counted = F.when(F.col("order_total").isNotNull(), F.col("rows"))
    per_customer = (
        invoices.where(F.col("owners") == 1)
        .groupBy(F.col("low").alias("customer_id"))
        .agg(
            F.count(F.lit(1)).alias("invoices"),
            F.sum(total * F.col("rows")).alias("spent"),
            F.sum(counted).alias("counted"),
        )
        .join(people, ["customer_id"], "inner")
        .select(
            "country", "invoices", (F.col("spent") * F.col("people")).alias("spent"), F.col("counted") * F.col("people")
        )
    )
    shared = invoices.where(F.col("owners") > 1).select("invoice_no", total.alias("order_total"))
    crowded = hot_keys(per_invoice, ["invoice_no"], "owners", slice_rows)
    spent = F.col("order_total") * F.col("rows") * F.col("people")
    in_shared = balanced_join(listed, shared, ["invoice_no"], ["customer_id"], crowded)
    # an upper bound for the rows of a customer in shared invoices; it uses all columns, so that the shuffle is shared
    busy = hot_keys(listed.groupBy("customer_id").agg(F.sum("rows").alias("rows")), ["customer_id"], slice_rows=slice_rows)
    per_country = (
        balanced_join(in_shared, people, ["customer_id"], ["invoice_no"], busy)
        .groupBy("country")
        .agg(
            F.count_distinct("invoice_no").alias("invoices"),
            F.sum(spent).alias("spent"),
            F.sum(F.when(F.col("order_total").isNotNull(), F.col("rows") * F.col("people"))).alias("counted"),
        )
    )
    return (
        per_customer.toDF("country", "invoices", "spent", "counted")
        .union(per_country)
        .groupBy("country")
        .agg(
            F.sum("invoices").alias("num_orders"),
            F.try_divide(F.sum("spent").cast("double"), F.sum("counted")).alias("avg_order_amount"),
        )
    )


def count_distinct_by(df: DataFrame, keys: Sequence[str], value: Column | str, name: str = "n_distinct") -> DataFrame:
    """Number of different values per key."""
    return df.groupBy(*keys).agg(F.count_distinct(_col(value)).alias(name))
