"""Views of the test tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.text import with_once


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str) -> Column:
    """An amount as whole cents, so that sums are exact in every order."""
    return F.floor(F.col(column) * 100 + 0.5).cast("bigint")


def whole(column: str) -> Column:
    return F.col(column).cast("bigint")


def document_cities(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as cities: language as state, source as county, length as population, words as zip codes."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("state"),
        F.col("source").alias("county"),
        F.col("n_chars").alias("population"),
        F.col("text").alias("zips"),
    )


def patchy_cities(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`document_cities` in which some states, counties and populations are missing."""
    return document_cities(spark, folder).select(
        "id",
        F.when(F.col("id") % 11 != 0, F.col("state")).alias("state"),
        F.when(F.col("id") % 7 != 0, F.col("county")).alias("county"),
        F.when(F.col("id") % 5 != 0, F.col("population")).alias("population"),
        "zips",
    )


def customer_countries(spark: SparkSession, folder: str, nameless: bool = False) -> DataFrame:
    """``(customer_id, country)``; with ``nameless``, customers in debt lose their id."""
    key = F.col("c_custkey").cast("string")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.when(F.col("c_acctbal") >= 0, key) if nameless else key).alias("customer_id"),
            F.col("n_name").alias("country"),
        )
    )


def invoices(spark: SparkSession, folder: str, nameless: bool = False) -> DataFrame:
    """``(invoice_no, customer_id)``; with ``nameless``, pending orders lose their customer."""
    key = F.col("o_custkey").cast("string")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("invoice_no"),
        (F.when(F.col("o_orderstatus") != "P", key) if nameless else key).alias("customer_id"),
    )


def shared_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`invoices` in which some are listed under two customers, one of them missing or not, some twice, some under none."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    nobody = F.lit(None).cast("string")
    second = F.when(key % 3 != 0, (F.col("o_custkey") + 1).cast("string"))
    owners = (
        F.when(key % 10 == 0, F.array(customer, second))
        .when(key % 7 == 0, F.array(nobody))
        .when(key % 13 == 0, F.array(customer, customer))
        .otherwise(F.array(customer))
    )
    return table(spark, folder, "orders").select(key.alias("invoice_no"), F.explode(owners).alias("customer_id"))


def edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The edges of :func:`part_supplier_edges` as lines, some with one end only, some with a third field."""
    line = F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    value = (
        F.when(F.col("l_quantity") == 50, F.col("l_partkey").cast("string"))
        .when(F.col("l_quantity") == 49, F.concat(line, F.lit(" x")))
        .otherwise(line)
    )
    return table(spark, folder, "lineitem").select(value.alias("value"))


def invoice_items(spark: SparkSession, folder: str) -> DataFrame:
    """``(invoice_no, amount)``, the amount in cents."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("invoice_no"), cents("l_extendedprice").alias("amount")
    )


def part_supplier_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The two id columns of the line items read as the ends of edges; suppliers are vertices with many edges."""
    return table(spark, folder, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def retail_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as tab-separated retail lines, some replaced by header lines, one field short or with bad quantities."""
    tab = F.lit("\t")
    quantity = (
        F.when(F.col("l_quantity") == 48, F.lit("abc"))
        .when(F.col("l_quantity") == 47, F.lit(""))
        .when(F.col("l_quantity") == 46, F.lit("99999999999999999999"))
        .otherwise(whole("l_quantity").cast("string"))
    )
    front = F.concat(F.col("l_orderkey"), tab, F.col("l_partkey"), tab, quantity, tab)
    line = F.concat(front, F.col("l_shipdate").cast("date").cast("string"), tab, F.lit(" "), F.col("l_suppkey"))
    value = (
        F.when(F.col("l_quantity") == 50, F.lit("InvoiceNo\titem\tquantity\tdate\tcustomer"))
        .when(F.col("l_quantity") == 49, F.concat(front, F.col("l_suppkey")))
        .otherwise(line)
    )
    return with_once(table(spark, folder, "lineitem"), "value", value).select("value")


def city_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as city lines, damaged in several ways depending on their segment and nation."""
    tab = F.lit("\t")
    population = (
        F.when(F.col("c_nationkey") == 0, F.lit("abc"))
        .when(F.col("c_nationkey") == 1, F.lit(" 12 "))
        .when(F.col("c_nationkey") == 2, F.lit("+5"))
        .when(F.col("c_nationkey") == 3, F.lit(""))
        .when(F.col("c_nationkey") == 4, F.lit("-7"))
        .when(F.col("c_nationkey") == 6, F.lit("99999999999999999999"))
        .otherwise(F.col("c_custkey").cast("string"))
    )
    nation, customer = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    zips = (
        F.when(F.col("c_acctbal") < 0, F.lit(""))
        .when(F.col("c_nationkey") < 12, nation)
        .otherwise(F.concat_ws(" ", nation, customer))
    )
    front = F.concat(F.col("c_name"), tab, F.col("c_mktsegment"), tab, F.lit("County"), tab, population, tab, zips)
    short = (F.col("c_nationkey") == 5) & (F.col("c_acctbal") < 0)
    value = F.when(short, front).otherwise(F.concat(front, tab, F.col("c_custkey")))
    return with_once(table(spark, folder, "customer"), "value", value).select("value")


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as key/value lines; the lines of some event types and users are damaged."""
    kind, props, tab = F.col("event_type"), F.col("props"), F.lit("\t")
    payload = (
        F.when(kind == "error", F.concat(props, F.lit(" x")))
        .when(kind == "click", F.concat(props, props))
        .otherwise(props)
    )
    key = F.when(F.col("amount") < 1, kind).otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    line = (
        F.when(F.col("user_id") == 7, F.concat(key, payload))
        .when(F.col("user_id") == 8, F.concat(key, tab, payload, tab))
        .otherwise(F.concat(key, tab, payload))
    )
    events = table(spark, folder, "events").withColumnRenamed("value", "amount")
    return with_once(events, "value", line).select("event_id", "value")
