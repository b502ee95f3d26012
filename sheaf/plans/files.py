"""Queries that write the test tables as files and read them back.

Each run writes to a folder of its own under the shared folder, since a lost task may write its files again.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators import joins, keyed, quality, words
from sheaf.plans import registry as r
from sheaf.plans import tables as t
from sheaf.session import shared_folder
from sheaf.sources import lines as src
from sheaf.sources import sinks, typed

FILES = 8
ORDERS = "order_key BIGINT, price DOUBLE, day DATE, note STRING"


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid4().hex}"


def event_files(spark: SparkSession, folder: str) -> list[str]:
    """Event lines as text, in the order of their ids, one folder with one file for each of ``FILES`` parts."""
    path = new_folder(spark)
    part = F.pmod(F.col("event_id"), F.lit(FILES)).cast("int")
    lines = t.event_lines(spark, folder).select("event_id", part.alias("part"), "value")
    sorted_lines = lines.repartition(FILES, "part").sortWithinPartitions("part", "event_id")
    sorted_lines.select("part", "value").write.partitionBy("part").text(path)
    return [f"{path}/part={number}" for number in range(FILES)]


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as comma-separated rows with quotes and line breaks in a field; some are damaged."""
    key = F.col("o_orderkey")
    note = F.concat(F.lit('"said ""'), F.col("o_orderpriority"), F.lit('"", then'), F.lit("\n"), F.col("o_orderstatus"), F.lit('"'))
    shown_key = F.when(key % 13 == 0, F.lit("")).otherwise(key.cast("string"))
    price = F.when(key % 7 == 0, F.lit("abc")).otherwise(F.round(F.col("o_totalprice")).cast("bigint").cast("string"))
    day = F.when(key % 17 == 0, F.lit("2020-13-01")).otherwise(F.col("o_orderdate").cast("date").cast("string"))
    whole = F.concat_ws(",", shown_key, price, day, note)
    value = F.when(key % 11 == 0, F.concat_ws(",", shown_key, price)).otherwise(whole)
    return t.table(spark, folder, "orders").select(value.alias("value"))


def _order_files(spark: SparkSession, folder: str):
    path = new_folder(spark)
    order_rows(spark, folder).repartition(FILES).write.text(path)
    return typed.read_typed(spark, path, schema=ORDERS, multiline=True, required=["order_key"])


SQL_ORDER_ROWS = """SELECT o_orderkey % 11 = 0 AS short,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS k,
  CASE WHEN o_orderkey % 7 = 0 THEN 'abc' ELSE CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) END AS p,
  CASE WHEN o_orderkey % 17 = 0 THEN '2020-13-01' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d,
  'said "' || o_orderpriority || '", then' || chr(10) || o_orderstatus AS n FROM orders"""
SQL_ORDER_REASON = """CASE WHEN short THEN 'field count' WHEN k IS NULL THEN 'missing: order_key'
  WHEN p = 'abc' THEN 'not a double: price' WHEN d = '2020-13-01' THEN 'not a date: day' END"""


@r.query(r.SQL["word_count"])
def word_count_of_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    t.table(spark, folder, "documents").where("text IS NOT NULL").select("text").repartition(FILES).write.text(path)
    return words.word_count(src.read_lines(spark, path), "value")


@r.query(
    f"""SELECT CAST(event_id % {FILES} AS INTEGER) AS part, count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_characters
FROM ({r.SQL_EVENT_LINES}) GROUP BY 1"""
)
def lines_per_file(spark: SparkSession, folder: str) -> DataFrame:
    """Several files as one input; each line knows the file it is from."""
    lines = src.read_lines_with_files(spark, *event_files(spark, folder))
    part = F.regexp_extract("path", r"/part=(\d+)/", 1).cast("int").alias("part")
    return lines.groupBy(part).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_characters"))


@r.query(
    f"""SELECT CAST(event_id % {FILES} AS INTEGER) AS part, line_number, value AS line, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id % {FILES} ORDER BY event_id) AS line_number FROM ({r.SQL_EVENT_LINES}))
  JOIN ({r.SQL["key_value_violations"].replace("value, CASE", "CASE")}) USING (event_id)"""
)
def file_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Faulty lines of files with their numbers."""
    found = quality.check_files(spark, *event_files(spark, folder), names=r"\.txt$", with_path=True)
    part = F.regexp_extract("path", r"/part=(\d+)/", 1).cast("int").alias("part")
    return found.select(part, "line_number", "line", "reason")


@r.query(
    f"""SELECT CAST(k AS BIGINT) AS order_key, CAST(p AS DOUBLE) AS price, d AS day, n AS note
FROM (SELECT *, {SQL_ORDER_REASON} AS reason FROM ({SQL_ORDER_ROWS})) WHERE reason IS NULL"""
)
def typed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _order_files(spark, folder).good.withColumn("day", F.col("day").cast("string"))


@r.query(
    f"""SELECT CASE WHEN short THEN coalesce(k, '') || ',' || p ELSE coalesce(k, '') || ',' || p || ',' || d || ',' || n END AS line, reason
FROM (SELECT *, {SQL_ORDER_REASON} AS reason FROM ({SQL_ORDER_ROWS})) WHERE reason IS NOT NULL"""
)
def typed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _order_files(spark, folder).rejects


@r.query(
    """SELECT o_orderkey AS invoice_no, CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS country, o_totalprice AS price
FROM customer JOIN orders ON c_custkey = o_custkey"""
)
def join_of_csv_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables as files with a header line, read with their types and joined."""
    path = new_folder(spark)
    customers = t.table(spark, folder, "customer").selectExpr("c_custkey AS customer_id", "c_mktsegment AS country")
    orders = t.table(spark, folder, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice")
    for name, table in (("customers", customers), ("orders", orders)):
        table.repartition(FILES).write.csv(f"{path}/{name}", header=True)
    schemas = {"customers": "customer_id STRING, country STRING", "orders": "invoice_no BIGINT, customer_id STRING, price DOUBLE"}
    tables = typed.read_typed_tables(spark, path, schemas)
    joined = joins.join_chain(tables["orders"].good, (tables["customers"].good, ["customer_id"]))
    return joined.select("invoice_no", "customer_id", "country", "price")


def _refused(write, df: DataFrame, path: str) -> bool:
    """Whether a second write to the same place fails and leaves the first one as it is."""
    try:
        write(df, path)
    except AnalysisException:
        return True
    return False


@r.query("SELECT CAST(l_suppkey AS BIGINT) AS k, CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS n FROM lineitem GROUP BY 1")
def csv_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of CSV files that replaces an earlier result."""
    path = new_folder(spark)
    items = t.table(spark, folder, "lineitem")
    sinks.write_csv(keyed.sum_and_count_by(items, ["l_partkey"], "l_linenumber"), path)
    sinks.write_csv(keyed.sum_and_count_by(items, ["l_suppkey"], "l_linenumber"), path)
    return src.read_delimited(spark, path, "k BIGINT, total BIGINT, n BIGINT", sep=",")


@r.query(f"SELECT value, true AS refused FROM ({r.SQL['tuple_lines']})")
def tuples_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of tuples in a folder that a second write may not touch."""
    path = new_folder(spark)
    customers = t.table(spark, folder, "customer")
    sums = keyed.measures(customers, ["c_mktsegment"], count="n", sums={"keys": "c_custkey"})
    sinks.write_tuples(sums, path, nested=["n", "keys"])
    refused = _refused(sinks.write_tuples, customers, path)
    return src.read_lines(spark, path).withColumn("refused", F.lit(refused))


@r.query("SELECT CAST(count(*) AS VARCHAR) AS value, true AS refused, 1 AS n_files FROM lineitem")
def scalar_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """One number in one file."""
    path = new_folder(spark)
    total = keyed.row_count(t.table(spark, folder, "lineitem"), "n")
    sinks.write_scalar(total, path)
    refused = _refused(sinks.write_scalar, total, path)
    lines = src.read_lines_with_files(spark, path)
    n_files = lines.select("path").distinct().count()
    return lines.select("value", F.lit(refused).alias("refused"), F.lit(n_files).alias("n_files"))


@r.query(r.SQL["key_value_lines"])
def key_values_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Key/value lines that replace an earlier result."""
    path = new_folder(spark)
    customers = t.table(spark, folder, "customer")
    sums = keyed.measures(customers, ["c_mktsegment", "c_nationkey"], count="n", sums={"keys": "c_custkey"})
    sinks.write_key_values(customers, ["c_custkey"], ["c_name"], path)
    sinks.write_key_values(sums, ["c_mktsegment", "c_nationkey"], ["n", "keys"], path)
    return src.read_lines(spark, path)


@r.query(r.SQL["edges_of_lines"])
def edges_of_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    t.edge_lines(spark, folder).repartition(FILES).write.text(path)
    return src.read_edges(spark, path)
