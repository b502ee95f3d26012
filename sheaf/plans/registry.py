"""The queries over the test tables, each next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import bucket, numbers, text
from sheaf.operators import exactsums, folds, graph, joins, keyed, products, quality, words
from sheaf.plans import tables as t
from sheaf.sources import lines as src
from sheaf.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL counterpart if it has one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def sql_tokens(column: str) -> str:
    return rf"list_filter(regexp_split_to_array({column}, '\s+'), lambda x: x <> '')"


def sql_cents(column: str) -> str:
    return f"CAST(floor({column} * 100 + 0.5) AS BIGINT)"


SQL_CITIES = "SELECT lang AS state, source AS county, n_chars AS population, text AS zips FROM documents"
SQL_EDGES = "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem"
SQL_CANONICAL = f"SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM ({SQL_EDGES}) WHERE src <> dst"
SQL_REDUNDANT = f"SELECT src, dst FROM ({SQL_CANONICAL}) UNION ALL SELECT dst AS src, src AS dst FROM ({SQL_CANONICAL})"
SQL_RETAIL = """
SELECT CASE WHEN l_quantity = 50 THEN 'InvoiceNo' || chr(9) || 'item' || chr(9) || 'quantity' || chr(9) || 'date' || chr(9) || 'customer'
  WHEN l_quantity = 49 THEN l_orderkey || chr(9) || l_partkey || chr(9) || CAST(l_quantity AS BIGINT) || chr(9) || l_suppkey
  ELSE l_orderkey || chr(9) || l_partkey || chr(9) || CASE CAST(l_quantity AS BIGINT) WHEN 48 THEN 'abc' WHEN 47 THEN ''
      WHEN 46 THEN '99999999999999999999' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END || chr(9)
    || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || chr(9) || ' ' || l_suppkey END AS value
FROM lineitem"""
SQL_SALES = f"SELECT string_split(value, chr(9)) AS f FROM ({SQL_RETAIL}) WHERE NOT starts_with(value, 'InvoiceNo')"
SQL_CITY_LINES = """
SELECT string_split(CASE WHEN c_nationkey = 5 AND c_acctbal < 0 THEN front ELSE front || chr(9) || c_custkey END, chr(9)) AS f FROM (
  SELECT c_nationkey, c_acctbal, c_custkey, c_name || chr(9) || c_mktsegment || chr(9) || 'County' || chr(9)
    || CASE c_nationkey WHEN 0 THEN 'abc' WHEN 1 THEN ' 12 ' WHEN 2 THEN '+5' WHEN 3 THEN '' WHEN 4 THEN '-7'
       WHEN 6 THEN '99999999999999999999' ELSE CAST(c_custkey AS VARCHAR) END
    || chr(9) || CASE WHEN c_acctbal < 0 THEN '' WHEN c_nationkey < 12 THEN CAST(c_nationkey AS VARCHAR)
       ELSE c_nationkey || ' ' || c_custkey END AS front FROM customer)"""
SQL_GOOD_CITY = """len(f) = 6 AND regexp_full_match(trim(f[4]), '(-?[0-9]+)?') AND regexp_full_match(trim(f[6]), '(-?[0-9]+)?')
  AND (trim(f[4]) = '' OR TRY_CAST(trim(f[4]) AS BIGINT) IS NOT NULL)"""
SQL_EVENT_LINES = """
SELECT event_id, CASE user_id WHEN 7 THEN k || v WHEN 8 THEN k || chr(9) || v || chr(9) ELSE k || chr(9) || v END AS value,
  k, v, user_id FROM (
  SELECT event_id, user_id, CASE WHEN value < 1 THEN event_type ELSE '"' || event_type || '"' END AS k,
    CASE event_type WHEN 'error' THEN props || ' x' WHEN 'click' THEN props || props ELSE props END AS v FROM events)"""
SQL_PEOPLE = "SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name AS country, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey"
SQL_TOTALS = f"SELECT l_orderkey AS invoice_no, CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) AS order_total FROM lineitem GROUP BY 1"


# --- text ---------------------------------------------------------------------------------------------------------


@query(
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""
)
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_count(t.table(spark, folder, "documents"), "text")


@query(f"SELECT CAST(len({sql_tokens('text')}) AS INT) AS tokens, count(*) AS texts FROM conversations GROUP BY 1")
def token_count_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return words.histogram(t.table(spark, folder, "conversations"), text.token_count("text"), "tokens", "texts")


@query(f"SELECT CAST(len({sql_tokens('zips')}) AS INT) AS num_zips, count(*) AS num_cities FROM ({SQL_CITIES}) GROUP BY 1")
def zip_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return words.zip_histogram(t.document_cities(spark, folder))


@query(f"SELECT conv_id, turn, CAST(len({sql_tokens('text')}) AS INT) AS num_zips FROM conversations")
def named_zip_counter(spark: SparkSession, folder: str) -> DataFrame:
    text.register_zip_counter(spark)
    return t.table(spark, folder, "conversations").selectExpr("conv_id", "turn", "zipCounter(text) AS num_zips")


@query(
    f"""SELECT word, CAST(sum(CASE WHEN size > 1 THEN size ELSE 0 END) AS BIGINT) AS weight FROM (
  SELECT unnest(words) AS word, len(words) AS size FROM (
    SELECT {sql_tokens('line')} AS words FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)))
GROUP BY word"""
)
def line_weights(spark: SparkSession, folder: str) -> DataFrame:
    return words.line_weights(words.lines_of(t.table(spark, folder, "documents"), "text"))


# --- records ------------------------------------------------------------------------------------------------------


@query(
    f"""SELECT f[1] AS name, f[2] AS state, f[3] AS county, CAST(nullif(trim(f[4]), '') AS BIGINT) AS population,
  f[5] AS zips, CAST(nullif(trim(f[6]), '') AS BIGINT) AS id FROM ({SQL_CITY_LINES}) WHERE {SQL_GOOD_CITY}"""
)
def good_records(spark: SparkSession, folder: str) -> DataFrame:
    return src.parse_records(t.city_lines(spark, folder)).good


@query(
    f"""SELECT array_to_string(f, chr(9)) AS line,
  CASE WHEN len(f) <> 6 THEN 'field count' WHEN length(f[4]) = 20 THEN 'out of range: population'
    ELSE 'not an integer: population' END AS reason
FROM ({SQL_CITY_LINES}) WHERE NOT ({SQL_GOOD_CITY})"""
)
def rejected_records(spark: SparkSession, folder: str) -> DataFrame:
    return src.parse_records(t.city_lines(spark, folder)).rejects


@query(
    f"""SELECT len({sql_tokens('f[5]')})::INT AS num_zips, count(*) AS num_cities
FROM ({SQL_CITY_LINES}) WHERE {SQL_GOOD_CITY} GROUP BY 1"""
)
def zip_histogram_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return words.zip_histogram(src.parse_records(t.city_lines(spark, folder)).good)


@query(f"SELECT value FROM ({SQL_RETAIL}) WHERE NOT starts_with(value, 'InvoiceNo')")
def header_dropped(spark: SparkSession, folder: str) -> DataFrame:
    return src.drop_header(t.retail_lines(spark, folder), src.RETAIL_HEADER)


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS id, CAST({sql_cents('p_retailprice')} AS DOUBLE) AS price FROM part")
def prices_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    parts = t.table(spark, folder, "part")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_brand", t.cents("p_retailprice").cast("string"))
    fields = parts.select(text.split_fields(line).alias("fields"))
    return fields.select(text.field("fields", 0).alias("id"), numbers.to_double(text.field("fields", 2)).alias("price"))


@query("SELECT unnest([CAST(p_partkey AS VARCHAR), p_brand]) AS item FROM part")
def flattened_fields(spark: SparkSession, folder: str) -> DataFrame:
    return src.flatten(t.table(spark, folder, "part"), "p_partkey", "p_brand")


@query("SELECT [CAST(p_partkey AS VARCHAR), p_brand][1] AS first, [CAST(p_partkey AS VARCHAR), p_brand][2] AS second FROM part")
def kept_fields(spark: SparkSession, folder: str) -> DataFrame:
    pair = F.array(F.col("p_partkey").cast("string"), F.col("p_brand"))
    kept = t.table(spark, folder, "part").select(pair.alias("pair"))
    return kept.select(text.field("pair", 0).alias("first"), text.field("pair", 1).alias("second"))


@query("SELECT * FROM documents ORDER BY doc_id LIMIT 10")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return src.preview(t.table(spark, folder, "documents"), 10, ["doc_id"])


@query(
    """SELECT '["' || c_mktsegment || '", ' || c_nationkey || ']' || chr(9) || '[' || count(*) || ', '
  || CAST(sum(c_custkey) AS BIGINT) || ']' AS value FROM customer GROUP BY c_mktsegment, c_nationkey"""
)
def key_value_lines(spark: SparkSession, folder: str) -> DataFrame:
    customers = t.table(spark, folder, "customer")
    sums = keyed.measures(customers, ["c_mktsegment", "c_nationkey"], count="n", sums={"keys": "c_custkey"})
    return sinks.key_value_lines(sums, ["c_mktsegment", "c_nationkey"], ["n", "keys"])


@query(
    """SELECT '(' || c_mktsegment || ',(' || count(*) || ',' || CAST(sum(c_custkey) AS BIGINT) || '))' AS value
FROM customer GROUP BY c_mktsegment"""
)
def tuple_lines(spark: SparkSession, folder: str) -> DataFrame:
    customers = t.table(spark, folder, "customer")
    sums = keyed.measures(customers, ["c_mktsegment"], count="n", sums={"keys": "c_custkey"})
    return sinks.tuple_lines(sums, nested=["n", "keys"])


@query("SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem WHERE l_quantity <> 50")
def edges_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return src.parse_edges(t.edge_lines(spark, folder)).good


@query("SELECT CAST(l_partkey AS VARCHAR) AS line, 'field count' AS reason FROM lineitem WHERE l_quantity = 50")
def rejected_edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    return src.parse_edges(t.edge_lines(spark, folder)).rejects


@query(
    f"""SELECT event_id, value, CASE WHEN user_id = 7 THEN 'no tab' WHEN user_id = 8 THEN 'more than one tab'
  WHEN NOT json_valid(k) THEN 'key is not JSON' ELSE 'value is not JSON' END AS reason
FROM ({SQL_EVENT_LINES}) WHERE user_id IN (7, 8) OR NOT json_valid(k) OR NOT json_valid(v)"""
)
def key_value_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.key_value_violations(t.event_lines(spark, folder))


def sql_bucket(text: str, buckets: int) -> str:
    """SHA-1 of a text modulo a number, the 160 bits taken in five parts."""
    return f"""list_reduce(list_prepend(0::BIGINT,
  [CAST(('0x' || substr(sha1({text}), i * 8 + 1, 8)) AS BIGINT) FOR i IN [0, 1, 2, 3, 4]]),
  lambda a, x: (a * (4294967296 % {buckets}) + x) % {buckets})"""


SQL_TEXT_KEY = "'seed|<class ' || chr(39) || 'str' || chr(39) || '>|' || event_type || '-' || user_id"
SQL_INTEGER_KEY = "'seed|<class ' || chr(39) || 'int' || chr(39) || '>|' || user_id"
SQL_LIST_KEY = (
    "'seed|<class ' || chr(39) || 'list' || chr(39) || '>|[' || chr(39) || event_type || chr(39) || ', ' || user_id || ']'"
)


@query(f"SELECT event_id, {sql_bucket(SQL_TEXT_KEY, 7)} AS bucket FROM events")
def stable_bucket(spark: SparkSession, folder: str) -> DataFrame:
    key = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    return t.table(spark, folder, "events").select("event_id", bucket.stable_bucket("seed", key, 7).alias("bucket"))


@query(f"SELECT event_id, {sql_bucket(SQL_INTEGER_KEY, 13)} AS bucket FROM events")
def stable_bucket_of_integers(spark: SparkSession, folder: str) -> DataFrame:
    number = bucket.stable_bucket("seed", "user_id", 13, bucket.INTEGER_KEY)
    return t.table(spark, folder, "events").select("event_id", number.alias("bucket"))


@query(f"SELECT event_id, {sql_bucket(SQL_LIST_KEY, 11)} AS bucket FROM events")
def stable_bucket_of_lists(spark: SparkSession, folder: str) -> DataFrame:
    key = bucket.list_key("event_type", "user_id", quoted=(True, False))
    number = bucket.stable_bucket("seed", key, 11, bucket.LIST_KEY)
    return t.table(spark, folder, "events").select("event_id", number.alias("bucket"))


# --- grouped measures ---------------------------------------------------------------------------------------------


@query(
    f"""SELECT state, CAST(sum(n) AS BIGINT) AS num_cities, CAST(sum(p) AS BIGINT) AS total_population,
  CAST(sum(CASE WHEN small <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS num_counties_le_2_small FROM (
  SELECT state, county, count(*) AS n, sum(population) AS p,
    sum(CASE WHEN len({sql_tokens('zips')}) <= 60 THEN 1 ELSE 0 END) AS small FROM ({SQL_CITIES}) GROUP BY state, county)
GROUP BY state"""
)
def small_county_report(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.small_county_report(t.document_cities(spark, folder), max_zips=60)


SQL_PATCHY = """SELECT CASE WHEN doc_id % 11 <> 0 THEN lang END AS state, CASE WHEN doc_id % 7 <> 0 THEN source END AS county,
  CASE WHEN doc_id % 5 <> 0 THEN n_chars END AS population, text AS zips FROM documents"""


@query(
    f"""SELECT state, CAST(sum(n) AS BIGINT) AS num_cities, CAST(sum(p) AS BIGINT) AS total_population,
  CAST(sum(CASE WHEN small <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS num_counties_le_2_small FROM (
  SELECT state, county, count(*) AS n, sum(population) AS p,
    sum(CASE WHEN len({sql_tokens('zips')}) <= 60 THEN 1 ELSE 0 END) AS small FROM ({SQL_PATCHY})
  WHERE state IS NOT NULL AND county IS NOT NULL AND population IS NOT NULL GROUP BY state, county)
GROUP BY state"""
)
def small_county_report_missing(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.small_county_report(t.patchy_cities(spark, folder), max_zips=60)


@query(
    f"""SELECT state, county, count(*) AS cities, CAST(sum(population) AS BIGINT) AS population,
  CAST(sum(CASE WHEN len({sql_tokens('zips')}) <= 60 THEN 1 ELSE 0 END) AS BIGINT) AS small
FROM ({SQL_CITIES}) GROUP BY state, county"""
)
def county_measures(spark: SparkSession, folder: str) -> DataFrame:
    small = numbers.flag(text.token_count("zips") <= 60)
    return keyed.measures(
        t.document_cities(spark, folder),
        ["state", "county"],
        count="cities",
        sums={"population": "population", "small": small},
    )


@query(
    f"""SELECT state, CAST(sum(population) AS DOUBLE) / count(*) AS avg_population,
  CAST(max(len({sql_tokens('zips')})) AS INT) AS max_zips FROM ({SQL_CITIES}) GROUP BY state"""
)
def state_profile(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.state_profile(t.document_cities(spark, folder))


@query(
    f"""SELECT state, count(*) AS num_cities, CAST(sum(population) AS BIGINT) AS population,
  CAST(max(len({sql_tokens('zips')})) AS INT) AS max_zips FROM ({SQL_CITIES}) GROUP BY state"""
)
def city_measures(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.city_measures(t.document_cities(spark, folder))


@query(
    f"""SELECT customer, CAST(sum(q) AS BIGINT) AS total_quantity, count(*) AS num_orders FROM (
  SELECT trim(f[5]) AS customer, f[1] AS invoice, sum(CAST(f[3] AS BIGINT)) AS q FROM ({SQL_SALES})
  WHERE len(f) = 5 AND TRY_CAST(f[3] AS BIGINT) IS NOT NULL GROUP BY 1, 2) GROUP BY customer"""
)
def customer_totals(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.customer_totals(t.retail_lines(spark, folder))


@query(
    f"""SELECT array_to_string(f, chr(9)) AS line, CASE WHEN len(f) <> 5 THEN 'field count' WHEN f[3] = 'abc' THEN 'not an integer: quantity'
  WHEN f[3] = '' THEN 'missing: quantity' ELSE 'out of range: quantity' END AS reason
FROM ({SQL_SALES}) WHERE len(f) <> 5 OR TRY_CAST(f[3] AS BIGINT) IS NULL"""
)
def rejected_sales(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.sales_records(t.retail_lines(spark, folder)).rejects


@query(
    """SELECT l_suppkey, CAST(sum(q) AS BIGINT) AS quantity, count(*) AS orders FROM (
  SELECT l_suppkey, l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1"""
)
def two_step_totals(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return keyed.two_step_totals(items, ["l_suppkey"], ["l_orderkey"], t.whole("l_quantity"), "quantity", "orders")


@query(
    """SELECT l_linestatus, l_returnflag, CAST(sum(l_linenumber * CAST(l_quantity AS BIGINT)) AS DECIMAL(38,0)) AS total,
  count(*) AS n FROM lineitem GROUP BY ALL"""
)
def product_sums(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return keyed.product_sums_by(items, ["l_linestatus", "l_returnflag"], "l_linenumber", t.whole("l_quantity"))


@query("SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def keyed_sum(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.sum_by(t.table(spark, folder, "lineitem"), ["l_orderkey"], t.whole("l_quantity"))


@query("SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM lineitem GROUP BY 1")
def keyed_sum_and_count(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.sum_and_count_by(t.table(spark, folder, "lineitem"), ["l_partkey"], t.whole("l_quantity"))


@query(
    """SELECT l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY 1"""
)
def pair_sums(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return keyed.pair_sums_by(items, ["l_suppkey"], "l_linenumber", t.whole("l_quantity"), ("lines", "quantity"))


@query(
    f"""SELECT l_returnflag, l_linestatus, CAST(sum({sql_cents('l_extendedprice')}) AS DOUBLE) / count(*) AS ratio
FROM lineitem GROUP BY ALL"""
)
def ratio_by_pair(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return keyed.ratio_by(items, ["l_returnflag", "l_linestatus"], t.cents("l_extendedprice"))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def distinct_count(spark: SparkSession, folder: str) -> DataFrame:
    return joins.count_distinct_by(t.table(spark, folder, "lineitem"), ["l_suppkey"], "l_partkey", "parts")


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.distinct_rows(t.table(spark, folder, "orders"), "o_custkey", "o_orderpriority")


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.row_count(t.table(spark, folder, "lineitem"))


# --- joins --------------------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, c_name, l_partkey, l_suppkey, l_quantity FROM customer
JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey"""
)
def three_table_join(spark: SparkSession, folder: str) -> DataFrame:
    customers = t.table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    orders = t.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    items = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_quantity"
    )
    return joins.join_chain(items, (orders, ["o_orderkey"]), (customers, ["o_custkey"]))


SQL_CHAIN = """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, s_name, p_name FROM lineitem
JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey"""


def _supplier_part_chain(spark: SparkSession, folder: str, slice_rows: int) -> DataFrame:
    items = t.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    suppliers = t.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    parts = t.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.join_skewed_chain(
        items,
        (suppliers, ["l_suppkey"]),
        (parts, ["l_partkey"]),
        spread=["l_orderkey", "l_linenumber"],
        slice_rows=slice_rows,
    )


@query(SQL_CHAIN)
def supplier_part_chain(spark: SparkSession, folder: str) -> DataFrame:
    return _supplier_part_chain(spark, folder, joins.SLICE_ROWS)


@query(SQL_CHAIN)
def supplier_part_chain_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return _supplier_part_chain(spark, folder, 20)


@query(SQL_TOTALS)
def order_totals(spark: SparkSession, folder: str) -> DataFrame:
    return joins.order_totals(t.invoice_items(spark, folder), F.col("amount"))


@query(
    f"""SELECT country, count(DISTINCT o_orderkey) AS num_orders,
  CAST(sum(order_total) AS DOUBLE) / count(*) AS avg_order_amount
FROM orders JOIN ({SQL_PEOPLE}) ON customer_id = CAST(o_custkey AS VARCHAR)
JOIN ({SQL_TOTALS}) ON invoice_no = o_orderkey GROUP BY country"""
)
def country_order_report(spark: SparkSession, folder: str) -> DataFrame:
    return _report(spark, folder, nameless=False)


@query(
    f"""SELECT country, count(DISTINCT o_orderkey) AS num_orders,
  CAST(sum(order_total) AS DOUBLE) / count(*) AS avg_order_amount
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) ELSE 'blank' END AS customer FROM orders)
JOIN ({SQL_PEOPLE}) ON CASE WHEN c_acctbal >= 0 THEN customer_id ELSE 'blank' END = customer
JOIN ({SQL_TOTALS}) ON invoice_no = o_orderkey GROUP BY country"""
)
def country_order_report_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _report(spark, folder, nameless=True)


def _report(spark: SparkSession, folder: str, nameless: bool) -> DataFrame:
    return joins.country_order_report(
        t.customer_countries(spark, folder, nameless),
        t.invoices(spark, folder, nameless),
        t.invoice_items(spark, folder),
        F.col("amount"),
    )


SQL_SHARED = """SELECT o_orderkey AS invoice_no, unnest(CASE WHEN o_orderkey % 10 = 0
    THEN [CAST(o_custkey AS VARCHAR), CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey + 1 AS VARCHAR) END]
  WHEN o_orderkey % 7 = 0 THEN [NULL] WHEN o_orderkey % 13 = 0 THEN [CAST(o_custkey AS VARCHAR), CAST(o_custkey AS VARCHAR)]
  ELSE [CAST(o_custkey AS VARCHAR)] END) AS customer FROM orders"""
SQL_SHARED_REPORT = f"""SELECT country, count(DISTINCT s.invoice_no) AS num_orders,
  CAST(sum(order_total) AS DOUBLE) / count(*) AS avg_order_amount
FROM ({SQL_SHARED}) s
JOIN ({SQL_PEOPLE}) ON CASE WHEN c_acctbal >= 0 THEN customer_id ELSE 'blank' END = coalesce(customer, 'blank')
JOIN ({SQL_TOTALS}) x ON x.invoice_no = s.invoice_no GROUP BY country"""


def _shared_report(spark: SparkSession, folder: str, **options) -> DataFrame:
    return joins.country_order_report(
        t.customer_countries(spark, folder, nameless=True),
        t.shared_invoices(spark, folder),
        t.invoice_items(spark, folder),
        F.col("amount"),
        **options,
    )


@query(SQL_SHARED_REPORT)
def country_order_report_shared(spark: SparkSession, folder: str) -> DataFrame:
    return _shared_report(spark, folder)


@query(SQL_SHARED_REPORT)
def country_order_report_shared_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return _shared_report(spark, folder, slice_rows=2)


SQL_NULL_KEYS = f"""SELECT customer_id, country, count(*) AS orders
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) ELSE 'blank' END AS customer_id FROM orders)
JOIN (SELECT DISTINCT CASE WHEN c_acctbal >= 0 THEN customer_id ELSE 'blank' END AS customer_id, country FROM ({SQL_PEOPLE}))
USING (customer_id) GROUP BY customer_id, country"""


def _null_key_join(spark: SparkSession, folder: str, **options) -> DataFrame:
    places = keyed.distinct_rows(t.customer_countries(spark, folder, nameless=True))
    orders = t.invoices(spark, folder, nameless=True)
    joined = joins.join_filled_keys(orders, places, ["customer_id"], ["invoice_no"], **options)
    return keyed.measures(joined, ["customer_id", "country"], count="orders")


@query(SQL_NULL_KEYS)
def null_key_join(spark: SparkSession, folder: str) -> DataFrame:
    return _null_key_join(spark, folder)


@query(SQL_NULL_KEYS)
def null_key_join_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """Keys with more than ten rows are cut on both sides."""
    return _null_key_join(spark, folder, other_spread=["country"], slice_rows=10)


# --- graph --------------------------------------------------------------------------------------------------------


@query(f"SELECT src, dst FROM ({SQL_EDGES}) WHERE src <> dst")
def edges_without_loops(spark: SparkSession, folder: str) -> DataFrame:
    return graph.drop_self_edges(t.part_supplier_edges(spark, folder))


@query(f"SELECT DISTINCT src, dst FROM ({SQL_EDGES} UNION ALL SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem)")
def redundant_edges(spark: SparkSession, folder: str) -> DataFrame:
    return graph.redundant_edges(t.part_supplier_edges(spark, folder))


@query(SQL_CANONICAL)
def canonical_edges(spark: SparkSession, folder: str) -> DataFrame:
    return graph.canonical_edges(t.part_supplier_edges(spark, folder))


@query(
    f"""SELECT p.dst AS mid, CAST(count(*) AS DECIMAL(38,0)) AS paths
FROM ({SQL_EDGES}) p JOIN ({SQL_EDGES}) q ON p.dst = q.src GROUP BY 1"""
)
def two_hop_counts(spark: SparkSession, folder: str) -> DataFrame:
    return graph.two_hop_counts(t.part_supplier_edges(spark, folder))


@query(
    f"""SELECT p.dst AS mid, CAST(count(*) AS DECIMAL(38,0)) AS paths
FROM ({SQL_REDUNDANT}) p JOIN ({SQL_REDUNDANT}) q ON p.dst = q.src AND p.src <> q.dst GROUP BY 1"""
)
def open_two_hop_counts(spark: SparkSession, folder: str) -> DataFrame:
    edges = graph.redundant_edges(graph.drop_self_edges(t.part_supplier_edges(spark, folder)))
    return graph.two_hop_counts(edges, include_degenerate=False)


@query(
    f"""SELECT e.src, e.dst, count(*) AS mids, CAST(sum(p.dst) AS BIGINT) AS mid_sum
FROM ({SQL_REDUNDANT}) p JOIN ({SQL_REDUNDANT}) q ON p.dst = q.src
JOIN ({SQL_REDUNDANT}) e ON e.src = p.src AND e.dst = q.dst GROUP BY e.src, e.dst"""
)
def closed_paths(spark: SparkSession, folder: str) -> DataFrame:
    paths = graph.closed_paths(t.part_supplier_edges(spark, folder))
    return keyed.measures(paths, ["src", "dst"], count="mids", sums={"mid_sum": "mid"})


SQL_TRIANGLES = f"""SELECT count(*) AS triangles FROM ({SQL_CANONICAL}) x JOIN ({SQL_CANONICAL}) y ON x.dst = y.src
JOIN ({SQL_CANONICAL}) z ON z.src = x.src AND z.dst = y.dst"""


@query(SQL_TRIANGLES)
def triangle_count(spark: SparkSession, folder: str) -> DataFrame:
    return graph.count_triangles(t.part_supplier_edges(spark, folder))


@query(SQL_TRIANGLES)
def triangle_count_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """Small slices, so that vertices with many edges are cut."""
    edges = t.part_supplier_edges(spark, folder)
    return graph.count_triangles(edges, edges_per_task=20_000)


@query(SQL_TRIANGLES)
def triangle_count_from_closed_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Paths along edges that point to the end with more neighbours, closed by such an edge: one for each triangle."""
    edges = graph.oriented_edges(t.part_supplier_edges(spark, folder)).select("src", "dst")
    return keyed.row_count(graph.close_paths(edges, graph.two_hop_paths(edges, closing=edges)), "triangles")


# --- folds --------------------------------------------------------------------------------------------------------


@query("SELECT CAST(CAST(o_orderkey AS HUGEINT) * o_orderkey AS DECIMAL(38,0)) AS value FROM orders")
def squares(spark: SparkSession, folder: str) -> DataFrame:
    return folds.squares(t.table(spark, folder, "orders"), "o_orderkey")


@query("SELECT sqrt(o_orderkey) AS value FROM orders")
def square_roots(spark: SparkSession, folder: str) -> DataFrame:
    return folds.square_roots(t.table(spark, folder, "orders"), "o_orderkey")


@query(f"SELECT l_returnflag, CAST(sum({sql_cents('l_extendedprice')}) AS DECIMAL(38,0)) AS total FROM lineitem GROUP BY 1")
def column_total(spark: SparkSession, folder: str) -> DataFrame:
    return folds.total(t.table(spark, folder, "lineitem"), t.cents("l_extendedprice"), ["l_returnflag"])


@query("SELECT l_orderkey, product(l_linenumber) AS product FROM lineitem GROUP BY 1")
def column_product(spark: SparkSession, folder: str) -> DataFrame:
    return folds.product(t.table(spark, folder, "lineitem"), "l_linenumber", ["l_orderkey"])


# A product of any size in SQL: factors are added to themselves as often as the next one says.
SQL_TIMES = "lambda x, y: list_reduce(list_transform(range(0, CAST(y AS BIGINT)), lambda i: x), lambda u, v: u + v)"


@query(
    f"""SELECT l_linestatus, CAST(list_reduce(list(CAST(l_linenumber AS BIGNUM)), {SQL_TIMES}) AS VARCHAR) AS product
FROM lineitem GROUP BY 1"""
)
def exact_product(spark: SparkSession, folder: str) -> DataFrame:
    """Two keys that hold all rows; the products have tens of thousands of digits."""
    return products.exact_product(t.table(spark, folder, "lineitem"), "l_linenumber", ["l_linestatus"])


@query(
    f"""SELECT n, CAST(n * (n + 1) // 2 AS DECIMAL(38,0)) AS total,
  CAST(list_reduce(list_transform(range(1, n + 1), lambda i: CAST(i AS BIGNUM)), {SQL_TIMES}) AS VARCHAR) AS product
FROM (SELECT DISTINCT CAST(p_size AS BIGINT) AS n FROM part)"""
)
def sums_and_products_up_to(spark: SparkSession, folder: str) -> DataFrame:
    return products.sums_and_products_up_to(t.table(spark, folder, "part"), "p_size")


@query("SELECT l_returnflag, round(sum(ln(l_quantity)), 6) AS log_total FROM lineitem GROUP BY 1")
def log_total(spark: SparkSession, folder: str) -> DataFrame:
    logs = folds.log_total(t.table(spark, folder, "lineitem"), "l_quantity", ["l_returnflag"])
    return logs.withColumn("log_total", F.round("log_total", 6))


@query(
    f"""SELECT l_returnflag, CAST(sum({sql_cents('l_quantity')}) AS DECIMAL(38,0)) AS first,
  CAST(sum({sql_cents('l_tax')}) AS DECIMAL(38,0)) AS second FROM lineitem GROUP BY 1"""
)
def pair_total(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return folds.pair_total(items, t.cents("l_quantity"), t.cents("l_tax"), ["l_returnflag"])


@query(
    f"""SELECT l_returnflag, CAST(sum({sql_cents('l_quantity')}) AS DECIMAL(38,0)) AS total,
  max(l_extendedprice) AS max FROM lineitem GROUP BY 1"""
)
def total_and_max(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return folds.total_and_max(items, t.cents("l_quantity"), "l_extendedprice", ["l_returnflag"])


@query("SELECT l_orderkey, CAST(sum(l_linenumber) AS DECIMAL(38,0)) AS total, product(l_linenumber) AS product FROM lineitem GROUP BY 1")
def total_and_product(spark: SparkSession, folder: str) -> DataFrame:
    return folds.total_and_product(t.table(spark, folder, "lineitem"), "l_linenumber", ["l_orderkey"])


@query(
    """SELECT l_returnflag, CAST(sum(CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey AS HUGEINT) * l_partkey ELSE 0 END) AS DECIMAL(38,0)) AS total
FROM lineitem GROUP BY 1"""
)
def even_square_total(spark: SparkSession, folder: str) -> DataFrame:
    return folds.even_square_total(t.table(spark, folder, "lineitem"), "l_partkey", ["l_returnflag"])


POSITION_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    f"""SELECT l_orderkey, CAST(sum(CAST(q AS HUGEINT) * i) AS DECIMAL(38,0)) AS weighted FROM (
  SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(POSITION_ORDER)}) AS i FROM lineitem) GROUP BY 1"""
)
def position_weighted(spark: SparkSession, folder: str) -> DataFrame:
    return _weighted(spark, folder, ["l_orderkey"])


@query(
    f"""SELECT l_returnflag, CAST(sum(CAST(q AS HUGEINT) * i) AS DECIMAL(38,0)) AS weighted FROM (
  SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS q,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, {', '.join(POSITION_ORDER)}) AS i FROM lineitem) GROUP BY 1"""
)
def position_weighted_large_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _weighted(spark, folder, ["l_returnflag"], "l_orderkey")


@query(
    f"""SELECT CAST(sum(CAST(q AS HUGEINT) * i) AS DECIMAL(38,0)) AS weighted FROM (
  SELECT CAST(l_quantity AS BIGINT) AS q, row_number() OVER (ORDER BY l_orderkey, {', '.join(POSITION_ORDER)}) AS i FROM lineitem)"""
)
def position_weighted_global(spark: SparkSession, folder: str) -> DataFrame:
    return _weighted(spark, folder, [], "l_orderkey")


@query(
    f"""SELECT user_id, CAST(sum(CAST(v AS HUGEINT) * i) AS DECIMAL(38,0)) AS weighted FROM (
  SELECT user_id, {sql_cents('value')} AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) GROUP BY 1"""
)
def position_weighted_unique_order(spark: SparkSession, folder: str) -> DataFrame:
    events = t.table(spark, folder, "events")
    return folds.position_weighted_sum(events, t.cents("value"), ["event_id"], ["user_id"], unique_order=True)


def _weighted(spark: SparkSession, folder: str, by: list[str], *leading: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    return folds.position_weighted_sum(items, t.whole("l_quantity"), [*leading, *POSITION_ORDER], by)


@query("SELECT l_returnflag, round(fsum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1")
def compensated_sum(spark: SparkSession, folder: str) -> DataFrame:
    sums = folds.compensated_sum(t.table(spark, folder, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return sums.withColumn("total", F.round("total", 2))


@query(
    f"""SELECT l_suppkey, CAST(sum({sql_cents('l_extendedprice')}) AS DOUBLE) / 100 AS price,
  CAST(sum({sql_cents('l_tax')}) AS DOUBLE) / 100 AS tax, max(l_discount) AS most FROM lineitem GROUP BY 1"""
)
def exact_totals(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    sums = exactsums.exact_totals(
        items, {"price": "l_extendedprice", "tax": "l_tax"}, ["l_suppkey"], {"most": (F.max, "l_discount")}
    )
    return sums.withColumns({"price": F.round("price", 2), "tax": F.round("tax", 2)})


@query(
    f"""SELECT l_suppkey, CAST(sum(CAST({sql_cents('l_extendedprice')} AS HUGEINT) * {sql_cents('l_discount')}) AS DOUBLE) / 10000 AS dot
FROM lineitem GROUP BY 1"""
)
def exact_dot(spark: SparkSession, folder: str) -> DataFrame:
    sums = exactsums.exact_dot(t.table(spark, folder, "lineitem"), "l_extendedprice", "l_discount", ["l_suppkey"])
    return sums.withColumn("dot", F.round("dot", 4))


@query(
    f"""SELECT l_suppkey, CAST(sum(CAST(c AS HUGEINT) * i) AS DOUBLE) / 100 AS weighted FROM (
  SELECT l_suppkey, {sql_cents('l_extendedprice')} AS c,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, {', '.join(POSITION_ORDER)}, l_extendedprice) AS i FROM lineitem) GROUP BY 1"""
)
def position_weighted_doubles(spark: SparkSession, folder: str) -> DataFrame:
    items = t.table(spark, folder, "lineitem")
    sums = folds.position_weighted_sum(items, "l_extendedprice", ["l_orderkey", *POSITION_ORDER], ["l_suppkey"])
    return sums.withColumn("weighted", F.round("weighted", 2))
