import re
from collections import defaultdict

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sheaf.operators import joins, skew

QUIET = dict(deadline=None, max_examples=5, suppress_health_check=list(HealthCheck))
CUSTOMERS = "customer_id string, country string"
ORDERS = "invoice_no string, customer_id string"
ITEMS = "invoice_no string, quantity int, unit_price double"


def test_country_report_has_named_columns(frame):
    report = joins.country_order_report(
        frame([("k7", "Peru"), ("k8", "Chad"), (None, "Chad")], CUSTOMERS),
        frame([("n1", "k7"), ("n2", None), ("n3", "k9")], ORDERS),
        frame([("n1", 3, 4.0), ("n1", 1, 0.5), ("n2", 2, 0.25), ("n3", 1, 1.0)], ITEMS),
    )
    assert rows(report) == [("Chad", 1, 0.5), ("Peru", 1, 12.5)]
    assert report.columns == ["country", "num_orders", "avg_order_amount"]


def plain_report(customers, orders, items):
    totals = defaultdict(list)
    for invoice, quantity, price in items:
        totals[invoice].append(None if quantity is None or price is None else quantity * price)
    met = defaultdict(list)
    for invoice, customer in orders:
        if invoice not in totals or invoice is None:
            continue
        known = [t for t in totals[invoice] if t is not None]
        total = sum(known) if known else None
        for other, country in customers:
            if (other or "blank") == (customer or "blank"):
                met[country].append((invoice, total))
    result = []
    for country, found in met.items():
        amounts = [t for _, t in found if t is not None]
        result.append((country, len({i for i, _ in found}), sum(amounts) / len(amounts) if amounts else None))
    return sorted(result, key=lambda row: tuple(str(v) for v in row))


ids = st.sampled_from(["C1", "C2", "blank", None])
invoice_ids = st.sampled_from(["i1", "i2", "i3", "i4", None])


@settings(**QUIET)
@given(
    st.lists(st.tuples(ids, st.sampled_from(["A", "B", None])), min_size=1, max_size=8),
    st.lists(st.tuples(invoice_ids, ids), min_size=1, max_size=12),
    st.lists(
        st.tuples(invoice_ids, st.sampled_from([1, 2, None]), st.sampled_from([0.5, 2.0])), min_size=1, max_size=12
    ),
)
def test_country_report_equals_joining_row_by_row(frame, customers, orders, items):
    report = joins.country_order_report(frame(customers, CUSTOMERS), frame(orders, ORDERS), frame(items, ITEMS))
    expected = plain_report(customers, orders, items)
    found = rows(report)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert [r[2] for r in found] == [pytest.approx(r[2]) for r in expected]


def test_country_report_with_invoices_of_several_customers(frame):
    customers = [("C1", "A"), ("C2", "A"), (None, "A"), (None, "A"), (None, "B")]
    orders = [("i1", "C1"), ("i1", "C2"), ("i1", "C2"), ("i2", None), ("i2", "C1"), ("i3", None), ("i3", None)]
    items = [("i1", 1, 2.0), ("i2", 2, 2.0), ("i3", 1, 1.0)]
    report = joins.country_order_report(frame(customers, CUSTOMERS), frame(orders, ORDERS), frame(items, ITEMS))
    assert rows(report) == plain_report(customers, orders, items)


@pytest.mark.parametrize("slice_rows", [2, 1_000_000])
def test_country_report_with_a_crowded_invoice(frame, slice_rows):
    customers = [(f"C{i}", "AB"[i % 2]) for i in range(20)] + [(None, "A")]
    orders = [("N/A", f"C{i}") for i in range(20)] * 2 + [("N/A", None)] * 30 + [("i1", "C1"), ("i2", None)]
    orders += [(f"s{i}", None) for i in range(9)] + [(f"s{i}", "C3") for i in range(9)]
    items = [("N/A", 1, 2.0), ("i1", 2, 2.0), ("i2", 1, 1.0)] + [(f"s{i}", 1, 0.5 + i) for i in range(9)]
    report = joins.country_order_report(
        frame(customers, CUSTOMERS), frame(orders, ORDERS), frame(items, ITEMS), slice_rows=slice_rows
    )
    assert rows(report) == plain_report(customers, orders, items)


def test_shared_invoices_scan_their_inputs_once(spark):
    folder = "/root/testdata/sf0.001"
    report = contract.queries()["country_order_report_shared_sliced"](spark, folder)
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    for table in ("orders", "lineitem"):
        assert len(re.findall(rf"FileScan parquet .*{table}.parquet", final)) == 1, table


def test_filled_keys_match_each_other_and_the_fill_text(frame):
    left = frame([(1, None), (2, "blank"), (3, "a")], "i int, k string")
    right = frame([(None, "x"), ("blank", "y"), ("b", "z")], "k string, v string")
    joined = joins.join_filled_keys(left, right, ["k"], ["i"])
    assert rows(joined.select("i", "v")) == [(1, "x"), (1, "y"), (2, "x"), (2, "y")]


def test_join_chain_keeps_each_key_once(frame):
    first = frame([(1, "a"), (2, "b")], "x int, n string")
    second = frame([(1, 10), (1, 11)], "x int, y int")
    third = frame([(10, True)], "y int, ok boolean")
    joined = joins.join_chain(first, (second, ["x"]), (third, ["y"]))
    assert joined.columns == ["y", "x", "n", "ok"] and rows(joined) == [(10, 1, "a", True)]


def test_count_distinct(frame):
    df = frame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "k string, v int")
    assert rows(joins.count_distinct_by(df, ["k"], "v")) == [("a", 2), ("b", 0)]


def test_hot_keys_are_cut_by_size(frame):
    counts = frame([("a", 100), ("b", 30), ("c", 11), ("d", 10), ("e", 30)], "k string, rows bigint")
    assert rows(skew.hot_keys(counts, ["k"], slice_rows=10)) == [("a", 10), ("b", 3), ("c", 2), ("e", 3)]


def uneven(spark, n):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, "warm").otherwise(F.col("id").cast("string"))
    return spark.range(n).select("id", key.alias("k"))


def largest_share(spark, frame):
    """Rows of the hot key in the fullest partition, and in how many partitions they are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        places = frame.where("k = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(row["count"] for row in places), len(places)


def test_balanced_join_equals_a_plain_join_and_spreads_hot_keys(spark):
    big = uneven(spark, 3000)
    lookup = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("warm", 3), ("5", 4), ("none", 5), (None, 6)], "k string, v int"
    )
    hot = skew.hot_keys(skew.count_rows_by(big, ["k"]), ["k"], slice_rows=50)
    joined = skew.balanced_join(big, lookup, ["k"], ["id"], hot)
    assert joined.columns == ["id", "k", "v"]
    assert rows(joined) == rows(big.join(lookup, ["k"]).select("id", "k", "v"))
    assert rows(skew.balanced_join(big, lookup, ["k"], ["id"], slice_rows=40)) == rows(joined)
    assert rows(skew.balanced_join(big, lookup, ["k"], ["id"])) == rows(joined)
    most, places = largest_share(spark, skew.balanced_join(big, lookup, ["k"], ["id"], hot))
    assert places > 3 and most < 1200


@pytest.mark.parametrize("left_rows, right_rows", [(300, 900), (900, 300), (30, 900)])
def test_both_sides_of_a_balanced_join_are_cut(spark, left_rows, right_rows):
    left, right = uneven(spark, left_rows), uneven(spark, right_rows).withColumnRenamed("id", "other")
    joined = skew.balanced_join(left, right, ["k"], ["id"], lookup_spread=["other"], slice_rows=25)
    assert joined.columns == ["id", "k", "other"]
    expected = left.join(right, ["k"]).select("id", "k", "other")
    assert joined.count() == expected.count() and joined.exceptAll(expected).count() == 0
    most, places = largest_share(spark, joined)
    assert places > 3 and most < 0.6 * joined.where("k = 'hot'").count()


def test_balanced_join_on_two_keys(frame):
    big = frame([(1, 1, "x"), (1, 1, "y"), (1, 2, "z"), (None, 1, "n")], "a int, b int, s string")
    lookup = frame([(1, 1, 10), (1, 2, 20), (None, 1, 30)], "a int, b int, v int")
    hot = skew.hot_keys(skew.count_rows_by(big, ["a", "b"]), ["a", "b"], slice_rows=1)
    assert rows(skew.balanced_join(big, lookup, ["a", "b"], ["s"], hot)) == [
        (1, 1, "x", 10), (1, 1, "y", 10), (1, 2, "z", 20),
    ]


def test_list_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    counts = spark.createDataFrame([(f"k{i}", 10 + i) for i in range(9)], "k string, rows long")
    assert rows(skew.hot_keys(counts, ["k"], slice_rows=5)) == [("k6", 4), ("k7", 4), ("k8", 4)]
    large = spark.range(300).selectExpr("id % 10 AS k", "id AS v")
    lookup = spark.range(10).selectExpr("id AS k", "id * 2 AS w")
    found = skew.balanced_join(large, lookup, ["k"], ["v"], slice_rows=4)
    assert rows(found) == rows(large.join(lookup, "k").select("k", "v", "w"))


def test_heavy_keys_by_sketch(frame):
    rows = [(1, "x", i) for i in range(3000)] + [(i, "y", i) for i in range(2, 1000)] + [(None, "z", i) for i in range(5000)]
    df = frame(rows, "a int, b string, i int")
    by_a, by_both = skew.heavy_keys(df, [["a"], ["a", "b"]], slice_rows=500)
    wanted = df.where("a = 1").select(skew.key_hash(["a"]).alias("a"), skew.key_hash(["a", "b"]).alias("b")).first()
    assert [(r["_key"], r["slices"]) for r in by_a.collect()] == [(wanted.a, 6)]
    assert [(r["_key"], r["slices"]) for r in by_both.collect()] == [(wanted.b, 6)]


def test_skewed_chain_is_the_plain_chain(frame):
    big = frame([(i % 7 if i % 2 else 3, i % 5 if i % 3 else None, i) for i in range(900)], "k int, m int, i int")
    first = frame([(k, f"k{k}") for k in range(6)] + [(3, "again"), (None, "none")], "k int, name string")
    second = frame([(m, "w") for m in range(5)] + [(None, "w"), (0, "twice")], "m int, w string")
    late = frame([("w", 1), ("w", 2)], "w string, late int")
    chain = [(first, ["k"]), (second, ["m"]), (late, ["w"])]
    plain = joins.join_chain(big, *chain)
    for slice_rows in (10, 100, 10_000):
        sliced = joins.join_skewed_chain(big, *chain, spread=["i"], slice_rows=slice_rows)
        assert sorted(sliced.columns) == sorted(plain.columns)
        assert rows(sliced.select(*plain.columns)) == rows(plain)
    assert joins.join_skewed_chain(big.limit(0), *chain, spread=["i"]).count() == 0


def test_sketches_shuffle_no_row_of_the_large_side(spark, frame):
    """Rows of the large side are shuffled once per join that cannot broadcast, never for the counting."""
    big = frame([(i % 7, i) for i in range(900)], "k int, i int")
    other = frame([(k, "x") for k in range(7)], "k int, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.join_skewed_chain(big, (other, ["k"]), spread=["i"], slice_rows=10)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    physical = plan.split("== Physical Plan ==")[1]
    assert "partial_approx_top_k" in physical
    assert len(re.findall(r"Exchange hashpartitioning\(_key", physical)) == 2  # one for each side of the join
    assert not re.search(r"HashAggregate\(keys=\[(?!\])", physical)
