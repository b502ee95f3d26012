"""Properties of the physical plans that decide how the queries behave on large tables."""

import re

import pytest

import __spark_entry__ as contract
from sheaf.plans import registry

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(registry.QUERIES)


# Spark has no functions for whole numbers of any size; these multiply counted values in Python, batch by batch.
ANY_SIZE = {"exact_product", "sums_and_products_up_to"}
PLANS = {}


def physical(spark, name):
    if name not in PLANS:
        text = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
        PLANS[name] = text.split("== Physical Plan ==")[1]
    return PLANS[name]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins_and_no_python(spark, name):
    text = physical(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        if operator == "ArrowEvalPython" and name in ANY_SIZE:
            assert text.index("ArrowEvalPython") < text.index("partial_count")  # values are counted below it
            continue
        assert operator not in text, operator


@pytest.mark.parametrize("name", NAMES)
def test_rows_never_meet_in_one_task(spark, name):
    """Single-partition exchanges carry one partial result per task, one row per partition of a sort, or a limit."""
    lines = physical(spark, name).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            per_task = re.search(r"(?:Object)?HashAggregate\(keys=\[\], functions=\[(partial_|merge_)", below)
            per_part = re.search(r"HashAggregate\(keys=\[_part#\d+L?\]", below)
            assert per_task or per_part or "LocalLimit" in below, below


@pytest.mark.parametrize(
    "name, columns",
    [
        ("word_count", "text:string"),
        ("keyed_sum", "l_orderkey:bigint,l_quantity:double"),
        ("state_profile", "text:string,lang:string,n_chars:bigint"),
        ("compensated_sum", "l_extendedprice:double,l_returnflag:string"),
        ("canonical_edges", "l_partkey:bigint,l_suppkey:bigint"),
        ("country_order_report", "o_orderkey:bigint,o_custkey:bigint"),
        ("row_count", ""),
    ],
)
def test_scans_read_only_the_columns_in_use(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in physical(spark, name)


@pytest.mark.parametrize("name", ["word_count", "line_weights", "small_county_report", "product_sums", "compensated_sum"])
def test_rows_are_combined_before_the_shuffle(spark, name):
    assert "partial_" in physical(spark, name)


def test_not_null_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in physical(spark, "three_table_join")


def test_an_edge_list_is_shuffled_once(spark):
    frame = contract.queries()["triangle_count"](spark, FOLDER)
    frame.collect()
    executed = frame._jdf.queryExecution().executedPlan().toString()
    final = executed.split("== Initial Plan ==")[0]
    # the subquery that counts the edges comes first and takes them from the shuffle of the other use
    assert "FileScan parquet" not in final and "ReusedExchange" in final


@pytest.mark.parametrize("name", NAMES)
def test_every_query_runs_and_has_named_columns(spark, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert frame.columns and all(re.fullmatch(r"[a-z_0-9]+", c) for c in frame.columns)
    assert frame.count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["word", "n"]


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
