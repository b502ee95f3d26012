import math
from fractions import Fraction

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.operators import folds

QUIET = dict(deadline=None, max_examples=8, suppress_health_check=list(HealthCheck))


@pytest.fixture
def column(frame):
    def make(data, kind="double", partitions=3):
        return frame([(x,) for x in data], f"x {kind}", partitions)

    return make


@pytest.fixture
def pairs(frame):
    return lambda data: frame(data, "a double, b double")


def only(df):
    found = rows(df)
    assert len(found) == 1
    return found[0][0] if len(found[0]) == 1 else found[0]


def test_sequences(spark):
    numbers = folds.first_numbers(spark, 5)
    assert sorted(int(x) for x, in rows(folds.squares(numbers, "id"))) == [1, 4, 9, 16, 25]
    assert rows(folds.square_roots(numbers, "id")) == sorted((math.sqrt(i),) for i in range(1, 6))
    large = spark.createDataFrame([(4_000_000_000,), (-(2**63),), (None,)], "x bigint")
    assert {x for x, in rows(folds.squares(large, "x"))} == {16 * 10**18, 2**126, None}
    assert only(folds.range_total_and_product(spark, 4)) == (10, 24.0)
    assert only(folds.range_total_and_product(spark, 0)) == (0, 1.0)
    assert only(folds.range_total_and_product(spark, 13)) == (91, float(math.factorial(13)))


@pytest.mark.parametrize("data, total, product", [([1.0, 2.0, 3.0], 6, 6), ([3.0, 4.0, 5.0], 12, 60), ([], 0, 1)])
def test_plain_folds(column, data, total, product):
    df = column(data)
    assert only(folds.total(df, "x")) == total
    assert only(folds.product(df, "x")) == product
    assert only(folds.log_total(df, "x")) == pytest.approx(math.log(product))
    assert only(folds.total_and_product(df, "x")) == (total, product)


def test_log_total_limits(column):
    assert only(folds.log_total(column([1.0, 0.0]), "x")) == float("-inf")
    assert math.isnan(only(folds.log_total(column([1.0, -1.0]), "x")))


def test_pair_folds(pairs):
    a, b = pairs([(1.0, 2.0), (2.0, 3.0), (3.0, 4.0)]), pairs([(3.0, 4.0), (5.0, 6.0)])
    assert only(folds.pair_total(a, "a", "b")) == (6, 9) and only(folds.pair_total(b, "a", "b")) == (8, 10)
    assert only(folds.total_and_max(a, "a", "b")) == (6, 4) and only(folds.total_and_max(b, "a", "b")) == (8, 6)
    assert only(folds.pair_total(pairs([]), "a", "b")) == (0, 0)
    assert only(folds.total_and_max(pairs([]), "a", "b")) == (0, float("-inf"))


@pytest.mark.parametrize("data, expected", [([4, 5, 8, 7], 80), ([], 0), ([-2, 3], 4), ([100_000], 10**10)])
def test_even_squares(column, data, expected):
    assert only(folds.even_square_total(column(data, "int"), "x")) == expected


def test_sums_beyond_bigint(column, frame):
    assert only(folds.even_square_total(column([4_000_000_000] * 3, "bigint"), "x")) == 48 * 10**18
    assert only(folds.even_square_total(column([2**62, 2**62], "bigint"), "x")) == 2 * 2**124
    large = column([2**62] * 5, "bigint")
    assert only(folds.total(large, "x")) == 5 * 2**62
    assert only(folds.total_and_product(large, "x"))[0] == 5 * 2**62
    both = frame([(2**62, 2**62)] * 3, "a bigint, b bigint")
    assert only(folds.pair_total(both, "a", "b")) == (3 * 2**62, 3 * 2**62)
    assert only(folds.total_and_max(both, "a", "b")) == (3 * 2**62, float(2**62))
    weighted = numbered(frame, [2**62] * 9, "bigint")
    assert only(folds.position_weighted_sum(weighted, "x", ["i"])) == 45 * 2**62


def test_position_weights_cross_few_shuffles(spark):
    """The rows cross once to be told apart and once to be put in order; what follows are sums per stretch."""
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for by in ([], ["l_returnflag"]):
        frame = folds.position_weighted_sum(items, "l_linenumber", ["l_orderkey"], by)
        plan = frame._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        lines = plan.splitlines()
        below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange " in line]
        full = [line for line in below if "partial_" not in line and "_stretch" not in line and "_part" not in line]
        assert len(full) == 1 and plan.count("rangepartitioning") == 1
        assert "Window" not in "".join(line for line in lines if "l_orderkey" in line)


def numbered(frame, data, kind, partitions=3):
    return frame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}", partitions)


@pytest.mark.parametrize("partitions", [1, 3, 8])
@pytest.mark.parametrize("kind, data, expected", [("double", [4.0, 5.0, 8.0, 7.0], 66), ("int", [4, 5, 8, 7], 66), ("double", [], 0)])
def test_position_weights(frame, partitions, kind, data, expected):
    assert only(folds.position_weighted_sum(numbered(frame, data, kind, partitions), "x", ["i"])) == expected


@pytest.mark.parametrize("bits, unique", [(1, True), (18, True), (18, False)])
def test_position_weights_over_many_partitions_and_stretches(spark, monkeypatch, bits, unique):
    monkeypatch.setattr(folds, "STRETCH_BITS", bits)
    df = spark.range(0, 5000, 1, 7).select(
        F.xxhash64("id").alias("o"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") % 11).cast("double").alias("v"),
    )
    data = sorted(df.collect())
    whole = sum(row.v * i for i, row in enumerate(data, 1))
    assert only(folds.position_weighted_sum(df, "v", ["o"], unique_order=unique)) == whole
    expected, seen = {}, {}
    for row in data:
        seen[row.k] = seen.get(row.k, 0) + 1
        expected[row.k] = expected.get(row.k, 0) + row.v * seen[row.k]
    assert dict(rows(folds.position_weighted_sum(df, "v", ["o"], ["k"], unique_order=unique))) == expected


@settings(**QUIET)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-(10**12), 10**12)), min_size=1, max_size=40))
def test_position_weights_of_any_integers(frame, data):
    df = frame([(i, k, x) for i, (k, x) in enumerate(data)], "i int, k string, x bigint")
    expected = {}
    for key in {k for k, _ in data}:
        expected[key] = sum(x * i for i, x in enumerate([x for k, x in data if k == key], 1))
    assert dict(rows(folds.position_weighted_sum(df, "x", ["i"], ["k"]))) == expected


def test_copies_of_a_row(frame):
    df = frame([("a", 1, 5)] * 300 + [("a", 0, 2), ("a", 1, 4), ("b", 9, 1)], "k string, o int, x int")
    expected = {"a": 2 * 1 + 4 * 2 + 5 * sum(range(3, 303)), "b": 1}
    weighted = folds.position_weighted_sum(df, "x", ["o"], ["k"])
    assert dict(rows(weighted)) == expected
    assert weighted.columns == ["k", "weighted"]


def test_position_counts_missing_values(frame):
    assert only(folds.position_weighted_sum(numbered(frame, [None, 2.0], "double"), "x", ["i"])) == 4


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_compensated_sum(column, partitions):
    assert only(folds.compensated_sum(column([1.0, 1e100, 1.0, -1e100], partitions=partitions), "x")) == 2.0
    assert only(folds.compensated_sum(column([0.1] * 1000, partitions=partitions), "x")) == math.fsum([0.1] * 1000)


def test_compensated_sum_limits(column, frame):
    inf = float("inf")
    assert only(folds.compensated_sum(column([]), "x")) == 0.0
    assert only(folds.compensated_sum(column([0.0, None, -0.0]), "x")) == 0.0
    assert only(folds.compensated_sum(column([1.0, inf]), "x")) == inf
    assert math.isnan(only(folds.compensated_sum(column([inf, -inf]), "x")))
    assert math.isnan(only(folds.compensated_sum(column([1.0, float("nan")]), "x")))
    grouped = frame([("a", 1.0), ("a", 1e100), ("a", -1e100), ("b", None), ("c", 0.0)], "k string, x double")
    assert rows(folds.compensated_sum(grouped, "x", ["k"])) == [("a", 1.0), ("b", 0.0), ("c", 0.0)]


@settings(**QUIET)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=60))
def test_compensated_sum_is_within_a_rounding_step(column, data):
    found = only(folds.compensated_sum(column(data), "x"))
    exact = sum((Fraction(x) for x in data), Fraction(0))
    assert abs(Fraction(found) - exact) <= abs(exact) * Fraction(1, 2**50) + Fraction(5e-324)


def test_powers_of_two_are_exact(column):
    data = [2.0**e for e in (-1074, -1060, -1022, -500, -1, 0, 1, 52, 53, 500, 1023)]
    for x in data:
        assert only(folds.compensated_sum(column([x, x, -x]), "x")) == x
        assert only(folds.compensated_sum(column([math.nextafter(x, 0), 0.0]), "x")) == math.nextafter(x, 0)


def neumaier(data):
    total = lost = 0.0
    for x in data:
        new = total + x
        lost += (total - new) + x if abs(total) >= abs(x) else (x - new) + total
        total = new
    return total + lost


@settings(**QUIET)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e200, max_value=1e200), max_size=30))
def test_fold_over_an_array(frame, data):
    df = frame([(data,)], "xs array<double>", 1).select(folds.neumaier_fold(F.col("xs")).alias("y"))
    assert only(df) == neumaier(data)
