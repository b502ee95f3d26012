import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.operators import products

QUIET = dict(deadline=None, max_examples=6, suppress_health_check=list(HealthCheck))


def written(number):
    """A fraction whose denominator is made of twos and fives, digit by digit."""
    number, digits = Fraction(number), 0
    while number.denominator > 1:
        number, digits = number * 10, digits + 1
    text = str(abs(number.numerator)).zfill(digits + 1)
    whole = text[: len(text) - digits] + ("." + text[len(text) - digits :] if digits else "")
    return ("-" if number < 0 else "") + whole


def only(df):
    ((found,),) = rows(df)
    return found


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_products_of_any_size(frame, partitions):
    rng = random.Random(partitions)
    data = [(rng.randrange(3), rng.choice([-7, 1, 2, 9, 10**18 + 9])) for _ in range(600)] + [(3, None), (None, 5), (4, 0), (4, 6)]
    found = dict(rows(products.exact_product(frame(data, "k int, x bigint", partitions), "x", ["k"])))
    expected = {k: str(math.prod(x for j, x in data if j == k and x is not None)) for k in {k for k, _ in data}}
    assert found == expected and found[3] == "1" and len(found[0]) > 500


def test_known_answers(frame):
    assert only(products.exact_product(frame([(1,), (2,), (3,)], "x int"), "x")) == "6"
    assert only(products.exact_product(frame([(3.0,), (4.0,), (5.0,)], "x double"), "x")) == "60"
    assert only(products.exact_product(frame([], "x int"), "x")) == "1"
    sums = products.sums_and_products_up_to(frame([(4,), (4,), (None,), (0,), (-3,), (30,)], "n int"), "n")
    assert rows(sums) == [(-3, 0, "1"), (0, 0, "1"), (30, 465, str(math.factorial(30))), (4, 10, "24")]


@settings(**QUIET)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), max_size=12))
def test_doubles_are_multiplied_as_fractions(frame, data):
    found = only(products.exact_product(frame([(x,) for x in data], "x double"), "x"))
    assert found == written(math.prod((Fraction(x) for x in data), start=Fraction(1)))


@settings(**QUIET)
@given(st.lists(st.decimals(-999, 999, places=3), max_size=40))
def test_decimals(frame, data):
    df = frame([(Decimal(x),) for x in data], "x decimal(9,3)")
    assert only(products.exact_product(df, "x")) == written(math.prod((Fraction(x) for x in data), start=Fraction(1)))


@pytest.mark.parametrize(
    "data, expected",
    [
        ([math.inf, -2.0], "-Infinity"),
        ([math.inf, -math.inf, -1.0], "Infinity"),
        ([math.inf, 0.0], "NaN"),
        ([math.nan, 2.0], "NaN"),
        ([5e-324, 2.0**1000, 2.0**74], "1"),
        ([-0.0, 3.0], "0"),
    ],
)
def test_endless_and_tiny_doubles(frame, data, expected):
    assert only(products.exact_product(frame([(x,) for x in data], "x double"), "x")) == expected


def test_one_key_with_very_many_digits(spark):
    df = spark.range(1, 20_001, numPartitions=8)
    assert only(products.exact_product(df, "id")) == _text(math.factorial(20_000))
    copies = spark.range(100_000).select(F.lit(3).alias("x"))
    assert only(products.exact_product(copies, "x")) == _text(3**100_000)


def _text(number):
    import sys

    sys.set_int_max_str_digits(0)
    return str(number)


def test_rows_are_counted_before_they_are_shuffled(spark):
    plan = products.exact_product(spark.range(100).selectExpr("id % 5 AS x"), "x")._jdf.queryExecution().toString()
    assert "partial_count" in plan


def test_text_is_no_number(frame):
    with pytest.raises(TypeError):
        products.exact_product(frame([("1",)], "x string"), "x")
