"""Products without rounding, as text of their digits.

A product is kept as how often each value occurs, which combines before the shuffle like a count. The values of a key are
then multiplied in ``PARTS`` parts over as many tasks, and the parts of a key by one more product. All of it is exact, so
the result is the same for every order of the rows and every number of partitions.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from sheaf.functions.text import _col

# Parts that the different values of a key are dealt to before they are multiplied.
PARTS = 256


def whole_and_power(value: int | float | Decimal, scale: int = 0) -> tuple[int, int]:
    """A value times ``10 ** scale`` as a whole number times a power of two."""
    if isinstance(value, float):
        significand, power = math.frexp(value)
        whole = int(significand * 2**53)
        return (whole, power - 53) if whole else (0, 0)
    return int(Decimal(value).scaleb(scale)) if scale else int(value), 0


def multiplied(factors: Sequence[int]) -> int:
    """Product of whole numbers, halves first, so that large numbers meet large ones."""
    factors = list(factors)
    while len(factors) > 1:
        factors = [x * y for x, y in zip(factors[::2], [*factors[1::2], *([1] * (len(factors) % 2))])]
    return factors[0] if factors else 1


def as_bytes(number: int) -> bytes:
    return number.to_bytes(number.bit_length() // 8 + 1, "big", signed=True)


def as_text(whole: int, twos: int, tens: int) -> str:
    """``whole * 2 ** twos / 10 ** tens`` written out, without zeros at the end of a fraction."""
    if twos < 0:  # a half is five tenths
        whole, tens = whole * 5**-twos, tens - twos
    else:
        whole <<= twos
    digits = str(abs(whole))
    if tens > 0:
        digits = digits.zfill(tens + 1)
        fraction = digits[-tens:].rstrip("0")
        digits = digits[:-tens] + ("." + fraction if fraction else "")
    return "-" + digits if whole < 0 else digits


def exact_product(
    df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "product", parts: int = PARTS
) -> DataFrame:
    """Product of whole numbers, decimals or doubles as text of all its digits, for the whole frame or per key.

    Missing values are passed over, the product of nothing is ``1``. Doubles are taken for what they are, sums of powers
    of two; with NaN among them, or an infinite one beside a zero, the product is ``NaN``, else with an infinite one
    ``Infinity`` or ``-Infinity``. There is no exponent and no zero at the end of a fraction. A product has as many
    digits as its factors together, and that is what the last step for a key handles.
    """
    keys = list(by)
    number = df.select(*keys, _col(value).alias("_value"))
    kind = number.schema["_value"].dataType
    if not isinstance(kind, IntegralType | DecimalType | DoubleType | FloatType):
        raise TypeError(f"exact_product takes numbers, not {kind.simpleString()}")
    is_float = isinstance(kind, DoubleType | FloatType)
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    if isinstance(kind, FloatType):
        number = number.withColumn("_value", F.col("_value").cast("double"))
    endless = (F.isnan("_value") | (F.abs("_value") == float("inf"))) if is_float else F.lit(False)
    counts = (
        number.groupBy(*keys, "_value")
        .agg(F.count("_value").alias("_n"))
        .withColumn("_endless", F.coalesce(endless, F.lit(False)))
    )

    def multiply_values(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for groups in batches:
            rows = []
            for group in groups:
                factors = [(*whole_and_power(x["v"], scale), x["n"]) for x in group]
                whole = multiplied([w**n for w, _, n in factors])
                rows.append((as_bytes(whole), sum(p * n for _, p, n in factors)))
            yield pd.DataFrame(rows, columns=["whole", "twos"])

    def multiply_parts(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        sys.set_int_max_str_digits(0)  # digits are what is asked for
        for wholes, twos, tens in batches:
            numbers = [multiplied([int.from_bytes(w, "big", signed=True) for w in group]) for group in wholes]
            yield pd.Series([as_text(*x) for x in zip(numbers, twos.tolist(), tens.tolist())], dtype=object)

    of_values = F.pandas_udf(multiply_values, "whole binary, twos bigint")
    of_parts = F.pandas_udf(multiply_parts, "string")
    usable = F.col("_value").isNotNull() & ~F.col("_endless")
    factor = F.struct(F.col("_value").alias("v"), F.col("_n").alias("n"))
    negative = F.when(F.col("_value") < 0, F.col("_n"))
    dealt = counts.groupBy(*keys, F.pmod(F.xxhash64("_value"), F.lit(parts)).alias("_part")).agg(
        F.collect_list(F.when(usable, factor)).alias("_factors"),
        F.sum(F.when(usable, F.col("_n"))).alias("_n"),
        F.max(F.when(F.col("_endless"), F.isnan(F.col("_value").cast("double")))).alias("_nan"),
        F.sum(negative).alias("_negative"),
        F.max(F.col("_value") == 0).alias("_zero"),
    )
    partial = dealt.withColumn("_product", of_values("_factors"))
    joined = partial.groupBy(*keys).agg(
        F.collect_list("_product.whole").alias("_wholes"),
        F.coalesce(F.sum("_product.twos"), F.lit(0)).alias("_twos"),
        (F.coalesce(F.sum("_n"), F.lit(0)) * scale).alias("_tens"),
        F.max("_nan").alias("_nan"),  # NULL: nothing endless, false: an infinite value
        F.coalesce(F.sum("_negative"), F.lit(0)).alias("_negative"),
        F.coalesce(F.max("_zero"), F.lit(False)).alias("_zero"),
    )
    infinite = F.when(F.col("_negative") % 2 == 0, "Infinity").otherwise("-Infinity")
    special = F.when(F.col("_nan") | (~F.col("_nan") & F.col("_zero")), "NaN").when(~F.col("_nan"), infinite)
    return joined.select(*keys, F.coalesce(special, of_parts("_wholes", "_twos", "_tens")).alias(name))


def sums_and_products_up_to(df: DataFrame, n: Column | str, names=("n", "total", "product")) -> DataFrame:
    """For every different whole number ``n`` of a column, the sum and the exact product of 1 .. n.

    The product is text, as from :func:`exact_product`; below 1 there is nothing to add or multiply. The numbers up to
    each ``n`` are listed, which is less than the digits of its product.
    """
    ends = df.select(_col(n).cast("bigint").alias("_end")).where("_end IS NOT NULL").distinct()
    numbers = F.when(F.col("_end") > 0, F.sequence(F.lit(1).cast("bigint"), F.greatest("_end", F.lit(1).cast("bigint"))))
    listed = ends.select("_end", F.explode_outer(numbers).alias("_i"))
    last = F.greatest(F.col("_end"), F.lit(0)).cast("decimal(19,0)")
    total = (last * (last + 1)).cast("decimal(38,0)") / 2
    found = exact_product(listed, "_i", ["_end"], "_product")
    return found.select(
        F.col("_end").alias(names[0]), total.cast("decimal(38,0)").alias(names[1]), F.col("_product").alias(names[2])
    )
