"""Column functions on numbers kept as text, flags and logarithms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import _col, strip


def is_int_or_blank(text: Column | str) -> Column:
    """True when the text, blanks aside, is empty or an optionally negative run of ASCII digits."""
    return strip(text).rlike("^(-?[0-9]+)?$")


def to_long(text: Column | str) -> Column:
    """Text to BIGINT; NULL where the text is not a number."""
    return strip(text).try_cast("bigint")


def to_double(text: Column | str) -> Column:
    """Text to DOUBLE; NULL where the text is not a number."""
    return strip(text).try_cast("double")


def flag(condition: Column) -> Column:
    """Condition as 0/1; an unknown condition stays NULL."""
    return condition.cast("int")


def log_or_limit(value: Column | str) -> Column:
    """Natural logarithm with ln(0) = -Infinity and NaN below 0, where Spark's ``ln`` gives NULL."""
    number = _col(value).cast("double")
    return (
        F.when(number > 0, F.ln(number))
        .when(number == 0, F.lit(float("-inf")))
        .when(number < 0, F.lit(float("nan")))
    )


def exact(df: DataFrame, value: Column | str) -> Column:
    """Whole numbers of ``df`` as DECIMAL, so that long weighted sums do not overflow; other numbers unchanged."""
    number = _col(value)
    kind = df.select(number.alias("value")).schema["value"].dataType.typeName()
    return number.cast("decimal(20,0)") if kind in ("byte", "short", "integer", "long") else number


def exact_sum(df: DataFrame, value: Column | str) -> Column:
    """Sum that does not overflow: whole numbers add up as DECIMAL(38,0), other numbers as they are."""
    number = exact(df, value)
    kind = df.select(_col(value).alias("value")).schema["value"].dataType.typeName()
    whole = kind in ("byte", "short", "integer", "long")
    return F.sum(number).cast("decimal(38,0)") if whole else F.sum(number)
