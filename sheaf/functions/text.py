"""Column functions on text: whitespace tokens, field splitting, stripping and the by-name zip counter."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the characters that Java's \s matches.
BLANKS = " \t\n\x0b\f\r"


def strip(text: Column | str) -> Column:
    """Remove blanks of every kind from both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(_col(text), F.lit(BLANKS))


def tokens(text: Column | str) -> Column:
    """Array of the blank-separated tokens of a text.

    Cutting at every blank and leaving out the empty pieces is faster than matching runs of blanks.
    """
    return F.array_remove(F.split(_col(text), r"\s"), "")


def token_count(text: Column | str) -> Column:
    """Number of blank-separated tokens; NULL and blank texts count 0."""
    return F.coalesce(F.size(tokens(text)), F.lit(0))


def split_fields(line: Column | str, sep: str = "\t") -> Column:
    """Split a line on a literal separator, keeping empty fields at the end.

    A separator of one character is passed on bare, or escaped if it has a meaning in patterns: Spark then splits
    without a pattern match.
    """
    literal = re.sub(r"([.$|()\[{^?*+\\])", r"\\\1", sep) if len(sep) == 1 else rf"\Q{sep}\E"
    return F.split(_col(line), literal, -1)


def field(fields: Column | str, position: int) -> Column:
    """One field by 0-based position; NULL when the line is too short."""
    return F.get(_col(fields), F.lit(position))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however many later filters and columns refer to it.

    Spark moves filters below a plain computed column by repeating its expression. It does not do so for an
    exploded one, which pays off when the expression splits or parses text.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def register_zip_counter(spark: SparkSession, name: str = "zipCounter") -> None:
    """Make the token counter callable by name in SQL strings.

    It is a SQL function, so Spark inlines the expression instead of calling opaque code.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(zips STRING) RETURNS INT "
        r"RETURN coalesce(size(array_remove(split(zips, '\\s'), '')), 0)"
    )


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
