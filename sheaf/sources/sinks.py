"""Writers: CSV folders, text lines and key/value lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder without header; an earlier result is replaced."""
    df.write.mode("overwrite").csv(path)


def tuple_lines(df: DataFrame, nested: Sequence[str] = ()) -> DataFrame:
    """Lines such as ``(word,3)`` or, with nested columns last, ``(key,(1,2))``."""
    plain = [_shown(c) for c in df.columns if c not in nested]
    if nested:
        plain.append(_in_brackets([_shown(c) for c in nested]))
    return df.select(_in_brackets(plain).alias("value"))


def write_tuples(df: DataFrame, path: str, nested: Sequence[str] = ()) -> None:
    """:func:`tuple_lines` as a text folder; fails when the folder exists."""
    tuple_lines(df, nested).write.mode("errorifexists").text(path)


def write_scalar(df: DataFrame, path: str) -> None:
    """A result of one row and one column as a text folder with one part."""
    df.select(_shown(df.columns[0]).alias("value")).coalesce(1).write.mode("errorifexists").text(path)


def key_value_lines(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Lines ``key TAB value``, both as JSON; several columns on one side form a list."""
    return df.select(F.concat(_json_side(keys), F.lit("\t"), _json_side(values)).alias("value"))


def write_key_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], path: str) -> None:
    """:func:`key_value_lines` as a text folder; an earlier result is replaced."""
    key_value_lines(df, keys, values).write.mode("overwrite").text(path)


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _in_brackets(parts: Sequence[Column]) -> Column:
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def _json_scalar(column: str) -> Column:
    listed = F.to_json(F.array(F.col(column)))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _json_side(columns: Sequence[str]) -> Column:
    if len(columns) == 1:
        return _json_scalar(columns[0])
    return F.concat(F.lit("["), F.concat_ws(", ", *[_json_scalar(c) for c in columns]), F.lit("]"))
