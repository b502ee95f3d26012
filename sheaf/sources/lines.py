"""Readers for text lines, delimited files and edge lists.

Damaged delimited lines are told apart with expressions over the raw line rather than with the CSV reader's
corrupt-record column: that column is only filled for the columns a query happens to read, so column pruning
would let damaged rows through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheaf.functions.numbers import is_int_or_blank, to_long
from sheaf.functions.text import _col, field, split_fields, strip, with_once

# The city layouts, the retail layout and the order tables.
CITY_FIELDS = ("name", "state", "county", "population", "zips", "id")
CITY_FIELDS_ID_FIRST = ("id", "name", "state", "county", "population", "zips")
CITY_INTEGERS = ("population", "id")
RETAIL_FIELDS = ("invoice", "item", "quantity", "date", "customer")
RETAIL_HEADER = "InvoiceNo"
ORDER_TABLES = {
    "customers": "customer_id STRING, country STRING",
    "orders": "invoice_no STRING, customer_id STRING",
    "items": "invoice_no STRING, quantity INT, unit_price DOUBLE",
}


class Records(NamedTuple):
    """Rows that passed a check, and the raw lines that did not, each with a reason."""

    good: DataFrame
    rejects: DataFrame


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per line (column ``value``) of one or more files, folders or globs."""
    return spark.read.text(list(paths))


def read_lines_with_files(spark: SparkSession, *paths: str) -> DataFrame:
    """:func:`read_lines` with the file of each line, as ``path`` and ``file``."""
    file = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file")
    return read_lines(spark, *paths).select("value", *file)


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = "\t", header: bool = False
) -> DataFrame:
    """Delimited file with a declared schema; nothing is inferred, fields that do not fit become NULL."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header)


def read_tables(
    spark: SparkSession, folder: str, schemas: Mapping[str, str] = ORDER_TABLES
) -> tuple[DataFrame, ...]:
    """Comma-separated tables with a header line, one sub-folder or file per table, in the order given."""
    return tuple(read_delimited(spark, f"{folder}/{name}", ddl, sep=",", header=True) for name, ddl in schemas.items())


def drop_header(lines: DataFrame, starts_with: str, column: str = "value") -> DataFrame:
    """Leave out every line that begins like the header; files joined together bring several."""
    return lines.where(~F.startswith(F.col(column), F.lit(starts_with)))


def reject_reason(
    fields: Column, names: Sequence[str], integers: Sequence[str] = (), required: Sequence[str] = ()
) -> Column:
    """NULL for a good line, otherwise why it is bad: its field count, or its first field that is no usable integer."""
    reason = F.when(F.size(fields) != len(names), F.lit("field count"))
    for name in integers:
        value = field(fields, names.index(name))
        reason = reason.when(~is_int_or_blank(value), F.lit(f"not an integer: {name}"))
        reason = reason.when((strip(value) != "") & to_long(value).isNull(), F.lit(f"out of range: {name}"))
        if name in required:
            reason = reason.when(strip(value) == "", F.lit(f"missing: {name}"))
    return reason


def parse_records(
    lines: DataFrame,
    names: Sequence[str] = CITY_FIELDS,
    integers: Sequence[str] = CITY_INTEGERS,
    sep: str = "\t",
    column: str = "value",
    required: Sequence[str] = (),
) -> Records:
    """Split lines into named fields; lines of another width or with an unusable number are rejects.

    Integer fields become BIGINT; one that is no integer or beyond BIGINT makes the line a reject. They may be blank
    (NULL) unless ``required``. All other fields stay text.
    """
    split_lines = with_once(lines.select(F.col(column).alias("line")), "fields", split_fields("line", sep))
    reason = reject_reason(F.col("fields"), names, integers, required)
    typed = [
        (to_long(field("fields", i)) if name in integers else field("fields", i)).alias(name)
        for i, name in enumerate(names)
    ]
    return Records(
        good=split_lines.where(reason.isNull()).select(*typed),
        rejects=split_lines.where(reason.isNotNull()).select("line", reason.alias("reason")),
    )


def read_records(spark: SparkSession, *paths: str, **options) -> Records:
    """:func:`parse_records` on files."""
    return parse_records(read_lines(spark, *paths), **options)


def parse_edges(lines: DataFrame, sep: str = " ", column: str = "value") -> Records:
    """Edge list ``(src, dst)`` from the first two fields of each line; lines with fewer are rejects, further fields are ignored."""
    fields = split_fields(column, sep)
    ends = lines.select(F.col(column).alias("line"), field(fields, 0).alias("src"), field(fields, 1).alias("dst"))
    return Records(
        good=ends.where(F.col("dst").isNotNull()).select("src", "dst"),
        rejects=ends.where(F.col("dst").isNull()).select("line", F.lit("field count").alias("reason")),
    )


def read_edges(spark: SparkSession, *paths: str, sep: str = " ") -> DataFrame:
    """Edge list ``(src, dst)`` of files with one edge per line."""
    return parse_edges(read_lines(spark, *paths), sep).good


def flatten(df: DataFrame, *columns: Column | str, name: str = "item") -> DataFrame:
    """One row per value: every input row gives as many rows as there are columns (kept together: ``F.array``)."""
    return df.select(F.explode(F.array(*[_col(c).cast("string") for c in columns])).alias(name))


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """A few rows, for looking at: the first by ``order_by``, or any if that is empty."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
