"""Checks of key/value lines: a JSON key, one tab, a JSON value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.functions.jsoncheck import is_json, is_python_json
from sheaf.functions.text import field, split_fields, strip, with_once

# The names of the files to check, and the reasons given.
TRACE_FILES = r"^(mapper.*out\.txt|reducer.*(in|out)\.txt)$"
NO_TAB = "no tab"
TABS = "more than one tab"
BAD_KEY = "key is not JSON"
BAD_VALUE = "value is not JSON"


def key_value_violations(lines: DataFrame, column: Column | str = "value", strict: bool = True) -> DataFrame:
    """The lines that are not ``JSON key TAB JSON value``, with all their columns and a ``reason``.

    Blank lines are passed over. Unless ``strict``, texts that Python's parser takes beyond the JSON standard
    (NaN, Infinity, repeated object keys) are accepted; only lines found faulty before are handed to it.
    """
    return with_reason(lines, column, strict).where(F.col("reason").isNotNull())


def with_reason(lines: DataFrame, column: Column | str = "value", strict: bool = True) -> DataFrame:
    """All lines with a column ``reason``, NULL for those that are blank or keep to the form."""
    columns = lines.columns
    sides = with_once(lines, "_sides", split_fields(column, "\t"))
    key, payload = field("_sides", 0), field("_sides", 1)
    reason = F.when(strip(column) != "", _reason(is_json(key), is_json(payload)))
    checked = with_once(sides, "reason", reason)
    if not strict:
        faulty = F.col("reason").isNotNull()
        checked = with_once(
            checked.withColumn("_key_ok", is_python_json(F.when(faulty, key))).withColumn(
                "_payload_ok", is_python_json(F.when(faulty, payload))
            ),
            "_reason",
            F.when(faulty, _reason(F.col("_key_ok"), F.col("_payload_ok"))),
        ).withColumn("reason", F.col("_reason"))
    return checked.select(*columns, "reason")


def check_files(
    spark: SparkSession, *paths: str, names: str = TRACE_FILES, strict: bool = True, first_only: bool = False,
    with_path: bool = False,
) -> DataFrame:
    """``(file, line_number, line, reason)`` for the faulty lines of the files whose names match, or also their ``path``.

    Large files are read in blocks by many tasks. A task counts the lines of its blocks and keeps the faulty ones with
    their places, so one pass over the files gives both; a line's number is its place in its block plus the lines of the
    blocks before it in the file.
    """
    lines = (
        spark.read.text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias("line"),
        )
        .where(F.col("file").rlike(names))
    )
    faulty = F.when(F.col("reason").isNotNull(), F.struct("place", "line", "reason"))
    per_block = (
        with_reason(lines, "line", strict)
        .groupBy("path", "file", "block")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"), F.collect_list(faulty).alias("faulty"))
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # both uses need the same aggregates in the same order, so that Spark reads the files and shuffles their blocks once
    rows = F.when((F.col("rows") > 0) & (F.col("first") >= 0) & (F.size("faulty") >= 0), F.col("rows")).alias("rows")
    counts = per_block.select("path", "block", rows, "first")
    before = counts.select("path", "block", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    known = before.select("path", "block", (F.col("before") - F.col("first") + 1).alias("shift"))
    found = (
        per_block.where((F.size("faulty") > 0) & (F.col("rows") > 0) & (F.col("first") >= 0))
        .join(known, ["path", "block"])
        .select("path", "file", "shift", F.inline("faulty"))
        .select("path", "file", (F.col("place") + F.col("shift")).alias("line_number"), "line", "reason")
    )
    if first_only:
        first = F.min(F.struct("line_number", "line", "reason")).alias("found")
        found = found.groupBy("path", "file").agg(first).select("path", "file", "found.*")
    return found if with_path else found.drop("path")


def _reason(key_ok: Column, payload_ok: Column) -> Column:
    sides = F.size("_sides")
    return (
        F.when(sides < 2, F.lit(NO_TAB))
        .when(sides > 2, F.lit(TABS))
        .when(~key_ok, F.lit(BAD_KEY))
        .when(~payload_ok, F.lit(BAD_VALUE))
    )
