"""Helpers shared by the operators: words, checkpoints, small tables."""

from __future__ import annotations

import ctypes
from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.session import shared_folder

# The blanks between words, [\x20\x09-\x0D]; bytes.split() cuts at the same characters.
BLANK = r"[\x20\x09-\x0D]"
# A table with at most so many narrow rows may be broadcast (under 20 MB).
BROADCAST_ROWS = 100_000
# Spark drops the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words(text: Column | str) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text, empty for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def word_count(text: Column | str) -> Column:
    """Number of words, 0 for NULL."""
    return F.size(words(text)).cast("bigint")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scratch_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, also set as Spark's checkpoint folder; see :func:`shared_folder`."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there, so that a lost executor costs no recomputation.

    Shuffle files of ``df`` go as soon as it is written. Spark deletes what was written once the frame is no longer in
    use, if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    scratch_folder(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # planned anew, as plans take the setting when they are made
    finally:
        conf.set(CLEANUP, before)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its known number of rows is under the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def spare_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def hand_back() -> None:
    """Give freed memory back to the system, in a task: Python workers outlive their tasks beside an executor's heap."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
