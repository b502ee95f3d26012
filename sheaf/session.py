"""Session factory for shells, tests and the benchmark; every operator takes its session or frames as arguments."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(app_name: str = "sheaf", master: str | None = None, **settings: str) -> SparkSession:
    """Return the running session, or start one with adaptive execution on and the web page off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset; it then gets a temporary folder. On a cluster, executors would
    write to folders that others cannot read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if not hasattr(spark, "_sheaf_folder"):
        spark._sheaf_folder = tempfile.mkdtemp(prefix="sheaf-")
    return spark._sheaf_folder
