"""Counts over words and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import _col, token_count, tokens


def word_rows(lines: DataFrame, text: Column | str = "value") -> DataFrame:
    """One row per blank-separated word."""
    return lines.select(F.explode_outer(F.split(_col(text), r"\s")).alias("word")).where(F.col("word") != "")


def word_count(lines: DataFrame, text: Column | str = "value") -> DataFrame:
    """``(word, n)``: how often each word occurs."""
    return word_rows(lines, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, value: Column, value_name: str = "value", count_name: str = "n") -> DataFrame:
    """How many rows have each value of an expression."""
    return df.select(value.alias(value_name)).groupBy(value_name).agg(F.count(F.lit(1)).alias(count_name))


def zip_histogram(cities: DataFrame, zips: str = "zips") -> DataFrame:
    """``(num_zips, num_cities)``: how many cities have 0, 1, 2, ... zip codes."""
    return histogram(cities, token_count(zips), "num_zips", "num_cities")


def line_weights(lines: DataFrame, text: Column | str = "value", above: int = 1) -> DataFrame:
    """``(word, weight)``: per word, the sum of the word counts of the lines it occurs in.

    Every occurrence adds the word count of its line; lines with ``above`` words or fewer add nothing, yet a word
    found only on such lines is still listed, with 0.
    """
    split_lines = lines.select(tokens(text).alias("words")).select("words", F.size("words").alias("size"))
    occurrences = split_lines.select(F.explode_outer("words").alias("word"), "size").where(F.col("word") != "")
    counted = F.when(F.col("size") > above, F.col("size")).otherwise(F.lit(0)).cast("bigint")
    return occurrences.groupBy("word").agg(F.sum(counted).alias("weight"))


def lines_of(df: DataFrame, text: Column | str, name: str = "value") -> DataFrame:
    """The lines of multi-line texts, one row each."""
    return df.select(F.explode_outer(F.split(_col(text), "\n")).alias(name)).where(F.col(name).isNotNull())
