"""Other ways to write some queries, timed by the benchmark beside the ones the library uses; not part of it.

They follow the plain recipe of the job in question: a row-at-a-time function for the zip counter, every path of
two edges for the triangles, pair records combined with ``reduceByKey`` for the word count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from sheaf.operators import graph, keyed
from sheaf.plans import tables as t


def zip_histogram_row_function(spark: SparkSession, folder: str) -> DataFrame:
    counter = F.udf(lambda text: 0 if text is None else len(text.split()), IntegerType())
    cities = t.document_cities(spark, folder)
    return cities.select(counter("zips").alias("num_zips")).groupBy("num_zips").count()


def triangle_count_all_paths(spark: SparkSession, folder: str) -> DataFrame:
    edges = graph.redundant_edges(graph.drop_self_edges(t.part_supplier_edges(spark, folder)))
    paths = graph.close_paths(edges, graph.two_hop_paths(edges))
    return keyed.row_count(paths, "paths").selectExpr("paths div 6 AS triangles")


def triangle_count_smaller_first(spark: SparkSession, folder: str) -> DataFrame:
    """Paths along edges that point from the smaller to the larger id."""
    edges = graph.canonical_edges(t.part_supplier_edges(spark, folder))
    return keyed.row_count(graph.close_paths(edges, graph.two_hop_paths(edges)), "triangles")


def word_count_pairs(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.table(spark, folder, "documents").select("text").rdd
    counted = lines.flatMap(lambda row: row.text.split()).map(lambda word: (word, 1)).reduceByKey(lambda a, b: a + b)
    return spark.createDataFrame(counted, "word string, n bigint")


FORMS = {
    function.__name__: function
    for function in (
        zip_histogram_row_function,
        triangle_count_all_paths,
        triangle_count_smaller_first,
        word_count_pairs,
    )
}
