"""Inputs of each job family, derived by Spark from the driver tables.

Every derived table is a projection/aggregate of the given tables, so its size
grows with them; nothing here is made-up data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.sources.text import dealt_by, spread, word_list_from_text

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the driver-table mapping (shared with the SQL oracles).
DENSE_TEST_MOD = 5          # lineitem rows with l_orderkey % 5 = 0 form the test set
N_FOLDS = 5                 # rating fold = (i*31 + j) % 5
RATING_CENTER = 25.5        # r = (avg quantity - 25.5) / 25
RATING_SCALE = 25.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- text ---------------------------------------------------------------
def documents(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def documents_by_id(spark, sf_dir) -> DataFrame:
    """The documents dealt by id, for what is grouped by document."""
    return dealt_by(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def easy_words(spark, sf_dir) -> DataFrame:
    """The easy-word list: distinct normalised words of ``benchmark.text``."""
    return word_list_from_text(table(spark, sf_dir, "benchmark"), "text")


# ---- dense --------------------------------------------------------------
def dense_points(spark, sf_dir) -> DataFrame:
    """``(row_id, x0, x1, x2, y, is_test)`` from lineitem: x = (1, quantity/50,
    10·discount), y = extendedprice/1000."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        F.lit(1.0).alias("x0"),
        (F.col("l_quantity") / 50).alias("x1"),
        (F.col("l_discount") * 10).alias("x2"),
        (F.col("l_extendedprice") / 1000).alias("y"),
        (F.col("l_orderkey") % DENSE_TEST_MOD == 0).alias("is_test"),
    )


def dense_array_points(spark, sf_dir) -> DataFrame:
    """Same rows as ``dense_points`` with ``x array<double>``."""
    d = dense_points(spark, sf_dir)
    return d.select("row_id", F.array("x0", "x1", "x2").alias("x"), "y", "is_test")


def wide_points(spark, sf_dir) -> DataFrame:
    """``(row_id, x array<double>(64), y)`` from embeddings, y = label."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"),
                    F.col("embedding").cast("array<double>").alias("x"),
                    F.col("label").cast("double").alias("y"))


# ---- sparse -------------------------------------------------------------
def sparse_points(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Labelled bag of words: ``points(row_id, y, is_test)`` and
    ``x_long(row_id, feature, value)``; y = 2·quality − 1, test = doc_id % 5 = 0."""
    from corvid.operators.features import bag_of_words

    lab = table(spark, sf_dir, "labels")
    docs = documents_by_id(spark, sf_dir)
    points = lab.select(F.col("doc_id").alias("row_id"),
                        (F.col("quality") * 2 - 1).cast("int").alias("y"),
                        (F.col("doc_id") % 5 == 0).alias("is_test"))
    x_long = bag_of_words(docs.join(lab.select("doc_id"), "doc_id", "left_semi"), "doc_id", "text")
    x_long = x_long.withColumnRenamed("doc_id", "row_id")
    return points, x_long


# ---- ratings ------------------------------------------------------------
ROWS_PER_TASK = 500_000     # of a join or an aggregate over lineitem


def ratings(spark, sf_dir) -> DataFrame:
    """``(i, j, r, fold)``: customer × supplier, r = (avg quantity − 25.5)/25. The
    number of tasks follows the rows, so that what one of them sorts does not grow."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    rows = li.count()  # from the footers
    if (n := math.ceil(rows / ROWS_PER_TASK)) > spark.sparkContext.defaultParallelism:
        o, li = o.repartition(n, "o_orderkey"), li.repartition(n, "l_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("i"), F.col("l_suppkey").alias("j"), "l_quantity")
    if n > spark.sparkContext.defaultParallelism:
        j = j.repartition(n, "i", "j")
    r = j.groupBy("i", "j").agg(((F.avg("l_quantity") - RATING_CENTER) / RATING_SCALE).alias("r"))
    return r.withColumn("fold", ((F.col("i") * 31 + F.col("j")) % N_FOLDS).cast("int"))
