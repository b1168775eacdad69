"""Ratings ``i,j,r`` text files, fold directories and factor tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATING_SCHEMA = "i bigint, j bigint, r double"


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``i,j,r`` lines with an explicit schema (no inference, fail fast)."""
    return spark.read.schema(RATING_SCHEMA).option("mode", "FAILFAST").csv(path)


def write_folds(R: DataFrame, path: str) -> None:
    """One text directory per fold, ``<path>/fold<k>`` (partitioned write)."""
    (R.select("i", "j", "r", F.concat(F.lit("fold"), F.col("fold").cast("string")).alias("f"))
     .write.mode("overwrite").partitionBy("f").csv(path))


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    """All folds in one glob scan; ``fold`` from the directory name."""
    df = spark.read.schema(RATING_SCHEMA).option("mode", "FAILFAST").csv(f"{path.rstrip('/')}/*")
    fold = F.regexp_extract(F.col("_metadata.file_path"), r"fold(\d+)/[^/]*$", 1).cast("int")
    return df.select("i", "j", "r", fold.alias("fold"))


def write_factors(U: DataFrame, V: DataFrame, path: str) -> None:
    """``<path>_U`` and ``<path>_V`` as parquet (arrays round-trip exactly)."""
    U.write.mode("overwrite").parquet(f"{path}_U")
    V.write.mode("overwrite").parquet(f"{path}_V")


def read_factors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}_U"), spark.read.parquet(f"{path}_V")
