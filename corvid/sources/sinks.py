"""Result sinks: iteration histories, metric rows and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_history(history: DataFrame, path: str) -> None:
    """Per-iteration history as CSV with a header; replaced if present."""
    history.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Rows such as (max_iter, lam, acc, pre, rec) of one run, as CSV in a folder of
    its own: a repeated run replaces its rows, and Spark's commit marks it whole."""
    if not run_id or "/" in run_id:
        raise ValueError(f"not a run id: {run_id!r}")
    metrics.write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/run={run_id}")


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of all committed runs, with their ``run``; others are not read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = [x.getPath() for x in fs.listStatus(root) if x.getPath().getName().startswith("run=")] if fs.exists(root) else []
    done = [x for x in runs if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], f"{schema}, run string")
    got = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv([x.toString() for x in done])
    return got.withColumn("run", F.regexp_extract(F.input_file_name(), "/run=([^/]+)/", 1))


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    w = report.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
