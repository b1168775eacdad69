"""Dense points ``x1,…,xd,y`` and dense coefficient vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.iterate import Steps
from corvid.sources.text import numbered_lines


def parse_dense_line(line) -> Column:
    """``x1,…,xd,y`` → struct(x array<double>, y double); the last field is y."""
    line = F.col(line) if isinstance(line, str) else line
    v = F.transform(F.split(F.trim(line), ","), lambda t: F.trim(t).cast("double"))
    return F.struct(F.slice(v, 1, F.size(v) - 1).alias("x"), F.element_at(v, -1).alias("y"))


def read_dense_points(spark: SparkSession, path: str) -> DataFrame:
    """CSV lines → ``(row_id, x array<double>, y double)``. Row ids are line numbers
    over all files, the same in every reading; blank lines are no rows."""
    raw = numbered_lines(spark, path).where(F.trim("line") != "")
    p = raw.select(F.col("line_no").alias("row_id"), parse_dense_line("line").alias("p"))
    return Steps(spark, "dense-points").write(p.select("row_id", "p.x", "p.y"))


def format_dense_line(x, y) -> Column:
    """Inverse of ``parse_dense_line``: doubles keep their shortest exact form."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.concat_ws(",", F.transform(x, lambda v: v.cast("string")), y.cast("string"))


def write_beta(beta: DataFrame, path: str) -> None:
    """β table ``(idx, value)`` → parquet (overwrite)."""
    beta.select("idx", "value").write.mode("overwrite").parquet(path)


def read_beta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("idx", "value")


def beta_line(beta: DataFrame) -> DataFrame:
    """β as the reference's one-line text ``b1,…,bd`` (ordered by idx)."""
    return beta.agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))),
                                                  lambda s: s["value"].cast("string"))).alias("line"))


def parse_beta_line(spark: SparkSession, line_df: DataFrame, col: str = "line") -> DataFrame:
    """``b1,…,bd`` → ``(idx, value)``."""
    return line_df.select(F.posexplode(F.split(F.trim(col), ",")).alias("idx", "v")) \
        .select(F.col("idx").cast("int"), F.col("v").cast("double").alias("value"))
