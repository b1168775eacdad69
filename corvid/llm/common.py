"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.iterate import drop_folder  # noqa: F401  (used by the operators)
from corvid.session import scratch_path

# ASCII white space that separates words, as a Java/RE2 character class body.
WORD_GAP = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WORD_GAP}]+"), "")


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python are bounded by bytes, not only by rows: a batch of
    long texts would otherwise be as large as its rows are many. Stays set, since
    the frames that an operator returns run later."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def materialise_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage with files that every executor can read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    return materialise_at(df, name)[0]


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of a text column, over all rows (one aggregate)."""
    return int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def parts_for(n: float, per_part: float, least: int = 1) -> int:
    """Number of parts that keeps each at about ``per_part`` of ``n``."""
    return max(least, math.ceil(n / per_part))


def exclusive_sums(df: DataFrame, key: str, order: list[str], value: str, out: str,
                   n_rows: int, rows_per_bucket: int = 20_000) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one of the
    same ``key``, in a pseudorandom order fixed by ``order``.

    Two levels, so that no task gets a whole key: rows are dealt by a hash of
    ``order`` into buckets of about ``rows_per_bucket`` rows, bucket totals are
    summed up first, then rows within (key, bucket)."""
    n_buckets = parts_for(n_rows, rows_per_bucket, 8)
    b = df.withColumn("__b", F.pmod(F.xxhash64(F.lit(out), *order), F.lit(n_buckets)).cast("int"))
    before = lambda w: F.coalesce(F.sum(F.col(value)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = b.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__tb")).agg(F.sum(value).alias(value))
    totals = totals.select("__k", "__tb", before(Window.partitionBy("__k").orderBy("__tb")).alias("__base"))
    inner = b.withColumn("__in", before(Window.partitionBy(key, "__b").orderBy(F.xxhash64(F.lit("w"), *order), *order)))
    got = inner.join(totals, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__tb")))
    return got.withColumn(out, (F.col("__base") + F.col("__in")).cast("long")).drop("__b", "__tb", "__k", "__base", "__in")
