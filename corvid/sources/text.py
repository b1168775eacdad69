"""Text sources: files of lines and word lists (one word per line)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.text import WHITESPACE, normalize_word, split_lines, tokens
from corvid.iterate import Steps

TEXT_PER_TASK = 8 << 20     # bytes of text whose words one task groups


def read_lines(spark: SparkSession, paths, min_partitions: int | None = None) -> DataFrame:
    """Text files → ``(file string, line string)``; many files in one scan."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"),
                                       F.col("value").alias("line"))
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores when its scan has fewer splits than there are: a file of
    one row group is one task, whatever is done with its texts. Fewer splits than
    cores also bounds what moves. Files alone decide where there are many; else one
    job over the footers counts the splits that hold rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or df.select(F.spark_partition_id().alias("p")).distinct().count() >= cores:
        return df
    return df.repartition(cores)


def dealt_by(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``df`` hash-partitioned by ``key`` into tasks of ``TEXT_PER_TASK`` bytes of text, or
    as many as there are cores. The texts move, once; what is then grouped by the key and
    anything else (words of a document) is grouped where it is, so neither the words are
    shuffled nor does a task hold more of them as the table grows."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TEXT_PER_TASK)), key)


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """``(line_no, line)``: lines of text files numbered from 0 in the order of
    (file, place), the same for any split size and cluster. Two levels: a place
    inside each split, on top of the lines of the splits before it. The lines are
    written with their places first, so that both levels see one reading."""
    raw = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("mid"))
    raw = Steps(spark, "lines").write(raw)
    splits = raw.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("low"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("n").alias("n"))  # one row per file
    above = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select(F.col("file").alias("_f"), above.alias("above"))
    base = (splits.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0))).join(files, F.col("file") == F.col("_f"))
            .select(F.col("file").alias("_file"), F.col("start").alias("_start"), "low", (F.col("above") + F.col("inside")).alias("base")))
    j = raw.join(base, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
    return j.select((F.col("base") + F.col("mid") - F.col("low")).alias("line_no"), "line")


def lines_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A text column → one row per line ``(id, line_no, line)``, line_no from 0."""
    return df.select(id_col, F.posexplode(split_lines(text_col)).alias("line_no", "line"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, surrounding whitespace stripped (as ``str.strip``)
    → ``(word string)``."""
    ws = WHITESPACE
    return spark.read.text(path).select(F.regexp_replace("value", f"^{ws}|{ws}$", "").alias("word"))


def word_list_from_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct normalised words of a text column (empty word excluded): how a
    word list is drawn from a reference corpus such as ``benchmark``."""
    w = df.select(F.explode(tokens(text_col)).alias("t")).select(normalize_word("t").alias("word"))
    return w.where(F.col("word") != "").distinct()
