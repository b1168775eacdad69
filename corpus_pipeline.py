"""A corpus pipeline of five operators: documents in, packed sequences out.

Toxic documents go, repeated passages go, one document of each group of near
copies stays, sources are mixed to target weights, and what the mix takes is
packed into sequences. Every stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.iterate import release
from corvid.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from corvid.llm.common import materialise
from corvid.session import scratch_folders


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def _text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with another text, and its length."""
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score_documents(docs, labels).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    return _text(out, F.col("text")).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document whose id names the group stays; documents without words are
    no group. Rows of one doc_id and text are one document: that of the first
    source stays. Rows without doc_id are linked with nothing and stay."""
    groups = jaccard_join.similar_groups(docs.select("doc_id", "text"))
    keep = materialise(groups.where("id = component_id").select("id").distinct(), "pipeline-keep")
    named = docs.where("doc_id IS NOT NULL").join(keep, F.col("doc_id") == F.col("id")).select(*docs.columns)
    first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", F.xxhash64(*docs.columns))
    named = named.withColumn("__first", F.row_number().over(first)).where("__first = 1").select(*docs.columns)
    return named.union(docs.where("doc_id IS NULL"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_group),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# A trained classifier and a tokenizer are no SQL; the tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    since = len(scratch_folders(spark))
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{k}")
        release(spark, keep=docs, since=since)  # tables of the stage and of its input
    return docs
