"""One query per operator over its whole table, with its DuckDB SQL where SQL
can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.iterate import release
from corvid.llm import (block_search, conversation_repair, cover_tree, jaccard_join, line_dedup, mixing, packing, pii,
                        quality, spelling, suffix_dedup, toxicity, warc)
from corvid.session import scratch_folders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, drops: bool = True):
    """Registers a query; of the tables it writes, those that its result reads stay
    (all, where the result reads files that Spark's plan does not show)."""
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            since = len(scratch_folders(spark))
            out = fn(spark, sf_dir)
            if drops:
                release(spark, keep=out, since=since)
            return out

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_line_dedup", line_dedup.LINE_DEDUP_SQL)
def op1_line_dedup(spark, sf_dir):
    """Texts of all documents without later occurrences of three-line windows."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_quality_rules", quality.quality_sql())
def op8_quality_rules(spark, sf_dir):
    """Counts and verdicts of the quality rules for all documents."""
    out = quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "n_lines", "n_stop_words", "base_failed", "kept")


@query("op2_mixing")
def op2_mixing(spark, sf_dir):
    """Words that the mix takes of each document."""
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    per_source = spark.createDataFrame([(s.rank, s.size, s.target) for s in mix.plan], "rank int, source_size long, target double")
    return mix.taken().join(F.broadcast(per_source), "rank").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op3_jaccard_join")
def op3_jaccard_join(spark, sf_dir):
    """Groups of documents linked by shingle sets of Jaccard similarity 0.8 or more."""
    got = jaccard_join.similar_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.withColumnRenamed("id", "doc_id")


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    """Toxicity scores of all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score_documents(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op5_pii_surrogates")
def op5_pii_surrogates(spark, sf_dir):
    """Texts of all documents with surrogates for personal data and secrets."""
    return pii.replace_entities(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    """Bytes of all documents that repeated 200-byte strings cover."""
    got = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.drop("spans").withColumnRenamed("id", "doc_id")


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


# sha1 is a hex string in DuckDB; base 32 takes five bits at a time.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, strlen(h) AS n, upper(sha1(h)) AS x FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d),
b AS (SELECT *, array_to_string(list_transform(range(40), lambda i: lpad(bin(strpos('0123456789ABCDEF', x[i + 1]) - 1), 4, '0')), '') AS bits FROM g)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(5), lambda o: CAST(bits[k * 5 + o + 1] AS INT) * (16 >> CAST(o AS INT))))::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM b"""


@query("op9_warc", WARC_SQL, drops=False)
def op9_warc(spark, sf_dir):
    """All pages written as WARC records and read back."""
    got = warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_cover_tree", cover_tree.TOP_K_SQL)
def op10_cover_tree(spark, sf_dir):
    """The five best inner products of every fiftieth vector with all others."""
    return cover_tree.top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query("op11_spelling_variants", spelling.VARIANTS_SQL)
def op11_spelling_variants(spark, sf_dir):
    """Words of all documents with their near words, forms and roots."""
    return spelling.variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_block_matrix_join", block_search.NEAREST_SQL)
def op12_block_matrix_join(spark, sf_dir):
    """The five nearest vectors of every fiftieth one by cosine."""
    return block_search.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query("op13_conversation_repair", conversation_repair.REPAIR_SQL)
def op13_conversation_repair(spark, sf_dir):
    """Faults, cheapest edits and repaired text of all conversations after damage."""
    return conversation_repair.repair(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
