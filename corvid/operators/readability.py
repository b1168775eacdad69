"""Readability: word statistics, difficult words and the Dale-Chall score.

The reference compares every word with every entry of the easy list (a theta
join). Here the easy list is expanded once into the set of all strings that
are "the same" as one of its words, and a word is easy exactly when it is in
that set — an equi-join, broadcast when the set is proven small.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import INFLECTION_ENDINGS, WHITESPACE, normalize_word, sentence_count, word_count
from corvid.iterate import Steps
from corvid.plans.joins import is_bounded

# Fixed values of the formula as the reference computes it (no +3.6365 term).
DCF_DIFFICULT_WEIGHT = 0.1579
DCF_LENGTH_WEIGHT = 0.0496
TOP_K = 30
SLICE_BYTES = 32 << 20  # of text that one task of the sweep reads


def _cols(cols):
    return [cols] if isinstance(cols, str) else list(cols)


def token_words(df: DataFrame, keys, text_col: str = "text") -> DataFrame:
    """One row per token: ``(*keys, token, word)`` with ``word`` normalised."""
    keys = _cols(keys)
    # explode the raw split and drop empty pieces with a (generated) filter
    # rather than a per-element lambda inside the generator input
    t = df.select(*keys, F.explode(F.split(text_col, WHITESPACE)).alias("token")).where(F.col("token") != "")
    return t.withColumn("word", normalize_word("token"))


def compute_counts(df: DataFrame, keys=(), text_col: str = "text",
                   num_partitions: int | None = None) -> DataFrame:
    """``(*keys, word, n)``: occurrences of each normalised word. Map-side
    partial aggregation keeps a hot word from reaching one task whole.
    ``num_partitions`` deals the texts (not their tokens) anew."""
    keys = _cols(keys)
    if num_partitions:
        df = df.select(*keys, text_col).repartition(num_partitions)
    return token_words(df, keys, text_col).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def count_sentences(df: DataFrame, keys, text_col: str = "text") -> DataFrame:
    keys = _cols(keys)
    return df.groupBy(*keys).agg(F.sum(sentence_count(text_col)).cast("bigint").alias("sentences"))


def count_words(df: DataFrame, keys, text_col: str = "text") -> DataFrame:
    """Token count without materialising tokens: size of the filtered split."""
    keys = _cols(keys)
    return df.groupBy(*keys).agg(F.sum(word_count(text_col)).cast("bigint").alias("words"))


def unique_words(df: DataFrame, keys, text_col: str = "text") -> DataFrame:
    keys = _cols(keys)
    return (compute_counts(df, keys, text_col).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("unique_words")))


def top_words(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k most frequent words; ties broken by word (TakeOrderedAndProject)."""
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(k)


def easy_keys(easy_words: DataFrame, word_col: str = "word") -> DataFrame:
    """All strings that are "the same" as some easy word, as ``(word)``.

    For a normalised easy word x the matching words are x itself, x plus an
    ending, and x minus an ending it carries. Words are normalised first, as
    the reference normalises both sides of every comparison.
    """
    x = easy_words.select(normalize_word(word_col).alias("x")).distinct()
    variants = [F.col("x")]
    for e in INFLECTION_ENDINGS:
        variants.append(F.concat(F.col("x"), F.lit(e)))
        variants.append(F.when(F.col("x").endswith(e),
                               F.expr(f"substring(x, 1, length(x) - {len(e)})")))
    keys = x.select(F.explode(F.array(*variants)).alias("word")).where(F.col("word").isNotNull())
    return keys.distinct()


def find_match(words: DataFrame, easy_words: DataFrame, word_col: str = "word") -> DataFrame:
    """For each distinct word, the sorted list of easy words that are "the
    same" as it, or NULL: ``(word, matches array<string>)``. An equi-join of the
    word on the expansion of each easy word — never a nested loop."""
    easy = easy_words.select(F.col(word_col).alias("easy_word")).distinct()
    x = easy.withColumn("x", normalize_word("easy_word"))
    variants = [F.col("x")]
    for e in INFLECTION_ENDINGS:
        variants.append(F.concat(F.col("x"), F.lit(e)))
        variants.append(F.when(F.col("x").endswith(e),
                               F.expr(f"substring(x, 1, length(x) - {len(e)})")))
    exp = (x.select("easy_word", F.explode(F.array(*variants)).alias("key"))
           .where(F.col("key").isNotNull()).distinct())
    w = words.select(F.col(word_col).alias("word")).distinct().withColumn("key", normalize_word("word"))
    m = w.join(exp, "key", "left")
    return m.groupBy("word").agg(
        F.when(F.count("easy_word") > 0, F.array_sort(F.collect_set("easy_word"))).alias("matches"))


def written_keys(keys_df: DataFrame) -> DataFrame:
    """The easy-key set computed once: ``(word, is_easy)``, written."""
    return Steps(keys_df.sparkSession, "easy-keys").write(keys_df.select("word", F.lit(True).alias("is_easy")))


def count_difficult_words(df: DataFrame, keys_df: DataFrame, keys, text_col: str = "text") -> DataFrame:
    """``(*keys, difficult)``: tokens whose normalised word has no easy match,
    from the single pass of ``readability``."""
    keys = _cols(keys)
    return readability(df, keys_df, keys, text_col).select(*keys, "difficult")


def dcf_expr(difficult, words, sentences):
    """0.1579·(difficult/words)·100 + 0.0496·(words/sentences); NULL on an
    empty denominator instead of a division error."""
    return (F.lit(DCF_DIFFICULT_WEIGHT) * F.try_divide(difficult, words) * F.lit(100)
            + F.lit(DCF_LENGTH_WEIGHT) * F.try_divide(words, sentences))


def readability(df: DataFrame, keys_df: DataFrame, group_cols, text_col: str = "text",
                rows_are_lines: bool = False, broadcast: bool | None = None) -> DataFrame:
    """Sentences, words, difficult words and Dale-Chall score per group.

    The easy keys are written once and measured. Bounded, they are broadcast:
    tokens are flagged where they are and one partial row per group and task is
    shuffled. Beyond the bound, tokens are first counted per (group, word), so a
    hot word is at most one row per group when it meets the keys in a
    sort-merge join. ``broadcast`` overrides the measured choice.

    ``group_cols`` may be coarser than a document (a category); the sentence
    count of each document is then taken once, on its first token. With
    ``rows_are_lines`` every row is one sentence, empty or not (a text file
    read line by line).
    """
    group_cols = _cols(group_cols)
    # The sentence count is computed in a projection *below* the generator
    # (once per text) and kept on the first piece of the split only; empty
    # pieces are dropped by a generated filter, except that first one.
    sent = F.lit(1) if rows_are_lines else sentence_count(text_col)
    base = df.select(*group_cols, sent.alias("_sent"), F.split(text_col, WHITESPACE).alias("_tk"))
    t = base.select(*group_cols, "_sent", F.posexplode_outer("_tk").alias("_pos", "token"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    has_token = F.col("token").isNotNull() & (F.col("token") != "")
    t = t.where(first | has_token).withColumn("word", normalize_word("token"))
    t = t.select(*group_cols, "word", F.when(first, F.col("_sent")).alias("_s"), has_token.cast("int").alias("_n"))
    keys = written_keys(keys_df)
    if is_bounded(keys) if broadcast is None else broadcast:
        t = t.join(F.broadcast(keys), "word", "left")
    else:
        t = t.groupBy(*group_cols, "word").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
        t = t.join(keys.hint("merge"), "word", "left")
    agg = t.groupBy(*group_cols).agg(
        F.sum("_s").cast("bigint").alias("sentences"),
        F.sum("_n").cast("bigint").alias("words"),
        F.sum(F.when(F.col("is_easy").isNull(), F.col("_n")).otherwise(0)).cast("bigint").alias("difficult"),
    )
    return agg.withColumn("dcf", dcf_expr(F.col("difficult"), F.col("words"), F.col("sentences")))


def dale_chall(df: DataFrame, keys_df: DataFrame, text_col: str = "text", rows_are_lines: bool = False) -> DataFrame:
    """Whole collection as one text: one row ``(sentences, words, difficult, dcf)``."""
    per = readability(df.withColumn("_all", F.lit(0)), keys_df, ["_all"], text_col, rows_are_lines)
    return per.drop("_all")


def partition_sweep(df: DataFrame, keys_df: DataFrame, partitions=(2, 5, 10, 15, 20),
                    text_col: str = "text") -> DataFrame:
    """The collection score and its wall time for each partition count of the
    input: ``(n_partitions, n_used, dcf, seconds)``. A partition is dealt as slices of
    about ``SLICE_BYTES`` of text, a task each, so that no task reads more as the table
    grows; its counts are summed over its slices, the score over the partitions.
    ``n_used`` is counted by the run itself (partitions that hold rows), so it shows
    that N was kept."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    rows = []
    for n in partitions:
        start = time.time()
        slices = max(1, math.ceil(size / n / SLICE_BYTES))
        dealt = df.select(text_col).repartition(n * slices).withColumn("_part", F.spark_partition_id() % n)
        per = readability(dealt, keys_df, ["_part"], text_col)
        r = per.agg(F.count(F.lit(1)).alias("used"), dcf_expr(F.sum("difficult"), F.sum("words"), F.sum("sentences")).alias("dcf")).first()
        rows.append((int(n), int(r["used"]), float(r["dcf"]) if r["dcf"] is not None else None, time.time() - start))
    return spark.createDataFrame(rows, "n_partitions int, n_used int, dcf double, seconds double")
