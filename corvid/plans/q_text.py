"""Registered readability queries (text family) with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as T
from corvid.operators import readability as R
from corvid.plans import inputs
from corvid.plans.registry import ORACLES, register
from corvid.plans.sqlfrag import lines, norm, tokens, with_easy, EASY_WORDS_SQL
from corvid.sources.text import lines_of


def _keys(spark, sf):
    return R.easy_keys(inputs.easy_words(spark, sf))


@register("read_lines", f"""
SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line
FROM (SELECT doc_id, {lines('text')} AS ls FROM documents)""")
def q_read_lines(spark, sf):
    return lines_of(inputs.documents(spark, sf), "doc_id", "text")


@register("read_word_list", EASY_WORDS_SQL)
def q_read_word_list(spark, sf):
    return inputs.easy_words(spark, sf)


@register("tokenize", f"""
SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({tokens('text')}) AS token FROM documents)
GROUP BY doc_id, token""")
def q_tokenize(spark, sf):
    d = inputs.documents_by_id(spark, sf)
    return (d.select("doc_id", F.explode(T.tokens("text")).alias("token"))
            .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")))


@register("to_lower_case", f"""
SELECT DISTINCT token, lower(token) AS lowered FROM (SELECT unnest({tokens('text')}) AS token FROM documents)""")
def q_to_lower(spark, sf):
    d = inputs.documents(spark, sf)
    t = d.select(F.explode(T.tokens("text")).alias("token")).distinct()
    return t.select("token", T.to_lower_case("token").alias("lowered"))


@register("strip_non_alpha", f"""
SELECT DISTINCT token, regexp_replace(token, '{T.NON_ALPHA_ENDS}', '', 'g') AS stripped
FROM (SELECT unnest({tokens('text')}) AS token FROM documents)""")
def q_strip(spark, sf):
    d = inputs.documents(spark, sf)
    t = d.select(F.explode(T.tokens("text")).alias("token")).distinct()
    return t.select("token", T.strip_non_alpha("token").alias("stripped"))


def _infl_sql(a: str, b: str) -> str:
    na, nb = norm(a), norm(b)
    ends = " OR ".join(f"{nb} = {na} || '{e.replace(chr(39), chr(39) * 2)}'" for e in T.INFLECTION_ENDINGS)
    return f"({na} = {nb} OR {ends})"


@register("inflection_pairs", f"""
SELECT doc_id,
  CAST(greatest(len(tk) - 1, 0) AS INTEGER) AS n_pairs,
  CAST(len(list_filter(range(1, len(tk)), lambda i: {_infl_sql('tk[i]', 'tk[i+1]')})) AS INTEGER) AS n_inflection,
  CAST(len(list_filter(range(1, len(tk)), lambda i: {_infl_sql('tk[i]', 'tk[i+1]')} OR {_infl_sql('tk[i+1]', 'tk[i]')})) AS INTEGER) AS n_same
FROM (SELECT doc_id, {tokens('text')} AS tk FROM documents)""")
def q_inflection_pairs(spark, sf):
    """is_inflection_of / same_word over each pair of adjacent tokens."""
    d = inputs.documents(spark, sf).select(
        "doc_id", F.transform(T.tokens("text"), T.normalize_word).alias("tk"))
    n = F.size("tk")
    a = F.slice("tk", 1, F.greatest(n - 1, F.lit(0)))
    b = F.when(n > 1, F.slice("tk", 2, n - 1)).otherwise(F.array().cast("array<string>"))
    infl = F.zip_with(a, b, lambda x, y: T.is_inflection_of(x, y, normalized=True))
    same = F.zip_with(a, b, lambda x, y: T.same_word(x, y, normalized=True))
    return d.select("doc_id",
                    F.greatest(n - 1, F.lit(0)).alias("n_pairs"),
                    F.size(F.filter(infl, lambda v: v)).alias("n_inflection"),
                    F.size(F.filter(same, lambda v: v)).alias("n_same"))


@register("find_match", with_easy(f"""
, words AS (SELECT DISTINCT {norm('t')} AS word FROM (SELECT unnest({tokens('text')}) AS t FROM documents)),
exp AS (
  SELECT DISTINCT easy_word, key FROM (
    SELECT word AS easy_word, word AS key FROM easy_words
    {''.join(f" UNION ALL SELECT word, word || '{e.replace(chr(39), chr(39) * 2)}' FROM easy_words" for e in T.INFLECTION_ENDINGS)}
    {''.join(f" UNION ALL SELECT word, substring(word, 1, length(word) - {len(e)}) FROM easy_words WHERE suffix(word, '{e.replace(chr(39), chr(39) * 2)}')" for e in T.INFLECTION_ENDINGS)}
  ))
SELECT w.word, CAST(count(e.easy_word) AS BIGINT) AS n_matches,
       CASE WHEN count(e.easy_word) > 0 THEN string_agg(e.easy_word, ',' ORDER BY e.easy_word) END AS matches
FROM words w LEFT JOIN exp e ON e.key = w.word GROUP BY w.word"""))
def q_find_match(spark, sf):
    d = inputs.documents(spark, sf)
    words = d.select(F.explode(T.tokens("text")).alias("t")).select(T.normalize_word("t").alias("word"))
    m = R.find_match(words, inputs.easy_words(spark, sf))
    return m.select("word", F.coalesce(F.size("matches"), F.lit(0)).cast("bigint").alias("n_matches"),
                    F.concat_ws(",", "matches").alias("matches")).select(
        "word", "n_matches", F.when(F.col("n_matches") > 0, F.col("matches")).alias("matches"))


@register("count_sentences", f"SELECT doc_id, CAST(len({lines('text')}) AS BIGINT) AS sentences FROM documents")
def q_count_sentences(spark, sf):
    return R.count_sentences(inputs.documents(spark, sf), "doc_id")


@register("count_words", f"SELECT doc_id, CAST(len({tokens('text')}) AS BIGINT) AS words FROM documents")
def q_count_words(spark, sf):
    return R.count_words(inputs.documents(spark, sf), "doc_id")


_WORDS = f"SELECT doc_id, {norm('t')} AS word FROM (SELECT doc_id, unnest({tokens('text')}) AS t FROM documents)"


@register("compute_counts", f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word")
def q_compute_counts(spark, sf):
    return R.compute_counts(inputs.documents(spark, sf))


@register("unique_words", f"SELECT doc_id, count(DISTINCT word) AS unique_words FROM ({_WORDS}) GROUP BY doc_id")
def q_unique_words(spark, sf):
    return R.unique_words(inputs.documents(spark, sf), "doc_id")


@register("top_words", f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word ORDER BY n DESC, word LIMIT 30")
def q_top_words(spark, sf):
    return R.top_words(R.compute_counts(inputs.documents(spark, sf)), 30)


@register("count_difficult_words", with_easy(f"""
, w AS ({_WORDS})
SELECT d.doc_id, CAST(count(w.word) AS BIGINT) AS difficult
FROM documents d LEFT JOIN (SELECT * FROM w WHERE word NOT IN (SELECT word FROM easy_keys)) w ON w.doc_id = d.doc_id
GROUP BY d.doc_id"""))
def q_count_difficult(spark, sf):
    return R.count_difficult_words(inputs.documents(spark, sf), _keys(spark, sf), "doc_id")


_STATS = f"""
, w AS ({_WORDS}),
diff AS (SELECT doc_id, count(*) AS difficult FROM w WHERE word NOT IN (SELECT word FROM easy_keys) GROUP BY doc_id),
st AS (
  SELECT d.doc_id, d.source, CAST(len({lines('d.text')}) AS BIGINT) AS sentences,
         CAST(len({tokens('d.text')}) AS BIGINT) AS words, CAST(coalesce(diff.difficult, 0) AS BIGINT) AS difficult
  FROM documents d LEFT JOIN diff ON diff.doc_id = d.doc_id)"""


def _dcf_sql(diff, words, sent):
    return (f"round(0.1579 * (CASE WHEN {words} = 0 THEN NULL ELSE {diff} / {words} END) * 100"
            f" + 0.0496 * (CASE WHEN {sent} = 0 THEN NULL ELSE {words} / {sent} END), 6)")


def _round_dcf(df):
    return df.withColumn("dcf", F.round("dcf", 6))


@register("dale_chall", with_easy(_STATS + f"""
SELECT CAST(sum(sentences) AS BIGINT) AS sentences, CAST(sum(words) AS BIGINT) AS words,
       CAST(sum(difficult) AS BIGINT) AS difficult,
       {_dcf_sql('sum(difficult)', 'sum(words)', 'sum(sentences)')} AS dcf FROM st"""))
def q_dale_chall(spark, sf):
    return _round_dcf(R.dale_chall(inputs.documents(spark, sf), _keys(spark, sf)))


@register("readability_report", with_easy(_STATS + f"""
SELECT source, doc_id, sentences, words, difficult, {_dcf_sql('difficult', 'words', 'sentences')} AS dcf FROM st"""))
def q_readability_report(spark, sf):
    return _round_dcf(R.readability(inputs.documents(spark, sf), _keys(spark, sf), ["source", "doc_id"]))


@register("readability_by_source", with_easy(_STATS + f"""
SELECT source, CAST(sum(sentences) AS BIGINT) AS sentences, CAST(sum(words) AS BIGINT) AS words,
       CAST(sum(difficult) AS BIGINT) AS difficult,
       {_dcf_sql('sum(difficult)', 'sum(words)', 'sum(sentences)')} AS dcf FROM st GROUP BY source"""))
def q_readability_by_source(spark, sf):
    return _round_dcf(R.readability(inputs.documents(spark, sf), _keys(spark, sf), ["source"]))


_SWEEP = (2, 5, 10, 15, 20)


@register("partition_sweep", with_easy(_STATS + f"""
, one AS (SELECT {_dcf_sql('sum(difficult)', 'sum(words)', 'sum(sentences)')} AS dcf FROM st)
SELECT CAST(n AS INTEGER) AS n_partitions, CAST(n AS INTEGER) AS n_used, one.dcf FROM one, (SELECT unnest([{', '.join(map(str, _SWEEP))}]) AS n)"""))
def q_partition_sweep(spark, sf):
    """The collection score for each partition count (wall times left out)."""
    return _round_dcf(R.partition_sweep(inputs.documents(spark, sf), _keys(spark, sf), _SWEEP)).drop("seconds")


@register("readability_report_smj", ORACLES["readability_report"])
def q_readability_report_smj(spark, sf):
    """The report without any broadcast: words are counted per document first."""
    return _round_dcf(R.readability(inputs.documents(spark, sf), _keys(spark, sf), ["source", "doc_id"], broadcast=False))
