"""Quality rules: a threshold table compiled into one Spark projection.

Counts of words, symbols, stop words and lines are expressions over the text;
each rule bounds one ratio of two counts. No user function, no shuffle.

Defined cases: a null or empty text has no words (all counts 0, base fails);
rows keep their order and number, repeated rows give repeated results; extra
columns are kept unless they carry the name of a result column, which then
replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import WORD_GAP, words

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au dans de des du en est et la le les pas pour que qui sur un une "
    "auf das dem den der die ein eine für ist mit nicht sich und von zu "
    "con del el los las no para por se su una y es"
).split()

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high`` in thousandths; a bound of
    None is open. A row with denominator 0 passes."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None

    def passes(self) -> Column:
        num, den = F.col(self.numerator) * 1000, F.col(self.denominator)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (num >= den * self.low)
        if self.high is not None:
            ok = ok & (num <= den * self.high)
        return ok

    def sql(self) -> str:
        parts = [f"{self.numerator} * 1000 >= {self.denominator} * {self.low}"] * (self.low is not None)
        parts += [f"{self.numerator} * 1000 <= {self.denominator} * {self.high}"] * (self.high is not None)
        return "(" + " AND ".join(parts) + ")"


# The threshold table.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2000, 15000),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 100),
    Rule("stop_words_per_word", "n_stop_words", "n_words", 30, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 400),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words"]


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice: windows are
    sorted with their places, equal neighbours kept, places merged."""
    grams = F.filter(F.transform(w, lambda x, i: F.struct(
        F.concat(x, F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2)).alias("g"), i.alias("i"))),
        lambda s: s["g"].isNotNull())
    return F.sort_array(grams)


def quality_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns of COUNTS (all long)."""
    keep = [c for c in df.columns if c not in COUNTS]
    t = F.coalesce(F.col(text), F.lit(""))
    a = df.select(*keep, words(F.col(text)).alias("__w"),
                  F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{WORD_GAP}]")).alias("__l"),
                  F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"))
    b = a.select(*keep, "__w", "n_symbols",
                 F.size("__l").cast("long").alias("n_lines"),
                 (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                 F.size("__w").cast("long").alias("n_words"),
                 F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
                 F.size(F.filter("__w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
                 _repeat_words(F.col("__w")).alias("__s"))
    s = F.col("__s")
    c = b.drop("__w").withColumn("__p", F.sort_array(F.transform(
        F.filter(s, lambda x, i: (x["g"] == F.get(s, i + 1)["g"]) | (x["g"] == F.get(s, i - 1)["g"])),
        lambda x: x["i"])))
    p = F.col("__p")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return c.select(*keep, *[x for x in COUNTS if x != "n_repeat_words"], covered.alias("n_repeat_words"))


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds the counts, ``base_failed`` (fewer than 50 words, or over half of
    the words in repeated 3-word windows) and ``kept`` (base and all rules)."""
    df = df.select(*[c for c in df.columns if c not in ("base_failed", "kept")])
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    verdict = F.lit(True)
    for r in rules:
        verdict = verdict & r.passes()
    out = quality_counts(df, text)
    return out.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict)


def quality_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result as DuckDB SQL over ``documents``."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    verdict = " AND ".join(r.sql() for r in rules)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
c AS (SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(t, '[{SYMBOLS}]')) AS n_symbols,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS n_stop_words FROM w),
p AS (SELECT doc_id, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT doc_id, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS g
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
v AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, i + o AS i FROM r, (SELECT unnest([0, 1, 2]) AS o)) GROUP BY doc_id),
a AS (SELECT c.*, coalesce(v.n_repeat_words, 0) AS n_repeat_words FROM c LEFT JOIN v USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, base_failed,
       NOT base_failed AND {verdict} AS kept FROM b"""
