"""Line dedup over overlapping three-line windows.

Content lines (``\\n``-split, holding a character that is not ASCII white space)
form overlapping windows of three; a window's key is a 128-bit hash of its
lines. The first occurrence of a key over the whole table, in the order
(doc_id, text hash, line), stays; the lines that later occurrences cover go,
covered places being merged. A blank line goes with the content line before it.

Defined cases: documents with fewer than three content lines have no window
and stay as they are; a null text stays null; rows with the same doc_id and text
are one document and get the same result; a null doc_id orders first; extra
columns are kept unless they carry the name of a result column.

Shuffles: one partial aggregate of keys (first and last occurrence), one join
back of the windows to the repeated keys (a hot key is split by the skew join),
and one join of the texts with the covered ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import WORD_GAP

WINDOW = 3
RESULT = ["n_lines", "n_removed", "n_spans"]


def line_windows(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, th, s, e, h1, h2)``: raw lines [s, e) covered by each window."""
    lines = F.split(F.col(text), "\n")
    a = df.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("th"), F.size(lines).alias("n"),
                  F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                           lambda s: s["x"].rlike(f"[^{WORD_GAP}]")).alias("c"))
    c = F.col("c")
    a = a.where(F.size(c) >= WINDOW)
    line = lambda j: F.get(c, j)["x"]
    win = F.transform(F.slice(c, 1, F.size(c) - (WINDOW - 1)), lambda s, j: F.struct(
        s["i"].alias("s"), F.coalesce(F.get(c, j + WINDOW)["i"], F.col("n")).alias("e"),
        F.xxhash64(line(j), line(j + 1), line(j + 2)).alias("h1"),
        F.xxhash64(F.lit("second"), line(j + 2), line(j + 1), line(j)).alias("h2")))
    return a.select("id", "th", F.explode(win).alias("v")).select("id", "th", "v.*")


def covered_ranges(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, th, ranges)``: line ranges covered by later occurrences."""
    w = line_windows(df, doc_id, text)
    at = F.struct("id", "th", "s")
    firsts = (w.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
              .where(~F.col("first").eqNullSafe(F.col("last"))).select("h1", "h2", "first"))
    later = w.join(firsts, ["h1", "h2"]).where(~at.eqNullSafe(F.col("first")))
    return later.groupBy("id", "th").agg(F.collect_set(F.struct("s", "e")).alias("ranges"))


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``text`` rid of repeated passages, plus RESULT columns."""
    keep = [c for c in df.columns if c not in RESULT]
    cov = covered_ranges(df, doc_id, text).withColumnsRenamed({"id": "__id", "th": "__th", "ranges": "__r"})
    d = df.select(*keep).withColumn("__x", F.xxhash64(text))
    j = d.join(cov, d[doc_id].eqNullSafe(cov["__id"]) & (d["__x"] == cov["__th"]), "left")
    lines = F.split(F.col(text), "\n")
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform("__r", lambda r: F.sequence(r["s"], r["e"] - 1)))))
    j = j.withColumn("__g", F.coalesce(gone, F.array().cast("array<int>"))).withColumn("__l", lines)
    g, l = F.col("__g"), F.col("__l")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(l) - 1), g), lambda i: F.get(l, i))
    new = F.when(F.size(g) > 0, F.array_join(left, "\n")).otherwise(F.col(text))
    spans = F.size(F.filter(g, lambda x, i: F.coalesce(x - F.get(g, i - 1) > 1, F.lit(True))))
    return j.select(*[new.alias(text) if c == text else F.col(c) for c in keep],
                    F.when(F.col(text).isNull(), 0).otherwise(F.size(l)).cast("long").alias("n_lines"),
                    F.size(g).cast("long").alias("n_removed"), spans.cast("long").alias("n_spans"))


# The same result by whole lines instead of hashes (documents have distinct ids).
LINE_DEDUP_SQL = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x,
                  unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
c AS (SELECT doc_id, x, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, i AS s, coalesce(lead(i, 3) OVER o, 1000000000) AS e,
             [x, lead(x, 1) OVER o, lead(x, 2) OVER o] AS key, lead(i, 2) OVER o AS i2
      FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
r AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY key ORDER BY doc_id, s) AS n FROM w WHERE i2 IS NOT NULL),
g AS (SELECT DISTINCT l.doc_id, l.i FROM l JOIN r ON l.doc_id = r.doc_id AND r.n > 1 AND l.i >= r.s AND l.i < r.e),
m AS (SELECT l.doc_id, l.i, l.x, g.i IS NOT NULL AS gone,
             lag(g.i IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.i) AS was
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i),
t AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS text, count(*) AS n_lines,
             count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT coalesce(was, false)) AS n_spans
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
       coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed, coalesce(t.n_spans, 0) AS n_spans
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id"""
