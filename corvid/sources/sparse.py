"""Sparse points ``({'feat': value, …}, y)`` and sparse β tables.

The reference evaluates every line with Python's ``eval``; here the line is
parsed with regular expressions into the long form — no code is executed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.iterate import Steps
from corvid.sources.text import numbered_lines

ENTRIES_PER_TASK = 1_000_000  # entries of parsed lines that one task groups

# Fixed patterns of the line format (a Python dict literal and a label).
_KEY = r"""(?:'((?:[^'\\]|\\.)*+)'|"((?:[^"\\]|\\.)*+)")"""
_NUM = r"([-+]?(?:[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?|inf|nan|Infinity))"
ENTRY = _KEY + r"\s*:\s*" + _NUM
LABEL = r"\}\s*,\s*([-+]?\d+(?:\.\d+)?)\s*\)\s*$"
# Escapes of a Python string literal that stand for one character.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}
_PIECE = r"\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|(?s:\\.)|[^\\]+"


def _unescape(c: Column) -> Column:
    """The text of a Python string literal: pieces from left to right, each
    escape by its meaning, any other character after a backslash as it is."""
    def piece(p):
        code = F.substring(p, 2, 1)
        out = F.when(~p.startswith("\\"), p)
        out = out.when((code == "x") & (F.length(p) == 4), F.decode(F.unhex(F.concat(F.lit("00"), F.substring(p, 3, 2))), "UTF-16BE"))
        out = out.when((code == "u") & (F.length(p) == 6), F.decode(F.unhex(F.substring(p, 3, 4)), "UTF-16BE"))
        for k, v in ESCAPES.items():
            out = out.when(code == k, F.lit(v))
        return out.otherwise(F.substring(p, 2, 1))

    return F.when(F.instr(c, "\\") == 0, c).otherwise(
        F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0)), piece), ""))


def parse_sparse_line(line) -> Column:
    """line → struct(entries array<struct<feature, value>>, y int). A line that
    holds anything else than entries, commas, braces and a label is an error."""
    line = F.col(line) if isinstance(line, str) else line
    k1 = F.regexp_extract_all(line, F.lit(ENTRY), 1)
    k2 = F.regexp_extract_all(line, F.lit(ENTRY), 2)
    v = F.regexp_extract_all(line, F.lit(ENTRY), 3)
    entries = F.zip_with(F.arrays_zip(k1, k2), v, lambda kk, vv: F.struct(
        _unescape(F.when(kk["0"] != "", kk["0"]).otherwise(kk["1"])).alias("feature"),
        vv.cast("double").alias("value")))
    y = F.regexp_extract(line, LABEL, 1)
    rest = F.regexp_replace(line, ENTRY, "e")
    good = rest.rlike(r"^\s*\(\s*\{[\s,e]*" + LABEL) & ~rest.rlike(r"e\s*e|,\s*,")
    return F.when(good, F.struct(entries.alias("entries"), y.cast("double").cast("int").alias("y"))).otherwise(
        F.raise_error(F.concat(F.lit("not a sparse point: "), F.substring(line, 1, 200))))


def sparse_points_from_lines(lines: DataFrame, id_col: str, line_col: str = "line") -> tuple[DataFrame, DataFrame]:
    """``points(row_id, y)`` and ``x_long(row_id, feature, value)``; a key
    repeated on a line keeps its last value, as a dict literal does. Lines are
    parsed once and written, both tables read the result."""
    p = lines.select(F.col(id_col).alias("row_id"), parse_sparse_line(line_col).alias("p"))
    p = Steps(lines.sparkSession, "sparse-lines").write(p)
    points = p.select("row_id", F.col("p.y").alias("y"))
    n = math.ceil((p.agg(F.sum(F.size("p.entries")).alias("n")).first()["n"] or 0) / ENTRIES_PER_TASK)
    dealt = p.repartition(max(n, lines.sparkSession.sparkContext.defaultParallelism), "row_id")  # lines move, not entries
    e = dealt.select("row_id", F.posexplode("p.entries").alias("pos", "e"))
    x_long = (e.groupBy("row_id", F.col("e.feature").alias("feature"))
              .agg(F.max_by(F.col("e.value"), F.col("pos")).alias("value")))
    return points, x_long


def read_sparse_points(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Text file(s) of sparse points. Row ids are line numbers over all files, the
    same in every reading; blank lines are no rows."""
    lines = numbered_lines(spark, path).where(F.trim("line") != "").select(F.col("line_no").alias("row_id"), "line")
    return sparse_points_from_lines(lines, "row_id", "line")


def _quoted(c) -> Column:
    """A single-quoted Python string literal on one line."""
    c = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'")
    for k in "nr":
        c = F.replace(c, F.lit(ESCAPES[k]), F.lit("\\" + k))
    return F.concat(F.lit("'"), c, F.lit("'"))


def format_sparse_line(x_long: DataFrame, points: DataFrame) -> DataFrame:
    """Inverse of the parser: ``(row_id, line)`` with keys as Python literals."""
    ent = x_long.select("row_id", F.concat(_quoted("feature"), F.lit(": "), F.col("value").cast("string")).alias("e"))
    per = ent.groupBy("row_id").agg(F.concat_ws(", ", F.array_sort(F.collect_list("e"))).alias("body"))
    j = points.join(per, "row_id", "left")
    return j.select("row_id", F.concat(F.lit("({"), F.coalesce("body", F.lit("")), F.lit("}, "),
                                       F.col("y").cast("string"), F.lit(")")).alias("line"))


def read_beta_lines(spark: SparkSession, path: str) -> DataFrame:
    """β stored as lines ``('feat', value)`` → ``(feature, value)``; any other
    line is an error."""
    c = F.col("value")
    pair = r"^\s*\(\s*" + _KEY + r"\s*,\s*" + _NUM + r"\s*\)\s*$"
    key = F.when(F.regexp_extract(c, pair, 1) != "", F.regexp_extract(c, pair, 1)).otherwise(F.regexp_extract(c, pair, 2))
    good = F.when(c.rlike(pair), F.struct(_unescape(key).alias("feature"), F.regexp_extract(c, pair, 3).cast("double").alias("value"))).otherwise(
        F.raise_error(F.concat(F.lit("not a coefficient: "), F.substring(c, 1, 200))))
    return spark.read.text(path).where(F.trim("value") != "").select(good.alias("p")).select("p.feature", "p.value")


def write_beta_lines(beta: DataFrame, path: str) -> None:
    """β as lines ``('feat', value)``; an existing target is replaced."""
    (beta.select(F.concat(F.lit("("), _quoted("feature"), F.lit(", "), F.col("value").cast("string"), F.lit(")")).alias("value"))
     .write.mode("overwrite").text(path))


def write_sparse_beta(beta: DataFrame, path: str, fmt: str = "parquet") -> None:
    """β ``(feature, value)``; an existing target is replaced. CSV output is
    quoted, so names holding commas, quotes or newlines read back intact."""
    w = beta.select("feature", "value").write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def read_sparse_beta(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return (spark.read.schema("feature string, value double").option("header", True).option("escape", '"')
                .option("multiLine", True).option("mode", "FAILFAST").csv(path))
    return spark.read.parquet(path).select("feature", "value")
