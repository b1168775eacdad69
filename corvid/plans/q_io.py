"""Registered source/sink round trips and feature-preparation queries.

Each writes under the session's checkpoint directory (a shared folder on a
cluster) and reads back with the library's own readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import factorization as M
from corvid.operators import logistic as L
from corvid.operators import readability as R
from corvid.operators import regression as G
from corvid.operators.features import onehot_sparse, poly2_features
from corvid.functions.text import split_lines
from corvid.iterate import Steps
from corvid.plans import inputs, q_dense, q_factor, q_logistic, q_text
from corvid.plans.registry import ORACLES, register
from corvid.plans.sqlfrag import EASY_WORDS_SQL, lines as lines_sql
from corvid.session import scratch_path
from corvid.sources import dense as SD
from corvid.sources import sinks as SK
from corvid.sources import sparse as SS
from corvid.sources import text as ST
from corvid.sources.ratings import read_factors, read_ratings, write_factors


@register("dense_beta_io", ORACLES["train_gd"])
def q_dense_beta_io(spark, sf):
    """Ridge β → parquet → read → one-line text ``b1,…,bd`` → parsed back."""
    beta = q_dense.q_train_gd(spark, sf)
    path = scratch_path(spark, "dense-beta")
    SD.write_beta(beta, path)
    back = SD.read_beta(spark, path)
    return SD.parse_beta_line(spark, SD.beta_line(back))


@register("read_sparse_points", f"WITH {q_logistic.XL}, {q_logistic.PT} SELECT xl.row_id, xl.feature, xl.value, pt.y "
          "FROM xl JOIN pt ON pt.row_id = xl.row_id")
def q_read_sparse_points(spark, sf):
    """Labelled bag of words written as ``({'feat': v, …}, y)`` lines and parsed
    back by the regex reader (no eval)."""
    pts, xl = inputs.sparse_points(spark, sf)
    lines = SS.format_sparse_line(xl, pts.select("row_id", "y"))
    path = scratch_path(spark, "sparse-points")
    lines.write.mode("overwrite").parquet(path)
    p2, x2 = SS.sparse_points_from_lines(spark.read.parquet(path), "row_id", "line")
    return x2.join(p2, "row_id").select("row_id", "feature", "value", "y")


@register("sparse_beta_io", f"WITH {q_logistic.XL}, {q_logistic.BP} SELECT feature, value FROM bp")
def q_sparse_beta_io(spark, sf):
    """Probe β → quoted CSV (replace) → read back."""
    _, xl = inputs.sparse_points(spark, sf)
    beta = q_logistic._probe(xl)
    path = scratch_path(spark, "sparse-beta")
    SS.write_sparse_beta(beta, path, "csv")
    SS.write_sparse_beta(beta, path, "csv")  # an existing target is replaced
    return SS.read_sparse_beta(spark, path, "csv")


@register("write_factors", "WITH " + q_factor.RT + " " + " UNION ALL ".join(
    f"SELECT '{p}' AS side, {i} AS id, " + ", ".join(f"round((({i} * 7919 + {k * 104729}) % 1000) / 1000.0 - 0.5, 9) AS c{k}" for k in range(3))
    + f" FROM (SELECT DISTINCT {i} FROM rt)" for p, i in (("u", "i"), ("v", "j"))))
def q_write_factors(spark, sf):
    """Profiles saved as ``<out>_U`` / ``<out>_V`` parquet and read back."""
    U, V = M.init_profiles(inputs.ratings(spark, sf), 3, method="formula")
    path = scratch_path(spark, "factors")
    write_factors(U, V, path)
    sides = [p.select(F.lit(n).alias("side"), F.col(i).alias("id"), *[F.round(F.col(n)[k], 9).alias(f"c{k}") for k in range(3)])
             for p, n, i in zip(read_factors(spark, path), "uv", "ij")]
    return sides[0].unionByName(sides[1])


# ---- readers over files that Spark wrote from the tables -------------------------
@register("read_lines_file", f"""SELECT source, line, count(*) AS n FROM
(SELECT source, unnest({lines_sql('text')}) AS line FROM documents) GROUP BY source, line""")
def q_read_lines_file(spark, sf):
    """All documents written as text files, a folder per source, read back by
    the line reader in one scan; the source comes from the file's path."""
    path = scratch_path(spark, "lines")
    d = inputs.documents(spark, sf).select("source", F.explode(split_lines("text")).alias("value"))
    d.write.partitionBy("source").text(path)
    got = ST.read_lines(spark, f"{path}/*")
    return (got.select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source"), "line")
            .groupBy("source", "line").agg(F.count(F.lit(1)).alias("n")))


@register("read_word_list_file", EASY_WORDS_SQL)
def q_read_word_list_file(spark, sf):
    """The easy words written one per line, with blanks around, and read back."""
    path = scratch_path(spark, "words")
    inputs.easy_words(spark, sf).select(F.concat(F.lit(" \t"), "word", F.lit("  ")).alias("value")).write.text(path)
    return ST.read_word_list(spark, path)


@register("read_dense_points_file", f"WITH {q_dense.PTS} SELECT x0, x1, x2, y, count(*) AS n FROM pts GROUP BY ALL")
def q_read_dense_points_file(spark, sf):
    """lineitem as CSV lines in text files, read by the dense reader; ``n``
    counts row ids, which must be distinct."""
    path = scratch_path(spark, "dense-lines")
    p = inputs.dense_points(spark, sf)
    p.select(SD.format_dense_line(F.array("x0", "x1", "x2"), F.col("y")).alias("value")).write.text(path)
    got = SD.read_dense_points(spark, path).select("row_id", *[F.col("x")[k].alias(f"x{k}") for k in range(3)], "y")
    return got.groupBy("x0", "x1", "x2", "y").agg(F.count_distinct("row_id").alias("n"))


@register("read_sparse_points_file", f"WITH {q_logistic.XL}, {q_logistic.PT} SELECT xl.feature, xl.value, pt.y, count(*) AS n "
          "FROM xl JOIN pt ON pt.row_id = xl.row_id GROUP BY ALL")
def q_read_sparse_points_file(spark, sf):
    """Labelled bags of words as literal lines in text files, read by the sparse
    reader; ``n`` counts row ids."""
    path = scratch_path(spark, "sparse-text")
    pts, xl = inputs.sparse_points(spark, sf)
    SS.format_sparse_line(xl, pts.select("row_id", "y")).select("line").write.text(path)
    points, x = SS.read_sparse_points(spark, path)
    rows = x.join(points, "row_id").select("feature", "value", "y", "row_id").distinct()  # where the rows are
    return rows.groupBy("feature", "value", "y").agg(F.count("row_id").alias("n"))


@register("read_beta_lines", f"WITH {q_logistic.XL}, {q_logistic.BP} SELECT feature, value FROM bp")
def q_read_beta_lines(spark, sf):
    """Probe β as lines ``('feat', value)`` in text files, read back."""
    path = scratch_path(spark, "beta-lines")
    SS.write_beta_lines(q_logistic._probe(inputs.sparse_points(spark, sf)[1]), path)
    return SS.read_beta_lines(spark, path)


@register("read_ratings_file", f"WITH {q_factor.RT} SELECT i, j, r FROM rt")
def q_read_ratings_file(spark, sf):
    """Ratings as ``i,j,r`` text, read back with the explicit schema."""
    path = scratch_path(spark, "ratings-text")
    inputs.ratings(spark, sf).select(F.concat_ws(",", F.col("i").cast("string"), F.col("j").cast("string"), F.col("r").cast("string")).alias("value")).write.text(path)
    return read_ratings(spark, path)


def _history_sink(spark, sf, max_iter: int, eps: float):
    pts, xl = q_logistic._data(spark, sf)
    path = scratch_path(spark, "history")
    SK.write_history(L.history_frame(spark, L.train(pts, xl, lam=q_logistic.LAM, max_iter=max_iter, eps=eps)), path)
    h = SK.read_csv_table(spark, path, "k int, t double, objective double, grad_norm double, step double, rejected int, "
                                       "acc double, pre double, rec double")
    return h.select("k", F.round("objective", 5).alias("objective"), F.round("grad_norm", 5).alias("grad_norm"), "step", "rejected")


@register("history_sink", q_logistic._history_sql(q_logistic.MAX_ITER, False, eps=q_logistic.EPS))
def q_history_sink(spark, sf):
    """Logistic training history (max_iter 40, eps 0.1) → CSV with header → read
    back (the time column is written too; it is left out of the result)."""
    return _history_sink(spark, sf, q_logistic.MAX_ITER, q_logistic.EPS)


@register("history_sink_2iter", q_logistic._history_sql(2, False))
def q_history_sink_2iter(spark, sf):
    """The same for two iterations, value-checked."""
    return _history_sink(spark, sf, 2, 0.0)


@register("metrics_sink", q_logistic._train_sql(2, " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS max_iter, CAST({q_logistic.LAM!r} AS DOUBLE) AS lam, m.* FROM ({q_logistic._metrics_sql(f'mg{k}')}) m"
    for k in (1, 2))))
def q_metrics_sink(spark, sf):
    """(max_iter, λ, ACC, PRE, REC) of two trained models on the test rows, each
    appended to one CSV table, and the table read back."""
    pts, xl = q_logistic._data(spark, sf)
    path = scratch_path(spark, "metrics")
    for k in (1, 2):
        fit = L.train(pts, xl, lam=q_logistic.LAM, max_iter=k, eps=0.0)
        e = L.evaluate(pts.where(F.col("is_test")), xl, Steps(spark, "beta").write(fit.beta))
        SK.append_metrics(e.select(F.lit(k).alias("max_iter"), F.lit(q_logistic.LAM).alias("lam"),
                                   *[F.round(c, 9).alias(c) for c in ("acc", "pre", "rec")]), path, f"iterations-{k}")
    return SK.read_metrics(spark, path, "max_iter int, lam double, acc double, pre double, rec double").drop("run")


@register("report_sink", ORACLES["readability_by_source"])
def q_report_sink(spark, sf):
    """Readability by category → CSV report → read back."""
    rep = q_text.q_readability_by_source(spark, sf)
    path = scratch_path(spark, "report")
    SK.write_report(rep, path)
    return SK.read_csv_table(spark, path, "source string, sentences bigint, words bigint, difficult bigint, dcf double")


@register("onehot_sparse", """SELECT c_custkey AS row_id, 'c_mktsegment_' || c_mktsegment AS feature, 1.0 AS value FROM customer
UNION ALL SELECT c_custkey, 'c_nationkey_' || CAST(c_nationkey AS VARCHAR), 1.0 FROM customer""")
def q_onehot_sparse(spark, sf):
    """Categorical columns of customer → sparse rows ``attr_value`` = 1.0."""
    c = inputs.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return onehot_sparse(c, "c_custkey", ["c_mktsegment", "c_nationkey"]).withColumnRenamed("c_custkey", "row_id")


@register("poly2_features", f"WITH {q_dense.PTS} SELECT row_id, x0 AS p0, x1 AS p1, x2 AS p2, "
          + ", ".join(f"x{i} * x{j} AS p{3 + n}" for n, (i, j) in enumerate((i, j) for i in range(3) for j in range(i, 3)))
          + " FROM pts")
def q_poly2_features(spark, sf):
    """Degree-2 expansion of the dense points: 3 → 9 columns."""
    p = q_dense._pts(spark, sf).select("row_id", poly2_features("x").alias("p"))
    return p.select("row_id", *[F.col("p")[k].alias(f"p{k}") for k in range(9)])
