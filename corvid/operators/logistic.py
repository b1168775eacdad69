"""Sparse logistic regression with a distributed coefficient table.

Data: ``points(row_id, y ∈ {−1,+1}[, is_test])`` and the long form
``x_long(row_id, feature, value)``; β and gradients are ``(feature, value)``
tables. Loss is a *sum* over rows plus λ‖β‖².

Layout: rows are dealt into blocks (``pid``, a hash of row_id) and x_long is
partitioned by block once (``Blocks``). A feature table that is proven small is
broadcast. Beyond that, ``f2p(feature, pid)`` says which blocks need which
feature: the table joins f2p, only the needed entries move to their blocks, and
the join with x_long happens in place. A feature that every row has is one
entry per block, so there is no hot key and x_long never moves.

Training runs on packed blocks instead (``sparse_blocks``): two scans per iteration
for any number of models, with dense feature ids.
"""

from __future__ import annotations

import heapq
import math
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.vectors import logistic_coef, softplus
from corvid.iterate import Steps
from corvid.operators.sparse_blocks import HELD_BYTES, PackedRows, batches_by_bytes, train_held, train_models
from corvid.plans.joins import is_bounded, size_of

# Fixed values of the reference's backtracking line search and defaults.
LS_A = 0.2
LS_B = 0.6
LS_BATCH = 64          # candidates evaluated per pass
GREEDY_ROUNDS = 64     # rows per group that are dealt one by one, the largest
BLOCK_ENTRIES = 4_000_000  # entries of x_long per block, about 200 MB
# A partitioning by block serves joins on (block, row) and (block, feature).
_SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def block_joins(spark):
    """Let joins on (pid, …) use a partitioning by pid alone."""
    old = spark.conf.get(_SUBSET_KEYS)
    spark.conf.set(_SUBSET_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_SUBSET_KEYS, old)


# ---- data preparation -----------------------------------------------------------
class Blocks:
    """``x_long`` dealt into blocks of rows, persisted; the caller releases it.

    ``broadcast``: whether feature tables of these features are bounded (rows
    and bytes measured); None lets ``bounded`` measure each table it is given."""

    def __init__(self, x_long: DataFrame, n_blocks: int | None = None, broadcast: bool | None = None):
        spark = x_long.sparkSession
        if n_blocks is None:
            entries = size_of(x_long.select("row_id"))[0]
            n_blocks = max(math.ceil(entries / BLOCK_ENTRIES), spark.sparkContext.defaultParallelism)
        self.n, self.broadcast, self._f2p = n_blocks, broadcast, None
        self.x = (x_long.select("row_id", "feature", "value", self.pid("row_id").alias("pid"))
                  .repartition(n_blocks, "pid").persist(StorageLevel.MEMORY_AND_DISK))
        self.x.count()  # the planner knows the layout of a cached table once it is there

    def pid(self, row_id) -> Column:
        return F.pmod(F.xxhash64(row_id), F.lit(self.n)).cast("int")

    @property
    def f2p(self) -> DataFrame:
        """``(feature, pid)``: the blocks that need a feature."""
        if self._f2p is None:
            self._f2p = self.x.select("feature", "pid").distinct().persist(StorageLevel.MEMORY_AND_DISK)
        return self._f2p

    def with_features(self, table: DataFrame) -> DataFrame:
        """x_long with the columns of a feature table (inner)."""
        if is_bounded(table) if self.broadcast is None else self.broadcast:
            return self.x.join(F.broadcast(table), "feature")
        needed = self.f2p.join(table.hint("merge"), "feature").repartition(self.n, "pid")
        return self.x.join(needed.hint("shuffle_hash"), ["pid", "feature"])

    def with_rows(self, rows: DataFrame) -> DataFrame:
        """x_long with the columns of a row table (inner)."""
        return self.x.join(rows.withColumn("pid", self.pid("row_id")).repartition(self.n, "pid").hint("shuffle_hash"), ["pid", "row_id"])

    def release(self) -> None:
        self.x.unpersist()
        if self._f2p is not None:
            self._f2p.unpersist()


def all_features(x_long: DataFrame) -> DataFrame:
    return x_long.select("feature").distinct()


def beta_init(x_long: DataFrame) -> DataFrame:
    """Every feature of the (train) data at 0.0."""
    return all_features(x_long).select("feature", F.lit(0.0).alias("value"))


def group_data(points: DataFrame, n: int) -> DataFrame:
    """Rows assigned to N groups by ``pid = pmod(row_id, N)`` and hash
    partitioned on it: a function of the data, not of the task layout."""
    return points.withColumn("pid", F.pmod(F.col("row_id"), F.lit(n)).cast("int")).repartition(n, "pid")


def balanced_groups(points: DataFrame, x_long: DataFrame, n: int, per_bucket: int = 50_000) -> DataFrame:
    """``(row_id, entries, pid)``: rows dealt into N groups of about equal entries.
    The largest rows (``GREEDY_ROUNDS`` per group) go to the least loaded group each,
    one after the other; the others are dealt to and fro, starting with the least
    loaded group, which adds at most the largest of them to any difference. Ties go by
    a hash of row_id; the place in the order is counted on two levels – the rows of each
    (entries, hash prefix), then inside them – so no task sorts all rows of one size."""
    spark = points.sparkSession
    sizes = x_long.groupBy("row_id").agg(F.count(F.lit(1)).alias("entries"))
    rows = points.select("row_id").join(sizes, "row_id", "left").select(
        "row_id", F.coalesce("entries", F.lit(0)).alias("entries"), F.md5(F.col("row_id").cast("string")).alias("h"))
    rows = Steps(spark, "row-sizes").write(rows)
    digits = max(0, math.ceil(math.log(max(rows.count(), 1) / per_bucket, 16)))  # of the hash prefix
    rows = rows.withColumn("b", F.substring("h", 1, digits))
    classes = rows.groupBy("entries", "b").agg(F.count(F.lit(1)).alias("m"))
    before = lambda w: F.coalesce(F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = (classes.groupBy("entries").agg(F.sum("m").alias("m"))  # one row per number of entries
             .select(F.col("entries").alias("_e"), before(Window.orderBy(F.desc("entries"))).alias("above")))
    inside = classes.select("entries", "b", before(Window.partitionBy("entries").orderBy("b")).alias("inside"))
    base = inside.join(above, F.col("entries") == F.col("_e")).select(
        F.col("entries").alias("_e"), F.col("b").alias("_b"), (F.col("above") + F.col("inside")).alias("base"))
    own = F.row_number().over(Window.partitionBy("entries", "b").orderBy("h", "row_id")) - 1
    placed = rows.withColumn("own", own).join(base, (F.col("entries") == F.col("_e")) & (F.col("b") == F.col("_b")))
    placed = Steps(spark, "row-places").write(placed.select("row_id", "entries", (F.col("base") + F.col("own")).alias("place")))
    first = n * GREEDY_ROUNDS
    top = placed.where(F.col("place") < first).select("place", "entries").orderBy("place").collect()  # as many at most
    loads, given = [(0, k) for k in range(n)], []
    for r in top:
        load, k = heapq.heappop(loads)
        given.append((r["place"], k))
        heapq.heappush(loads, (load + r["entries"], k))
    given = spark.createDataFrame(given, "_place long, _given int")
    turn = F.array(*[F.lit(k) for _, k in sorted(loads)])  # groups by load
    later = F.col("place") - first
    at, back = F.pmod(later, F.lit(n)), F.floor(later / n) % 2 == 1
    dealt = F.element_at(turn, (F.when(back, n - 1 - at).otherwise(at) + 1).cast("int"))
    j = placed.join(F.broadcast(given), F.col("place") == F.col("_place"), "left")
    return j.select("row_id", "entries", F.coalesce("_given", dealt).cast("int").alias("pid"))


def partition_stats(x_long: DataFrame, points: DataFrame, n: int) -> DataFrame:
    """min/max/mean of rows and of distinct features per group, one row."""
    pid = F.pmod(F.col("row_id"), F.lit(n)).cast("int")
    rows = points.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("rows"))
    feats = (x_long.select(pid.alias("pid"), "feature").distinct()
             .groupBy("pid").agg(F.count(F.lit(1)).alias("features")))
    j = rows.join(feats, "pid", "left").fillna(0, ["features"])
    return j.agg(F.min("rows").alias("rows_min"), F.max("rows").alias("rows_max"), F.avg("rows").alias("rows_avg"),
                 F.min("features").alias("features_min"), F.max("features").alias("features_max"),
                 F.avg("features").alias("features_avg"))


def features_to_partitions(x_long: DataFrame, n: int) -> DataFrame:
    return x_long.select("feature", F.pmod(F.col("row_id"), F.lit(n)).cast("int").alias("pid")).distinct()


def send_to_partitions(beta: DataFrame, f2p: DataFrame) -> DataFrame:
    """Per group only the β entries its rows use: ``(pid, feature, value)``."""
    return f2p.join(beta, "feature")


def _with_features(x, table: DataFrame) -> DataFrame:
    """x_long ⋈ a feature table; a single call on x_long that is in no blocks
    broadcasts a bounded table, else Spark joins by feature and splits hot ones."""
    if isinstance(x, Blocks):
        return x.with_features(table)
    return x.join(F.broadcast(table) if is_bounded(table) else table.hint("merge"), "feature")


def _with_rows(x, rows: DataFrame) -> DataFrame:
    return x.with_rows(rows) if isinstance(x, Blocks) else x.join(rows, "row_id")


def margins(points: DataFrame, x, beta: DataFrame) -> DataFrame:
    """``(row_id, y, margin)``; rows sharing no feature with β keep margin 0
    (left join from the points, so no row is lost from loss or metrics).
    ``x`` is x_long or its ``Blocks``."""
    j = _with_features(x, beta.withColumnRenamed("value", "_b"))
    m = j.groupBy("row_id").agg(F.sum(F.col("value") * F.col("_b")).alias("margin"))
    return points.join(m, "row_id", "left").withColumn("margin", F.coalesce("margin", F.lit(0.0)))


def sq_norm(beta: DataFrame) -> DataFrame:
    return beta.agg(F.coalesce(F.sum(F.col("value") * F.col("value")), F.lit(0.0)).alias("sq"))


def total_loss(points: DataFrame, x, beta: DataFrame, lam: float = 0.0) -> float:
    m = margins(points, x, beta)
    loss = m.agg(F.sum(softplus(-F.col("y") * F.col("margin"))).alias("l")).first()["l"] or 0.0
    reg = lam * (sq_norm(beta).first()["sq"]) if lam else 0.0
    return float(loss + reg)


def gradient_from_rows(rows: DataFrame, x, beta: DataFrame, lam: float = 0.0) -> DataFrame:
    """∇ = Σ_rows c·x + 2λβ as ``(feature, value)``, defined on β's features
    (left join from β: a feature absent from the data still shrinks)."""
    c = rows.select("row_id", logistic_coef(F.col("margin"), F.col("y")).alias("_c"))
    g = _with_rows(x, c).groupBy("feature").agg(F.sum(F.col("_c") * F.col("value")).alias("_g"))
    return (beta.join(g, "feature", "left")
            .select("feature", (F.coalesce("_g", F.lit(0.0)) + F.lit(2.0 * lam) * F.col("value")).alias("value")))


def total_gradient(points, x, beta, lam: float = 0.0) -> DataFrame:
    return gradient_from_rows(margins(points, x, beta), x, beta, lam)


def slopes(rows: DataFrame, x, grad: DataFrame) -> DataFrame:
    """rows + ``s = <x, ∇>`` per row (0 for rows sharing no feature with ∇)."""
    j = _with_features(x, grad.withColumnRenamed("value", "_g"))
    s = j.groupBy("row_id").agg(F.sum(F.col("value") * F.col("_g")).alias("s"))
    return rows.join(s, "row_id", "left").withColumn("s", F.coalesce("s", F.lit(0.0)))


def _vec_terms(beta: DataFrame, grad: DataFrame) -> tuple[float, float, float]:
    """‖β‖², <β,∇>, ‖∇‖² in one aggregate over the feature table."""
    j = beta.withColumnRenamed("value", "_b").join(grad.withColumnRenamed("value", "_g"), "feature", "full")
    b, g = F.coalesce("_b", F.lit(0.0)), F.coalesce("_g", F.lit(0.0))
    r = j.agg(F.sum(b * b).alias("bb"), F.sum(b * g).alias("bg"), F.sum(g * g).alias("gg")).first()
    return float(r["bb"] or 0.0), float(r["bg"] or 0.0), float(r["gg"] or 0.0)


def line_search(rows_s: DataFrame, bb: float, bg: float, gg: float, lam: float = 0.0,
                a: float = LS_A, b: float = LS_B) -> tuple[float, float, float, int]:
    """Backtracking: the first t ∈ {1, b, b², …} with
    f(β − t∇) ≤ f(β) − a·t·‖∇‖². All candidates of a batch are evaluated in
    one aggregate over the row table (margins m, slopes s):
    f(β − t∇) = Σ softplus(−y(m − t·s)) + λ(‖β‖² − 2t<β,∇> + t²‖∇‖²).
    Returns (t, f(β − t∇), f(β), k)."""
    y, m, s = F.col("y"), F.col("margin"), F.col("s")
    f0, t, k = None, 1.0, 0
    while t > 0:  # until the step underflows; the reference has no bound
        ts = []
        for _ in range(LS_BATCH):  # t ← b·t, the same sequence of doubles as the reference
            ts.append(t)
            t = b * t
        aggs = [F.sum(softplus(-y * (m - F.lit(x) * s))).alias(f"l{i}") for i, x in enumerate(ts)]
        if f0 is None:
            aggs.append(F.sum(softplus(-y * m)).alias("base"))
        r = rows_s.agg(*aggs).first()
        if f0 is None:
            f0 = float(r["base"] or 0.0) + lam * bb
        for i, x in enumerate(ts):
            ft = float(r[f"l{i}"] or 0.0) + lam * (bb - 2 * x * bg + x * x * gg)
            if ft <= f0 - a * x * gg:
                return x, ft, f0, k + i
        k += LS_BATCH
    raise RuntimeError("line search found no step")


def confusion_expr(margin="margin", y="y"):
    """#P, #N, #TP, #FP, #TN, #FN from the sign of the margin. Like the
    reference, a zero margin is in neither P nor N."""
    m, yy = F.col(margin), F.col(y)
    return [F.count_if(m > 0).alias("P"), F.count_if(m < 0).alias("N"),
            F.count_if((m > 0) & (yy == 1)).alias("TP"), F.count_if((m > 0) & (yy == -1)).alias("FP"),
            F.count_if((m < 0) & (yy == -1)).alias("TN"), F.count_if((m < 0) & (yy == 1)).alias("FN")]


def acc_pre_rec(df: DataFrame) -> DataFrame:
    """ACC, PRE, REC from confusion counts; NULL on a zero denominator."""
    c = F.col
    return df.select("*",
                     F.try_divide(c("TP") + c("TN"), c("P") + c("N")).alias("acc"),
                     F.try_divide(c("TP"), c("TP") + c("FP")).alias("pre"),
                     F.try_divide(c("TP"), c("TP") + c("FN")).alias("rec"))


def confusion_counts(rows_with_margin: DataFrame) -> DataFrame:
    return rows_with_margin.agg(*confusion_expr())


def evaluate(points, x, beta) -> DataFrame:
    return acc_pre_rec(confusion_counts(margins(points, x, beta)))


@dataclass
class LogisticFit:
    beta: DataFrame | None
    grad_norm: float
    iterations: int
    history: list


def train_sweep(points: DataFrame, x_long: DataFrame, lams, beta0: DataFrame | None = None, max_iter: int = 40,
                eps: float = 0.1, n_partitions: int | None = None, online_test: bool = False, broadcast: bool | None = None,
                betas: bool = True, journal: str | None = None) -> list[LogisticFit]:
    """One model per λ, all trained in the same scans of packed blocks (see
    ``sparse_blocks``), on the rows of ``points`` with ``is_test`` false (all rows
    when the column is absent). With ``online_test`` the histories carry test
    ACC/PRE/REC per iteration; without it, test rows take no part at all.

    A model stops at ``max_iter`` or when ‖∇L(β_k)‖ ≤ eps; the reported norm is the
    one of the last gradient (before the last update), as in the reference.
    ``broadcast`` overrides the counted choice: coefficients broadcast from the
    driver, or a table of which each block gets what it uses. Without ``betas`` the
    fits carry no β tables. ``journal`` names a folder in which every iteration is
    committed; called again with it, training goes on from the last one (history,
    norms and β included), also with a larger ``max_iter``."""
    if "is_test" not in points.columns:
        points = points.withColumn("is_test", F.lit(False))
    if not online_test:
        points = points.where(~F.col("is_test"))
    with batches_by_bytes(points.sparkSession):
        x = PackedRows(points, x_long, beta0, n_partitions)
        if beta0 is None and broadcast is None and journal is None and not betas and 0 < x.held_bytes() <= HELD_BYTES:
            runs = train_held(x, lams, max_iter, eps, online_test, LS_A, LS_B, LS_BATCH)
            x.release()
            return [LogisticFit(None, r.grad_norm, r.iterations, r.history) for r in runs]
        vectors, runs = train_models(x, lams, beta0, max_iter, eps, online_test, LS_A, LS_B, LS_BATCH, broadcast, journal)
        out = Steps(points.sparkSession, "logistic")
        all_betas = out.write(vectors.coefficients()) if betas else None
    fits = [LogisticFit(all_betas.select("feature", F.col("values")[k].alias("value")) if betas else None, r.grad_norm, r.iterations, r.history)
            for k, r in enumerate(runs)]
    vectors.release()
    x.release()
    return fits


def train(points: DataFrame, x_long: DataFrame, beta0: DataFrame | None = None, lam: float = 0.0,
          max_iter: int = 40, eps: float = 0.1, n_partitions: int | None = None,
          online_test: bool = False, broadcast: bool | None = None, journal: str | None = None) -> LogisticFit:
    """One model: ``train_sweep`` with a single λ."""
    return train_sweep(points, x_long, [lam], beta0, max_iter, eps, n_partitions, online_test, broadcast, journal=journal)[0]


def history_frame(spark, fit: LogisticFit) -> DataFrame:
    cols = ["k", "t", "objective", "grad_norm", "step", "rejected", "acc", "pre", "rec"]
    rows = [tuple(h.get(c) for c in cols) for h in fit.history]
    return spark.createDataFrame(rows, "k int, t double, objective double, grad_norm double, step double, "
                                       "rejected int, acc double, pre double, rec double")


def sparse_fd_gradient(points, x, beta, lam: float = 0.0, delta: float = 1e-4) -> DataFrame:
    """Forward differences per feature in one scan: moving β_f by δ only
    changes the margins of rows holding f, so
    ΔL_f = Σ_{rows ∋ f} [softplus(−y(m+δx)) − softplus(−y·m)] + λ((β_f+δ)² − β_f²).
    → ``(feature, fd, analytic)``."""
    m = margins(points, x, beta)
    j = _with_rows(x, m.select("row_id", "y", "margin"))
    y, mm, v = F.col("y"), F.col("margin"), F.col("value")
    d = j.groupBy("feature").agg(
        F.sum(softplus(-y * (mm + F.lit(delta) * v)) - softplus(-y * mm)).alias("_dl"),
        F.sum(logistic_coef(mm, y) * v).alias("_g"))
    b = beta.withColumnRenamed("value", "_b")
    out = b.join(d, "feature", "left")
    bv = F.col("_b")
    return out.select("feature",
                      ((F.coalesce("_dl", F.lit(0.0)) + F.lit(lam) * ((bv + F.lit(delta)) * (bv + F.lit(delta)) - bv * bv))
                       / F.lit(delta)).alias("fd"),
                      (F.coalesce("_g", F.lit(0.0)) + F.lit(2.0 * lam) * bv).alias("analytic"))


def model_compare(beta_a: DataFrame, beta_b: DataFrame) -> DataFrame:
    """Two β tables side by side: features in either, max |a − b|, norms."""
    j = beta_a.withColumnRenamed("value", "_a").join(beta_b.withColumnRenamed("value", "_b"), "feature", "full")
    a, b = F.coalesce("_a", F.lit(0.0)), F.coalesce("_b", F.lit(0.0))
    return j.agg(F.count(F.lit(1)).alias("n_features"),
                 F.coalesce(F.max(F.abs(a - b)), F.lit(0.0)).alias("max_abs_diff"),
                 F.sqrt(F.sum(a * a)).alias("norm_a"), F.sqrt(F.sum(b * b)).alias("norm_b"))
