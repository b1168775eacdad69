"""Dense least squares: ridge by gradient descent with exact line search and
L1-ball constrained least squares by Frank-Wolfe.

Every quantity the solvers need is a quadratic in β, so one pass over the data
computing the sufficient statistics (n, Σy², Xᵀy, XᵀX — ``gram_stats``) is
enough for any number of iterations, λ values or K values: the loops run on a
d×d summary and launch no further Spark job. The per-call operators
(objective, gradient, line quadratic, MSE) are also available as single
aggregates over the data for any β.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.vectors import dot_lit

# Width above which XᵀX is built per partition with numpy instead of as one
# generated aggregate of d(d+1)/2 sums (code size grows with d²).
WIDE_D = 24


# ---- sufficient statistics -------------------------------------------------------
@dataclass
class Gram:
    """Means over the data: A = XᵀX/n, b = Xᵀy/n, c = yᵀy/n."""
    n: int
    A: np.ndarray
    b: np.ndarray
    c: float

    @property
    def d(self) -> int:
        return len(self.b)


def _x_dim(df: DataFrame, x_col: str) -> int:
    r = df.select(F.size(x_col).alias("d")).where(F.col("d") >= 0).first()
    if r is None:
        raise ValueError("no data")
    return int(r["d"])


def gram_sums(df: DataFrame, x_col: str = "x", y_col: str = "y", d: int | None = None) -> DataFrame:
    """Long form ``(i, j, s)`` of the raw sums with the conventions
    i = j = −1: n; i = −1, j = −2: Σy²; i = −1, j ≥ 0: Σ x_j y; 0 ≤ i ≤ j: Σ x_i x_j.

    Small d: one aggregate (partial per task, one row per task shuffled).
    Wide d: numpy XᵀX per Arrow batch inside the tasks; a task emits one packed
    row per matrix row (d + 1 rows, whatever n is), which are summed column-wise
    by partial and final aggregates.
    """
    d = d or _x_dim(df, x_col)
    pts = df.select(F.col(x_col).alias("x"), F.col(y_col).cast("double").alias("y"))
    if d <= WIDE_D:
        x = F.col("x")
        aggs = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy")]
        aggs += [F.sum(x[j] * F.col("y")).alias(f"xy_{j}") for j in range(d)]
        aggs += [F.sum(x[i] * x[j]).alias(f"xx_{i}_{j}") for i in range(d) for j in range(i, d)]
        row = pts.agg(*aggs)
        stack = [("-1", "-1", "n"), ("-1", "-2", "yy")]
        stack += [("-1", str(j), f"xy_{j}") for j in range(d)]
        stack += [(str(i), str(j), f"xx_{i}_{j}") for i in range(d) for j in range(i, d)]
        expr = "stack({}, {}) as (i, j, s)".format(len(stack), ", ".join(f"{a}, {b}, {c}" for a, b, c in stack))
        return row.selectExpr(expr)

    def partial(batches):
        acc_xx, acc_xy, n, yy = np.zeros((d, d)), np.zeros(d), 0.0, 0.0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.vstack(pdf["x"].to_numpy())
            y = pdf["y"].to_numpy(dtype=float)
            acc_xx += X.T @ X
            acc_xy += X.T @ y
            n += len(y)
            yy += float(y @ y)
        # row -1 holds n, Σy², Xᵀy; row i holds XᵀX[i]
        rows = [np.concatenate([[n, yy], acc_xy]), *(np.concatenate([[0.0, 0.0], r]) for r in acc_xx)]
        yield pd.DataFrame({"i": np.arange(-1, d, dtype="int32"), "a": rows})

    parts = pts.mapInPandas(partial, "i int, a array<double>")
    summed = parts.groupBy("i").agg(F.array(*[F.sum(F.col("a")[k]) for k in range(d + 2)]).alias("a"))
    long = summed.select("i", F.posexplode("a").alias("k", "s"))
    j = F.when(F.col("k") == 0, F.lit(-1)).when(F.col("k") == 1, F.lit(-2)).otherwise(F.col("k") - 2)
    return long.select("i", j.cast("int").alias("j"), "s").where("i = -1 OR j >= i")


def gram_stats(df: DataFrame, x_col: str = "x", y_col: str = "y", d: int | None = None) -> Gram:
    """Collect the O(d²) summary to the driver (never the data)."""
    d = d or _x_dim(df, x_col)
    rows = gram_sums(df, x_col, y_col, d).collect()
    A = np.zeros((d, d))
    b = np.zeros(d)
    n = yy = 0.0
    for r in rows:
        i, j, s = int(r["i"]), int(r["j"]), float(r["s"] or 0.0)
        if i == -1 and j == -1:
            n = s
        elif i == -1 and j == -2:
            yy = s
        elif i == -1:
            b[j] = s
        else:
            A[i, j] = A[j, i] = s
    if n == 0:
        raise ValueError("no data")
    return Gram(int(n), A / n, b / n, yy / n)


# ---- quadratic forms on the summary ---------------------------------------------
def objective_g(g: Gram, beta, lam: float = 0.0) -> float:
    beta = np.asarray(beta, float)
    return float(g.c - 2 * g.b @ beta + beta @ g.A @ beta + lam * beta @ beta)


def gradient_g(g: Gram, beta, lam: float = 0.0) -> np.ndarray:
    beta = np.asarray(beta, float)
    return 2 * (g.A @ beta) - 2 * g.b + 2 * lam * beta


def hcoeff_g(g: Gram, beta1, beta2, lam: float = 0.0) -> tuple[float, float, float]:
    """(a, b, c) with F(β1 + γβ2) = aγ² + bγ + c."""
    b1, b2 = np.asarray(beta1, float), np.asarray(beta2, float)
    a = float(b2 @ g.A @ b2 + lam * b2 @ b2)
    b = float(2 * lam * b1 @ b2 - 2 * (g.b @ b2 - b1 @ g.A @ b2))
    c = objective_g(g, b1, lam)
    return a, b, c


def solve_lin(z, K: float) -> np.ndarray:
    """argmin zᵀs over ‖s‖₁ ≤ K: −K·sign(z) on the coordinate of largest |z|
    (lowest index among ties, so the point stays in the ball)."""
    z = np.asarray(z, float)
    s = np.zeros_like(z)
    if z.size:
        i = int(np.argmax(np.abs(z)))
        s[i] = -K * np.sign(z[i])
    return s


def fw_gamma(a: float, b: float) -> float:
    """argmin over [0,1] of aγ² + bγ: clip(−b/2a); a = 0 → 0 if b > 0 else 1."""
    if a != 0:
        return float(np.clip(-b / (2 * a), 0.0, 1.0))
    return 0.0 if b > 0 else 1.0


# ---- solvers ---------------------------------------------------------------------
@dataclass
class FitResult:
    beta: np.ndarray
    measure: float          # ‖∇F‖ (GD) or FW gap, from before the last update
    iterations: int
    history: list = field(default_factory=list)


def train_gd_g(g: Gram, beta0=None, lam: float = 0.0, max_iter: int = 100, eps: float = 0.01) -> FitResult:
    """Gradient descent with exact line search on the summary. Stops at
    ``max_iter`` or when ‖∇F(β_k)‖ ≤ eps; like the reference the reported norm
    is the one computed before the last update. A zero curvature (a = 0)
    stops the loop instead of dividing by zero."""
    beta = np.zeros(g.d) if beta0 is None else np.asarray(beta0, float).copy()
    k, norm, hist = 0, float("inf"), []
    while k < max_iter and norm > eps:
        grad = gradient_g(g, beta, lam)
        obj = objective_g(g, beta, lam)
        a, b, _ = hcoeff_g(g, beta, -grad, lam)
        norm = float(np.linalg.norm(grad))
        if a == 0:
            hist.append((k, obj, norm, 0.0))
            break
        gamma = -b / (2 * a)
        hist.append((k, obj, norm, gamma))
        beta = beta - gamma * grad
        k += 1
    return FitResult(beta, norm, k, hist)


def train_fw_g(g: Gram, beta0=None, K: float = 100.0, max_iter: int = 100, eps: float = 0.01) -> FitResult:
    """Frank-Wolfe on ‖β‖₁ ≤ K with exact line search on [0, 1]; stops when the
    gap (β_k − s_k)ᵀ∇F(β_k) ≤ eps."""
    beta = np.zeros(g.d) if beta0 is None else np.asarray(beta0, float).copy()
    k, crit, hist = 0, float("inf"), []
    while k < max_iter and crit > eps:
        obj = objective_g(g, beta, 0.0)
        grad = gradient_g(g, beta, 0.0)
        s = solve_lin(grad, K)
        crit = float((beta - s) @ grad)
        a, b, _ = hcoeff_g(g, beta, s - beta, 0.0)
        gamma = fw_gamma(a, b)
        beta = (1 - gamma) * beta + gamma * s
        hist.append((k, obj, crit, gamma, float(np.abs(beta).sum() / K)))
        k += 1
    return FitResult(beta, crit, k, hist)


def beta_frame(spark: SparkSession, beta, extra: dict | None = None) -> DataFrame:
    """A driver vector (O(d)) as the table ``(idx int, value double)``."""
    rows = [(i, float(v)) for i, v in enumerate(beta)]
    df = spark.createDataFrame(rows, "idx int, value double")
    for k, v in (extra or {}).items():
        df = df.withColumn(k, F.lit(v))
    return df


def train_gd(df: DataFrame, beta0=None, lam: float = 0.0, max_iter: int = 100, eps: float = 0.01,
             x_col: str = "x", y_col: str = "y") -> FitResult:
    return train_gd_g(gram_stats(df, x_col, y_col), beta0, lam, max_iter, eps)


def train_fw(df: DataFrame, beta0=None, K: float = 100.0, max_iter: int = 100, eps: float = 0.01,
             x_col: str = "x", y_col: str = "y") -> FitResult:
    return train_fw_g(gram_stats(df, x_col, y_col), beta0, K, max_iter, eps)


def history_frame(spark: SparkSession, fit: FitResult, solver: str = "gd") -> DataFrame:
    if solver == "gd":
        return spark.createDataFrame(fit.history, "k int, objective double, grad_norm double, step double")
    return spark.createDataFrame(fit.history, "k int, objective double, gap double, step double, feasibility double")


# ---- single-pass operators over the data, for any β -------------------------------
def _res(x, y, beta):
    return F.col(y) - dot_lit(x, beta)


def ridge_objective(df: DataFrame, beta, lam: float = 0.0, x_col="x", y_col="y") -> DataFrame:
    """F(β) = mean (y − <x,β>)² + λ‖β‖² as a one-row table ``(objective)``."""
    r = _res(x_col, y_col, beta)
    reg = float(lam * np.dot(beta, beta))
    return df.agg((F.avg(r * r) + F.lit(reg)).alias("objective"))


def mse(df: DataFrame, beta, x_col="x", y_col="y") -> DataFrame:
    r = _res(x_col, y_col, beta)
    return df.agg(F.avg(r * r).alias("mse"))


def _with_residual(df: DataFrame, beta, x_col, y_col) -> DataFrame:
    """``(_x, _r)``: the residual y − <x,β> computed once per row, below the
    aggregates that use it d times."""
    return df.select(F.col(x_col).alias("_x"), _res(x_col, y_col, beta).alias("_r"))


def ridge_gradient(df: DataFrame, beta, lam: float = 0.0, x_col="x", y_col="y") -> DataFrame:
    """∇F = mean(−2 (y − <x,β>) x) + 2λβ as ``(idx, value)``: d averages in one
    aggregate, unpivoted; for wide x, numpy partial sums of d rows per task."""
    beta = np.asarray(beta, float)
    d = len(beta)
    if d > WIDE_D:
        return _wide_gradient(df, beta, lam, x_col, y_col)
    x, r = F.col("_x"), F.col("_r")
    row = _with_residual(df, beta, x_col, y_col).agg(
        *[(F.avg(F.lit(-2.0) * r * x[i]) + F.lit(2 * lam * float(beta[i]))).alias(f"g{i}") for i in range(d)])
    expr = "stack({}, {}) as (idx, value)".format(d, ", ".join(f"{i}, g{i}" for i in range(d)))
    return row.selectExpr(expr)


def _wide_gradient(df: DataFrame, beta: np.ndarray, lam: float, x_col, y_col) -> DataFrame:
    d = len(beta)

    def partial(batches):
        g, n = np.zeros(d), 0
        for pdf in batches:
            if len(pdf):
                X = np.vstack(pdf["x"].to_numpy())
                g += -2 * X.T @ (pdf["y"].to_numpy(dtype=float) - X @ beta)
                n += len(pdf)
        yield pd.DataFrame({"idx": np.arange(d, dtype="int32"), "s": g, "n": n})

    pts = df.select(F.col(x_col).alias("x"), F.col(y_col).cast("double").alias("y"))
    g = pts.mapInPandas(partial, "idx int, s double, n long").groupBy("idx").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    reg = F.element_at(F.array(*[F.lit(float(2 * lam * b)) for b in beta]), F.col("idx") + 1)
    return g.select("idx", (F.try_divide(F.col("s"), F.col("n")) + reg).alias("value"))


def train_gd_direct(df: DataFrame, lam: float = 0.0, max_iter: int = 100, eps: float = 0.01, beta0=None,
                    x_col="x", y_col="y") -> FitResult:
    """The same descent with one gradient and one line-quadratic pass over the
    data per iteration: for d so large that a d×d summary is no option."""
    beta = np.zeros(_x_dim(df, x_col)) if beta0 is None else np.asarray(beta0, float)
    hist, k, norm = [], 0, float("inf")
    while k < max_iter and norm > eps:
        g = np.zeros(len(beta))
        for r in ridge_gradient(df, beta, lam, x_col, y_col).collect():  # d rows
            g[r["idx"]] = r["value"]
        q = line_quadratic(df, beta, -g, lam, x_col, y_col).first()
        norm = float(np.sqrt(g @ g))
        step = -q["b"] / (2 * q["a"]) if q["a"] else 0.0
        hist.append((k, q["c"], norm, step))
        beta, k = beta - step * g, k + 1
        if not q["a"]:
            break
    return FitResult(beta, norm, k, hist)


def line_quadratic(df: DataFrame, beta1, beta2, lam: float = 0.0, x_col="x", y_col="y") -> DataFrame:
    """(a, b, c) of h(γ) = F(β1 + γβ2) in one aggregate (three means)."""
    b1, b2 = np.asarray(beta1, float), np.asarray(beta2, float)
    p2 = dot_lit(x_col, b2)
    r1 = _res(x_col, y_col, b1)
    return df.agg(
        (F.avg(p2 * p2) + F.lit(float(lam * b2 @ b2))).alias("a"),
        (F.lit(float(2 * lam * b1 @ b2)) - F.lit(2.0) * F.avg(r1 * p2)).alias("b"),
        (F.avg(r1 * r1) + F.lit(float(lam * b1 @ b1))).alias("c"),
    )


def exact_line_search(df: DataFrame, beta, lam: float = 0.0, x_col="x", y_col="y") -> DataFrame:
    """γ* = −b/(2a) along −∇F(β): gradient aggregate, then the quadratic."""
    g = np.array([r["value"] for r in ridge_gradient(df, beta, lam, x_col, y_col).orderBy("idx").collect()])
    q = line_quadratic(df, beta, -g, lam, x_col, y_col)
    return q.select("a", "b", "c", F.try_divide(-F.col("b"), F.lit(2.0) * F.col("a")).alias("gamma"))


def l1_ball_lmo(grad: DataFrame, K: float, idx_col: str = "idx", value_col: str = "value") -> DataFrame:
    """LMO over a gradient table: −K·sign(g) at the row with the largest |g|
    (lowest idx among ties), 0 elsewhere → ``(idx, s)``. The arg-max is a
    global top-1 (partial per task, one row shuffled) joined back by broadcast."""
    top = (grad.orderBy(F.abs(value_col).desc(), F.col(idx_col).asc()).limit(1)
           .select(F.col(idx_col).alias("_top"), (F.lit(-float(K)) * F.signum(value_col)).alias("_s")))
    j = grad.join(F.broadcast(top), F.col(idx_col) == F.col("_top"), "left")
    return j.select(idx_col, F.coalesce("_s", F.lit(0.0)).alias("s"))


def fw_line_search_expr(a, b):
    """γ = clip(−b/2a, 0, 1), and 0 if b > 0 else 1 when a = 0 (column form)."""
    a, b = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    return F.when(a != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -b / (F.lit(2.0) * a)))) \
        .otherwise(F.when(b > 0, F.lit(0.0)).otherwise(F.lit(1.0)))


def label_histogram(df: DataFrame, y_col: str = "y", bins: int = 10) -> DataFrame:
    """``(bin, n)``: equal-width bins between min and max, the last one closed.
    min and max come from one scalar aggregate and are bound as literals, so
    the count is a plain partial + final aggregate over the data."""
    mm = df.agg(F.min(y_col).alias("mn"), F.max(y_col).alias("mx")).first()
    if mm["mn"] is None:
        return df.sparkSession.createDataFrame([], "bin int, n bigint")
    mn, mx = float(mm["mn"]), float(mm["mx"])
    width = mx - mn
    if width == 0:
        b = F.lit(0)
    else:
        raw = F.floor((F.col(y_col) - F.lit(mn)) / F.lit(width) * F.lit(bins))
        b = F.least(raw, F.lit(bins - 1))
    return df.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def fd_gradient(df: DataFrame, beta, lam: float = 0.0, delta: float = 1e-4, x_col="x", y_col="y") -> DataFrame:
    """Forward differences (F(β+δe_i) − F(β))/δ next to the analytic gradient:
    the d+1 objectives and the d gradient means in one aggregate → ``(idx, fd, analytic)``."""
    beta = np.asarray(beta, float)
    d = len(beta)
    x, r = F.col("_x"), F.col("_r")
    reg = float(lam * beta @ beta)
    aggs = [(F.avg(r * r) + F.lit(reg)).alias("f0")]
    for i in range(d):
        ri = r - F.lit(delta) * x[i]  # the residual at β + δe_i
        bi = reg + lam * (2 * float(beta[i]) * delta + delta * delta)
        aggs.append((F.avg(ri * ri) + F.lit(float(bi))).alias(f"f{i + 1}"))
        aggs.append((F.avg(F.lit(-2.0) * r * x[i]) + F.lit(2 * lam * float(beta[i]))).alias(f"g{i}"))
    row = _with_residual(df, beta, x_col, y_col).agg(*aggs)
    expr = "stack({}, {}) as (idx, fd, analytic)".format(
        d, ", ".join(f"{i}, (f{i + 1} - f0) / {delta!r}, g{i}" for i in range(d)))
    return row.selectExpr(expr)
