"""Registered dense-regression queries with their SQL oracles.

Input (see ``inputs.dense_points``): lineitem rows, x = (1, quantity/50,
10·discount), y = extendedprice/1000, test rows l_orderkey % 5 = 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from corvid.operators import regression as G
from corvid.plans import inputs
from corvid.plans.registry import register
from corvid.sources.dense import format_dense_line, parse_dense_line

# Fixed parameters of the registered queries.
BETA1 = [0.5, 1.0, -0.25]
BETA2 = [0.1, -0.2, 0.3]
S_FW = [-10.0, 0.0, 0.0]
LAM = 0.1
K_LMO = 10.0
EPS_EXACT = 1e-8
LAMBDAS = [0.125, 0.25, 0.5, 1.0, 2.0, 4.0, 8.0]
KS = [1.0, 5.0, 10.0, 20.0, 30.0, 40.0, 50.0]
D = 3

PTS = """pts AS (SELECT l_orderkey * 8 + l_linenumber AS row_id, CAST(1.0 AS DOUBLE) AS x0,
  l_quantity / 50 AS x1, l_discount * 10 AS x2, l_extendedprice / 1000 AS y, l_orderkey % 5 = 0 AS is_test
  FROM lineitem)"""


def _pts(spark, sf, split=None):
    p = inputs.dense_array_points(spark, sf)
    if split == "train":
        p = p.where(~F.col("is_test"))
    elif split == "test":
        p = p.where(F.col("is_test"))
    return p


def _dot(beta, prefix="x"):
    return " + ".join(f"{prefix}{i} * {float(b)!r}" for i, b in enumerate(beta))


def _res(beta):
    return f"(y - ({_dot(beta)}))"


@register("read_dense_points", f"WITH {PTS} SELECT row_id, x0, x1, x2, y FROM pts")
def q_read_dense_points(spark, sf):
    """lineitem → CSV lines ``x0,x1,x2,y`` → parsed back by the dense reader."""
    p = inputs.dense_points(spark, sf)
    lines = p.select("row_id", format_dense_line(F.array("x0", "x1", "x2"), F.col("y")).alias("line"))
    q = lines.select("row_id", parse_dense_line("line").alias("p"))
    return q.select("row_id", *[F.col("p.x")[i].alias(f"x{i}") for i in range(D)], F.col("p.y").alias("y"))


# Per-row values are not rounded: both engines evaluate the same IEEE
# operations in the same order, while decimal-looking inputs often land
# exactly on a rounding tie that the two engines break differently.
@register("linear_predict", f"WITH {PTS} SELECT row_id, {_dot(BETA1)} AS pred FROM pts")
def q_linear_predict(spark, sf):
    from corvid.functions.vectors import linear_predict
    return _pts(spark, sf).select("row_id", linear_predict("x", BETA1).alias("pred"))


@register("squared_error", f"WITH {PTS} SELECT row_id, {_res(BETA1)} * {_res(BETA1)} AS sq_err FROM pts")
def q_squared_error(spark, sf):
    from corvid.functions.vectors import squared_error
    return _pts(spark, sf).select("row_id", squared_error("x", "y", BETA1).alias("sq_err"))


@register("local_gradient", f"WITH {PTS} SELECT row_id, "
          + ", ".join(f"-2.0 * {_res(BETA1)} * x{i} AS g{i}" for i in range(D)) + " FROM pts")
def q_local_gradient(spark, sf):
    from corvid.functions.vectors import local_gradient
    g = _pts(spark, sf).select("row_id", local_gradient("x", "y", BETA1).alias("g"))
    return g.select("row_id", *[F.col("g")[i].alias(f"g{i}") for i in range(D)])


_REG1 = float(LAM * np.dot(BETA1, BETA1))


@register("ridge_objective", f"WITH {PTS} SELECT round(avg({_res(BETA1)} * {_res(BETA1)}) + {_REG1!r}, 9) AS objective FROM pts WHERE NOT is_test")
def q_ridge_objective(spark, sf):
    return G.ridge_objective(_pts(spark, sf, "train"), BETA1, LAM).select(F.round("objective", 9).alias("objective"))


def _grad_sql(lam):
    return ("SELECT " + ", ".join(f"avg(-2.0 * {_res(BETA1)} * x{i}) + {2 * lam * BETA1[i]!r} AS g{i}" for i in range(D))
            + " FROM pts WHERE NOT is_test")


_GRAD_SQL = _grad_sql(LAM)


@register("ridge_gradient", f"WITH {PTS}, g AS ({_GRAD_SQL}) "
          + " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS idx, round(g{i}, 9) AS value FROM g" for i in range(D)))
def q_ridge_gradient(spark, sf):
    g = G.ridge_gradient(_pts(spark, sf, "train"), BETA1, LAM)
    return g.select(F.col("idx").cast("int"), F.round("value", 9).alias("value"))


def _hq_sql(b1, b2, lam):
    p2 = f"({_dot(b2)})"
    r1 = _res(b1)
    return (f"SELECT avg({p2} * {p2}) + {float(lam * np.dot(b2, b2))!r} AS a, "
            f"{float(2 * lam * np.dot(b1, b2))!r} - 2.0 * avg({r1} * {p2}) AS b, "
            f"avg({r1} * {r1}) + {float(lam * np.dot(b1, b1))!r} AS c FROM pts WHERE NOT is_test")


@register("line_quadratic", f"WITH {PTS}, q AS ({_hq_sql(BETA1, BETA2, LAM)}) SELECT round(a, 9) AS a, round(b, 9) AS b, round(c, 9) AS c FROM q")
def q_line_quadratic(spark, sf):
    q = G.line_quadratic(_pts(spark, sf, "train"), BETA1, BETA2, LAM)
    return q.select(*[F.round(c, 9).alias(c) for c in ("a", "b", "c")])


def _els_sql():
    # direction −g with g the gradient at BETA1 (λ = LAM); a, b of h along −g
    p2 = " + ".join(f"x{i} * (-g.g{i})" for i in range(D))
    r1 = _res(BETA1)
    gg = " + ".join(f"g.g{i} * g.g{i}" for i in range(D))
    bg = " + ".join(f"{BETA1[i]!r} * (-g.g{i})" for i in range(D))
    return (f"WITH {PTS}, g AS ({_GRAD_SQL}), q AS (SELECT avg(({p2}) * ({p2})) + {LAM!r} * ({gg}) AS a, "
            f"2 * {LAM!r} * ({bg}) - 2.0 * avg({r1} * ({p2})) AS b FROM pts, g WHERE NOT is_test GROUP BY g.g0, g.g1, g.g2) "
            "SELECT round(-b / (2.0 * a), 9) AS gamma FROM q")


@register("exact_line_search", _els_sql())
def q_exact_line_search(spark, sf):
    q = G.exact_line_search(_pts(spark, sf, "train"), BETA1, LAM)
    return q.select(F.round("gamma", 9).alias("gamma"))


@register("mse", f"WITH {PTS} SELECT round(avg({_res(BETA1)} * {_res(BETA1)}), 9) AS mse FROM pts WHERE is_test")
def q_mse(spark, sf):
    return G.mse(_pts(spark, sf, "test"), BETA1).select(F.round("mse", 9).alias("mse"))


def _gram_sql(where="NOT is_test"):
    parts = ["SELECT CAST(-1 AS INTEGER) AS i, CAST(-1 AS INTEGER) AS j, CAST(count(*) AS DOUBLE) AS s FROM pts WHERE " + where,
             "SELECT -1, -2, round(avg(y * y), 8) FROM pts WHERE " + where]
    parts += [f"SELECT -1, {j}, round(avg(x{j} * y), 8) FROM pts WHERE {where}" for j in range(D)]
    parts += [f"SELECT {i}, {j}, round(avg(x{i} * x{j}), 8) FROM pts WHERE {where}" for i in range(D) for j in range(i, D)]
    return f"WITH {PTS} " + " UNION ALL ".join(parts)


@register("gram_stats", _gram_sql())
def q_gram_stats(spark, sf):
    """Sufficient statistics as means (n itself on the (−1, −1) row)."""
    sums = G.gram_sums(_pts(spark, sf, "train"), d=D)
    # n is a one-row scalar: bind it after one tiny aggregate of the summary
    n = sums.where((F.col("i") == -1) & (F.col("j") == -1)).first()["s"]
    return sums.select(F.col("i").cast("int"), F.col("j").cast("int"),
                       F.when((F.col("i") == -1) & (F.col("j") == -1), F.col("s"))
                       .otherwise(F.round(F.col("s") / F.lit(float(n)), 8)).alias("s"))


# ---- closed-form ridge by Cramer's rule (3×3), the oracle of the GD solver ----
def _cramer_sql(lam_expr: str, src: str) -> str:
    """SELECT idx, beta from (A + λI) β = b using means in ``src`` (columns a00.., b0..)."""
    m = [[f"(a{min(i, j)}{max(i, j)}" + (f" + {lam_expr})" if i == j else ")") for j in range(3)] for i in range(3)]

    def det(M):
        return (f"({M[0][0]} * ({M[1][1]} * {M[2][2]} - {M[1][2]} * {M[2][1]}) - "
                f"{M[0][1]} * ({M[1][0]} * {M[2][2]} - {M[1][2]} * {M[2][0]}) + "
                f"{M[0][2]} * ({M[1][0]} * {M[2][1]} - {M[1][1]} * {M[2][0]}))")

    dets = []
    for c in range(3):
        Mc = [[(f"b{i}" if j == c else m[i][j]) for j in range(3)] for i in range(3)]
        dets.append(det(Mc))
    return " UNION ALL ".join(
        f"SELECT lam, CAST({c} AS INTEGER) AS idx, {dets[c]} / {det(m)} AS beta FROM {src}" for c in range(3))


_MEANS = ("SELECT " + ", ".join(f"avg(x{i} * x{j}) AS a{i}{j}" for i in range(D) for j in range(i, D))
          + ", " + ", ".join(f"avg(x{i} * y) AS b{i}" for i in range(D)) + " FROM pts WHERE NOT is_test")


@register("train_gd", f"WITH {PTS}, m AS ({_MEANS}), ml AS (SELECT {LAM!r} AS lam, * FROM m), "
          f"sol AS ({_cramer_sql('lam', 'ml')}) SELECT idx, round(beta, 4) AS value FROM sol")
def q_train_gd(spark, sf):
    """Ridge by GD with exact line search until ‖∇F‖ ≤ 1e-8 (λ = 0.1)."""
    fit = G.train_gd(_pts(spark, sf, "train"), lam=LAM, max_iter=1000, eps=EPS_EXACT)
    return G.beta_frame(spark, np.round(fit.beta, 4))


def _gd_loop_sql(lam: float, max_iter: int = 100, eps: float = 0.01) -> str:
    """GD with exact line search from β = 0 as a recursive CTE ``gd``: one row
    per state entering the loop, with the objective, gradient norm and step
    computed there (the loop of ``train_gd_g`` in SQL; a = 0 stops it)."""
    A = [[f"a{min(i, j)}{max(i, j)}" for j in range(D)] for i in range(D)]
    p = ", ".join(f"p{i}" for i in range(D))
    mcols = ", ".join(f"a{i}{j}" for i in range(D) for j in range(i, D)) + ", " + ", ".join(f"b{i}" for i in range(D)) + ", c"
    g = ", ".join(f"2.0 * ({' + '.join(f'{A[i][j]} * p{j}' for j in range(D))}) - 2.0 * b{i} + 2.0 * {lam!r} * p{i} AS g{i}"
                  for i in range(D))
    obj = (f"c - 2.0 * ({' + '.join(f'b{i} * p{i}' for i in range(D))}) + "
           f"({' + '.join(f'p{i} * {A[i][j]} * p{j}' for i in range(D) for j in range(D))}) + "
           f"{lam!r} * ({' + '.join(f'p{i} * p{i}' for i in range(D))})")
    qa = (f"({' + '.join(f'g{i} * {A[i][j]} * g{j}' for i in range(D) for j in range(D))}) + "
          f"{lam!r} * ({' + '.join(f'g{i} * g{i}' for i in range(D))})")
    # b of the line quadratic along d = −g
    qb = (f"2.0 * {lam!r} * ({' + '.join(f'-p{i} * g{i}' for i in range(D))}) - 2.0 * "
          f"(({' + '.join(f'-b{i} * g{i}' for i in range(D))}) - "
          f"({' + '.join(f'-p{i} * {A[i][j]} * g{j}' for i in range(D) for j in range(D))}))")
    nrm = f"sqrt({' + '.join(f'g{i} * g{i}' for i in range(D))})"
    body = (f"SELECT *, CASE WHEN qa = 0 THEN 0.0 ELSE -qb / (2.0 * qa) END AS gamma FROM "
            f"(SELECT *, {obj} AS obj, {qa} AS qa, {qb} AS qb, {nrm} AS nrm FROM (SELECT *, {g} FROM {{src}}))")
    step = ("SELECT it + 1, " + ", ".join(f"p{i} - gamma * g{i}" for i in range(D)) + f", nrm, qa <> 0, {mcols} FROM ("
            + body.format(src=f"(SELECT it, {p}, {mcols} FROM gd WHERE go AND it < {max_iter} AND prev > {eps!r})") + ")")
    return (f"WITH RECURSIVE {PTS}, m AS ({_MEANS[:-len(' FROM pts WHERE NOT is_test')]}, avg(y * y) AS c FROM pts WHERE NOT is_test), "
            f"gd(it, {p}, prev, go, {mcols}) AS (SELECT CAST(0 AS INTEGER), "
            + ", ".join("CAST(0.0 AS DOUBLE)" for _ in range(D)) + f", CAST('inf' AS DOUBLE), true, {mcols} FROM m UNION ALL {step}), "
            "hist AS (" + body.format(src=f"(SELECT it, {p}, {mcols} FROM gd WHERE go AND it < {max_iter} AND prev > {eps!r})") + ") ")


@register("train_gd_history", _gd_loop_sql(LAM) + "SELECT it AS k, round(obj, 6) AS objective, round(nrm, 6) AS grad_norm, "
          "round(gamma, 6) AS step FROM hist")
def q_train_gd_history(spark, sf):
    """Per-iteration objective, gradient norm and step of the GD run (defaults)."""
    fit = G.train_gd(_pts(spark, sf, "train"), lam=LAM)
    h = G.history_frame(spark, fit, "gd")
    return h.select("k", *[F.round(c, 6).alias(c) for c in ("objective", "grad_norm", "step")])


def _lmo_sql():
    return (f"WITH {PTS}, g AS ({_grad_sql(0.0)}), "
            "gl AS (" + " UNION ALL ".join(f"SELECT {i} AS idx, g{i} AS g FROM g" for i in range(D)) + "), "
            "top AS (SELECT idx, g FROM gl ORDER BY abs(g) DESC, idx LIMIT 1) "
            f"SELECT CAST(gl.idx AS INTEGER) AS idx, CASE WHEN gl.idx = top.idx THEN -{K_LMO!r} * sign(gl.g) ELSE 0.0 END AS s "
            "FROM gl, top")


@register("l1_ball_lmo", _lmo_sql())
def q_l1_ball_lmo(spark, sf):
    """LMO of the ball ‖s‖₁ ≤ 10 at the (λ = 0) gradient of BETA1."""
    g = G.ridge_gradient(_pts(spark, sf, "train"), BETA1, 0.0)
    return G.l1_ball_lmo(g, K_LMO).select(F.col("idx").cast("int"), F.col("s").cast("double"))


def _fwls_sql():
    dvec = [S_FW[i] - BETA1[i] for i in range(D)]
    return (f"WITH {PTS}, q AS ({_hq_sql(BETA1, dvec, 0.0)}) SELECT round(a, 9) AS a, round(b, 9) AS b, "
            "round(CASE WHEN a <> 0 THEN greatest(0.0, least(1.0, -b / (2.0 * a))) WHEN b > 0 THEN 0.0 ELSE 1.0 END, 9) AS gamma FROM q")


@register("fw_line_search", _fwls_sql())
def q_fw_line_search(spark, sf):
    """γ = argmin over [0,1] of F((1−γ)β + γs), β = BETA1, s = S_FW."""
    dvec = [S_FW[i] - BETA1[i] for i in range(D)]
    q = G.line_quadratic(_pts(spark, sf, "train"), BETA1, dvec, 0.0)
    return q.select(F.round("a", 9).alias("a"), F.round("b", 9).alias("b"),
                    F.round(G.fw_line_search_expr("a", "b"), 9).alias("gamma"))


@register("fw_gap", _lmo_sql().replace(
    f"SELECT CAST(gl.idx AS INTEGER) AS idx, CASE WHEN gl.idx = top.idx THEN -{K_LMO!r} * sign(gl.g) ELSE 0.0 END AS s FROM gl, top",
    f", s AS (SELECT gl.idx, gl.g, CASE WHEN gl.idx = top.idx THEN -{K_LMO!r} * sign(gl.g) ELSE 0.0 END AS s FROM gl, top) "
    f"SELECT round(sum((CASE idx " + " ".join(f"WHEN {i} THEN {BETA1[i]!r}" for i in range(D)) + " END - s) * g), 9) AS gap, "
    f"round(CAST({float(np.abs(BETA1).sum() / K_LMO)!r} AS DOUBLE), 9) AS feasibility FROM s"))
def q_fw_gap(spark, sf):
    """(β − s)ᵀ∇F(β) and ‖β‖₁/K at β = BETA1, s = LMO(∇F, 10)."""
    g = G.ridge_gradient(_pts(spark, sf, "train"), BETA1, 0.0)
    s = G.l1_ball_lmo(g, K_LMO)
    b = spark.createDataFrame([(i, float(v)) for i, v in enumerate(BETA1)], "idx int, beta double")
    j = g.join(s, "idx").join(F.broadcast(b), "idx")
    return j.agg(F.round(F.sum((F.col("beta") - F.col("s")) * F.col("value")), 9).alias("gap"),
                 F.round(F.lit(float(np.abs(BETA1).sum() / K_LMO)), 9).alias("feasibility"))


def _fw_loop_sql(Ks, max_iter: int = 100, eps: float = 0.01) -> str:
    """Frank-Wolfe from β = 0 for every K in ``Ks`` as a recursive CTE ``fw``
    (one state row per K and step; ``crit`` is the gap from before the step)
    and ``last`` (the final state of each K): the loop of ``train_fw_g`` in SQL."""
    A = [[f"a{min(i, j)}{max(i, j)}" for j in range(D)] for i in range(D)]
    p = ", ".join(f"p{i}" for i in range(D))
    mcols = ", ".join(f"a{i}{j}" for i in range(D) for j in range(i, D)) + ", " + ", ".join(f"b{i}" for i in range(D))
    g = ", ".join(f"2.0 * ({' + '.join(f'{A[i][j]} * p{j}' for j in range(D))}) - 2.0 * b{i} AS g{i}" for i in range(D))
    top = "CASE " + " ".join("WHEN " + " AND ".join(f"abs(g{i}) >= abs(g{j})" for j in range(i + 1, D)) + f" THEN {i}"
                             for i in range(D - 1)) + f" ELSE {D - 1} END"
    s = ", ".join(f"CASE WHEN top = {i} THEN -kk * sign(g{i}) ELSE 0.0 END AS s{i}" for i in range(D))
    dd = ", ".join(f"s{i} - p{i} AS d{i}" for i in range(D))
    qa = " + ".join(f"d{i} * {A[i][j]} * d{j}" for i in range(D) for j in range(D))
    qb = (f"-2.0 * (({' + '.join(f'b{i} * d{i}' for i in range(D))}) - "
          f"({' + '.join(f'p{i} * {A[i][j]} * d{j}' for i in range(D) for j in range(D))}))")
    crit = " + ".join(f"(p{i} - s{i}) * g{i}" for i in range(D))
    gam = "CASE WHEN qa <> 0 THEN greatest(0.0, least(1.0, -qb / (2.0 * qa))) WHEN qb > 0 THEN 0.0 ELSE 1.0 END"
    ks = ", ".join(f"(CAST({float(k)!r} AS DOUBLE))" for k in Ks)
    step = (f"SELECT kk, it + 1, " + ", ".join(f"(1.0 - gamma) * p{i} + gamma * s{i}" for i in range(D)) + f", crit, {mcols} "
            f"FROM (SELECT *, {gam} AS gamma FROM (SELECT *, {qa} AS qa, {qb} AS qb, {crit} AS crit FROM "
            f"(SELECT *, {dd} FROM (SELECT *, {s} FROM (SELECT *, {top} AS top FROM "
            f"(SELECT kk, it, {p}, {mcols}, {g} FROM fw WHERE it < {max_iter} AND crit > {eps!r}))))))")
    return (f"WITH RECURSIVE {PTS}, m AS ({_MEANS}), fw(kk, it, {p}, crit, {mcols}) AS ("
            f"SELECT v.kk, CAST(0 AS INTEGER), " + ", ".join("CAST(0.0 AS DOUBLE)" for _ in range(D))
            + f", CAST('inf' AS DOUBLE), {mcols} FROM m, (VALUES {ks}) v(kk) UNION ALL {step}), "
            "last AS (SELECT * FROM fw QUALIFY it = max(it) OVER (PARTITION BY kk)) ")


@register("train_fw", _fw_loop_sql([K_LMO]) + " " + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS idx, round(p{i}, 6) AS value, round(crit, 6) + 0.0 AS gap, it AS iterations FROM last"
    for i in range(D)))
def q_train_fw(spark, sf):
    """Frank-Wolfe on ‖β‖₁ ≤ 10 (max_iter 100, eps 0.01): β, gap, iterations."""
    fit = G.train_fw(_pts(spark, sf, "train"), K=K_LMO)
    return G.beta_frame(spark, np.round(fit.beta, 6), {"gap": round(float(fit.measure), 6) + 0.0,
                                                      "iterations": int(fit.iterations)})


@register("label_histogram", f"""WITH {PTS}, mm AS (SELECT min(y) AS mn, max(y) AS mx FROM pts)
SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((y - mn) / (mx - mn) * 10), 9) END AS INTEGER) AS bin,
       count(*) AS n FROM pts, mm GROUP BY 1""")
def q_label_histogram(spark, sf):
    return G.label_histogram(_pts(spark, sf), "y", 10)


def _fd_sql(delta=1e-4):
    beta = np.asarray(BETA1, float)
    parts = [f"avg({_res(beta)} * {_res(beta)}) + {float(LAM * beta @ beta)!r} AS f0"]
    for i in range(D):
        bi = beta.copy()
        bi[i] += delta
        parts.append(f"avg({_res(bi)} * {_res(bi)}) + {float(LAM * bi @ bi)!r} AS f{i + 1}")
        parts.append(f"avg(-2.0 * {_res(beta)} * x{i}) + {2 * LAM * float(beta[i])!r} AS g{i}")
    sel = " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS idx, round((f{i + 1} - f0) / {delta!r}, 4) AS fd, "
                             f"round(g{i}, 4) AS analytic FROM r" for i in range(D))
    return f"WITH {PTS}, r AS (SELECT {', '.join(parts)} FROM pts WHERE NOT is_test) {sel}"


@register("fd_gradient", _fd_sql())
def q_fd_gradient(spark, sf):
    r = G.fd_gradient(_pts(spark, sf, "train"), BETA1, LAM, 1e-4)
    return r.select(F.col("idx").cast("int"), F.round("fd", 4).alias("fd"), F.round("analytic", 4).alias("analytic"))


_LAM_VALUES = ", ".join(f"({lam!r})" for lam in LAMBDAS)


@register("lambda_sweep", f"""WITH {PTS}, m AS ({_MEANS}), ml AS (SELECT lam, m.* FROM m, (VALUES {_LAM_VALUES}) v(lam)),
sol AS ({_cramer_sql('lam', 'ml')}),
bw AS (SELECT lam, {', '.join(f"max(CASE WHEN idx = {i} THEN beta END) AS c{i}" for i in range(D))} FROM sol GROUP BY lam)
SELECT lam, round(avg((y - ({' + '.join(f'x{i} * c{i}' for i in range(D))})) * (y - ({' + '.join(f'x{i} * c{i}' for i in range(D))}))), 6) AS mse
FROM pts, bw WHERE is_test GROUP BY lam""")
def q_lambda_sweep(spark, sf):
    """Ridge for each λ from one summary of the train split; test MSE of all
    fitted β in one aggregate over the test split."""
    g = G.gram_stats(_pts(spark, sf, "train"), d=D)
    fits = {lam: G.train_gd_g(g, lam=lam, max_iter=1000, eps=EPS_EXACT).beta for lam in LAMBDAS}
    test = _pts(spark, sf, "test")
    aggs = []
    for k, lam in enumerate(LAMBDAS):
        r = F.col("y") - G.dot_lit("x", fits[lam])
        aggs.append(F.avg(r * r).alias(f"m{k}"))
    row = test.agg(*aggs)
    expr = "stack({}, {}) as (lam, mse)".format(len(LAMBDAS), ", ".join(f"{lam!r}D, m{k}" for k, lam in enumerate(LAMBDAS)))
    return row.selectExpr(expr).select("lam", F.round("mse", 6).alias("mse"))


@register("k_sweep", _fw_loop_sql(KS) + f"""SELECT last.kk AS K, round(avg((y - ({' + '.join(f'x{i} * last.p{i}' for i in range(D))})) *
  (y - ({' + '.join(f'x{i} * last.p{i}' for i in range(D))}))), 6) AS mse, any_value(last.it) AS iterations
FROM last, pts WHERE pts.is_test GROUP BY last.kk""")
def q_k_sweep(spark, sf):
    """Frank-Wolfe for each K from one summary; test MSE of each in one aggregate."""
    g = G.gram_stats(_pts(spark, sf, "train"), d=D)
    fits = {K: G.train_fw_g(g, K=K) for K in KS}
    test = _pts(spark, sf, "test")
    aggs = []
    for k, K in enumerate(KS):
        r = F.col("y") - G.dot_lit("x", fits[K].beta)
        aggs.append(F.avg(r * r).alias(f"m{k}"))
    row = test.agg(*aggs)
    expr = "stack({}, {}) as (K, mse, iterations)".format(
        len(KS), ", ".join(f"{K!r}D, m{k}, {fits[K].iterations}" for k, K in enumerate(KS)))
    return row.selectExpr(expr).select("K", F.round("mse", 6).alias("mse"), "iterations")


WIDE_D = 64


@register("gram_stats_wide", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y FROM embeddings),
ij AS (SELECT i, j FROM range(0, 64) a(i), range(0, 64) b(j) WHERE i <= j)
SELECT CAST(-1 AS INTEGER) AS i, CAST(-1 AS INTEGER) AS j, CAST(count(*) AS DOUBLE) AS s FROM e
UNION ALL SELECT -1, -2, round(avg(y * y), 8) FROM e
UNION ALL SELECT -1, CAST(j AS INTEGER), round(avg(x[j + 1] * y), 8) FROM e, range(0, 64) t(j) GROUP BY j
UNION ALL SELECT CAST(i AS INTEGER), CAST(j AS INTEGER), round(avg(x[i + 1] * x[j + 1]), 8) FROM e, ij GROUP BY i, j""")
def q_gram_stats_wide(spark, sf):
    """The 64-wide path: per-task numpy XᵀX, combined by a groupBy."""
    sums = G.gram_sums(inputs.wide_points(spark, sf), d=WIDE_D)
    n = sums.where((F.col("i") == -1) & (F.col("j") == -1)).first()["s"]
    return sums.select(F.col("i").cast("int"), F.col("j").cast("int"),
                       F.when((F.col("i") == -1) & (F.col("j") == -1), F.col("s"))
                       .otherwise(F.round(F.col("s") / F.lit(float(n)), 8)).alias("s"))


@register("train_gd_direct", f"WITH {PTS}, m AS ({_MEANS}), ml AS (SELECT {LAM!r} AS lam, * FROM m), "
          f"sol AS ({_cramer_sql('lam', 'ml')}) SELECT idx, round(beta, 4) AS value FROM sol")
def q_train_gd_direct(spark, sf):
    """The same descent with two passes over the data per iteration (no d×d
    summary), until ‖∇F‖ ≤ 1e-6."""
    fit = G.train_gd_direct(_pts(spark, sf, "train"), lam=LAM, max_iter=200, eps=1e-6)
    return G.beta_frame(spark, np.round(fit.beta, 4))


WIDE_BETA = [(k % 7 - 3) / 10.0 for k in range(64)]


@register("ridge_gradient_wide", f"""WITH e AS (SELECT CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y FROM embeddings),
b AS (SELECT {WIDE_BETA!r}::DOUBLE[] AS b),
r AS (SELECT x, y - list_inner_product(x, b.b) AS r FROM e, b)
SELECT CAST(k AS INTEGER) AS idx, round(avg(-2.0 * r * x[k + 1]) + 2 * {LAM!r} * any_value(b.b[k + 1]), 7) AS value
FROM r, b, range(0, 64) t(k) GROUP BY k""")
def q_ridge_gradient_wide(spark, sf):
    """∇F on the 64-dimensional embeddings: d partial sums per task."""
    g = G.ridge_gradient(inputs.wide_points(spark, sf), WIDE_BETA, LAM)
    return g.select("idx", F.round("value", 7).alias("value"))


# Points of the embeddings, and the means of their products as lists.
_WIDE = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y FROM embeddings)"


def _gd_wide_sql(max_iter: int, eps: float) -> str:
    inner = lambda m, v: f"list_transform(range(1, {WIDE_D + 1}), lambda i: list_inner_product({m}[i], {v}))"
    return f"""WITH RECURSIVE {_WIDE}, ij AS (SELECT i, j FROM range(1, {WIDE_D + 1}) a(i), range(1, {WIDE_D + 1}) b(j)),
m AS MATERIALIZED (SELECT (SELECT list(r ORDER BY i) FROM (SELECT i, list(s ORDER BY j) AS r FROM (SELECT i, j, avg(x[i] * x[j]) AS s FROM e, ij GROUP BY i, j) GROUP BY i)) AS a,
      (SELECT list(s ORDER BY i) FROM (SELECT i, avg(x[i] * y) AS s FROM e, range(1, {WIDE_D + 1}) t(i) GROUP BY i)) AS b),
gd(k, beta, norm) AS (SELECT 0, list_transform(range({WIDE_D}), lambda i: CAST(0 AS DOUBLE)), CAST('Infinity' AS DOUBLE)
  UNION ALL SELECT k + 1, list_transform(range(1, {WIDE_D + 1}), lambda i: beta[i] - gg / (2 * (list_inner_product(g, ag) + {LAM!r} * gg)) * g[i]), sqrt(gg)
  FROM (SELECT *, list_inner_product(g, g) AS gg, {inner('a', 'g')} AS ag FROM (
    SELECT k, beta, norm, a, list_transform(range(1, {WIDE_D + 1}), lambda i: 2 * list_inner_product(a[i], beta) - 2 * b[i] + 2 * {LAM!r} * beta[i]) AS g
    FROM gd, m WHERE k < {max_iter} AND norm > {eps!r})))
SELECT CAST(unnest(range({WIDE_D})) AS INTEGER) AS idx, round(unnest(beta), 6) AS value, round(norm, 5) AS grad_norm, CAST(k AS INTEGER) AS iterations
FROM (SELECT * FROM gd ORDER BY k DESC LIMIT 1)"""


@register("train_gd_wide", _gd_wide_sql(1000, 1e-6))
def q_train_gd_wide(spark, sf):
    """Ridge by GD on the 64-dimensional embeddings (λ = 0.1)."""
    fit = G.train_gd(inputs.wide_points(spark, sf), lam=LAM, max_iter=1000, eps=1e-6)
    return G.beta_frame(spark, np.round(fit.beta, 6), {"grad_norm": round(float(fit.measure), 5), "iterations": int(fit.iterations)})


TILED_D = WIDE_D + WIDE_D * (WIDE_D + 1) // 2  # degree-2 expansion: 2,144 columns
TILED_ITERS = 4


def _gd_tiled_sql(iters: int) -> str:
    n = TILED_D
    c = [_WIDE, f"p AS (SELECT y, list_concat(x, flatten(list_transform(range(1, {WIDE_D + 1}), lambda i: list_transform(range(i, {WIDE_D + 1}), lambda j: x[i] * x[j])))) AS x FROM e)",
         f"b0 AS (SELECT list_transform(range({n}), lambda i: CAST(0 AS DOUBLE)) AS b)"]
    for k in range(iters):
        c += [f"g{k} AS (SELECT list(v ORDER BY i) AS g FROM (SELECT i, avg(-2.0 * r * xi) + 2 * {LAM!r} * any_value(bi) AS v FROM (SELECT unnest(x) AS xi, "
              f"unnest(b) AS bi, unnest(range({n})) AS i, r FROM (SELECT x, b, y - list_inner_product(x, b) AS r FROM p, b{k})) GROUP BY i))",
              f"t{k} AS (SELECT any_value(list_inner_product(g, g)) / (2 * (avg(list_inner_product(x, g) * list_inner_product(x, g)) + "
              f"{LAM!r} * any_value(list_inner_product(g, g)))) AS t FROM p, g{k})",
              f"b{k + 1} AS (SELECT list_transform(range(1, {n + 1}), lambda i: b[i] - t * g[i]) AS b FROM b{k}, g{k}, t{k})"]
    return ("WITH " + ", ".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in c)
            + f" SELECT CAST(unnest(range({n})) AS INTEGER) AS idx, round(unnest(b), 7) AS value FROM b{iters}")


@register("train_gd_tiled", _gd_tiled_sql(TILED_ITERS))
def q_train_gd_tiled(spark, sf):
    """Four steps of ridge by GD on the degree-2 expansion of the embeddings: 2,144
    columns, XᵀX in tiles that never meet on one machine."""
    from corvid.operators import tiled_gram
    from corvid.operators.features import poly2_features

    pts = inputs.wide_points(spark, sf).select(poly2_features("x").alias("x"), "y")
    g = tiled_gram.TiledGram(pts, TILED_D)
    fit = tiled_gram.train_gd(g, lam=LAM, max_iter=TILED_ITERS, eps=0.0)
    g.release()
    return G.beta_frame(spark, np.round(fit.beta, 7))


def _fw_train_sql(iters: int = 2) -> str:
    """SQL unrolling of ``iters`` Frank-Wolfe steps from β = 0 on ‖β‖₁ ≤ K_LMO:
    gradient from the means, LMO (largest |g|, lowest index on ties), exact
    step on [0, 1], convex update — one single-row CTE per step."""
    A = [[f"a{min(i, j)}{max(i, j)}" for j in range(D)] for i in range(D)]
    cte = [PTS, f"m AS ({_MEANS})", "it0 AS (SELECT m.*, " + ", ".join(f"0.0 AS p{i}" for i in range(D)) + " FROM m)"]
    for k in range(iters):
        g = ", ".join(f"2.0 * ({' + '.join(f'{A[i][j]} * p{j}' for j in range(D))}) - 2.0 * b{i} AS g{i}" for i in range(D))
        top = "CASE " + " ".join(
            "WHEN " + " AND ".join(f"abs(g{i}) >= abs(g{j})" for j in range(i + 1, D)) + f" THEN {i}"
            for i in range(D - 1)) + f" ELSE {D - 1} END"
        s = ", ".join(f"CASE WHEN top = {i} THEN -{K_LMO!r} * sign(g{i}) ELSE 0.0 END AS s{i}" for i in range(D))
        dd = ", ".join(f"s{i} - p{i} AS d{i}" for i in range(D))
        qa = " + ".join(f"d{i} * {A[i][j]} * d{j}" for i in range(D) for j in range(D))
        qb = (f"-2.0 * (({' + '.join(f'b{i} * d{i}' for i in range(D))}) - "
              f"({' + '.join(f'p{i} * {A[i][j]} * d{j}' for i in range(D) for j in range(D))}))")
        gam = "CASE WHEN qa <> 0 THEN greatest(0.0, least(1.0, -qb / (2.0 * qa))) WHEN qb > 0 THEN 0.0 ELSE 1.0 END"
        cte += [f"g{k} AS (SELECT *, {g} FROM it{k})",
                f"s{k} AS (SELECT *, {s} FROM (SELECT *, {top} AS top FROM g{k}))",
                f"d{k} AS (SELECT *, {qa} AS qa, {qb} AS qb FROM (SELECT *, {dd} FROM s{k}))",
                f"it{k + 1} AS (SELECT {', '.join(f'a{i}{j}' for i in range(D) for j in range(i, D))}, "
                f"{', '.join(f'b{i}' for i in range(D))}, "
                + ", ".join(f"(1.0 - gamma) * p{i} + gamma * s{i} AS p{i}" for i in range(D))
                + f" FROM (SELECT *, {gam} AS gamma FROM d{k}))"]
    sel = " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS idx, round(p{i}, 6) AS value FROM it{iters}" for i in range(D))
    return "WITH " + ",\n".join(cte) + "\n" + sel


@register("train_fw_2iter", _fw_train_sql(2))
def q_train_fw_2iter(spark, sf):
    """Two Frank-Wolfe steps on ‖β‖₁ ≤ 10 from β = 0, value-checked against
    the SQL unrolling of the same two steps."""
    fit = G.train_fw(_pts(spark, sf, "train"), K=K_LMO, max_iter=2, eps=0.0)
    return G.beta_frame(spark, np.round(fit.beta, 6))
