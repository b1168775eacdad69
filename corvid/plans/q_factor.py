"""Registered matrix-factorisation queries with SQL oracles.

Ratings (``inputs.ratings``): customer × supplier from orders ⋈ lineitem,
r = (avg quantity − 25.5)/25, fold = (i·31 + j) % 5. Update steps are checked
from the formula profiles ((id·7919 + k·104729) % 1000)/1000 − 0.5, which any
engine reproduces; training itself starts from the seeded normal init.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from corvid.iterate import Steps
from corvid.operators import factorization as M
from corvid.plans import inputs
from corvid.plans.registry import register

DF = 3
LAM = 0.05
MU = 0.05
GAMMA = 0.001
TEST_FOLD = 0
N_FOLDS = 5

RT = ("rt AS (SELECT o.o_custkey AS i, l.l_suppkey AS j, (avg(l.l_quantity) - 25.5) / 25.0 AS r, "
      "CAST((o.o_custkey * 31 + l.l_suppkey) % 5 AS INTEGER) AS fold FROM lineitem l JOIN orders o "
      "ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)")


def _fv(col: str, k: int) -> str:
    return f"((({col} * 7919 + {k * 104729}) % 1000) / 1000.0 - 0.5)"


def _dot(a: str, b: str) -> str:
    return " + ".join(f"{_fv(a, k)} * {_fv(b, k)}" for k in range(DF))


TRAIN = f"tr AS (SELECT * FROM rt WHERE fold <> {TEST_FOLD})"
JOINED = f"jd AS (SELECT i, j, r, ({_dot('i', 'j')}) - r AS delta FROM tr)"
BASE = f"WITH {RT}, {TRAIN}, {JOINED}"


def _ratings(spark, sf):
    return inputs.ratings(spark, sf)


def _train_joined(spark, sf):
    R = _ratings(spark, sf)
    tr = R.where(F.col("fold") != TEST_FOLD)
    U, V = M.init_profiles(tr, DF, method="formula")
    return tr, U, V, M.join_and_predict(tr, U, V, DF)


@register("read_ratings", f"WITH {RT} SELECT i, j, round(r, 9) AS r, fold FROM rt")
def q_read_ratings(spark, sf):
    return _ratings(spark, sf).select("i", "j", F.round("r", 9).alias("r"), "fold")


@register("read_folds", f"WITH {RT} SELECT fold, count(*) AS n, round(sum(r), 6) AS r_sum FROM rt GROUP BY fold")
def q_read_folds(spark, sf):
    """Ratings written as text files fold0..fold4 and read back with one glob
    scan, the fold taken from the file name."""
    from corvid.session import scratch_path
    from corvid.sources.ratings import read_folds, write_folds
    path = scratch_path(spark, "folds")
    write_folds(_ratings(spark, sf), path)
    f = read_folds(spark, path)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("r"), 6).alias("r_sum"))


@register("rating_ids", f"WITH {RT} SELECT DISTINCT 'i' AS side, i AS id FROM rt UNION ALL SELECT DISTINCT 'j', j FROM rt")
def q_rating_ids(spark, sf):
    R = _ratings(spark, sf)
    return (M.rating_ids(R, "i").select(F.lit("i").alias("side"), F.col("i").alias("id"))
            .unionByName(M.rating_ids(R, "j").select(F.lit("j").alias("side"), F.col("j").alias("id"))))


def _normal(side: str, col: str, k: int) -> str:
    """The seeded normal init in SQL: Box-Muller over the first 52 bits of an MD5."""
    u = [f"((CAST('0x' || substr(md5('{M.SEED}|{side}|' || {col} || '|{k}|{n}'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)" for n in (0, 1)]
    return f"(sqrt(-2.0 * ln({u[0]})) * cos({2 * math.pi!r} * {u[1]}))"


def _normal_side(side: str, col: str, d: int) -> str:
    return " UNION ALL ".join(f"SELECT '{side}' AS side, {_normal(side, col, k)} AS z FROM (SELECT DISTINCT {col} FROM rt)" for k in range(d))


@register("init_profiles", f"WITH {RT}, z AS ({_normal_side('u', 'i', 10)} UNION ALL {_normal_side('v', 'j', 10)}) "
          "SELECT side, count(*) AS n, round(avg(z), 9) AS mean, round(var_pop(z), 9) AS var FROM z GROUP BY side")
def q_init_profiles(spark, sf):
    """Seeded normal profiles (d = 10): per side count, mean and variance of
    all components (a property check: mean ≈ 0, variance ≈ 1)."""
    U, V = M.init_profiles(_ratings(spark, sf), 10)
    a = U.select(F.lit("u").alias("side"), F.explode("u").alias("z"))
    b = V.select(F.lit("v").alias("side"), F.explode("v").alias("z"))
    return a.unionByName(b).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("z"), 9).alias("mean"),
                                                 F.round(F.var_pop("z"), 9).alias("var"))


@register("rating_predict", f"WITH {RT} SELECT i, j, round({_dot('i', 'j')}, 9) AS pred FROM rt")
def q_rating_predict(spark, sf):
    R = _ratings(spark, sf)
    U, V = M.init_profiles(R, DF, method="formula")
    J = R.join(U, "i").join(V, "j")
    return J.select("i", "j", F.round(M.predict("u", "v", DF), 9).alias("pred"))


@register("join_and_predict", f"{BASE} SELECT i, j, round(delta, 9) AS delta FROM jd")
def q_join_and_predict(spark, sf):
    _, _, _, J = _train_joined(spark, sf)
    return J.select("i", "j", F.round("delta", 9).alias("delta"))


@register("gradient_u", f"{BASE} SELECT i, j, " + ", ".join(f"round(2.0 * delta * {_fv('j', k)}, 9) AS g{k}" for k in range(DF)) + " FROM jd")
def q_gradient_u(spark, sf):
    _, _, _, J = _train_joined(spark, sf)
    g = J.select("i", "j", M.gradient_u("delta", "v", DF).alias("g"))
    return g.select("i", "j", *[F.round(F.col("g")[k], 9).alias(f"g{k}") for k in range(DF)])


@register("gradient_v", f"{BASE} SELECT i, j, " + ", ".join(f"round(2.0 * delta * {_fv('i', k)}, 9) AS g{k}" for k in range(DF)) + " FROM jd")
def q_gradient_v(spark, sf):
    _, _, _, J = _train_joined(spark, sf)
    g = J.select("i", "j", M.gradient_v("delta", "u", DF).alias("g"))
    return g.select("i", "j", *[F.round(F.col("g")[k], 9).alias(f"g{k}") for k in range(DF)])


@register("squared_error_sum", f"{BASE} SELECT round(sum(delta * delta), 6) AS se, count(*) AS m FROM jd")
def q_squared_error_sum(spark, sf):
    _, _, _, J = _train_joined(spark, sf)
    return M.squared_error(J).select(F.round("se", 6).alias("se"), "m")


def _norm_sql(col, reg):
    return f"round({reg!r} * sum({' + '.join(f'{_fv(col, k)} * {_fv(col, k)}' for k in range(DF))}), 9)"


@register("profile_norm", f"{BASE}, ui AS (SELECT DISTINCT i FROM tr) SELECT {_norm_sql('i', LAM)} AS norm_u FROM ui")
def q_profile_norm(spark, sf):
    _, U, _, _ = _train_joined(spark, sf)
    return M.norm_sq(U, "u", DF).select(F.round(F.col("n_u") * F.lit(LAM), 9).alias("norm_u"))


@register("mf_objective", f"""{BASE}, ui AS (SELECT DISTINCT i FROM tr), vj AS (SELECT DISTINCT j FROM tr),
a AS (SELECT sum(delta * delta) AS se FROM jd),
b AS (SELECT sum({' + '.join(f"{_fv('i', k)} * {_fv('i', k)}" for k in range(DF))}) AS nu FROM ui),
c AS (SELECT sum({' + '.join(f"{_fv('j', k)} * {_fv('j', k)}" for k in range(DF))}) AS nv FROM vj)
SELECT round(se + {LAM!r} * nu + {MU!r} * nv, 6) AS objective FROM a, b, c""")
def q_mf_objective(spark, sf):
    _, U, V, J = _train_joined(spark, sf)
    se = M.squared_error(J).first()["se"]
    nu = M.norm_sq(U, "u", DF).first()["n_u"]
    nv = M.norm_sq(V, "v", DF).first()["n_v"]
    return spark.createDataFrame([(round(se + LAM * nu + MU * nv, 6),)], "objective double")


def _adapt_sql(side, other, reg):
    g = ", ".join(f"sum(2.0 * delta * {_fv(other, k)}) AS g{k}" for k in range(DF))
    sel = ", ".join(f"round({_fv(side, k)} - {GAMMA!r} * (g{k} + 2.0 * {reg!r} * {_fv(side, k)}), 9) AS {'u' if side == 'i' else 'v'}{k}"
                    for k in range(DF))
    return f"{BASE}, g AS (SELECT {side}, {g} FROM jd GROUP BY {side}) SELECT {side}, {sel} FROM g"


@register("adapt_u", _adapt_sql("i", "j", LAM))
def q_adapt_u(spark, sf):
    _, U, _, J = _train_joined(spark, sf)
    u = M.adapt(J, U, "i", GAMMA, LAM, DF)
    return u.select("i", *[F.round(F.col("u")[k], 9).alias(f"u{k}") for k in range(DF)])


@register("adapt_v", _adapt_sql("j", "i", MU))
def q_adapt_v(spark, sf):
    _, _, V, J = _train_joined(spark, sf)
    v = M.adapt(J, V, "j", GAMMA, MU, DF)
    return v.select("j", *[F.round(F.col("v")[k], 9).alias(f"v{k}") for k in range(DF)])


_RMSE = f"""WITH {RT}, {TRAIN},
ui AS (SELECT DISTINCT i FROM tr), vj AS (SELECT DISTINCT j FROM tr),
te AS (SELECT t.i, t.j, t.r, (ui.i IS NOT NULL AND vj.j IS NOT NULL) AS hit FROM rt t
       LEFT JOIN ui ON ui.i = t.i LEFT JOIN vj ON vj.j = t.j WHERE t.fold = {TEST_FOLD}),
e AS (SELECT sum(CASE WHEN hit THEN (({_dot('i', 'j')}) - r) * (({_dot('i', 'j')}) - r) ELSE 0.0 END) AS se,
             count(*) AS m, count_if(hit) AS mh FROM te)
SELECT round(sqrt(se / m), 9) AS rmse, round(sqrt(se / mh), 9) AS rmse_matched, round(mh / m, 9) AS coverage FROM e"""


@register("test_rmse", _RMSE)
def q_test_rmse(spark, sf):
    """Test RMSE of the formula profiles on fold 0 (users/items of the train folds)."""
    R = _ratings(spark, sf)
    tr, te = M.fold_split(R, TEST_FOLD)
    U, V = M.init_profiles(tr, DF, method="formula")
    J = M.join_and_predict(te, U, V, DF)
    e = M.squared_error(J).first()
    m = te.count()
    se, mh = e["se"] or 0.0, e["m"]
    return spark.createDataFrame([(round((se / m) ** 0.5, 9), round((se / mh) ** 0.5, 9), round(mh / m, 9))],
                                 "rmse double, rmse_matched double, coverage double")


@register("fold_split", f"""WITH {RT}
SELECT CAST(k AS INTEGER) AS k, count_if(fold <> k) AS n_train, count_if(fold = k) AS n_test FROM rt, range(0, 5) t(k) GROUP BY k""")
def q_fold_split(spark, sf):
    R = _ratings(spark, sf)
    tr, te = M.fold_keyed(R, N_FOLDS)
    a = tr.groupBy("k").agg(F.count(F.lit(1)).alias("n_train"))
    b = te.groupBy("k").agg(F.count(F.lit(1)).alias("n_test"))
    return a.join(b, "k", "full").select(F.col("k").cast("int"), F.coalesce("n_train", F.lit(0)).alias("n_train"),
                                         F.coalesce("n_test", F.lit(0)).alias("n_test"))


def _steps_sql(models: str, train_on: str, test_on: str, iters: int, d: int, reg: str, init=_normal) -> str:
    """SQL unrolling of MF training for all ``models`` (rows m with a fold k
    and a reg) at once: both sides updated from the same joined table, test
    error from the profiles before the update. CTEs u0..un, v0..vn, s0..s(n-1)
    (se, objective per model) and e0.. (test error)."""
    c = [RT, f"mo AS ({models})", f"tr AS (SELECT mo.m, rt.i, rt.j, rt.r FROM rt, mo WHERE {train_on})",
         f"te AS (SELECT mo.m, rt.i, rt.j, rt.r FROM rt, mo WHERE {test_on})",
         "u0 AS (SELECT m, i, " + ", ".join(f"{init('u', 'i', k)} AS c{k}" for k in range(d)) + " FROM (SELECT DISTINCT m, i FROM tr))",
         "v0 AS (SELECT m, j, " + ", ".join(f"{init('v', 'j', k)} AS c{k}" for k in range(d)) + " FROM (SELECT DISTINCT m, j FROM tr))"]
    dot = " + ".join(f"u.c{k} * v.c{k}" for k in range(d))
    sq = " + ".join(f"c{k} * c{k}" for k in range(d))
    for it in range(iters):
        gamma = M.gain_schedule(M.GAIN, M.POWER, it + 1)
        pair = lambda t: f"FROM {t} t JOIN u{it} u ON u.m = t.m AND u.i = t.i JOIN v{it} v ON v.m = t.m AND v.j = t.j"
        c.append(f"j{it} AS (SELECT t.m, t.i, t.j, ({dot}) - t.r AS delta, "
                 + ", ".join(f"u.c{k} AS uc{k}, v.c{k} AS vc{k}" for k in range(d)) + f" {pair('tr')})")
        c.append(f"s{it} AS (SELECT mo.m, a.se + {reg} * b.n + {reg} * w.n AS objective FROM mo "
                 f"JOIN (SELECT m, sum(delta * delta) AS se FROM j{it} GROUP BY m) a ON a.m = mo.m "
                 f"JOIN (SELECT m, sum({sq}) AS n FROM u{it} GROUP BY m) b ON b.m = mo.m "
                 f"JOIN (SELECT m, sum({sq}) AS n FROM v{it} GROUP BY m) w ON w.m = mo.m)")
        c.append(f"e{it} AS (SELECT n.m, sqrt(e.se / n.n) AS rmse, sqrt(e.se / e.n) AS rmse_matched, e.n / n.n AS coverage FROM "
                 f"(SELECT m, count(*) AS n FROM te GROUP BY m) n JOIN (SELECT t.m, sum((({dot}) - t.r) * (({dot}) - t.r)) AS se, "
                 f"count(*) AS n {pair('te')} GROUP BY t.m) e ON e.m = n.m)")
        for side, p, q in (("i", "u", "v"), ("j", "v", "u")):
            sums = ", ".join(f"sum(2.0 * delta * {q}c{k}) AS s{k}" for k in range(d))
            upd = ", ".join(f"p.c{k} - {gamma!r} * (g.s{k} + 2.0 * {reg} * p.c{k}) AS c{k}" for k in range(d))
            c.append(f"{p}{it + 1} AS (SELECT p.m, p.{side}, {upd} FROM {p}{it} p JOIN mo ON mo.m = p.m JOIN "
                     f"(SELECT m, {side}, {sums} FROM j{it} GROUP BY m, {side}) g ON g.m = p.m AND g.{side} = p.{side})")
    return "WITH " + ",\n".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in c)


_FOLD = f"SELECT 0 AS m, {TEST_FOLD} AS k"
_ALL_FOLDS = f"SELECT CAST(k AS INTEGER) AS m, CAST(k AS INTEGER) AS k FROM range(0, {N_FOLDS}) t(k)"
_CV_ITERS, _GRID_ITERS = 3, 2  # of the value-checked parts
_REGS = [0.0, 1.0, 2.0]
GRID = [float(x) for x in np.linspace(0, 3000, 20)]  # the reference's grid


def _per_iteration(columns: str, n: int, join: str = "") -> str:
    return " UNION ALL ".join(f"SELECT CAST({k + 1} AS INTEGER) AS iteration, "
                              + columns.format(k=k, gamma=repr(M.gain_schedule(M.GAIN, M.POWER, k + 1)))
                              + f" FROM s{k} s JOIN e{k} e ON e.m = s.m" for k in range(n))


def _cv_sql(iters: int, init=_normal, d: int = DF) -> str:
    n = iters - 1
    return (_steps_sql(_ALL_FOLDS, "rt.fold <> mo.k", "rt.fold = mo.k", iters, d, repr(LAM), init)
            + f" SELECT CAST(m AS INTEGER) AS k, round(rmse, 9) AS test_rmse, round(rmse_matched, 9) AS rmse_matched, "
              f"round(coverage, 9) AS coverage, CAST({iters} AS INTEGER) AS iterations, "
              f"round(avg(rmse) OVER (), 9) AS cv_rmse FROM e{n}")


def _cv(spark, sf, iters: int, d: int = DF, **kw):
    df = M.cross_validate(_ratings(spark, sf), N_FOLDS, d=d, lam=LAM, mu=MU, maxiter=iters, **kw)
    rounded = ["test_rmse", "rmse_matched", "coverage", "cv_rmse"]
    return df.select("k", "iterations", *[F.round(c, 9).alias(c) for c in rounded])


@register("cross_validate_mf", _cv_sql(M.MAXITER, d=M.D))
def q_cross_validate_mf(spark, sf):
    """5-fold CV at the defaults (d = 10, 20 iterations), all folds in the same
    jobs over one copy of R: per-fold RMSE and their mean."""
    return _cv(spark, sf, M.MAXITER, M.D)


@register("cross_validate_mf_3iter", _cv_sql(_CV_ITERS))
def q_cross_validate_mf_3iter(spark, sf):
    """Three iterations of it at d = 3."""
    return _cv(spark, sf, _CV_ITERS)


@register("cv_mf_trained", _cv_sql(_CV_ITERS, lambda side, col, k: _fv(col, k)))
def q_cv_mf_trained(spark, sf):
    """The same three iterations from the formula profiles."""
    return _cv(spark, sf, _CV_ITERS, init="formula")


_TRAIN_COLUMNS = "round(s.objective, 5) AS objective, round(e.rmse, 8) AS test_rmse, CAST({gamma} AS DOUBLE) AS gamma"


def _train_mf_sql(iters: int, d: int) -> str:
    return (_steps_sql(_FOLD, "rt.fold <> mo.k", "rt.fold = mo.k", iters, d, repr(LAM))
            + " " + _per_iteration(_TRAIN_COLUMNS, iters))


def _train_mf(spark, sf, **kw):
    tr, te = M.fold_split(Steps(spark, "ratings-read").write(_ratings(spark, sf)), TEST_FOLD)  # joined once for both
    res = M.train(tr, te, lam=LAM, mu=MU, **kw)
    rows = [(h["iteration"], round(h["objective"], 5), round(h["test_rmse"], 8), h["gamma"]) for h in res.history]
    return spark.createDataFrame(rows, "iteration int, objective double, test_rmse double, gamma double")


@register("train_mf", _train_mf_sql(M.MAXITER, M.D))
def q_train_mf(spark, sf):
    """Training at the defaults (d = 10, 20 iterations, seeded normal init),
    λ = μ = 0.05, test fold 0: objective and test RMSE per iteration."""
    return _train_mf(spark, sf)


@register("train_mf_smj", _train_mf_sql(3, DF))
def q_train_mf_smj(spark, sf):
    """Three iterations on many small blocks of users and items."""
    return _train_mf(spark, sf, d=DF, maxiter=3, blocks=(7, 5))


def _grid_sql(regs, iters: int, d: int) -> str:
    models = " UNION ALL ".join(f"SELECT CAST({n} * 100 + k AS INTEGER) AS m, CAST(k AS INTEGER) AS k, CAST({r!r} AS DOUBLE) AS reg FROM range(0, {N_FOLDS}) t(k)"
                                for n, r in enumerate(regs))
    return (_steps_sql(models, "rt.fold <> mo.k", "rt.fold = mo.k", iters, d, "mo.reg")
            + f" SELECT reg, CASE WHEN isfinite(cv_rmse) THEN round(cv_rmse, 9) END AS cv_rmse FROM (SELECT mo.reg, avg(e.rmse) AS cv_rmse "
              f"FROM e{iters - 1} e JOIN mo ON mo.m = e.m GROUP BY mo.reg)")


def _grid(spark, sf, regs, **kw):
    got = M.reg_grid(_ratings(spark, sf), N_FOLDS, regs, **kw)
    return got.select("reg", F.when(F.col("cv_rmse") < float("inf"), F.round("cv_rmse", 9)).alias("cv_rmse"))


@register("mf_reg_grid", _grid_sql(GRID, M.MAXITER, M.D))
def q_mf_reg_grid(spark, sf):
    """CV RMSE for λ = μ on linspace(0, 3000, 20) at the defaults (d = 10, 20
    iterations): 20 grid points x 5 folds in one run over one copy of R. Where the
    step times λ is beyond 1 the run diverges, as the reference's does: where it
    leaves the doubles the RMSE is null."""
    return _grid(spark, sf, GRID)


@register("mf_reg_grid_2iter", _grid_sql(_REGS, _GRID_ITERS, DF))
def q_mf_reg_grid_2iter(spark, sf):
    """Two iterations at d = 3 for λ = μ ∈ {0, 1, 2}, value-checked."""
    return _grid(spark, sf, _REGS, d=DF, maxiter=_GRID_ITERS)


def _fit_full_sql(iters: int, d: int) -> str:
    return (_steps_sql(_FOLD, "true", "true", iters, d, repr(LAM))
            + " " + _per_iteration("round(s.objective, 6) AS objective, round(e.rmse, 9) AS train_rmse", iters))


@register("fit_full_mf", _fit_full_sql(M.MAXITER, M.D))
def q_fit_full_mf(spark, sf):
    """No CV: train on all ratings at the defaults (RMSE on the training set),
    save U and V."""
    from corvid.session import scratch_path
    from corvid.sources.ratings import write_factors
    res = M.train(_ratings(spark, sf), None, lam=LAM, mu=MU)
    write_factors(res.U, res.V, scratch_path(spark, "factors-out"))
    rows = [(h["iteration"], round(h["objective"], 6), round(h["test_rmse"], 9)) for h in res.history]
    return spark.createDataFrame(rows, "iteration int, objective double, train_rmse double")


@register("train_mf_2iter", _steps_sql(_FOLD, "rt.fold <> mo.k", "rt.fold = mo.k", 2, DF, repr(LAM), lambda side, col, k: _fv(col, k))
          + " " + " UNION ALL ".join(f"SELECT '{p}' AS side, {i} AS id, " + ", ".join(f"round(c{k}, 9) AS c{k}" for k in range(DF))
                                     + f" FROM {p}2" for p, i in (("u", "i"), ("v", "j"))))
def q_train_mf_2iter(spark, sf):
    """Two MF iterations (λ = μ = 0.05, γ_i = 0.001/i^0.2) from the formula
    profiles, value-checked against the SQL unrolling."""
    tr, _ = M.fold_split(_ratings(spark, sf), TEST_FOLD)
    res = M.train(tr, None, d=DF, lam=LAM, mu=MU, maxiter=2, init="formula")
    cols = [F.round(F.col("p")[k], 9).alias(f"c{k}") for k in range(DF)]
    u = res.U.select(F.lit("u").alias("side"), F.col("i").alias("id"), F.col("u").alias("p")).select("side", "id", *cols)
    v = res.V.select(F.lit("v").alias("side"), F.col("j").alias("id"), F.col("v").alias("p")).select("side", "id", *cols)
    return u.unionByName(v)


@register("gain_schedule", f"WITH {RT} SELECT fold + 1 AS iteration, round({M.GAIN!r} / power(fold + 1, {M.POWER!r}), 12) AS gamma, count(*) AS n FROM rt GROUP BY 1, 2")
def q_gain_schedule(spark, sf):
    """γ_i = gain / i^power as a column, the iteration taken from the fold."""
    i = (F.col("fold") + 1).alias("iteration")
    g = _ratings(spark, sf).select(i).withColumn("gamma", F.round(M.gain_column("iteration"), 12))
    return g.groupBy("iteration", "gamma").agg(F.count(F.lit(1)).alias("n"))
