"""Matrix factorisation of ratings by simultaneous gradient steps on user and
item profiles, with k-fold cross-validation.

Ratings ``(i, j, r)``; profiles ``U(i, u array<double>)``, ``V(j, v …)``.
Single steps are table operators (any number of leading key columns may prefix the
three tables). Training runs on a grid of rating blocks (``rating_blocks``): one
copy of R for all folds of a cross-validation and all points of a grid, with no
driver loop over them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions.vectors import dot_arrays
from corvid.operators.rating_blocks import LOCAL_BYTES, Model, RatingGrid, train_held, train_models

# Reference defaults.
GAIN = 0.001
POWER = 0.2
EPSILON = 1e-99
D = 10
MAXITER = 20
SEED = 1234567


# ---- initial profiles -------------------------------------------------------------
def _uniform(seed: int, side: str, id_col: Column, k: int, stream: int) -> Column:
    """In (0, 1), from the first 52 bits of an MD5 that any engine reproduces."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(side), id_col.cast("string"), F.lit(str(k)), F.lit(str(stream))))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def normal_vector(seed: int, side: str, id_col, d: int) -> Column:
    """d standard normals by Box-Muller over hashes of (seed, side, id, k): a
    pure function of the id, so independent of partitioning and task order;
    ``side`` keeps user and item vectors apart."""
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    out = []
    for k in range(d):
        u1, u2 = _uniform(seed, side, id_col, k, 0), _uniform(seed, side, id_col, k, 1)
        out.append(F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2))
    return F.array(*out)


def formula_vector(id_col, d: int) -> Column:
    """Deterministic profiles ((id·7919 + k·104729) mod 1000)/1000 − 0.5, the
    same in any engine: used to check the update steps against SQL."""
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.array(*[F.pmod(id_col * 7919 + F.lit(k * 104729), F.lit(1000)).cast("double") / F.lit(1000.0)
                     - F.lit(0.5) for k in range(d)])


def rating_ids(R: DataFrame, side: str = "i", keys=()) -> DataFrame:
    return R.select(*keys, side).distinct()


def init_profiles(R: DataFrame, d: int = D, seed: int = SEED, keys=(), method: str = "normal"):
    """``(U, V)`` for the ids present in R (per key)."""
    keys = list(keys)
    ui = rating_ids(R, "i", keys)
    vj = rating_ids(R, "j", keys)
    if method == "formula":
        return ui.withColumn("u", formula_vector("i", d)), vj.withColumn("v", formula_vector("j", d))
    return ui.withColumn("u", normal_vector(seed, "u", "i", d)), vj.withColumn("v", normal_vector(seed, "v", "j", d))


# ---- row functions ------------------------------------------------------------------
def predict(u, v, d: int | None = None) -> Column:
    return dot_arrays(u, v, d)


def pred_diff(u, v, r, d: int | None = None) -> Column:
    r = F.col(r) if isinstance(r, str) else r
    return predict(u, v, d) - r


def gradient_u(delta, v, d: int) -> Column:
    """∇_u (<u,v> − r)² = 2δv"""
    delta = F.col(delta) if isinstance(delta, str) else delta
    v = F.col(v) if isinstance(v, str) else v
    return F.array(*[F.lit(2.0) * delta * v[k] for k in range(d)])


def gradient_v(delta, u, d: int) -> Column:
    return gradient_u(delta, u, d)


# ---- table operators ---------------------------------------------------------------
def join_and_predict(R: DataFrame, U: DataFrame, V: DataFrame, d: int, keys=(), bcast=(None, None)) -> DataFrame:
    """``(keys…, i, j, delta, u, v)`` by two inner equi-joins. Ratings of ids
    without a profile drop out (as in the reference)."""
    keys = list(keys)
    ub = bcast[0] if bcast[0] is not None else U
    vb = bcast[1] if bcast[1] is not None else V
    j = R.join(ub, keys + ["i"]).join(vb, keys + ["j"])
    return j.select(*keys, "i", "j", pred_diff("u", "v", "r", d).alias("delta"), "u", "v")


def squared_error(J: DataFrame, keys=()) -> DataFrame:
    return J.groupBy(*keys).agg(F.sum(F.col("delta") * F.col("delta")).alias("se"), F.count(F.lit(1)).alias("m"))


def norm_sq(P: DataFrame, col: str, d: int, keys=()) -> DataFrame:
    """Σ‖p‖² per key (multiply by λ or μ outside)."""
    return P.groupBy(*keys).agg(F.sum(dot_arrays(col, col, d)).alias(f"n_{col}"))


def adapt(J: DataFrame, P: DataFrame, side: str, gamma: float, reg, d: int, keys=()) -> DataFrame:
    """p ← p − γ(Σ 2δ·q + 2·reg·p) for side ``i`` (p=u, q=v) or ``j``.
    The d gradient sums are plain doubles (hash aggregation, partial per
    task); the profile is joined back instead of being carried in the buffer.
    ``reg`` is a number or a column (a key such as ``reg``)."""
    keys = list(keys)
    pc, qc = ("u", "v") if side == "i" else ("v", "u")
    q = F.col(qc)
    sums = J.groupBy(*keys, side).agg(*[F.sum(F.lit(2.0) * F.col("delta") * q[k]).alias(f"_g{k}") for k in range(d)])
    regc = reg if isinstance(reg, Column) else F.lit(float(reg))
    p = F.col(pc)
    j = P.join(sums, keys + [side])
    new = F.array(*[p[k] - F.lit(float(gamma)) * (F.col(f"_g{k}") + F.lit(2.0) * regc * p[k]) for k in range(d)])
    return j.select(*keys, side, new.alias(pc))


def gain_schedule(gain: float, power: float, i: int) -> float:
    """γ_i = gain / i^power (i from 1)."""
    return gain / i ** power


def gain_column(i, gain: float = GAIN, power: float = POWER) -> Column:
    """The same schedule for a column of iteration numbers."""
    return F.lit(float(gain)) / F.pow(F.col(i) if isinstance(i, str) else i, F.lit(float(power)))


@dataclass
class MFResult:
    U: DataFrame
    V: DataFrame
    history: list = field(default_factory=list)      # per iteration


def _start(seed: int, d: int, method: str):
    """The first profile of an id, the same in every model."""
    return (lambda side, c: formula_vector(c, d)) if method == "formula" else (lambda side, c: normal_vector(seed, side, c, d))


def train(train_R: DataFrame, test_R: DataFrame | None = None, d: int = D, lam: float = 0.0, mu: float = 0.0,
          gain: float = GAIN, power: float = POWER, epsilon: float = EPSILON, maxiter: int = MAXITER,
          seed: int = SEED, init: str = "normal", last_update: bool = True, blocks: tuple[int, int] | None = None,
          journal: str | None = None) -> MFResult:
    """Gradient steps on U and V from the same errors; stop at ``maxiter`` or when
    |Δobjective| ≤ epsilon. Profiles are those of the ids of the training ratings.
    The test RMSE of an iteration uses the profiles from before its update, and
    divides by all test ratings (unmatched ones add no error, as in the reference);
    ``rmse_matched`` divides by the matched ones only; both are None without test
    ratings; without ``test_R`` the training ratings are tested. Without
    ``last_update`` the profiles stay those the last RMSE was taken with.
    ``blocks`` are the numbers of user and item blocks, chosen by size if not given.
    ``journal`` names a folder in which every update is committed; called again with
    it, training goes on from the last one, also with a larger ``maxiter``."""
    R = train_R.select("i", "j", "r", F.lit(1).alias("fold"))
    if test_R is not None:
        R = R.union(test_R.select("i", "j", "r", F.lit(0)))
    grid = RatingGrid(R, [Model(None if test_R is None else 0, float(lam), float(mu))], d, _start(seed, d, init), blocks)
    run = train_models(grid, lambda i: gain_schedule(gain, power, i), epsilon, maxiter, last_update, journal)[0]
    kinds = dict(train_R.dtypes)
    U, V = (grid.factors(s).select(F.col("id").cast(kinds[c]).alias(c), F.col("p").alias(p)) for s, c, p in ((0, "i", "u"), (1, "j", "v")))
    grid.release()
    return MFResult(U, V, run.history)


# ---- folds -------------------------------------------------------------------------
def fold_split(R: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """train = all other folds, test = fold k (one table, two filters)."""
    return R.where(F.col("fold") != k), R.where(F.col("fold") == k)


def fold_keyed(R: DataFrame, n_folds: int) -> tuple[DataFrame, DataFrame]:
    """Training ratings replicated once per fold they train (k ≠ fold) and
    test ratings keyed by their own fold: ``(k, i, j, r)`` each."""
    tr = (R.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
          .where(F.col("k") != F.col("fold")).select("k", "i", "j", "r"))
    te = R.select(F.col("fold").alias("k"), "i", "j", "r")
    return tr, te


def _trained(R: DataFrame, models: list[Model], d: int = D, gain: float = GAIN, power: float = POWER, epsilon: float = EPSILON,
             maxiter: int = MAXITER, seed: int = SEED, init: str = "normal", blocks: tuple[int, int] | None = None,
             held_bytes: int = LOCAL_BYTES) -> list[dict]:
    """The last record of every model, all trained over one copy of R; where that is at
    most ``held_bytes`` (with the start profiles), each model by one task."""
    grid, step = RatingGrid(R, models, d, _start(seed, d, init), blocks, keep=False), lambda i: gain_schedule(gain, power, i)
    if grid.own and grid.total and grid.held_bytes() <= held_bytes:
        runs = train_held(grid, step, epsilon, maxiter)
    else:
        runs = train_models(grid, step, epsilon, maxiter, last_update=False)
    grid.release()
    return [r.history[-1] for r in runs]


def _mean(values) -> float | None:
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def cross_validate(R: DataFrame, n_folds: int, lam: float = 0.0, mu: float = 0.0, **kw) -> DataFrame:
    """k-fold CV, all folds in the same jobs: ``(k, test_rmse, …, cv_rmse)`` per fold
    from the last iteration; ``cv_rmse`` is the mean over the folds."""
    last = _trained(R, [Model(k, float(lam), float(mu)) for k in range(n_folds)], **kw)
    mean = _mean(h["test_rmse"] for h in last)
    rows = [(k, h["test_rmse"], h["rmse_matched"], h["coverage"], h["iteration"], mean) for k, h in enumerate(last)]
    return R.sparkSession.createDataFrame(rows, "k int, test_rmse double, rmse_matched double, coverage double, "
                                                "iterations int, cv_rmse double")


def reg_grid(R: DataFrame, n_folds: int, regs, **kw) -> DataFrame:
    """CV for λ = μ over a grid, all grid points and folds in the same jobs over one
    copy of R: ``(reg, cv_rmse)``."""
    models = [Model(k, float(x), float(x)) for x in regs for k in range(n_folds)]
    last = _trained(R, models, **kw)
    rows = [(float(x), _mean(h["test_rmse"] for h in last[n * n_folds:(n + 1) * n_folds])) for n, x in enumerate(regs)]
    return R.sparkSession.createDataFrame(rows, "reg double, cv_rmse double")
