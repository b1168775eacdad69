"""Dense and sparse vector arithmetic as column expressions.

Dense vectors are ``array<double>`` columns; a driver-side coefficient vector
is bound into the expression as literals, term by term, so the whole product
stays in generated code (no interpreted higher-order function).
Sparse vectors are ``map<string,double>`` columns (missing key = 0.0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- dense: array column × literal vector -----------------------------------
def dot_lit(x, beta: Sequence[float]) -> Column:
    """<x, β> for an array column x and a driver vector β (D1 / G3 form)."""
    x = _c(x)
    terms = [x[i] * F.lit(float(b)) for i, b in enumerate(beta)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def linear_predict(x, beta) -> Column:
    return dot_lit(x, beta)


def squared_error(x, y, beta) -> Column:
    """(y − <x,β>)²"""
    r = _c(y) - dot_lit(x, beta)
    return r * r


def local_gradient(x, y, beta) -> Column:
    """−2 (y − <x,β>) x as an array column."""
    x = _c(x)
    r = _c(y) - dot_lit(x, beta)
    return F.array(*[F.lit(-2.0) * r * x[i] for i in range(len(beta))])


# ---- dense: array column × array column ---------------------------------------
def dot_arrays(u, v, d: int | None = None) -> Column:
    """<u, v> for two array columns; with ``d`` known the sum is unrolled."""
    u, v = _c(u), _c(v)
    if d:
        out = u[0] * v[0]
        for k in range(1, d):
            out = out + u[k] * v[k]
        return out
    return F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t)


# ---- sparse: map<string,double> -------------------------------------------------
def sv_access(m, key) -> Column:
    """Value at ``key`` or 0.0 (a missing map key is NULL, even under ANSI)."""
    k = key if isinstance(key, Column) else F.lit(key)
    return F.coalesce(F.try_element_at(_c(m), k), F.lit(0.0))


def sv_dot(a, b) -> Column:
    """Σ over common keys of a[k]·b[k]: the keys meet in one hash pass (a lookup
    per key would scan the other map each time)."""
    both = F.map_zip_with(_c(a), _c(b), lambda k, x, y: x * y)
    return F.aggregate(F.map_values(both), F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))


def sv_add(a, b) -> Column:
    """Union of keys, values summed (a missing side counts 0.0)."""
    return F.map_zip_with(_c(a), _c(b), lambda k, x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0)))


def sv_sub(a, b) -> Column:
    return F.map_zip_with(_c(a), _c(b), lambda k, x, y: F.coalesce(x, F.lit(0.0)) - F.coalesce(y, F.lit(0.0)))


def sv_scale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform_values(_c(a), lambda k, v: v * s)


def sv_norm(a, p: float | str = 2) -> Column:
    """p-norm of a map vector; ``p='inf'`` for the max norm; empty → 0.0."""
    vals = F.map_values(_c(a))
    if p in ("inf", float("inf")):
        return F.coalesce(F.array_max(F.transform(vals, lambda v: F.abs(v))), F.lit(0.0))
    if p == 1:
        return F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + F.abs(v))
    if p == 2:
        return F.sqrt(F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + v * v))
    pf = float(p)
    return F.pow(F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + F.pow(F.abs(v), F.lit(pf))), F.lit(1.0 / pf))


# ---- logistic ------------------------------------------------------------------
def softplus(z) -> Column:
    """log(1 + exp(z)) without overflow: max(z, 0) + log1p(exp(−|z|))."""
    z = _c(z)
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def logistic_loss(margin, y) -> Column:
    """log(1 + exp(−y·m))"""
    return softplus(-_c(y) * _c(margin))


def logistic_coef(margin, y) -> Column:
    """Row weight of the gradient: −y / (1 + exp(y·m))."""
    y = _c(y)
    return -y / (F.lit(1.0) + F.exp(y * _c(margin)))
