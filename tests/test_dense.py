"""Dense regression: the trainers against plain numpy loops over the rows,
line-quadratic identity, finite differences, histogram."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from corvid.operators import regression as G
from corvid.operators.features import poly2_features
from corvid.plans import inputs
from corvid.sources.dense import format_dense_line, read_dense_points


@pytest.fixture(scope="module")
def medium(spark, tmp_path_factory):
    """Degree-2 points of lineitem, written as text and read by the reader."""
    out = []
    pts = inputs.dense_array_points(spark, SF_SMALL).withColumn("p", poly2_features(F.slice("x", 2, 2)))
    for name, rows in (("train", pts.where(~F.col("is_test"))), ("test", pts.where(F.col("is_test")))):
        path = str(tmp_path_factory.mktemp("dense") / name)
        rows.select(format_dense_line("p", F.col("y")).alias("value")).write.text(path)
        out.append(read_dense_points(spark, path).cache())
    return *out, G.gram_stats(out[0])


@pytest.fixture(scope="module")
def rows(medium):
    pdf = [m.toPandas() for m in medium[:2]]
    return [(np.vstack(p["x"].to_numpy()), p["y"].to_numpy()) for p in pdf]


def _direct_gd(X, y, lam, max_iter, eps):
    b, k, norm = np.zeros(X.shape[1]), 0, np.inf
    while k < max_iter and norm > eps:
        g = -2 * X.T @ (y - X @ b) / len(y) + 2 * lam * b
        norm = np.sqrt(g @ g)
        b = b - (g @ g) / (2 * (np.mean((X @ g) ** 2) + lam * g @ g)) * g
        k += 1
    return b, k


def _direct_fw(X, y, K, max_iter, eps):
    b, k, gap = np.zeros(X.shape[1]), 0, np.inf
    while k < max_iter and gap > eps:
        g = -2 * X.T @ (y - X @ b) / len(y)
        s = np.zeros(len(b))
        s[np.argmax(np.abs(g))] = -K * np.sign(g[np.argmax(np.abs(g))])
        gap, d = (b - s) @ g, s - b
        q = np.mean((X @ d) ** 2)
        b = b + (np.clip(-(g @ d) / (2 * q), 0, 1) if q else 0) * d
        k += 1
    return b, k


@pytest.mark.parametrize("lam", [0.125, 0.5, 2.0, 8.0])
def test_gd_equals_a_direct_loop(medium, rows, lam):
    _, te, g = medium
    fit = G.train_gd_g(g, lam=lam, max_iter=40, eps=0.01)
    b, k = _direct_gd(*rows[0], lam, 40, 0.01)
    assert fit.iterations == k and np.max(np.abs(fit.beta - b)) < 1e-7
    X, y = rows[1]
    assert abs(G.mse(te, fit.beta).first()["mse"] - np.mean((y - X @ b) ** 2)) < 1e-6


@pytest.mark.parametrize("K", [1.0, 10.0, 50.0])
def test_fw_equals_a_direct_loop(medium, rows, K):
    fit = G.train_fw_g(medium[2], K=K, max_iter=12, eps=0.01)
    b, k = _direct_fw(*rows[0], K, 12, 0.01)
    assert fit.iterations == k and np.max(np.abs(fit.beta - b)) < 1e-6
    assert np.abs(fit.beta).sum() <= K * (1 + 1e-12)


def test_summary_equals_direct_aggregates(spark, medium):
    tr, _, g = medium
    rng = np.random.default_rng(0)
    b1, b2 = rng.normal(size=g.d), rng.normal(size=g.d)
    for lam in (0.0, 0.5):
        assert abs(G.ridge_objective(tr, b1, lam).first()[0] - G.objective_g(g, b1, lam)) < 1e-8
        grad = np.array([r["value"] for r in G.ridge_gradient(tr, b1, lam).orderBy("idx").collect()])
        assert np.max(np.abs(grad - G.gradient_g(g, b1, lam))) < 1e-8
        q = G.line_quadratic(tr, b1, b2, lam).first()
        a, b, c = G.hcoeff_g(g, b1, b2, lam)
        assert abs(q["a"] - a) < 1e-8 and abs(q["b"] - b) < 1e-8 and abs(q["c"] - c) < 1e-8
        # identity h(γ) = F(β1 + γβ2)
        for gam in (0.3, -1.7):
            assert abs(a * gam ** 2 + b * gam + c - G.objective_g(g, b1 + gam * b2, lam)) < 1e-8


def test_fd_gradient_close_to_analytic(spark, medium):
    tr, _, g = medium
    beta = np.linspace(-1, 1, g.d)
    rows = G.fd_gradient(tr, beta, 0.5, 1e-4).collect()
    assert max(abs(r["fd"] - r["analytic"]) for r in rows) < 1e-2


def test_label_histogram_equals_numpy(medium, rows):
    h = {r["bin"]: r["n"] for r in G.label_histogram(medium[0], "y", 10).collect()}
    assert [h.get(i, 0) for i in range(10)] == np.histogram(rows[0][1], 10)[0].tolist()


def test_wide_gram_equals_numpy(spark):
    pts = inputs.wide_points(spark, SF_SMALL)
    g = G.gram_stats(pts)
    pdf = pts.toPandas()
    X = np.vstack(pdf["x"].to_numpy())
    y = pdf["y"].to_numpy()
    assert np.allclose(g.A, X.T @ X / len(y)) and np.allclose(g.b, X.T @ y / len(y))


def test_lmo_ties_lowest_index(spark):
    gdf = spark.createDataFrame([(0, 1.0), (1, -3.0), (2, 3.0)], "idx int, value double")
    s = {r["idx"]: r["s"] for r in G.l1_ball_lmo(gdf, 5.0).collect()}
    assert s == {0: 0.0, 1: 5.0, 2: 0.0}
    assert list(G.solve_lin([1.0, -3.0, 3.0], 5.0)) == [0.0, 5.0, 0.0]


def test_zero_eps_runs_max_iter(medium):
    """eps = 0 means "run max_iter iterations", not "stop before the first"."""
    g = medium[2]
    assert G.train_gd_g(g, lam=0.5, max_iter=3, eps=0.0).iterations == 3
    assert G.train_fw_g(g, K=50.0, max_iter=3, eps=0.0).iterations == 3
