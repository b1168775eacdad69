"""Sparse logistic regression: gradient check, monotone training, join
strategies agree, invariance to the data layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from corvid.operators import logistic as L
from corvid.operators import sparse_blocks as S
from corvid.plans import inputs


@pytest.fixture(scope="module")
def data(spark):
    pts, xl = inputs.sparse_points(spark, SF_SMALL)
    return pts.cache(), xl.cache()


def test_gradient_matches_finite_differences(spark, data):
    pts, xl = data
    tr = pts.where(~F.col("is_test"))
    beta = L.all_features(xl).select("feature", (F.length("feature") % 5 / F.lit(1000.0)).alias("value"))
    rows = L.sparse_fd_gradient(tr, xl, beta, 0.1, 1e-6).collect()
    err = max(abs(r["fd"] - r["analytic"]) for r in rows)
    assert err < 1e-2 * max(1.0, max(abs(r["analytic"]) for r in rows))


def test_training_decreases_loss(spark, data):
    pts, xl = data
    fit = L.train(pts, xl, lam=0.1, max_iter=3, eps=1e-9)
    objs = [h["objective"] for h in fit.history]
    assert all(b <= a for a, b in zip(objs, objs[1:]))
    assert fit.iterations == 3
    # the recurrence m ← m − t·s equals margins recomputed by a join
    direct = L.total_loss(pts.where(~F.col("is_test")), xl, fit.beta, 0.1)
    assert abs(direct - objs[-1]) < 1e-6 * max(1.0, abs(direct))


def test_blocks_equal_broadcast(spark, data):
    pts, xl = data
    beta = L.all_features(xl).select("feature", (F.length("feature") / F.lit(100.0)).alias("value"))
    a, b = L.Blocks(xl, 5, broadcast=True), L.Blocks(xl, 5, broadcast=False)
    m = [{r["row_id"]: r["margin"] for r in L.margins(pts, x, beta).collect()} for x in (a, b, xl)]
    assert m[0].keys() == m[1].keys() == m[2].keys()
    assert max(abs(m[0][k] - m[1][k]) + abs(m[0][k] - m[2][k]) for k in m[0]) < 1e-9
    a.release(), b.release()


def test_unbounded_features_never_move_x_long(spark, data):
    """Joined by block, x_long has no exchange above its cached layout."""
    _, xl = data
    x = L.Blocks(xl, 5, broadcast=False)
    beta = L.all_features(xl).select("feature", F.lit(1.0).alias("_b"))
    with L.block_joins(spark):
        plan = x.with_features(beta)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("InMemoryTableScan")]
    assert "ShuffledHashJoin" in above and "Broadcast" not in above
    assert "Exchange" not in above.split("ShuffledHashJoin", 1)[1]
    x.release()


def test_blocks_training_equals_broadcast_training(spark, data):
    pts, xl = data
    a = L.train(pts, xl, lam=0.1, max_iter=2, eps=0.0, broadcast=True, n_partitions=4).beta
    b = L.train(pts, xl, lam=0.1, max_iter=2, eps=0.0, broadcast=False, n_partitions=4).beta
    assert L.model_compare(a, b).first()["max_abs_diff"] < 1e-12


def test_storage_does_not_grow_with_iterations(spark, data):
    import os

    from corvid.session import scratch_path

    pts, xl = data
    root = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    os.makedirs(root, exist_ok=True)
    pts.count(), xl.count()  # cached by the fixture
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    folders = lambda: len([f for f in os.listdir(root) if f.startswith("logistic-")])
    for on_driver in (True, False):
        sizes = []
        for n in (1, 3):
            before = cached(), folders(), len(os.listdir(root))
            L.train(pts, xl, lam=0.1, max_iter=n, eps=0.0, n_partitions=3, broadcast=on_driver)
            sizes.append((cached() - before[0], folders() - before[1], len(os.listdir(root)) - before[2]))
        assert sizes == [(0, 1, 1), (0, 1, 1)]  # the β table that the caller gets


@pytest.mark.parametrize("per_bucket, rounds", [(50_000, 64), (7, 2)])
def test_groups_are_balanced_by_entries(spark, monkeypatch, per_bucket, rounds):
    """A heavy tail of row sizes: groups within a tenth of their mean."""
    monkeypatch.setattr(L, "GREEDY_ROUNDS", rounds)
    rng = np.random.default_rng(3)
    size = np.minimum(rng.pareto(1.2, 400) * 5, 300).astype(int)
    pts = spark.createDataFrame([(i, 1) for i in range(400)], "row_id long, y int")
    xl = pts.join(spark.createDataFrame([(i, int(k)) for i, k in enumerate(size)], "row_id long, k int"), "row_id").where("k > 0").select(
        "row_id", F.explode(F.transform(F.sequence(F.lit(1), "k"), lambda x: x.cast("string"))).alias("feature"), F.lit(1.0).alias("value"))
    got = L.balanced_groups(pts, xl, 8, per_bucket).toPandas()
    assert sorted(got["row_id"]) == list(range(400)) and (got.set_index("row_id").sort_index()["entries"].to_numpy() == size).all()
    load = got.groupby("pid")["entries"].sum()
    assert len(load) == 8 and load.max() < 1.1 * load.mean()
    hashed = got.groupby(got["row_id"] % 8)["entries"].sum()
    assert load.max() < hashed.max()
    assert L.balanced_groups(pts.limit(0), xl, 8).count() == 0


def test_dictionary_numbers_features_densely(spark):
    f = spark.range(1000).select(F.concat(F.lit("f"), "id").alias("feature"))
    a, b = (S.dictionary(x, 1000, per_bucket=70).collect() for x in (f, f.repartition(13)))
    assert sorted(r["fid"] for r in a) == list(range(1000))
    assert {tuple(r) for r in a} == {tuple(r) for r in b}


def test_models_in_one_pass_equal_plain_ones(spark, monkeypatch):
    """Finished models are masked, others go on; vectors on the driver and in
    chunks agree with single runs in numpy."""
    x, y, test, pts, xl = small_points(spark)
    lams = [1e-5, 1.0, 1e3]
    eps = plain_training(x, y, test, 1.0, 3, 0.0)[0][-1][1] * 1.0001
    plain = [plain_training(x, y, test, v, 6, eps) for v in lams]
    assert len({len(h) for h, _ in plain}) > 1
    for on_driver in (True, False):
        fits = L.train_sweep(pts, xl, lams, max_iter=6, eps=eps, online_test=True, broadcast=on_driver, n_partitions=3)
        for (hist, b), fit in zip(plain, fits):
            assert fit.iterations == len(hist)
            assert [h["rejected"] for h in fit.history] == [h[3] for h in hist]
            assert np.allclose([(h["objective"], h["grad_norm"]) for h in fit.history], [h[:2] for h in hist], rtol=1e-9)
            beta = {r["feature"]: r["value"] for r in fit.beta.collect()}
            assert np.allclose([beta[f"f{j}"] for j in range(6)], b, atol=1e-12)
            m = (x @ b)[test]
            assert abs(fit.history[-1]["acc"] - np.mean((m > 0) == (y[test] > 0))) < 1e-12


@pytest.mark.parametrize("on_driver", [True, False])
def test_training_goes_on_from_its_journal(spark, tmp_path, on_driver):
    """Stopped after 3 of 6 iterations and called again: as if it had not stopped."""
    _, _, _, pts, xl = small_points(spark)
    kw = {"eps": 0.0, "online_test": True, "broadcast": on_driver, "n_partitions": 2}
    path = str(tmp_path / "journal")
    whole = L.train_sweep(pts, xl, [0.1, 2.0], max_iter=6, **kw)
    first = L.train_sweep(pts, xl, [0.1, 2.0], max_iter=3, journal=path, **kw)
    assert [f.iterations for f in first] == [3, 3]
    (tmp_path / "journal" / "step-9").mkdir()  # a step that was not committed
    (tmp_path / "journal" / "manifest-9.draft").write_text("{")
    again = L.train_sweep(pts, xl, [0.1, 2.0], max_iter=6, journal=path, **kw)
    for a, b in zip(whole, again):
        assert b.iterations == 6 and len(b.history) == 6
        assert L.model_compare(a.beta, b.beta).first()["max_abs_diff"] < 1e-12
        for x, y in zip(a.history, b.history):
            assert {k: v for k, v in x.items() if k != "t"} == pytest.approx({k: v for k, v in y.items() if k != "t"}, rel=1e-9)
    with pytest.raises(ValueError):
        L.train_sweep(pts, xl, [0.1, 3.0], max_iter=6, journal=path, **kw)


def test_rows_without_features_and_foreign_features(spark):
    """A row that shares no feature with β counts with margin 0; a start β rules
    which features there are."""
    pts = spark.createDataFrame([(1, 1, False), (2, -1, False), (3, 1, False), (4, 1, True)], "row_id long, y int, is_test boolean")
    xl = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "c", 1.0)], "row_id long, feature string, value double")
    for on_driver in (True, False):
        fit = L.train(pts, xl, max_iter=1, eps=0.0, online_test=True, broadcast=on_driver)
        assert {r["feature"]: round(r["value"], 12) for r in fit.beta.collect()} == {"a": 0.5, "b": -1.0}
        want = np.logaddexp(0, -0.5) + np.logaddexp(0, -2.0) + np.log(2)
        assert abs(fit.history[0]["objective"] - want) < 1e-12 and fit.history[0]["acc"] is None
        start = spark.createDataFrame([("a", 0.0), ("z", 3.0)], "feature string, value double")
        fit = L.train(pts, xl, beta0=start, lam=0.5, max_iter=1, eps=0.0, broadcast=on_driver)
        assert {r["feature"] for r in fit.beta.collect()} == {"a", "z"}


def test_layout_invariance(spark, data):
    pts, xl = data
    a = L.train(pts, xl, lam=0.1, max_iter=2, eps=1e-9, n_partitions=3).beta
    b = L.train(pts, xl, lam=0.1, max_iter=2, eps=1e-9, n_partitions=11).beta
    r = L.model_compare(a, b).first()
    assert r["max_abs_diff"] < 1e-12


def test_metrics_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 0, 0)], "P long, N long, TP long, FP long, TN long, FN long")
    r = L.acc_pre_rec(df).first()
    assert r["acc"] is None and r["pre"] is None and r["rec"] is None


def plain_training(x, y, test, lam, max_iter, eps):
    """The trainer in numpy over a dense matrix: history and β."""
    loss = lambda m, b: np.logaddexp(0, -y * m)[~test].sum() + lam * (b @ b)
    b, hist = np.zeros(x.shape[1]), []
    while len(hist) < max_iter and (not hist or hist[-1][1] > eps):
        m = x @ b
        g = x[~test].T @ (-y / (1 + np.exp(y * m)))[~test] + 2 * lam * b
        t, k, f0, gg = 1.0, 0, loss(m, b), g @ g
        while loss(m - t * (x @ g), b - t * g) > f0 - 0.2 * t * gg:
            t, k = 0.6 * t, k + 1
        b = b - t * g
        hist.append((loss(x @ b, b), gg ** 0.5, t, k))
    return hist, b


def small_points(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random((60, 6)) < 0.6, rng.integers(1, 4, (60, 6)), 0).astype(float)
    y, test = np.where(rng.random(60) < 0.5, 1, -1), np.arange(60) % 5 == 0
    pts = spark.createDataFrame([(i, int(a), bool(t)) for i, (a, t) in enumerate(zip(y, test))], "row_id long, y int, is_test boolean")
    xl = spark.createDataFrame([(int(i), f"f{j}", float(x[i, j])) for i, j in zip(*x.nonzero())], "row_id long, feature string, value double")
    return x, y, test, pts, xl


def test_queries_train_at_the_reference_defaults(spark, monkeypatch):
    """40 iterations or the norm below 0.1, on a small fixture against numpy."""
    from corvid.plans import q_io, q_logistic as Q

    x, y, test, pts, xl = small_points(spark)
    monkeypatch.setattr(Q, "_data", lambda spark, sf: (pts, xl))
    hist, b = plain_training(x, y, test, 0.1, 40, 0.1)
    assert len(hist) > 5
    for query in (Q.q_online_test, q_io.q_history_sink):
        got = query(spark, "").orderBy("k").collect()
        assert [r["rejected"] for r in got] == [h[3] for h in hist]
        assert np.allclose([(r["objective"], r["grad_norm"]) for r in got], [h[:2] for h in hist], atol=2e-5)
    beta = {r["feature"]: r for r in Q.q_train_logistic(spark, "").collect()}
    assert np.allclose([beta[f"f{j}"]["value"] for j in range(6)], b, atol=1e-7)
    assert {r["iterations"] for r in beta.values()} == {len(hist)}
    r = Q.q_model_compare(spark, "").first()
    assert r["max_abs_diff"] < 1e-8 and abs(r["norm_a"] - (b @ b) ** 0.5) < 1e-5


def test_sweep_trains_every_lambda_at_the_reference_defaults(spark, monkeypatch):
    from corvid.plans import q_logistic as Q

    x, y, test, pts, xl = small_points(spark)
    monkeypatch.setattr(Q, "_data", lambda spark, sf: (pts, xl))
    monkeypatch.setattr(Q, "SWEEP", [1e-5, 1.0, 1e5])
    for r in Q.q_logistic_lambda_sweep(spark, "").collect():
        hist, b = plain_training(x, y, test, r["lam"], 40, 0.1)
        m = (x @ b)[test]
        assert abs(r["acc"] - np.mean((m > 0) == (y[test] > 0))) < 1e-9, r
        assert abs(r["grad_norm"] - hist[-1][1]) < 1e-4, (r, hist[-1])


def test_softplus_sums_by_products(spark):
    """Sums of log(1 + exp(z)) in products of 512 factors equal the plain ones (F3, F11, F21)."""
    rng = np.random.default_rng(5)
    for n in (0, 1, 511, 512, 513, 5000):
        for scale in (1e-9, 1.0, 50.0, 1e6):
            z = rng.normal(size=n) * scale
            assert abs(S.softplus_sum(z) - np.logaddexp(0, z).sum()) <= 1e-12 * max(1.0, np.logaddexp(0, z).sum())


def test_blocks_go_to_python_one_at_a_time(spark, monkeypatch):
    """A task with several blocks gets them in batches by bytes (F12, F23)."""
    monkeypatch.setattr(S, "ROW_BYTES", 1000)
    df = spark.range(0, 50, 1, 1).selectExpr("id", "cast(repeat('x', 900) as binary) AS b")

    def most(frames):
        for f in frames:
            yield f[["id"]].iloc[:1].assign(id=len(f))

    with S.batches_by_bytes(spark):
        assert max(r["id"] for r in df.mapInPandas(most, "id long").collect()) <= 2
    assert S.DRIVER_VALUES * 8 * 41 < 1_000_000_000  # gradients of 40 iterations (F18, F20)


def test_partials_of_a_task_are_summed_before_they_are_sent():
    import numpy as np
    import pandas as pd

    from corvid.operators import sparse_blocks as S

    def packed(pid, feats):
        n = len(feats)
        return S._pack(pd.DataFrame({"row_id": range(n), "pid": pid, "y": 1, "is_test": False}),
                       pd.DataFrame({"row_id": range(n), "fid": feats, "value": 1.0}))

    frames = [packed(0, [0, 5, 40_000]), packed(1, [5, 6, 40_000]), packed(2, [6])]
    sent = pd.concat(list(S._gradient_rows(iter(frames), 1, [0], lambda block, r: np.zeros((1, len(block.feats))))))
    got = {c: (np.frombuffer(i, np.uint16).tolist(), np.frombuffer(g).tolist()) for c, i, g in zip(sent["chunk"], sent["ids"], sent["g"]) if c >= 0}
    assert (sent["chunk"] >= 0).sum() == 2, "one row a chunk, not one a block"
    assert got == {0: ([0, 5, 6], [-0.5, -1.0, -1.0]), 1: ([40_000 - S.CHUNK], [-1.0])}


def test_cells_of_several_blocks_train_the_same(spark):
    from corvid.operators import sparse_blocks as S

    rows = [(i, 1 if i % 3 else -1, i % 7 == 0) for i in range(60)]
    pts = spark.createDataFrame(rows, "row_id long, y int, is_test boolean")
    xl = spark.createDataFrame([(i, f"f{(i * k) % 17}", float(k)) for i in range(60) for k in (1, 2, 5) if i % 10], "row_id long, feature string, value double")
    found = []
    for n, on_driver in ((1, True), (40, True), (40, False)):
        x = S.PackedRows(pts, xl, n_blocks=n)
        assert x.n_cells == {1: 1, 40: 10}[n]
        vectors, _ = S.train_models(x, [0.1, 1.0], max_iter=3, eps=0.0, on_driver=on_driver)
        found.append({r["feature"]: r["values"] for r in vectors.coefficients().collect()})
        vectors.release()
        x.release()
    for f in found[1:]:
        assert f.keys() == found[0].keys()
        assert all(abs(p - q) < 1e-9 for k in f for p, q in zip(f[k], found[0][k]))


def test_a_sweep_that_a_task_can_hold_caches_no_blocks(spark, monkeypatch):
    """Each λ is trained by one task, with the history that the blocks' scans give; no job
    per iteration (F2)."""
    x, y, test, pts, xl = small_points(spark)
    lams, made = [1e-5, 0.1, 1.0, 30.0, 1e5], []
    monkeypatch.setattr(S.DriverVectors, "gradient", lambda *a, f=S.DriverVectors.gradient: (made.append(1), f(*a))[1])
    a = L.train_sweep(pts, xl, lams, max_iter=12, online_test=True, betas=False)
    assert not made
    b = L.train_sweep(pts, xl, lams, max_iter=12, online_test=True, betas=False, broadcast=True)
    assert made
    for lam, f, g in zip(lams, a, b, strict=True):
        assert f.iterations == g.iterations == len(f.history) and f.grad_norm == pytest.approx(g.grad_norm, rel=1e-9)
        for p, q in zip(f.history, g.history, strict=True):
            assert {k: v for k, v in p.items() if k != "t"} == pytest.approx({k: v for k, v in q.items() if k != "t"}, rel=1e-9)
        hist, _ = plain_training(x, y, test, lam, 12, 0.1)
        assert [h["rejected"] for h in f.history] == [h[3] for h in hist]


def test_a_block_takes_few_bytes_an_entry():
    """Counts of words are told as numbers of few values, rows as their entries (F4)."""
    import pandas as pd

    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"row_id": rng.permutation(400), "pid": 0, "y": 1, "is_test": False})
    x = np.where(rng.random((400, 300)) < 0.3, rng.integers(1, 9, (400, 300)), 0).astype(float)
    x[7] = 0.0  # a row without entries
    i, j = x.nonzero()
    deal = rng.permutation(len(i))
    packed = S._pack(rows, pd.DataFrame({"row_id": i[deal], "fid": 10 * j[deal], "value": x[i, j][deal]}))
    r = next(packed.itertuples())
    assert sum(len(getattr(r, c)) for c in ("row", "col", "code", "value")) < 5 * len(i), "16 bytes an entry before"
    block, b, c = S.Block(r), rng.normal(size=300), rng.normal(size=400)
    dense = x[rows["row_id"]]
    assert block.feats.tolist() == [10 * k for k in range(300)]
    assert np.allclose(block.times(b), dense @ b) and np.allclose(block.transposed(c), dense.T @ c)
