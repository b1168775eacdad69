"""Matrix factorisation: folds from files against numpy, seeded init properties,
objective decrease, fold-keyed training equals per-fold runs, missing test rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from corvid.operators import factorization as M
from corvid.operators import rating_blocks as B
from corvid.plans import inputs
from corvid.sources.ratings import read_folds, write_folds


def test_fold_rmse_of_files(spark, tmp_path):
    """Fold files written and read back; RMSE of the formula profiles in numpy."""
    write_folds(inputs.ratings(spark, SF_SMALL), str(tmp_path / "folds"))
    R = read_folds(spark, str(tmp_path / "folds"))
    pdf = R.toPandas()
    vec = lambda ids: np.array([[((int(i) * 7919 + k * 104729) % 1000) / 1000.0 - 0.5 for k in range(2)] for i in ids])
    want = {}
    for k in range(5):
        te, tr = pdf[pdf["fold"] == k], pdf[pdf["fold"] != k]
        hit = te["i"].isin(tr["i"]) & te["j"].isin(tr["j"])
        err = (vec(te["i"]) * vec(te["j"])).sum(1) - te["r"].to_numpy()
        want[k] = np.sqrt((err[hit.to_numpy()] ** 2).sum() / len(te))
    df = M.cross_validate(R, 5, d=2, maxiter=1, init="formula")
    got = df.collect()
    assert {r["k"] for r in got} == set(want) and all(abs(r["test_rmse"] - want[r["k"]]) < 1e-9 for r in got)
    assert all(abs(r["cv_rmse"] - np.mean(list(want.values()))) < 1e-9 for r in got)


def test_training_without_test_ratings(spark):
    """An empty test table trains all the same, with no RMSE; a fold without test
    rows stays in the CV."""
    R = inputs.ratings(spark, SF_SMALL)
    a = M.train(R, R.limit(0), d=2, lam=0.05, mu=0.05, maxiter=2)
    b = M.train(R, None, d=2, lam=0.05, mu=0.05, maxiter=2)
    assert [h["objective"] for h in a.history] == [h["objective"] for h in b.history]
    assert all(h["test_rmse"] is None for h in a.history) and len(a.history) == 2
    df = M.cross_validate(R.where("fold <> 3"), 5, d=2, maxiter=1)
    rows = {r["k"]: r["test_rmse"] for r in df.collect()}
    assert set(rows) == set(range(5)) and rows[3] is None and rows[2] is not None


def test_any_number_of_blocks_trains_the_same(spark, monkeypatch):
    R = inputs.ratings(spark, SF_SMALL)
    a = M.train(R, None, d=2, lam=0.05, mu=0.05, maxiter=2, blocks=(1, 1))
    monkeypatch.setattr(B, "CELL_RATINGS", 20)  # cells are cut into parts
    b = M.train(R, None, d=2, lam=0.05, mu=0.05, maxiter=2, blocks=(4, 3))
    assert abs(a.history[-1]["objective"] - b.history[-1]["objective"]) < 1e-8
    u, v = ({r[0]: r[1] for r in x.U.collect()} for x in (a, b))
    assert u.keys() == v.keys() and np.allclose([u[i] for i in u], [v[i] for i in u], atol=1e-12)


def test_ratings_never_move_after_the_deal(spark):
    """The cells are joined where they are cached: only what is sent to them is exchanged."""
    grid = B.RatingGrid(inputs.ratings(spark, SF_SMALL), [B.Model(0)], 2, M._start(1, 2, "normal"), (3, 2))
    plan = grid.partials([0], True)._jdf.queryExecution().executedPlan().toString()
    cells = plan[plan.index("FlatMapCoGroupsInPandas"):plan.index("InMemoryTableScan")]
    assert "Exchange" not in cells and "Exchange" in plan[plan.index("InMemoryTableScan"):]
    grid.release()


def test_repeated_ratings_equal_separate_ones(spark):
    """Ratings of one (i, j) are one entry with number, mean and spread."""
    rows = [(1, 1, 0.5), (1, 1, 1.5), (1, 1, 1.5), (2, 1, -1.0), (1, 2, 0.25), (2, 2, 2.0), (2, 2, 3.0), (None, 2, 1.0), (2, None, 1.0)]
    R = spark.createDataFrame(rows, "i long, j int, r double")
    got = M.train(R, None, d=3, lam=0.1, mu=0.2, maxiter=3, gain=0.1)
    known = [r for r in rows if r[0] and r[1]]
    U, V = ({r[0]: np.array(r[1]) for r in p.collect()} for p in M.init_profiles(spark.createDataFrame(known, "i long, j int, r double"), 3))
    for it, h in enumerate(got.history, 1):
        errors = [(U[i] @ V[j] - r) for i, j, r in known]
        want = sum(e * e for e in errors) + 0.1 * sum(u @ u for u in U.values()) + 0.2 * sum(v @ v for v in V.values())
        assert abs(h["objective"] - want) < 1e-9 and abs(h["test_rmse"] - np.sqrt(np.mean(np.square(errors)))) < 1e-9
        gu, gv = {i: 0.2 * U[i] for i in U}, {j: 0.4 * V[j] for j in V}
        for (i, j, _), e in zip(known, errors):
            gu[i], gv[j] = gu[i] + 2 * e * V[j], gv[j] + 2 * e * U[i]
        g = M.gain_schedule(0.1, M.POWER, it)
        U, V = {i: U[i] - g * gu[i] for i in U}, {j: V[j] - g * gv[j] for j in V}
    assert got.V.dtypes[0] == ("j", "int") and all(np.allclose(r["u"], U[r["i"]]) for r in got.U.collect())


def test_training_goes_on_from_its_journal(spark, tmp_path):
    tr, te = M.fold_split(inputs.ratings(spark, SF_SMALL), 0)
    kw = {"d": 2, "lam": 0.05, "mu": 0.05, "blocks": (2, 2)}
    path = str(tmp_path / "journal")
    whole = M.train(tr, te, maxiter=4, **kw)
    assert len(M.train(tr, te, maxiter=2, journal=path, **kw).history) == 2
    again = M.train(tr, te, maxiter=4, journal=path, **kw)
    drop = lambda h: [{k: v for k, v in x.items() if k != "time"} for x in h]
    assert len(again.history) == 4
    for x, y in zip(drop(whole.history), drop(again.history)):
        assert x == pytest.approx(y, rel=1e-12)
    a, b = ({r["i"]: r["u"] for r in x.U.collect()} for x in (whole, again))
    assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-14) for i in a)


def test_a_stopped_model_keeps_its_profiles(spark):
    R = inputs.ratings(spark, SF_SMALL)
    a = M.train(R, None, d=2, maxiter=5, epsilon=1e98)
    b = M.train(R, None, d=2, maxiter=1, last_update=False)
    assert len(a.history) == 2 and a.history[0]["objective"] == b.history[0]["objective"]


def test_init_is_a_function_of_the_id(spark):
    R = inputs.ratings(spark, SF_SMALL)
    U1, _ = M.init_profiles(R, 4)
    U2, _ = M.init_profiles(R.repartition(7), 4)
    a = {r["i"]: r["u"] for r in U1.collect()}
    b = {r["i"]: r["u"] for r in U2.collect()}
    assert a == b
    z = np.array(list(a.values())).ravel()
    assert abs(z.mean()) < 0.15 and abs(z.var() - 1) < 0.2


def test_training_decreases_objective(spark):
    R = inputs.ratings(spark, SF_SMALL)
    tr, te = M.fold_split(R, 0)
    res = M.train(tr, te, d=3, lam=0.05, mu=0.05, maxiter=4)
    objs = [h["objective"] for h in res.history]
    assert all(b < a for a, b in zip(objs, objs[1:]))


def test_fold_keyed_equals_single_fold(spark):
    R = inputs.ratings(spark, SF_SMALL)
    df = M.cross_validate(R, 5, d=3, lam=0.05, mu=0.05, maxiter=2)
    keyed = {r["k"]: r["test_rmse"] for r in df.collect()}
    tr, te = M.fold_split(R, 2)
    single = M.train(tr, te, d=3, lam=0.05, mu=0.05, maxiter=2).history[-1]["test_rmse"]
    assert abs(keyed[2] - single) < 1e-12


def test_grid_is_the_reference_one_at_the_defaults(spark, monkeypatch):
    """linspace(0, 3000, 20), d = 10, 20 iterations, against numpy; large λ diverge on both sides."""
    from corvid.plans import q_factor as Q

    rng = np.random.default_rng(3)
    rows = [(i, j, float(rng.normal()), (i * 31 + j) % 5) for i in range(8) for j in range(6) if rng.random() < 0.7]
    R = spark.createDataFrame(rows, "i long, j long, r double, fold int")
    U, V = ({r[0]: np.array(r[1]) for r in p.collect()} for p in M.init_profiles(R, M.D))
    monkeypatch.setattr(Q, "_ratings", lambda spark, sf: R)
    got = {r["reg"]: r["cv_rmse"] for r in Q.q_mf_reg_grid(spark, "").collect()}
    assert sorted(got) == [float(x) for x in np.linspace(0, 3000, 20)]
    with np.errstate(all="ignore"):
        for reg, value in got.items():
            per = []
            for fold in range(5):
                tr, te = [r for r in rows if r[3] != fold], [r for r in rows if r[3] == fold]
                u, v = {r[0]: U[r[0]] for r in tr}, {r[1]: V[r[1]] for r in tr}
                for it in range(1, M.MAXITER + 1):
                    err = [(u[i] @ v[j] - r) ** 2 for i, j, r, _ in te if i in u and j in v]
                    g = M.gain_schedule(M.GAIN, M.POWER, it)
                    gu, gv = {i: 2 * reg * u[i] for i in u}, {j: 2 * reg * v[j] for j in v}
                    for i, j, r, _ in tr:
                        delta = u[i] @ v[j] - r
                        gu[i], gv[j] = gu[i] + 2 * delta * v[j], gv[j] + 2 * delta * u[i]
                    u, v = {i: u[i] - g * gu[i] for i in u}, {j: v[j] - g * gv[j] for j in v}
                per.append((sum(err) / len(te)) ** 0.5)
            want = np.mean(per)
            assert np.isfinite(want) == (value is not None) and (value is None or abs(value - want) <= 1e-6 * max(1, want)), (reg, value, want)


def test_users_move_once_and_items_once_per_cell(spark):
    """What is sent per iteration: every user profile once, an item's at most once per cell,
    whatever the number of models (F1, F2, F4, F5)."""
    rows = [(i, j, (i * 7 + j * 3) % 5 - 2.0, (i + j) % 3) for i in range(300) for j in range(40) if (i * j) % 7 < 3]
    R = spark.createDataFrame(rows, "i long, j long, r double, fold int")
    for models in ([B.Model(0)], [B.Model(k % 3, float(k)) for k in range(60)]):
        grid = B.RatingGrid(R, models, 4, M._start(1, 4, "normal"))
        need = grid.route.select("side", (F.length("need") / 8).alias("n")).groupBy("side").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
        need = {r["side"]: r["n"] for r in need}
        assert grid.own and need[0] == len({r[0] for r in rows}) and need[1] <= len({r[1] for r in rows}) * grid.n_cells
        assert grid.n_cells <= spark.sparkContext.defaultParallelism  # follows ratings and bytes, not models
        grid.release()


def test_own_users_train_as_those_that_are_summed(spark, monkeypatch):
    """Cells that step their users, cells cut by items and cells in parts agree, also
    where one of the models stops before the others."""
    R = inputs.ratings(spark, SF_SMALL)
    models = [B.Model(0, 0.05, 0.05), B.Model(1, 400.0, 400.0), B.Model(None, 0.0, 0.0)]

    def run(blocks, epsilon):
        grid = B.RatingGrid(R, models, 2, M._start(1, 2, "normal"), blocks)
        runs = B.train_models(grid, lambda i: 0.001 / i, epsilon, 4)
        out = [{(r["model"], r["id"]): r["p"] for r in grid.factors(s).collect()} for s in (0, 1)]
        grid.release()
        return grid.own, [[h["objective"] for h in r.history] for r in runs], out

    first = run(None, 1e-99)[1]
    change = sorted(abs(h[1] - h[0]) for h in first)
    epsilon = (change[0] + change[1]) / 2  # one model stops at its second iteration
    own, a, p = run(None, epsilon)
    cut, b, q = run((3, 2), epsilon)
    assert own and not cut and len({len(h) for h in a}) > 1
    for x, y in zip(a, b):
        assert x == pytest.approx(y, rel=1e-9)
    for x, y in zip(p, q):
        assert x.keys() == y.keys() and all(np.allclose(x[k], y[k], atol=1e-9) for k in x)


def _small_ratings(spark):
    rows = [(i, j, ((i * 7 + j * 3) % 11 - 5) / 4, (i * 31 + j) % 5) for i in range(90) for j in range(25) if (i * j + i) % 7 < 3]
    return spark.createDataFrame(rows + rows[:9], "i long, j long, r double, fold int")


def _same_records(a, b):
    for x, y in zip(a, b, strict=True):
        for g, h in zip(x.history, y.history, strict=True):
            for c in set(g) - {"time"}:
                same = g[c] == h[c] or (g[c] is not None and h[c] is not None and (
                    g[c] == pytest.approx(h[c], rel=1e-9) or not (np.isfinite(g[c]) or np.isfinite(h[c]))))
                assert same, (c, g, h)


def test_a_grid_that_a_task_can_hold_moves_no_profiles(spark, monkeypatch):
    """Each model is trained by one task: no profiles are written in any iteration, and
    every record of every model is that of the cells' run, also of models that diverge (F1)."""
    R, written, write = _small_ratings(spark), [], B.Steps.write
    monkeypatch.setattr(B.Steps, "write", lambda self, df: (written.append(self.name), write(self, df))[1])
    models = [B.Model(k, x, x) for x in (0.0, 600.0, 3000.0) for k in (0, 3)] + [B.Model(None, 0.1, 0.2)]
    start, step = M._start(1, 3, "normal"), lambda i: M.gain_schedule(M.GAIN, M.POWER, i)
    held = B.RatingGrid(R, models, 3, start, keep=False)
    a = B.train_held(held, step, 1e-99, 14)
    assert held.own and 0 < held.held_bytes() < 200_000 and "factors" not in written
    held.release()
    cells = B.RatingGrid(R, models, 3, start)
    b = B.train_models(cells, step, 1e-99, 14, last_update=False)
    cells.release()
    assert "factors" in written and not np.isfinite(b[5].history[-1]["objective"]) and len(a[5].history) == 14
    _same_records(a, b)
    written.clear()
    got = {r["reg"]: r["cv_rmse"] for r in M.reg_grid(R, 5, [0.0, 500.0], d=3, maxiter=4).collect()}
    assert "factors" not in written
    want = M._trained(R, [B.Model(k, x, x) for x in (0.0, 500.0) for k in range(5)], 3, maxiter=4, held_bytes=0)
    assert got == pytest.approx({x: np.mean([h["test_rmse"] for h in want[n * 5:n * 5 + 5]]) for n, x in enumerate((0.0, 500.0))}, rel=1e-9)


def test_held_models_stop_as_the_others_do(spark):
    R, models = _small_ratings(spark), [B.Model(0, 0.05, 0.05), B.Model(1, 400.0, 400.0), B.Model(2)]
    run = lambda f, eps: f(B.RatingGrid(R, models, 2, M._start(1, 2, "normal")), lambda i: 0.001 / i, eps, 5)
    change = sorted(abs(r.history[1]["objective"] - r.history[0]["objective"]) for r in run(B.train_held, 1e-99))
    a, b = (run(f, (change[0] + change[1]) / 2) for f in (B.train_held, B.train_models))
    assert len({len(r.history) for r in a}) > 1
    _same_records(a, b)


def test_groups_of_models_bound_what_a_cell_gets(spark, monkeypatch):
    """Where the items of all models are more than a cell's bytes, groups of models are trained
    one after the other over the same cells, with the same records and profiles (F3)."""
    R, models = _small_ratings(spark), [B.Model(k, 0.5 * k, 0.1) for k in range(5)]
    step, found = lambda i: 0.001 / i, []
    for most in (32 << 20, 1500):
        monkeypatch.setattr(B, "CELL_BYTES", most)
        grid = B.RatingGrid(R, models, 2, M._start(1, 2, "normal"))
        items = grid.first.where("side = 1").selectExpr("sum(length(ids) / 8) AS n").first()["n"]
        assert all(len(g) * items * (2 * 8 + 1) <= most for g in grid.groups) and grid.own
        assert (len(grid.groups) > 1) == (most == 1500) and sorted(sum(grid.groups, [])) == list(range(5))
        runs = B.train_models(grid, step, 1e-99, 3)
        found.append((runs, [{(r["model"], r["id"]): r["p"] for r in grid.factors(s).collect()} for s in (0, 1)]))
        grid.release()
    (a, p), (b, q) = found
    _same_records(a, b)
    for x, y in zip(p, q):
        assert x.keys() == y.keys() and all(np.allclose(x[k], y[k], atol=1e-12) for k in x)


def test_cells_are_packed_as_their_ratings_stream_in():
    """A cell may come in many batches, and a batch may hold many cells (F3)."""
    import pandas as pd

    rng = np.random.default_rng(4)
    n = 700
    f = pd.DataFrame({"cell": np.sort(rng.integers(0, 4, n)), "i": rng.integers(0, 40, n), "j": rng.integers(0, 30, n), "fold": rng.integers(0, 5, n),
                      "r": rng.integers(0, 9, n) / 4, "c": 1.0, "ss": 0.0})
    f["ub"], f["jb"] = f["cell"], f["j"] % 2
    f = f.sort_values(["cell", "i"], ignore_index=True)
    rows = [next(x.itertuples()) for x in B._pack_cells(f.iloc[s:s + 90] for s in range(0, n, 90))]
    assert [r.cell for r in rows] == [0, 1, 2, 3]
    for row in rows:
        cell, want = B.Cell(row), f[f["cell"] == row.cell]
        who = np.repeat(cell.users[cell.order], np.repeat(cell.bands[0], cell.bands[1]))
        r = cell.r if cell.values is None else cell.values[cell.r]
        got = sorted(zip(who.tolist(), cell.items[cell.jv].tolist(), cell.fold.tolist(), r.tolist()))
        assert got == sorted(zip(want["i"], want["j"], want["fold"], want["r"])) and cell.c is None
        assert len(row.jv) + len(row.r) + len(row.fold) == 3 * len(want)
