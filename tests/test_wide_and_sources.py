"""Tiles of wide Gram matrices against numpy; line numbers, metric runs and the
spreading of scans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.operators import regression as G
from corvid.operators import tiled_gram as T
from corvid.sources import sinks
from corvid.sources.dense import read_dense_points
from corvid.sources.sparse import read_sparse_points
from corvid.sources.text import numbered_lines, spread

D = 70


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(2)
    X, y = rng.normal(size=(300, D)), rng.normal(size=300)
    return X, y, spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(X, y)], "x array<double>, y double").repartition(5)


@pytest.mark.parametrize("held", [1 << 30, 0])
def test_tiles_are_the_gram_matrix(spark, wide, held):
    """Tiles added up in the tasks, and sent off per few rows."""
    X, y, df = wide
    g = T.TiledGram(df, D, tile=16, held_bytes=held, row_bytes=8 * D * 7)
    A = X.T @ X / len(X)
    for r in g.tiles.collect():
        rows, cols = slice(r["bi"] * 16, min(r["bi"] * 16 + 16, D)), slice(r["bj"] * 16, min(r["bj"] * 16 + 16, D))
        assert np.allclose(np.frombuffer(r["t"]).reshape(rows.stop - rows.start, -1) / len(X), A[rows, cols])
    assert g.tiles.count() == 15 and g.n == 300 and np.allclose(g.b, X.T @ y / 300) and abs(g.c - y @ y / 300) < 1e-12
    v = np.arange(D) / D
    assert np.allclose(g.times(v), A @ v)
    g.release()


def test_tiled_training_equals_the_summary(spark, wide):
    _, _, df = wide
    whole, g = G.gram_stats(df), T.TiledGram(df, D, tile=32)
    start = np.linspace(-1, 1, D)
    for a, b in ((T.train_gd(g, start, lam=0.3, max_iter=12, eps=0.0), G.train_gd_g(whole, start, 0.3, 12, 0.0)),
                 (T.train_fw(g, K=3.0, max_iter=9, eps=0.0), G.train_fw_g(whole, K=3.0, max_iter=9, eps=0.0))):
        assert np.allclose(a.beta, b.beta, atol=1e-10) and a.iterations == b.iterations
        assert np.allclose(a.history, b.history, atol=1e-9)
    g.release()


def test_tiles_of_no_rows(spark, wide):
    with pytest.raises(ValueError):
        T.TiledGram(wide[2].limit(0), D)


@pytest.fixture
def split_reads(spark):
    """Reads the same files with few and with many splits."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)

    def both(read):
        out = []
        for size in ("128m", "97"):
            spark.conf.set(key, size)
            out.append(read())
        return out

    yield both
    spark.conf.set(key, old)


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split_reads):
    files = {"b.txt": ["b%d" % k * (k % 9) for k in range(120)], "a.txt": ["a%d" % k for k in range(77)] + [""], "empty.txt": []}
    for name, rows in files.items():
        (tmp_path / name).write_text("".join(r + "\n" for r in rows))
    want = list(enumerate(files["a.txt"] + files["b.txt"]))
    assert split_reads(lambda: spark.read.text(str(tmp_path)).select(F.spark_partition_id()).distinct().count())[1] > 8
    for got in split_reads(lambda: numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()):
        assert [(r["line_no"], r["line"]) for r in got] == want


def test_row_ids_survive_another_reading(spark, tmp_path, split_reads):
    (tmp_path / "d").mkdir(), (tmp_path / "s").mkdir()
    (tmp_path / "d" / "x.csv").write_text("".join(f"{k},{k * 2},{k % 3}\n" + "\n" * (k % 4 == 0) for k in range(60)))
    (tmp_path / "s" / "x.txt").write_text("".join("({'f%d': %d.0}, %d)\n" % (k, k, 1 - 2 * (k % 2)) for k in range(60)))
    a, b = split_reads(lambda: {r["row_id"]: (tuple(r["x"]), r["y"]) for r in read_dense_points(spark, str(tmp_path / "d")).collect()})
    assert a == b and len(a) == 60 and a[0] == ((0.0, 0.0), 0.0) and a[2] == ((1.0, 2.0), 1.0)
    a, b = split_reads(lambda: {tuple(r) for r in read_sparse_points(spark, str(tmp_path / "s"))[1].collect()})
    assert a == b == {(k, f"f{k}", float(k)) for k in range(60)}


def test_a_repeated_run_replaces_its_metrics(spark, tmp_path):
    path, schema = str(tmp_path / "metrics"), "max_iter int, acc double"
    assert sinks.read_metrics(spark, path, schema).collect() == []
    row = lambda k, v: spark.createDataFrame([(k, v)], schema)
    sinks.append_metrics(row(1, 0.5), path, "first")
    sinks.append_metrics(row(2, 0.7), path, "second")
    sinks.append_metrics(row(2, 0.8), path, "second")
    (tmp_path / "metrics" / "run=torn").mkdir()
    (tmp_path / "metrics" / "run=torn" / "part-0.csv").write_text("max_iter,acc\n9,9.0\n")
    got = sinks.read_metrics(spark, path, schema).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0.5, "first"), (2, 0.8, "second")]
    with pytest.raises(ValueError):
        sinks.append_metrics(row(1, 0.5), path, "")


def test_few_splits_are_spread(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "cast(id as string) AS text")
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    df.repartition(9).write.parquet(str(tmp_path / "many"))
    one, many = (spark.read.parquet(str(tmp_path / n)).select("text") for n in ("one", "many"))
    parts = lambda x: x.select(F.spark_partition_id()).distinct().count()
    assert parts(one) == 1 and parts(spread(one)) > 1 and spread(many) is many
    assert sorted(r[0] for r in spread(one).collect()) == sorted(str(k) for k in range(1000))


def test_scratch_tables_have_an_owner(spark):
    from corvid.iterate import Steps, release
    from corvid.session import scratch_folders

    since, there = len(scratch_folders(spark)), lambda: [f for f in scratch_folders(spark)[since:]]
    a, b = (Steps(spark, n).write(spark.range(5)) for n in ("one", "two"))
    out = a.join(spark.range(3), "id")
    release(spark, keep=out, since=since)
    assert len(there()) == 1 and "one-" in there()[0] and out.count() == 3
    release(spark, since=since)
    assert there() == []
    with pytest.raises(Exception):
        b.count()
