"""Sparse rows in packed blocks, and many logistic models trained in one pass.

Features get dense integer ids (``dictionary``); rows are dealt into as many blocks
as their entries need, and each block is one row of numpy arrays: its labels, its entries as
(entries of a row, local feature, number of the value) and the ids of the features it uses. One scan of the
blocks serves any number of models (``lam`` of a sweep): margins, slopes and
gradient partials are vectorised products per block, and what is per feature or
per row has a leading model axis. Finished models are masked.

An iteration is two scans: gradient (Xb, row weights, X'c), then the losses of all
line-search candidates of all models (Xb and X∇). Nothing per row is kept between
scans, so a lost executor costs its blocks' share of one scan.

Coefficients and gradients are dense vectors over feature ids. While models x
features stay below ``DRIVER_VALUES`` (counted first) they are on the driver and
go out as a broadcast. Beyond, they are a table of chunks, and a routing table says
which ids of a chunk a cell (some blocks) uses: per scan each cell receives just these,
once, and x never moves. Gradient partials of a task's blocks are summed before they are
sent, then chunk by chunk in a stream, so no task holds the partials of all blocks.

Models of a sweep do not meet. Where a task can keep all blocks (``HELD_BYTES``, a mapped file
that goes with the task), it trains its models alone, from the first iteration to the last
(``train_held``): margins are kept there, and an iteration is two products, X'c and X∇, with
no job of its own.
"""

from __future__ import annotations

import math
import mmap
import tempfile
import time
from collections import namedtuple
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.iterate import Journal, Steps, drop_shuffles
from corvid.plans.joins import is_bounded

BLOCK_ENTRIES = 250_000     # about 1.3 MB: features of a block are two bytes, as a rule
BUCKET_FEATURES = 500_000
CELL_BLOCKS = 4             # blocks whose partials are summed, and that are sent coefficients, together
CHUNK = 1 << 15             # feature ids of a chunk, two bytes each
HELD_BYTES = 1 << 30        # of all blocks, up to which a task keeps them, in a file of its own
HELD_VALUES = 4_000_000     # of gradient partials that a task sums up before it sends them: 32 MB
DRIVER_VALUES = 2_000_000   # models x features of vectors on the driver: 16 MB, 650 MB of gradients in 40 iterations
FACTORS = 512               # of a product in softplus_sum
ROW_BYTES = 4 << 20         # of rows that go to Python at once; a block is one row

BLOCK = "pid int, n_rows int, y binary, test binary, row binary, col binary, code binary, value binary, feats binary"


def dictionary(features: DataFrame, n: int, per_bucket: int = BUCKET_FEATURES) -> DataFrame:
    """``(feature, fid)``: ids 0 … n−1 of distinct features, numbered within hash
    buckets on top of the buckets' counts, so no task sorts all features."""
    bucket = F.pmod(F.xxhash64("feature"), F.lit(max(1, math.ceil(n / per_bucket)))).cast("int")
    b = features.select("feature", bucket.alias("b"))
    base = b.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("b").alias("_b"), F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = F.row_number().over(Window.partitionBy("b").orderBy("feature")) - 1
    return b.withColumn("_i", inner).join(F.broadcast(base), F.col("b") == F.col("_b")).select("feature", (F.col("base") + F.col("_i")).alias("fid"))


def _smallest(x: np.ndarray, kinds=(np.uint8, np.uint16, np.int32, np.int64)) -> bytes:
    """Whole numbers from 0 on, in the first of ``kinds`` that holds them."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(k for k in kinds if most <= np.iinfo(k).max)).tobytes()


def _numbers(x: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``_smallest`` made ``x`` of."""
    return np.frombuffer(x, {1: np.uint8, 2: np.uint16, 4: np.int32, 8: np.int64}[len(x) // n if n else 1])


def _pack(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    ids = rows["row_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    feats, col = np.unique(entries["fid"].to_numpy(), return_inverse=True)
    row = order[np.searchsorted(ids[order], entries["row_id"].to_numpy())]
    at = np.argsort(row * max(1, len(feats)) + col, kind="stable")  # by row, and by feature in it
    value = entries["value"].to_numpy(np.float64)[at]
    values, code = np.unique(value, return_inverse=True)  # few values are told once, and entries as their numbers
    coded = len(values) <= min(len(value) // 4, 1 << 16)
    return pd.DataFrame([{"pid": int(rows["pid"].iloc[0]), "n_rows": len(rows), "y": rows["y"].to_numpy(np.int8).tobytes(),
                          "test": rows["is_test"].to_numpy(bool).tobytes(), "row": _smallest(np.bincount(row, minlength=len(rows))), "col": _smallest(col[at]),
                          "code": _smallest(code) if coded else b"", "value": (values if coded else value).tobytes(),
                          "feats": feats.astype(np.int64).tobytes()}])


class Block:
    """One block as numpy arrays; entries are in the order of their rows."""

    def __init__(self, r):
        self.n = r.n_rows
        self.y = np.frombuffer(r.y, np.int8).astype(float)
        self.test = np.frombuffer(r.test, bool)
        self.count, self.feats = _numbers(r.row, self.n).astype(np.int64), np.frombuffer(r.feats, np.int64)
        n = int(self.count.sum())
        self.col, self.values = _numbers(r.col, n), np.frombuffer(r.value)
        self.code = _numbers(r.code, n) if len(r.code) else None
        self.rows = np.flatnonzero(self.count)  # those with entries, and where these begin
        self.start = (np.cumsum(self.count) - self.count)[self.rows]

    @property
    def value(self) -> np.ndarray:
        return self.values if self.code is None else np.take(self.values, self.code)

    def times(self, b: np.ndarray) -> np.ndarray:
        """X b for local coefficients."""
        out = np.zeros(self.n)
        if len(self.rows):
            product = np.take(b, self.col)
            product *= self.value
            out[self.rows] = np.add.reduceat(product, self.start)
        return out

    def transposed(self, c: np.ndarray) -> np.ndarray:
        """X'c over the local features."""
        weights = np.repeat(c, self.count)
        weights *= self.value
        return np.bincount(self.col, weights=weights, minlength=len(self.feats))

    def gradient(self, b: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(gradient partial of the training rows, confusion counts of the test rows)."""
        m = self.times(b)
        return self.transposed(self.weights(m)), self.confusion(m)

    def weights(self, m: np.ndarray) -> np.ndarray:
        """Of the rows in the gradient, for margins m; 0 for test rows."""
        with np.errstate(over="ignore"):
            return np.where(self.test, 0.0, -self.y / (1.0 + np.exp(self.y * m)))

    def confusion(self, m: np.ndarray) -> list[int]:
        """TP, FP, TN, FN of the test rows."""
        t, y = m[self.test], self.y[self.test]
        return [int(((t > 0) & (y == 1)).sum()), int(((t > 0) & (y == -1)).sum()),
                int(((t < 0) & (y == -1)).sum()), int(((t < 0) & (y == 1)).sum())]

    def losses(self, b: np.ndarray, g: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Loss of the training rows at b, and at b − t·g for each step."""
        return self.line(self.times(b), self.times(g), steps)

    def line(self, m: np.ndarray, s: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """The same for margins m and slopes s."""
        on = ~self.test
        y, m, s = self.y[on], m[on], s[on]
        ym, ys = -y * m, y * s
        return np.array([softplus_sum(ym + t * ys) for t in (0.0, *steps)])


def softplus_sum(z: np.ndarray) -> float:
    """Σ log(1 + exp(z)) = Σ max(z, 0) + log Π (1 + exp(−|z|)): factors of 1 to 2, so 512
    of them stay within the doubles and one logarithm serves them all."""
    if not len(z):
        return 0.0
    with np.errstate(under="ignore"):
        e = 1.0 + np.exp(-np.abs(z))
    tail = len(e) % FACTORS
    cut = len(e) - tail
    total = np.maximum(z, 0.0).sum() + np.log(e[:cut].reshape(-1, FACTORS).prod(axis=1)).sum()
    return float(total + np.log(e[cut:].prod()))


def _chunked(feats: np.ndarray, values: np.ndarray):
    """Rows (chunk, ids, values) of a vector over sorted ``feats``: values (n, models)."""
    chunk = feats // CHUNK
    cut = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(feats)]
    for s, e in zip(cut, cut[1:]):
        if e > s:
            yield int(chunk[s]), (feats[s:e] % CHUNK).astype(np.uint16).tobytes(), values[s:e].tobytes()


def _gradient_rows(blocks, models: int, active: list[int], local):
    """Gradient partials by chunk, and one row of counts: those of all blocks, as long as
    they are few values."""
    held, counts = {}, np.zeros((models, 4), dtype=np.int64)

    def partials():
        rows = [(-1, None, counts.tobytes())]
        for chunk, (used, total) in sorted(held.items()):
            ids = np.flatnonzero(used)
            rows.append((chunk, ids.astype(np.uint16).tobytes(), total[ids].tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "ids", "g"])

    for frame in blocks:
        for r in frame.itertuples():
            block = Block(r)
            b = local(block, r)
            grad = np.zeros((len(block.feats), models))
            for k in active:
                grad[:, k], found = block.gradient(b[k])
                counts[k] += found
            for chunk, ids, g in _chunked(block.feats, grad):
                used, total = held.setdefault(chunk, (np.zeros(CHUNK, dtype=bool), np.zeros((CHUNK, models))))
                at = np.frombuffer(ids, np.uint16)
                used[at] = True
                total[at] += np.frombuffer(g).reshape(-1, models)
            if len(held) * CHUNK * models > HELD_VALUES:
                yield partials()
                held, counts = {}, np.zeros((models, 4), dtype=np.int64)
    if held or counts.any():
        yield partials()


def _summed(models: int):
    """Sums the partials of a chunk as they stream in, sorted by chunk."""
    def run(frames):
        now, total = None, None
        for f in frames:
            for chunk, ids, g in zip(f["chunk"], f["ids"], f["g"]):
                if now is not None and chunk != now:
                    yield pd.DataFrame({"chunk": [now], "g": [total.tobytes()]})
                    total = None
                now = chunk
                if chunk < 0:
                    part = np.frombuffer(g, np.int64)
                    total = part.copy() if total is None else total + part
                else:
                    total = np.zeros((CHUNK, models)) if total is None else total
                    total[np.frombuffer(ids, np.uint16)] += np.frombuffer(g).reshape(-1, models)
        if now is not None:
            yield pd.DataFrame({"chunk": [now], "g": [total.tobytes()]})
    return run


def sum_chunks(rows: DataFrame, models: int) -> DataFrame:
    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInPandas(_summed(models), "chunk int, g binary")


def _loss_rows(blocks, steps: dict[int, np.ndarray], local):
    for frame in blocks:
        total = {k: np.zeros(len(t) + 1) for k, t in steps.items()}
        for r in frame.itertuples():
            block = Block(r)
            b, g = local(block, r)
            for k, t in steps.items():
                total[k] += block.losses(b[k], g[k], t)
        yield pd.DataFrame([(k, x.tolist()) for k, x in total.items()], columns=["model", "loss"])


def sum_losses(rows: DataFrame) -> dict[int, np.ndarray]:
    got = (rows.select("model", F.posexplode("loss").alias("at", "v")).groupBy("model", "at").agg(F.sum("v").alias("v"))
           .orderBy("model", "at").collect())
    out: dict[int, list] = {}
    for r in got:
        out.setdefault(r["model"], []).append(r["v"])
    return {k: np.array(v) for k, v in out.items()}


class PackedRows:
    """Rows to train on (and to test), packed; the caller releases it."""

    def __init__(self, points: DataFrame, x_long: DataFrame, features: DataFrame | None = None, n_blocks: int | None = None,
                 block_entries: int = BLOCK_ENTRIES):
        spark = self.spark = points.sparkSession
        if "is_test" not in points.columns:
            points = points.withColumn("is_test", F.lit(False))
        self.tables, read = Steps(spark, "packed"), Steps(spark, "entries")
        rows = points.select("row_id", F.col("y").cast("int").alias("y"), "is_test")
        x = read.write(x_long.select("row_id", "feature", F.col("value").cast("double").alias("value"))
                              .join(rows.select("row_id", "is_test"), "row_id"))
        if features is None:
            features = x.where(~F.col("is_test"))
        features = read.write(features.select("feature").distinct())
        self.n_features = features.count()
        self.names = self.tables.write(dictionary(features, self.n_features))
        n = max(n_blocks or 0, math.ceil(x.count() / block_entries), 1 if n_blocks else spark.sparkContext.defaultParallelism)
        pid = F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int").alias("pid")
        names = F.broadcast(self.names) if is_bounded(self.names) else self.names
        entries = x.join(names, "feature").select("row_id", "fid", "value", pid)
        blocks = (rows.select("*", pid).groupBy("pid").cogroup(entries.groupBy("pid"))
                  .applyInPandas(lambda a, b: _pack(a, b) if len(a) else pd.DataFrame(columns=[c.split()[0] for c in BLOCK.split(", ")]), BLOCK))
        self.n_cells = min(n, max(spark.sparkContext.defaultParallelism, math.ceil(n / CELL_BLOCKS)))
        self.packed, self._blocks = self.tables.write(blocks), None
        read.keep_last(0)

    @property
    def blocks(self) -> DataFrame:
        """The blocks, cached by cell."""
        if self._blocks is None:
            cell = F.pmod(F.col("pid"), F.lit(self.n_cells)).alias("cell")
            self._blocks = self.packed.select("*", cell).repartition(self.n_cells, "cell").persist(StorageLevel.MEMORY_AND_DISK)
            self._blocks.count()
        return self._blocks

    def held_bytes(self) -> int:
        """Of all blocks, as a task would hold them; 0 without rows."""
        return self.packed.agg(F.sum(sum(F.length(c.split()[0]) for c in BLOCK.split(", ") if c.endswith("binary")))).first()[0] or 0

    def release(self) -> None:
        if self._blocks is not None:
            self._blocks.unpersist()
        self.tables.keep_last(0)


class DriverVectors:
    """Coefficients and gradients (models, features) on the driver."""

    def __init__(self, x: PackedRows, start: DataFrame | None, models: int):
        self.x, self.models = x, models
        self.b = np.zeros((models, x.n_features))
        self.g = np.zeros_like(self.b)
        if start is not None:
            got = start.join(x.names, "feature").select("fid", "values").toPandas()  # models x features values
            if len(got):
                self.b[:, got["fid"].to_numpy()] = np.stack(got["values"].to_numpy()).T

    def gradient(self, lams: np.ndarray, active: list[int]) -> np.ndarray:
        """Sets g of the active models; returns the test counts (models, 4)."""
        shared, models = self.x.spark.sparkContext.broadcast(self.b), self.models
        rows = self.x.blocks.mapInPandas(
            lambda f: _gradient_rows(f, models, active, lambda block, r: shared.value[:, block.feats]), "chunk int, ids binary, g binary")
        counts = np.zeros((models, 4), dtype=np.int64)
        grad = np.zeros((self.x.n_features, models))
        for r in sum_chunks(rows, models).collect():  # models x features values
            if r["chunk"] < 0:
                counts += np.frombuffer(r["g"], np.int64).reshape(models, 4)
            else:
                at = r["chunk"] * CHUNK
                grad[at:at + CHUNK] += np.frombuffer(r["g"]).reshape(-1, models)[:len(grad) - at]
        shared.destroy()
        for k in active:
            self.g[k] = grad[:, k] + 2.0 * lams[k] * self.b[k]
        return counts

    def products(self) -> np.ndarray:
        """(models, 3): b·b, b·g, g·g."""
        return np.stack([(self.b * self.b).sum(1), (self.b * self.g).sum(1), (self.g * self.g).sum(1)], axis=1)

    def losses(self, steps: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        shared = self.x.spark.sparkContext.broadcast((self.b, self.g))
        rows = self.x.blocks.mapInPandas(
            lambda f: _loss_rows(f, steps, lambda block, r: (shared.value[0][:, block.feats], shared.value[1][:, block.feats])),
            "model int, loss array<double>")
        got = sum_losses(rows)
        shared.destroy()
        return got

    def step(self, steps: np.ndarray) -> None:
        self.b = self.b - steps[:, None] * self.g

    def release(self) -> None:
        pass

    def coefficients(self) -> DataFrame:
        """``(feature, values)``: the coefficients of all models."""
        f = pd.DataFrame({"fid": np.arange(self.x.n_features), "values": self.b.T.tolist()})
        return self.x.names.join(self.x.spark.createDataFrame(f, "fid long, values array<double>"), "fid").select("feature", "values")


class ChunkVectors:
    """The same as a table of chunks; cells get the ids that their blocks use."""

    def __init__(self, x: PackedRows, start: DataFrame | None, models: int):
        self.x, self.models = x, models
        self.tables, self.kept = Steps(x.spark, "chunks"), Steps(x.spark, "routes")
        route = x.blocks.select("cell", "feats").groupBy("cell").applyInPandas(_routes, "cell int, chunk int, ids binary")
        self.route = self.kept.write(route)
        zero = F.array_repeat(F.lit(0.0), models)
        ids = x.names.select("fid", zero.alias("values")) if start is None else x.names.join(start, "feature", "left").select(
            "fid", F.coalesce("values", zero).alias("values"))

        def fill(frames):
            yield from _filled(frames, models)

        rows = ids.select((F.col("fid") / CHUNK).cast("int").alias("chunk"), (F.col("fid") % CHUNK).cast("int").alias("id"), "values")
        self.vec = self.tables.write(rows.repartition("chunk").sortWithinPartitions("chunk").mapInPandas(fill, "chunk int, b binary, g binary"))
        self.pending = np.zeros(models)

    def _sent(self, with_g: bool) -> DataFrame:
        """Per cell and chunk the values of the ids that its blocks use."""
        models, t = self.models, self.pending

        def cut(frames):
            for f in frames:
                out = []
                for cell, chunk, ids, b, g in zip(f["cell"], f["chunk"], f["ids"], f["b"], f["g"]):
                    at = np.frombuffer(ids, np.uint16)
                    b, g = np.frombuffer(b).reshape(-1, models)[at], np.frombuffer(g).reshape(-1, models)[at]
                    out.append((cell, chunk, (b - t * g).tobytes(), g.tobytes() if with_g else b""))
                yield pd.DataFrame(out, columns=["cell", "chunk", "b", "g"])

        return self.route.join(self.vec.hint("merge"), "chunk").select("cell", "chunk", "ids", "b", "g").mapInPandas(
            cut, "cell int, chunk int, b binary, g binary")

    def _scan(self, sent: DataFrame, rows, schema: str) -> DataFrame:
        """``rows([block frame], local)`` over the cells' blocks, each with what it was sent."""
        models = self.models

        def run(blocks: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
            parts, feats = parts.sort_values("chunk"), _feats(blocks)
            sent = [np.concatenate([np.frombuffer(x).reshape(-1, models) for x in parts[c]]).T if len(parts) and len(parts[c].iloc[0]) else np.zeros((models, 0))
                    for c in ("b", "g")]

            def local(block, r):
                at = np.searchsorted(feats, block.feats)
                return [v[:, at] if v.shape[1] else v for v in sent]

            got = list(rows([blocks], local))
            return pd.concat(got, ignore_index=True) if got else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

        blocks = self.x.blocks.groupBy("cell")
        return blocks.cogroup(sent.repartition(self.x.n_cells, "cell").groupBy("cell")).applyInPandas(run, schema)

    def gradient(self, lams: np.ndarray, active: list[int]) -> np.ndarray:
        models, t, lam = self.models, self.pending, lams
        rows = self._scan(self._sent(False), lambda f, local: _gradient_rows(f, models, active, lambda block, r: local(block, r)[0]), "chunk int, ids binary, g binary")
        found = self.tables.write(sum_chunks(rows, models))
        on = np.zeros(models, dtype=bool)
        on[active] = True

        def merge(frames):
            for f in frames:
                out = []
                for chunk, b, g, new in zip(f["chunk"], f["b"], f["g"], f["new"]):
                    b, g = np.frombuffer(b).reshape(-1, models), np.frombuffer(g).reshape(-1, models)
                    b = b - t * g
                    new = (np.frombuffer(new).reshape(-1, models)[:len(b)] if new is not None else 0.0) + 2.0 * lam * b
                    out.append((chunk, b.tobytes(), np.where(on, new, g).tobytes()))
                yield pd.DataFrame(out, columns=["chunk", "b", "g"])

        both = self.vec.join(found.select("chunk", F.col("g").alias("new")), "chunk", "left").select("chunk", "b", "g", "new")
        self.vec, self.pending = self.tables.write(both.mapInPandas(merge, "chunk int, b binary, g binary")), np.zeros(models)
        counts = np.zeros((models, 4), dtype=np.int64)
        for r in found.where("chunk < 0").select("g").collect():  # one row
            counts += np.frombuffer(r["g"], np.int64).reshape(models, 4)
        return counts

    def products(self) -> np.ndarray:
        models = self.models

        def run(frames):
            for f in frames:
                for b, g in zip(f["b"], f["g"]):
                    b, g = np.frombuffer(b).reshape(-1, models), np.frombuffer(g).reshape(-1, models)
                    yield pd.DataFrame({"model": range(models), "loss": [x.tolist() for x in np.stack([(b * b).sum(0), (b * g).sum(0), (g * g).sum(0)], 1)]})

        got = sum_losses(self.vec.select("b", "g").mapInPandas(run, "model int, loss array<double>"))
        return np.stack([got.get(k, np.zeros(3)) for k in range(models)])

    def losses(self, steps: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        return sum_losses(self._scan(self._sent(True), lambda f, local: _loss_rows(f, steps, local), "model int, loss array<double>"))

    def step(self, steps: np.ndarray) -> None:
        self.pending = steps
        self.tables.keep_last(1)  # the vectors

    def release(self) -> None:
        self.tables.keep_last(0)
        self.kept.keep_last(0)

    def coefficients(self) -> DataFrame:
        """``(feature, values)``: the coefficients of all models."""
        models, t = self.models, self.pending

        def rows(frames):
            for f in frames:
                for chunk, b, g in zip(f["chunk"], f["b"], f["g"]):
                    b, g = np.frombuffer(b).reshape(-1, models), np.frombuffer(g).reshape(-1, models)
                    yield pd.DataFrame({"fid": chunk * CHUNK + np.arange(len(b)), "values": list(b - t * g)})

        return self.x.names.join(self.vec.mapInPandas(rows, "fid long, values array<double>"), "fid").select("feature", "values")


def _feats(blocks: pd.DataFrame) -> np.ndarray:
    """Sorted ids of the features that the blocks use."""
    return np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in blocks["feats"]]))


def _routes(blocks: pd.DataFrame) -> pd.DataFrame:
    ids, cell = _feats(blocks), blocks["cell"].iloc[0]
    return pd.DataFrame([(cell, c, i) for c, i, _ in _chunked(ids, np.zeros((len(ids), 0)))], columns=["cell", "chunk", "ids"])


def _filled(frames, models: int):
    """One row of dense values per chunk, from (chunk, id, values) sorted by chunk."""
    now, held = None, None
    def row():
        return pd.DataFrame({"chunk": [now], "b": [held.tobytes()], "g": [np.zeros_like(held).tobytes()]})

    for f in frames:
        for chunk, part in f.groupby("chunk", sort=True):
            if chunk != now:
                if now is not None:
                    yield row()
                now, held = int(chunk), np.zeros((CHUNK, models))
            held[part["id"].to_numpy()] = np.stack(part["values"].to_numpy())
    if now is not None:
        yield row()


def balanced_keys(spark, n: int) -> list[int]:
    """``n`` integers that a hash partitioning into ``n`` deals one to each."""
    found = (spark.range(0, n * (20 + n.bit_length() * 4)).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p"))
             .agg(F.min("k").alias("k")).collect())  # n rows
    return sorted(r["k"] for r in found) if len(found) == n else list(range(n))


class Spool:
    """Rows with binary columns, kept in a file without a name that is mapped: it takes no
    memory that cannot be given back, and goes with the task."""

    def __init__(self, names: list[str]):
        self.file, self.row, self.rows, self.at = tempfile.TemporaryFile(), namedtuple("Kept", names), [], 0

    def add(self, r) -> None:
        kept = []
        for name in self.row._fields:
            if isinstance(x := getattr(r, name), bytes):
                self.file.write(x + bytes(-len(x) % 8))
                kept.append((self.at, self.at + len(x)))
                self.at += len(x) + -len(x) % 8
            else:
                kept.append(x)
        self.rows.append(kept)

    def read(self) -> list:
        """The rows, their binary columns as views of the file."""
        self.file.flush()
        whole = memoryview(mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)) if self.at else memoryview(b"")
        return [self.row(*(whole[x[0]:x[1]] if isinstance(x, tuple) else x for x in r)) for r in self.rows]


@contextmanager
def batches_by_bytes(spark):
    """Rows of blocks and chunks go to Python by bytes: a task that has several blocks
    holds one at a time, not all of them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(ROW_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


@dataclass
class Trained:
    """What one model's run ended with."""
    lam: float
    grad_norm: float = float("inf")
    iterations: int = 0
    history: list = field(default_factory=list)


def _ratios(counts: list[int]) -> dict:
    tp, fp, tn, fn = counts
    ratio = lambda p, q: p / q if q else None
    return {"acc": ratio(tp + tn, tp + fp + tn + fn), "pre": ratio(tp, tp + fp), "rec": ratio(tp, tp + fn)}


def _steps(t: float, b: float, batch: int) -> tuple[np.ndarray, float]:
    """The next candidates of a line search from t on, and the one after them."""
    ts = []
    for _ in range(batch):  # t ← b·t, the same doubles as one at a time
        if t == 0.0:
            break
        ts.append(t)
        t = b * t
    return np.array(ts), t


def _accepted(loss: np.ndarray, f0: float, ts: np.ndarray, lam: float, bb: float, bg: float, gg: float, a: float) -> tuple[int, float] | None:
    """The first step that decreases enough, and the objective there."""
    ft = loss + lam * (bb - 2 * ts * bg + ts * ts * gg)
    ok = np.flatnonzero(ft <= f0 - a * ts * gg)
    return (int(ok[0]), float(ft[ok[0]])) if len(ok) else None


NO_STEP = "line search found no step"


def train_held(x: PackedRows, lams, max_iter: int, eps: float, online_test: bool, a: float, b: float, batch: int) -> list[Trained]:
    """``train_models`` from zero coefficients, where a task can hold all blocks: models are
    dealt to the tasks, and each is trained by one of them to its end. Only its history
    comes back."""
    lams, spark, n_features = [float(v) for v in lams], x.spark, x.n_features
    n_tasks = max(1, min(len(lams), spark.sparkContext.defaultParallelism))
    keys = balanced_keys(spark, n_tasks) if n_tasks > 1 else [0]
    drop_shuffles(spark)  # those of the packing
    sent = x.packed.select("*", F.explode(F.array(*[F.lit(k) for k in keys])).alias("task")).repartition(n_tasks, "task")

    def run(frames):
        held: dict[int, Spool] = {}
        for f in frames:
            for r in f.itertuples():
                if r.task not in held:
                    held[r.task] = Spool([c.split()[0] for c in BLOCK.split(", ")])
                held[r.task].add(r)
        for task, spool in held.items():
            blocks = [Block(r) for r in spool.read()]
            for k in (k for k in range(len(lams)) if keys[k % n_tasks] == task):
                for h, counts in _held_run(blocks, n_features, lams[k], max_iter, eps, online_test, a, b, batch):
                    yield pd.DataFrame([(k, h.get("k"), h["t"], h.get("objective"), h.get("grad_norm"), h.get("step"), h.get("rejected"), counts)],
                                       columns=["model", "k", "t", "objective", "grad_norm", "step", "rejected", "counts"])

    told = sent.mapInPandas(run, "model int, k int, t double, objective double, grad_norm double, step double, rejected int, counts array<long>").collect()
    runs = [Trained(v) for v in lams]
    for row in sorted(told, key=lambda r: (r["model"], r["t"])):  # a few numbers per model and iteration
        h, r = row.asDict(), runs[row["model"]]
        if h["k"] is None:
            raise RuntimeError(NO_STEP)
        counts = h.pop("counts")
        del h["model"]
        r.history.append({**h, **_ratios(counts)} if online_test else h)
        r.grad_norm, r.iterations = h["grad_norm"], h["k"] + 1
    return runs


def _held_run(blocks: list[Block], n_features: int, lam: float, max_iter: int, eps: float, online_test: bool, a: float, b: float, batch: int):
    """(record, confusion counts) of each iteration of one model over all blocks."""
    began, beta, norm, k = time.time(), np.zeros(n_features), math.inf, 0
    margins = [np.zeros(x.n) for x in blocks]
    while k < max_iter and norm > eps:
        g = 2.0 * lam * beta
        for x, m in zip(blocks, margins):
            g[x.feats] += x.transposed(x.weights(m))
        bb, bg, gg = float(beta @ beta), float(beta @ g), float(g @ g)
        slopes = [x.times(g[x.feats]) for x in blocks]
        t, tried, found, f0 = 1.0, 0, None, None
        while found is None:
            if t == 0.0:
                yield {"t": time.time() - began}, None
                return
            ts, t = _steps(t, b, batch)
            loss = sum(x.line(m, s, ts) for x, m, s in zip(blocks, margins, slopes))
            f0 = loss[0] + lam * bb if f0 is None else f0
            found = _accepted(loss[1:], f0, ts, lam, bb, bg, gg, a)
            tried += len(ts) if found is None else found[0]
        step, norm = float(ts[found[0]]), gg ** 0.5
        for m, s in zip(margins, slopes):
            m -= step * s
        beta -= step * g
        counts = np.sum([x.confusion(m) for x, m in zip(blocks, margins)], axis=0).tolist() if online_test else None
        yield {"k": k, "t": time.time() - began, "objective": found[1], "grad_norm": norm, "step": step, "rejected": tried}, counts
        k += 1


def train_models(x: PackedRows, lams, start: DataFrame | None = None, max_iter: int = 40, eps: float = 0.1, online_test: bool = False,
                 a: float = 0.2, b: float = 0.6, batch: int = 64, on_driver: bool | None = None, journal: str | None = None):
    """Gradient descent with backtracking for every λ of ``lams`` in the same scans:
    ``(vectors, [Trained])``. A model stops at ``max_iter`` or when the norm of its
    gradient is at most ``eps``; others go on. ``on_driver`` overrides the choice
    that the number of values makes. ``start (feature, value)`` are the first
    coefficients of all models. With ``journal`` (a folder) every iteration is
    committed there, and a run that finds one goes on from its last step."""
    lams = np.array([float(v) for v in lams])
    log = Journal(x.spark, journal, {"kind": "logistic", "lams": lams.tolist(), "a": a, "b": b}) if journal else None
    found = log.last() if log else None
    if found:
        start = found[1]["coefficients"]
    elif start is not None:
        start = start.select("feature", F.array_repeat(F.col("value").cast("double"), len(lams)).alias("values"))
    if on_driver is None:
        on_driver = len(lams) * x.n_features <= DRIVER_VALUES
    vectors = (DriverVectors if on_driver else ChunkVectors)(x, start, len(lams))
    runs, began = [Trained(float(v)) for v in lams], time.time()
    fresh: set[int] = set()  # models whose last entry still lacks its test metrics
    if found:
        runs, fresh = [Trained(**r) for r in found[2]["runs"]], set(found[2]["fresh"])

    def tell(counts):
        for k in fresh:
            runs[k].history[-1].update(_ratios(counts[k].tolist()))
        fresh.clear()

    while active := [k for k, r in enumerate(runs) if r.iterations < max_iter and r.grad_norm > eps]:
        drop_shuffles(x.spark)
        counts = vectors.gradient(lams, sorted(fresh | set(active)))
        tell(counts)
        bb, bg, gg = vectors.products().T
        chosen, t, tried = np.zeros(len(lams)), 1.0, 0
        open_ = set(active)
        base: dict[int, float] = {}
        while open_:
            if t == 0.0:
                raise RuntimeError(NO_STEP)
            ts, t = _steps(t, b, batch)
            for k, loss in vectors.losses({k: ts for k in open_}).items():
                f0 = base.setdefault(k, loss[0] + lams[k] * bb[k])
                if best := _accepted(loss[1:], f0, ts, lams[k], bb[k], bg[k], gg[k], a):
                    (i, ft), r = best, runs[k]
                    chosen[k], r.grad_norm = ts[i], float(gg[k]) ** 0.5
                    r.history.append({"k": r.iterations, "t": time.time() - began, "objective": ft, "grad_norm": r.grad_norm,
                                      "step": float(ts[i]), "rejected": tried + i})
                    r.iterations += 1
                    open_.discard(k)
            tried += len(ts)
        vectors.step(chosen)
        if online_test:
            fresh.update(active)
        if log:
            log.commit(max(r.iterations for r in runs), {"coefficients": vectors.coefficients()},
                       {"runs": [vars(r) for r in runs], "fresh": sorted(fresh)})
    if fresh:
        tell(vectors.gradient(lams, sorted(fresh)))
    return vectors, runs
