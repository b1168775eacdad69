"""Least squares on many columns: XᵀX as tiles, never on one machine.

A tile (bi, bj), bi ≤ bj, holds the products of two blocks of ``TILE`` columns. A
task makes the tiles of its rows with numpy: it adds them up while all tiles fit in
``HELD_BYTES``, and sends them off per ``ROW_BYTES`` of rows beyond; partial tiles
are summed in a stream, sorted by tile. The solver keeps vectors of d numbers on the
driver and multiplies tiles by a vector in Spark, once per iteration: the gradient
follows from A·β, which moves along with the step.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.iterate import Steps
from corvid.operators.regression import FitResult, fw_gamma, solve_lin

TILE = 512
HELD_BYTES = 64 << 20
ROW_BYTES = 32 << 20

TILES = "bi int, bj int, t binary"


def _blocks(d: int, tile: int) -> list[slice]:
    return [slice(s, min(s + tile, d)) for s in range(0, d, tile)]


def _tile_rows(frames, d: int, tile: int, held_bytes: int, row_bytes: int):
    cols = _blocks(d, tile)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    hold = sum((cols[i].stop - cols[i].start) * (cols[j].stop - cols[j].start) for i, j in pairs) * 8 <= held_bytes
    held, sums = {}, np.zeros(d + 2)  # Xᵀy, n, Σy²
    rows, size = [], 0

    def products():
        X = np.vstack([x for x, _ in rows])
        y = np.concatenate([y for _, y in rows])
        sums[:d] += X.T @ y
        sums[d:] += len(y), float(y @ y)
        for i, j in pairs:
            t = X[:, cols[i]].T @ X[:, cols[j]]
            if hold:
                held[i, j] = held[i, j] + t if (i, j) in held else t
            else:
                yield pd.DataFrame([(i, j, t.tobytes())], columns=["bi", "bj", "t"])

    for f in frames:
        if len(f):
            for s in range(0, len(f), max(1, row_bytes // (8 * d))):
                part = f.iloc[s:s + max(1, row_bytes // (8 * d))]
                rows.append((np.vstack(part["x"].to_numpy()), part["y"].to_numpy(dtype=float)))
                size += len(part) * d * 8
                if size >= row_bytes:
                    yield from products()
                    rows, size = [], 0
    if rows:
        yield from products()
    for (i, j), t in held.items():
        yield pd.DataFrame([(i, j, t.tobytes())], columns=["bi", "bj", "t"])
    yield pd.DataFrame([(-1, -1, sums.tobytes())], columns=["bi", "bj", "t"])


def _summed(frames):
    """Adds up what has one (bi, bj), as it comes sorted by it."""
    now, total = None, None
    for f in frames:
        for bi, bj, t in zip(f["bi"], f["bj"], f["t"]):
            if now is not None and now != (bi, bj):
                yield pd.DataFrame([(*now, total.tobytes())], columns=["bi", "bj", "t"])
                total = None
            now, part = (bi, bj), np.frombuffer(t)
            total = part.copy() if total is None else total + part
    if now is not None:
        yield pd.DataFrame([(*now, total.tobytes())], columns=["bi", "bj", "t"])


def _sum(rows: DataFrame) -> DataFrame:
    return rows.repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInPandas(_summed, TILES)


class TiledGram:
    """Means over the data: A = XᵀX/n in tiles, b = Xᵀy/n and c = yᵀy/n."""

    def __init__(self, points: DataFrame, d: int, x_col: str = "x", y_col: str = "y", tile: int = TILE,
                 held_bytes: int = HELD_BYTES, row_bytes: int = ROW_BYTES):
        self.spark, self.d, self.tile = points.sparkSession, d, tile
        self.tables = Steps(self.spark, "tiles")
        pts = points.select(F.col(x_col).alias("x"), F.col(y_col).cast("double").alias("y"))
        made = self.tables.write(_sum(pts.mapInPandas(lambda f: _tile_rows(f, d, tile, held_bytes, row_bytes), TILES)))
        sums = made.where("bi = -1").select("t").first()
        if sums is None or np.frombuffer(sums["t"])[d] == 0:
            raise ValueError("no data")
        sums = np.frombuffer(sums["t"])  # d + 2 numbers
        self.n = int(sums[d])
        self.b, self.c = sums[:d] / self.n, float(sums[d + 1]) / self.n
        self.tiles = made.where("bi >= 0").persist(StorageLevel.MEMORY_AND_DISK)

    def times(self, v: np.ndarray) -> np.ndarray:
        """A·v: tiles meet the vector where they are, blocks of d numbers come back."""
        cols, shared = _blocks(self.d, self.tile), self.spark.sparkContext.broadcast(np.asarray(v, float))

        def multiply(frames):
            out = {}
            for f in frames:
                for i, j, t in zip(f["bi"], f["bj"], f["t"]):
                    t = np.frombuffer(t).reshape(cols[i].stop - cols[i].start, -1)
                    out[i] = out.get(i, 0) + t @ shared.value[cols[j]]
                    if i != j:
                        out[j] = out.get(j, 0) + t.T @ shared.value[cols[i]]
            if out:
                yield pd.DataFrame([(i, 0, x.tobytes()) for i, x in out.items()], columns=["bi", "bj", "t"])

        got = np.zeros(self.d)
        for r in _sum(self.tiles.mapInPandas(multiply, TILES)).collect():  # d numbers
            got[cols[r["bi"]]] = np.frombuffer(r["t"])
        shared.destroy()
        return got / self.n

    def release(self) -> None:
        self.tiles.unpersist()
        self.tables.keep_last(0)


def train_gd(g: TiledGram, beta0=None, lam: float = 0.0, max_iter: int = 100, eps: float = 0.01) -> FitResult:
    """Ridge by gradient descent with exact line search, as on the d x d summary."""
    beta = np.zeros(g.d) if beta0 is None else np.asarray(beta0, float).copy()
    at = g.times(beta) if beta.any() else np.zeros(g.d)
    k, norm, hist = 0, float("inf"), []
    while k < max_iter and norm > eps:
        grad = 2 * at - 2 * g.b + 2 * lam * beta
        obj = float(g.c - 2 * g.b @ beta + beta @ at + lam * beta @ beta)
        along = g.times(grad)
        a = float(grad @ along + lam * grad @ grad)
        b = float(-2 * lam * beta @ grad + 2 * (g.b @ grad - at @ grad))
        norm = float(np.linalg.norm(grad))
        if a == 0:
            hist.append((k, obj, norm, 0.0))
            break
        gamma = -b / (2 * a)
        hist.append((k, obj, norm, gamma))
        beta, at, k = beta - gamma * grad, at - gamma * along, k + 1
    return FitResult(beta, norm, k, hist)


def train_fw(g: TiledGram, beta0=None, K: float = 100.0, max_iter: int = 100, eps: float = 0.01) -> FitResult:
    """Frank-Wolfe on ‖β‖₁ ≤ K with exact line search."""
    beta = np.zeros(g.d) if beta0 is None else np.asarray(beta0, float).copy()
    at = g.times(beta) if beta.any() else np.zeros(g.d)
    k, gap, hist = 0, float("inf"), []
    while k < max_iter and gap > eps:
        grad = 2 * at - 2 * g.b
        s = solve_lin(grad, K)
        gap = float((beta - s) @ grad)
        to = s - beta
        along = g.times(s) - at
        a, b = float(to @ along), float(-2 * (g.b @ to - at @ to))
        obj, gamma = float(g.c - 2 * g.b @ beta + beta @ at), fw_gamma(a, b)
        beta, at = (1 - gamma) * beta + gamma * s, at + gamma * along
        hist.append((k, obj, gap, gamma, float(np.abs(beta).sum() / K)))
        k += 1
    return FitResult(beta, gap, k, hist)
