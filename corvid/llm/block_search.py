"""Nearest neighbours by cosine with a block matrix join.

Vectors are collapsed to distinct ones first (each with the few smallest ids that
carry it), so copies cost nothing. Distinct vectors that a query carries are dealt
into groups of about ``QUERY_GROUP``, all distinct vectors into slabs; a task gets
one group and one slab, sorted so that the group comes first and the slab streams
past it, batch by batch. For every tile (some queries x some rows) of a batch:

1. unit vectors are rounded to int8 codes, u = s * code + rest; the products of the
   codes are whole numbers, so float32 matrix products give them exactly in slices
   of at most ``SLICE`` components;
2. |u.w - s_u s_w (code_u.code_w)| <= |rest_u| |w^| + |rest_w| |u^| + |rest_u| |rest_w|
   (w^ = s * code), so a pair whose upper bound is below the query's kth score, or
   below the kth lower bound of the tile, cannot be among the nearest;
3. surviving pairs are recomputed in double precision on the original vectors and
   merged into a heap per query, whose worst score prunes the next tile.

A task holds one group, one batch and k + 1 entries per query, however many rows a
slab has; it sends back those entries, which a rank merges. Nothing is approximate
but the codes: the result is that of a full search. Every row goes once to every
query group (rows x groups of ``QUERY_GROUP``), which is the price of a search
whose queries grow with the rows; codes are made in the task, so each row is sent
as it is.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part; a null id takes no part; vectors are searched among those
of their own length; rows that repeat an id are candidates each, but none that
carries the query's own id is its candidate; repeated query rows are one query per
distinct vector and id; ties go to the smaller id; an empty table gives no rows;
extra columns do not matter. Components whose squares leave the range of doubles
are scaled by a power of two first, which changes no cosine.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import materialise

K = 5
QUERY_GROUP = 4096
SLAB = 8192        # rows of a slab, more where there would be over MAX_SLABS
MAX_SLABS = 64
TILE_QUERIES, TILE_ROWS = 512, 2048
SLICE = 1024       # 127 * 127 * 1024 < 2^24: such sums are exact in float32
PAIRS = 1 << 16    # surviving pairs recomputed at a time
ROUNDING = 1e-6    # room for rounding in the bounds

FOUND = "asked long, found long, score double, least long"


class Coded:
    """Vectors with their int8 codes: unit = scale * code + rest."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)
        top = np.abs(self.vectors).max(1)
        far = (top > 1e140) | (top < 1e-140)
        if far.any():
            self.vectors[far] = np.ldexp(self.vectors[far], -np.frexp(top[far])[1][:, None])
        self.norm = np.sqrt(in_order(self.vectors, self.vectors))
        unit = self.vectors / self.norm[:, None]
        self.scale = np.abs(unit).max(1) / 127
        self.code = np.rint(unit / self.scale[:, None]).astype(np.int8)
        coded = self.code * self.scale[:, None]
        self.rest = np.sqrt(((unit - coded) ** 2).sum(1))
        self.coded_norm = np.sqrt((coded ** 2).sum(1))


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component: the value depends
    on the two vectors alone, not on their place in a tile."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def cosine(a: Coded, i: np.ndarray, b: Coded, j: np.ndarray) -> np.ndarray:
    return in_order(a.vectors[i], b.vectors[j]) / (a.norm[i] * b.norm[j])


def tile_bounds(a: Coded, rows: slice, b: Coded, cols: slice) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, error) of the cosines of a tile, from the int8 codes."""
    est = np.zeros((rows.stop - rows.start, cols.stop - cols.start))
    for k in range(0, a.code.shape[1], SLICE):
        est += a.code[rows, k:k + SLICE].astype(np.float32) @ b.code[cols, k:k + SLICE].astype(np.float32).T
    est *= a.scale[rows, None] * b.scale[None, cols]
    err = a.rest[rows, None] * (b.coded_norm + b.rest)[None, cols] + a.coded_norm[rows, None] * b.rest[None, cols]
    return est, err + ROUNDING


class Best:
    """The best ``k`` distinct vectors of each query of one group."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, k: int):
        self.keys, self.k, self.coded = keys, k, Coded(vectors)
        self.heaps: list[list] = [[] for _ in keys]  # (score, -least id, key): the worst first
        self.worst = np.full(len(keys), -np.inf)
        self.recomputed = 0

    def add(self, keys: np.ndarray, least: np.ndarray, vectors: np.ndarray) -> None:
        b = Coded(vectors)
        for c in range(0, len(keys), TILE_ROWS):
            cols = slice(c, min(c + TILE_ROWS, len(keys)))
            for r in range(0, len(self.keys), TILE_QUERIES):
                self._tile(slice(r, min(r + TILE_QUERIES, len(self.keys))), b, cols, keys, least)

    def _tile(self, rows, b, cols, keys, least) -> None:
        est, err = tile_bounds(self.coded, rows, b, cols)
        limit = self.worst[rows]
        if np.isneginf(limit).any() and est.shape[1] >= self.k:
            low = est - err
            limit = np.maximum(limit, np.partition(low, est.shape[1] - self.k, axis=1)[:, est.shape[1] - self.k])
        q, c = np.nonzero(est + err >= limit[:, None])
        q, c = q + rows.start, c + cols.start
        self.recomputed += len(q)
        for at in range(0, len(q), PAIRS):
            i, j = q[at:at + PAIRS], c[at:at + PAIRS]
            score = cosine(self.coded, i, b, j)
            on = score >= self.worst[i]
            for x, y, s in zip(i[on].tolist(), j[on].tolist(), score[on].tolist()):
                heap, entry = self.heaps[x], (s, -int(least[y]), int(keys[y]))
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                if len(heap) == self.k:
                    self.worst[x] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        got = [(int(k), key, s, -low) for k, h in zip(self.keys, self.heaps) for s, low, key in h]
        cols = list(zip(*got)) if got else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64())],
                                          names=["asked", "found", "score", "least"])


def _tiles(batches, k: int):
    """Streams (d, part, slab, side) runs: queries of a task come before its rows."""
    now, asked, best = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("d", "part", "slab", "side", "key", "least")}
        values = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
        label = np.stack([col[n] for n in ("d", "part", "slab", "side")], axis=1)
        cut = [0, *(np.flatnonzero((label[1:] != label[:-1]).any(1)) + 1).tolist(), len(label)]
        at = np.concatenate(([0], np.cumsum(col["d"])))
        for s, e in zip(cut, cut[1:]):
            if now != (new := tuple(label[s, :3].tolist())):
                if best is not None:
                    yield best.rows()
                now, asked, best = new, [], None
            vectors = values[at[s]:at[e]].reshape(e - s, new[0])
            if label[s, 3] == 0:
                asked.append((col["key"][s:e], vectors.copy()))
            elif asked or best is not None:
                if best is None:
                    best = Best(np.concatenate([a for a, _ in asked]), np.concatenate([v for _, v in asked]), k)
                    asked = []
                best.add(col["key"][s:e], col["least"][s:e], vectors)
    if best is not None:
        yield best.rows()


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def distinct_vectors(vectors: DataFrame, is_query: Column, vec_id: str, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """``(key, d, least, vec, ids, q)`` per distinct vector, with its k + 1 smallest
    ids (a query leaves out one of them) and how often each is there; and
    ``(query_id, key)`` per query. Repeats are counted before anything is gathered."""
    kind = dict(vectors.dtypes)[vector]
    v = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    rows = (vectors.select(F.col(vec_id).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), v.alias("vec"))
            .where(F.col("id").isNotNull() & usable(F.col("vec"))).withColumn("h", F.xxhash64("vec")))
    per_id = materialise(rows.groupBy("h", "vec", "id").agg(F.max("q").alias("q"), F.least(F.count("*"), F.lit(k)).alias("n")), "vectors-ids")
    first = Window.partitionBy("h", "vec").orderBy("id")
    few = per_id.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= k + 1)
    asked = per_id.where("q").select("h", "vec").distinct().withColumn("q", F.lit(True))
    one = few.groupBy("h", "vec").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"))
    one = one.join(asked, ["h", "vec"], "left")
    distinct = materialise(one.select(F.monotonically_increasing_id().alias("key"), F.size("vec").alias("d"),
                                      F.col("ids")[0]["id"].alias("least"), "h", "vec", "ids", F.coalesce("q", F.lit(False)).alias("q")), "vectors")
    queries = per_id.where("q").select(F.col("id").alias("query_id"), "h", "vec").join(
        distinct.where("q").select("h", "vec", "key"), ["h", "vec"]).select("query_id", "key")
    return distinct, materialise(queries, "vectors-queries")


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows nearest to each query."""
    distinct, queries = distinct_vectors(vectors, is_query, vec_id, vector, k)
    keep = k + 1  # one of them may be the query's own vector
    # One row per length of vectors: few, as n components have at most about sqrt(2n) lengths.
    sizes = distinct.groupBy("d").agg(F.ceil(F.count_if("q") / QUERY_GROUP).cast("int").alias("parts"),
                                      F.least(F.ceil(F.count("*") / SLAB), F.lit(MAX_SLABS)).cast("int").alias("slabs")).where("parts > 0")
    tiles = int(sizes.agg(F.sum(F.col("parts") * F.col("slabs"))).first()[0] or 1)
    deal = lambda name, of: F.pmod(F.xxhash64(F.lit(name), "key"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    v = distinct.join(F.broadcast(sizes), "d")
    cols = ["d", "part", "slab", "side", "key", "least", "vec"]
    data = v.withColumn("slab", deal("slab", "slabs")).withColumn("part", every("parts")).withColumn("side", F.lit(1)).select(cols)
    asked = v.where("q").withColumn("part", deal("part", "parts")).withColumn("slab", every("slabs")).withColumn("side", F.lit(0)).select(cols)
    dealt = asked.union(data).repartition(max(tiles, 1), "d", "part", "slab").sortWithinPartitions("d", "part", "slab", "side")
    found = dealt.mapInArrow(lambda batches: _tiles(batches, keep), FOUND)
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "least")
    top = materialise(found.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= keep).drop("__r", "least"), "vectors-found")
    rows = (queries.join(top, F.col("key") == F.col("asked")).drop("key")
            .join(distinct.select(F.col("key").alias("found"), "ids"), "found")
            .select("query_id", "asked", "score", F.explode("ids").alias("i")).where("i.id <> query_id")
            .select("query_id", "asked", "score", F.col("i.id").alias("vec_id"), F.explode(F.sequence(F.lit(1), F.col("i.n").cast("int")))))
    rank = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return (rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


NEAREST_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
w AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS l FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) / (q.l * c.l) AS score
      FROM w q JOIN w c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
