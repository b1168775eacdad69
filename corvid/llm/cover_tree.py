"""Exact top-k search by inner product with cover trees on both sides.

Rows are dealt to the nearest of some pivots: the leaf centres of a cover tree over
a sample (at most ``PIVOTS`` rows a length and ``PIVOT_BYTES``; the sample decides
where rows go, never what is found). A pivot's rows are cut into blocks of about
``BLOCK`` by a hash of id, vector and a written row salt, so rows that repeat an id or
a vector spread as well. With s the largest distance of a row from its pivot c, no row
there scores more than q·c + |q| s for a query q. Two rounds use that bound:

1. each query meets the pivot of largest q·c, which gives it a kth score;
2. it meets those other pivots whose bound reaches that score, and no others.

So what is sent are rows times the query groups that need their pivot: near rows
times queries / ``QUERY_GROUP`` where directions are uniform, far less where the data
are clustered. The queries of a pivot are dealt into groups of about ``QUERY_GROUP``;
a task gets one block and one group and builds a cover tree over each (children lie
within half the radius of their parent's covering ball, nodes hold their covering
radius). The group walks the block's tree together: for a query node with centre q
and radius r and a data node with centre c and radius s, no pair in them scores more
than

    q·c + |q| s + |c| r + r s

so the pair of nodes is pruned when this is below the worst kth score that the query
node's queries have, which in round 2 starts from round 1's. Leaves are scored
exactly with integers. Each task returns its best k per query, which a rank merges.

Components are floor(scale * x), x as double, scores whole numbers. A vector whose
products could leave 64 bits with another one is scored beside the trees with Python's
integers: as a row it meets every query, as a query every row. The pivots reach the
driver, with a count and a radius each; only the ``PIVOT_LENGTHS`` lengths with most
rows have some, rows of other lengths are dealt around the origin.

Defined cases: vectors that are null or hold null or non-finite components take no
part; vectors are searched among those of their own length; a score beyond 64 bits is
null, its rank is right; a null id takes no part; ties go to the smaller id; rows that
repeat an id are candidates each, but none that carries the query's own id is its
candidate; repeated query rows are one query per distinct vector and id; an empty
table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import materialise

SCALE = 256
K = 5
BLOCK = 4096
QUERY_GROUP = 512
LEAF = 256  # a leaf pair is one matrix product: below some thousand products its calls cost more than its work
QUERY_LEAF = 16
PIVOTS = 4096  # rows of a length in the sample, so pivots at most
PIVOT_BYTES = 16 << 20  # of all samples together
PIVOT_LENGTHS = 64  # lengths that have pivots
PIVOT_LEAF = 8
SLACK = 1e-6  # relative room for rounding in the bounds
WIDE = float(1 << 60)  # components from here on are sent as text
OFFSET = 2200  # bits: more than a score of doubles can have
SAFE = float(1 << 62)  # products of lengths below this stay within 64 bits
NONE = -(1 << 63)  # as a kth score: none yet
ALONE = -1  # the pivot of vectors that may leave 64 bits


@dataclass
class Node:
    rows: np.ndarray  # places in the tree's vectors
    centre: np.ndarray
    radius: float
    children: list["Node"] = field(default_factory=list)
    worst: float = -np.inf  # of a query node: the worst kth score in it


def build(vectors: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """Cover tree over ``vectors[rows]`` (floats): the centre is a point of the
    node; children are centres more than half the radius apart, every other
    point goes to its nearest child."""
    points = vectors[rows]
    centre = points[0]
    far = np.sqrt(((points - centre) ** 2).sum(1))
    node = Node(rows, centre, float(far.max()))
    if len(rows) <= leaf or node.radius == 0:
        return node
    # Farthest-first centres until all points are within half the radius, or there are too many to help.
    best, own, centres = far, np.zeros(len(rows), dtype=np.int64), [0]
    while best.max() > node.radius / 2 and len(centres) < max(2, len(rows) // (leaf // 2)):
        at = int(best.argmax())
        d = np.sqrt(((points - points[at]) ** 2).sum(1))
        own[d < best] = len(centres)
        best = np.minimum(best, d)
        centres.append(at)
    for k, at in enumerate(centres):
        part = np.flatnonzero(own == k)
        if len(part) == len(rows):
            return node
        if len(part):
            part = np.concatenate(([at], part[part != at]))  # the centre comes first
            node.children.append(build(vectors, rows[part], leaf))
    return node


class Search:
    """Best k of one query group, over one block after another. ``floor``: scores
    below it are not asked for, per query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.exact, self.k = ids, vectors, k
        self.float = vectors.astype(float)
        self.tree = build(self.float, np.arange(len(ids)), QUERY_LEAF)
        self.floor = np.full(len(ids), NONE, dtype=np.int64) if floor is None else floor
        self.start(self.tree)
        self.score = np.zeros((len(ids), k), dtype=np.int64)  # the first ``filled`` count
        self.found = np.full((len(ids), k), -1, dtype=np.int64)
        self.filled = np.zeros(len(ids), dtype=np.int64)

    def start(self, q: Node) -> None:
        q.worst = float(self.floor[q.rows].min())
        for child in q.children:
            self.start(child)

    def block(self, ids: np.ndarray, vectors: np.ndarray, tree: Node) -> None:
        self.cand_ids, self.cand, self.cand_float = ids, vectors, vectors.astype(float)
        # Sums below 2^53 are whole in doubles, whatever their order.
        longest = [np.linalg.norm(x, axis=1).max(initial=0) for x in (self.float, self.cand_float)]
        self.floats = longest[0] * longest[1] < 1 << 52
        self.walk(self.tree, tree)

    def bound(self, q: Node, c: Node) -> float:
        a, b = np.linalg.norm(q.centre), np.linalg.norm(c.centre)
        spread = a * c.radius + b * q.radius + q.radius * c.radius
        return float(q.centre @ c.centre) + spread + SLACK * (a * b + spread + 1)

    def walk(self, q: Node, c: Node) -> None:
        if self.bound(q, c) < q.worst:
            return
        if not q.children and not c.children:
            self.leaves(q, c)
        elif q.children and (not c.children or q.radius > c.radius):
            for child in q.children:
                self.walk(child, c)
            q.worst = min(x.worst for x in q.children)
        else:  # the most promising data nodes first: they raise the worst score
            for _, _, child in sorted((-self.bound(q, x), i, x) for i, x in enumerate(c.children)):
                self.walk(q, child)

    def leaves(self, q: Node, c: Node) -> None:
        if self.floats:
            scores = (self.float[q.rows] @ self.cand_float[c.rows].T).astype(np.int64)
        else:
            scores = self.exact[q.rows] @ self.cand[c.rows].T
        ids = self.cand_ids[c.rows]
        for at in np.flatnonzero((scores >= self.asked(q.rows)[:, None]).any(1)):
            r, s = q.rows[at], scores[at]
            n = self.filled[r]
            on = np.flatnonzero((ids != self.ids[r]) & (s >= (max(self.score[r].min(), self.floor[r]) if n == self.k else self.floor[r])))
            if len(on):
                some = np.concatenate([self.score[r, :n], s[on]]), np.concatenate([self.found[r, :n], ids[on]])
                order = np.lexsort((some[1], -some[0]))[: self.k]
                self.filled[r] = n = len(order)
                self.score[r, :n], self.found[r, :n] = some[0][order], some[1][order]
        q.worst = float(self.asked(q.rows).min())

    def asked(self, rows: np.ndarray) -> np.ndarray:
        """Per query the score that a candidate must reach."""
        return np.maximum(np.where(self.filled[rows] == self.k, self.score[rows].min(1), NONE), self.floor[rows])


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x): as longs (``v``), or for a vector with a component that
    a long might not hold as text (``w``; after an x the component itself, a
    whole number, is still to be scaled). Null for a vector that takes no part."""
    v = vector.cast("array<double>")
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    wide = F.exists(v, lambda x: F.abs(x) >= WIDE / scale)
    text = lambda x: F.when(F.abs(x) < float(1 << 53) / scale, F.floor(x * scale).cast("string")).otherwise(
        F.when(F.abs(x) < float(1 << 53), F.concat(F.lit("f"), x.cast("string"))).otherwise(F.concat(F.lit("x"), x.cast("string"))))
    return F.when(ok, F.struct(F.when(~wide, F.transform(v, lambda x: F.floor(x * scale))).alias("v"),
                               F.when(wide, F.transform(v, text)).alias("w")))


def _whole(v, w, scale: int) -> list[int]:
    """A vector as Python's integers."""
    if v is not None:
        return [int(x) for x in v]
    read = {"x": lambda x: int(float(x[1:])) * scale, "f": lambda x: math.floor(float(x[1:]) * scale)}
    return [read.get(x[0], int)(x) for x in w]


class Side:
    """Rows of one side of a task: ids, exact vectors, and their lengths."""

    def __init__(self, rows: pd.DataFrame, scale: int):
        self.ids, self.rows, self.scale = rows["id"].to_numpy(), rows, scale
        wide = rows["v"].isna().to_numpy()
        self.length = np.full(len(rows), np.inf)
        self.length[~wide] = [float(np.linalg.norm(np.asarray(v, dtype=float))) for v in rows["v"][~wide]]

    def matrix(self, at: np.ndarray) -> np.ndarray:
        return np.stack([np.asarray(v, dtype=np.int64) for v in self.rows["v"].iloc[at]])

    def whole(self, at: np.ndarray) -> np.ndarray:
        part = self.rows.iloc[at]
        out = np.empty((len(part), int(part["d"].iloc[0])), dtype=object)
        for i, (v, w) in enumerate(zip(part["v"], part["w"])):
            out[i, :] = _whole(v, w, self.scale)
        return out


def best_of(q: Side, c: Side, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the best k candidates per query, or more of them."""
    # Vectors short enough to stay within 64 bits among themselves go through the trees; a pair with a longer one is exact.
    small_q, small_c = (np.flatnonzero(s.length < SAFE ** 0.5) for s in (q, c))
    big_q, big_c = (np.flatnonzero(~(s.length < SAFE ** 0.5)) for s in (q, c))
    rows = []
    if len(small_q) and len(small_c):
        cand = c.matrix(small_c)
        s = Search(q.ids[small_q], q.matrix(small_q), k, q.rows["t"].to_numpy(dtype=np.int64)[small_q])
        s.block(c.ids[small_c], cand, build(cand.astype(float), np.arange(len(cand)), LEAF))
        for i, n, ids, scores in zip(s.ids, s.filled, s.found, s.score):
            rows += [(int(i), int(x), int(y)) for x, y in zip(ids[:n], scores[:n])]
    for qs, cs in ((big_q, np.arange(len(c.ids))), (small_q, big_c)):
        if len(qs) and len(cs):
            ids, cand = c.ids[cs].tolist(), c.whole(cs)
            for at in qs:
                scores = cand @ q.whole(np.array([at]))[0] if cand.shape[1] else np.zeros(len(cs), dtype=object)
                pairs = ((-int(y), x) for x, y in zip(ids, scores) if x != q.ids[at])
                rows += [(int(q.ids[at]), x, -y) for y, x in heapq.nsmallest(k, pairs)]
    return rows


def leaf_centres(node: Node) -> list[np.ndarray]:
    return [x for c in node.children for x in leaf_centres(c)] if node.children else [node.centre]


def choose_pivots(v: DataFrame) -> dict[int, np.ndarray]:
    """Pivots per length: about one per ``BLOCK`` rows, for lengths with more rows."""
    sizes = (v.groupBy("d").agg(F.count("*").alias("n"), F.count_if("q").alias("asks")).where((F.col("n") > BLOCK) & (F.col("asks") > 0) & (F.col("d") > 0))
             .orderBy(F.desc("n"), "d").limit(PIVOT_LENGTHS).collect())
    out = {}
    for r in sizes:
        most = min(PIVOTS, PIVOT_BYTES // (8 * r["d"] * len(sizes)), math.ceil(r["n"] / BLOCK) * PIVOT_LEAF // 2)
        some = (v.where((F.col("d") == r["d"]) & F.col("v").isNotNull()).orderBy(F.xxhash64("id", "v"), "salt").limit(most)
                .select("v").collect())
        sample = np.array([x["v"] for x in some], dtype=float).reshape(len(some), r["d"])
        sample = np.unique(sample[np.linalg.norm(sample, axis=1) < SAFE ** 0.5], axis=0)
        if len(sample) > 1:
            out[r["d"]] = np.stack(leaf_centres(build(sample, np.arange(len(sample)), PIVOT_LEAF)))
    return out


def _by_length(d: pd.Series, v: pd.Series, pivots: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, vectors, pivots) of the vectors that stay within 64 bits, in
    runs of rows that keep rows x pivots small."""
    ok = np.flatnonzero(v.notna())
    for n in np.unique(d.to_numpy()[ok]):
        at = ok[d.to_numpy()[ok] == n]
        c = pivots.get(int(n), np.zeros((1, n)))
        step = max(1, (1 << 20) // max(len(c), n))
        for lo in range(0, len(at), step):
            x = np.stack([np.asarray(v.iloc[i], dtype=float) for i in at[lo:lo + step]])
            small = np.linalg.norm(x, axis=1) < SAFE ** 0.5
            yield at[lo:lo + step][small], x[small], c


def nearest_pivot(pivots: dict[int, np.ndarray]):
    """(d, v) -> the pivot that a row is dealt to, and its distance."""
    @F.pandas_udf("pivot int, far double")
    def run(d: pd.Series, v: pd.Series) -> pd.DataFrame:
        own, far = np.full(len(d), ALONE, np.int32), np.zeros(len(d))
        for at, x, c in _by_length(d, v, pivots):
            own[at] = ((c ** 2).sum(1) - 2 * (x @ c.T)).argmin(1)
            far[at] = np.linalg.norm(x - c[own[at]], axis=1)
        return pd.DataFrame({"pivot": own, "far": far})
    return run


def first_pivot(pivots: dict[int, np.ndarray], known: dict[int, dict[int, tuple[int, float]]], k: int):
    """(d, v) -> the pivot of more than k rows with the largest product, null if there is none."""
    @F.pandas_udf("array<int>")
    def run(d: pd.Series, v: pd.Series) -> pd.Series:
        out = [[] for _ in range(len(d))]
        for at, x, c in _by_length(d, v, pivots):
            some = np.array(sorted(p for p, (n, _) in known[int(d.iloc[at[0]])].items() if n > k and p != ALONE), dtype=int) if len(at) else []
            if len(some):
                for i, p in zip(at, some[(x @ c[some].T).argmax(1)]):
                    out[i] = [int(p)]
        return pd.Series(out)
    return run


def other_pivots(pivots: dict[int, np.ndarray], known: dict[int, dict[int, tuple[int, float]]]):
    """(d, v, first, t) -> pivots that may hold a score of t or more, but the
    first; all for a vector that may leave 64 bits."""
    @F.pandas_udf("array<int>")
    def run(d: pd.Series, v: pd.Series, first: pd.Series, t: pd.Series) -> pd.Series:
        out = [sorted(known[int(n)]) for n in d]
        for at, x, c in _by_length(d, v, pivots):
            if not len(at):
                continue
            here = known[int(d.iloc[at[0]])]
            some = np.array(sorted(p for p in here if p != ALONE), dtype=int)
            far, size = np.array([here[p][1] for p in some]), np.linalg.norm(c[some], axis=1)
            length = np.linalg.norm(x, axis=1)[:, None]
            bound = x @ c[some].T + length * far + SLACK * (length * (size + far) + 1)
            for i, reach in zip(at, bound >= t.to_numpy()[at][:, None]):
                out[i] = [int(p) for p in some[reach] if p not in first.iloc[i]] + [ALONE] * (ALONE in here)
        return pd.Series(out)
    return run


def dealt(queries: DataFrame, rows: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries and rows by (d, block, group): each group of the queries that ask
    for a pivot meets each block of its rows in a task of its own."""
    asks = queries.select("d", F.explode("ask").alias("pivot")).groupBy("d", "pivot").agg(F.ceil(F.count("*") / QUERY_GROUP).alias("n_groups"))
    cells = F.broadcast(asks.join(blocks.select("d", "pivot", F.ceil(F.col("n") / BLOCK).alias("n_blocks")), ["d", "pivot"]))  # a row per pivot
    deal = lambda name, of, *by: F.pmod(F.xxhash64(F.lit(name), *by), F.col(of)).cast("long")
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    row = [F.col(c).alias(c) for c in ("d", "id", "v", "w")]  # columns of their own on either side
    block = (F.shiftleft(F.col("pivot").cast("long"), 32) + F.col("sub")).alias("block")
    data = (rows.join(cells, ["d", "pivot"]).select(*row, "pivot", deal("block", "n_blocks", "id", "v", "w", "salt").alias("sub"), every("n_groups").alias("group"))
            .select(*row, block, "group"))
    asked = (queries.select(*row, "t", F.explode("ask").alias("pivot")).join(cells, ["d", "pivot"])
             .select(*row, "t", "pivot", deal("group", "n_groups", "id", "v", "w").alias("group"), every("n_blocks").alias("sub"))
             .select(*row, "t", block, "group"))
    return asked, data


def met(asked: DataFrame, data: DataFrame, k: int, scale: int) -> DataFrame:
    """The best k candidates per query of each task."""

    def search(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        rows = best_of(Side(q, scale), Side(c, scale), k) if len(q) and len(c) else []
        fits = [-(1 << 63) <= y < 1 << 63 for _, _, y in rows]
        return pd.DataFrame({"query_id": pd.Series([i for i, _, _ in rows], dtype="int64"), "vec_id": pd.Series([x for _, x, _ in rows], dtype="int64"),
                             "score": pd.Series([y if f else None for (_, _, y), f in zip(rows, fits)], dtype="Int64"),
                             # beyond 64 bits: the sign, and bytes in the order of the scores
                             "beyond": pd.Series([0 if f else 1 if y > 0 else -1 for (_, _, y), f in zip(rows, fits)], dtype="int32"),
                             "order": [None if f else (y + (1 << OFFSET)).to_bytes(OFFSET // 8 + 1, "big") for (_, _, y), f in zip(rows, fits)]})

    return (asked.groupBy("d", "block", "group").cogroup(data.groupBy("d", "block", "group"))
            .applyInPandas(search, "query_id long, vec_id long, score long, beyond int, order binary"))


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding",
          k: int = K, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best candidates per query."""
    # The salt is written with the rows, so that every reader deals them alike.
    v = materialise(vectors.select(F.col(vec_id).cast("long").alias("id"), is_query.alias("q"), F.size(vector).alias("d"),
                                   quantised(F.col(vector), scale).alias("p"), F.monotonically_increasing_id().alias("salt"))
                    .where("id IS NOT NULL AND p IS NOT NULL").select("id", "q", "d", "p.*", "salt"), "cover-vectors")
    pivots = choose_pivots(v)
    rows = materialise(v.withColumn("p", nearest_pivot(pivots)("d", "v")).select("id", "q", "d", "v", "w", "salt", "p.*"), "cover-rows")
    blocks = materialise(rows.groupBy("d", "pivot").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.count_if("q").alias("asks")), "cover-blocks")
    known: dict[int, dict[int, tuple[int, float]]] = {}  # per length: pivot -> rows and radius
    for r in blocks.collect():
        known.setdefault(r["d"], {})[r["pivot"]] = (r["n"], r["far"])

    queries = rows.where("q").dropDuplicates(["id", "v", "w"]).select("id", "d", "v", "w")
    queries = materialise(queries.withColumn("ask", first_pivot(pivots, known, k)("d", "v")).withColumn("t", F.lit(NONE).cast("long")), "cover-first")
    got = materialise(met(*dealt(queries, rows, blocks), k, scale), "cover-found")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = (got.where("beyond = 0").withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k)
           .select(F.col("query_id").alias("id"), F.col("score").alias("t")))
    left = (queries.drop("t").withColumnRenamed("ask", "first").join(kth, "id", "left").withColumn("t", F.coalesce("t", F.lit(NONE).cast("long")))
            .withColumn("ask", other_pivots(pivots, known)("d", "v", "first", F.col("t").cast("double"))))
    left = materialise(left.where(F.size("ask") > 0), "cover-left")
    got = got.union(met(*dealt(left, rows, blocks), k, scale))
    w = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("order"), F.desc("score"), "vec_id")
    return got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
