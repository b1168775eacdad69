"""Mixing sources to target weights by index.

Words of a source form one stream (its documents in a pseudorandom order), cut
into blocks of ``block_words``. The mix has as many slots per source as its
target asks for. Every output shard draws how many of its slots each source
fills: a multinomial draw conditioned on the sources' total slots (a
multivariate hypergeometric draw, split down a binary tree over the shards, so
that each shard is drawn alone and reruns agree; nodes of 1e9 slots or more draw
from the normal or binomial approximation, clipped to the totals). A source's slots are numbered
through the shards; slot j of a source with n blocks is entry j mod n of the
pseudorandom permutation of pass j div n. Blocks join by (source, index).

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating;
they share 100 % of all words; a target stops at ``MAX_REPEAT`` times the
source's words and the excess is shared again by weight until none is above.
No block, so no document, is taken more than MAX_REPEAT times.

The driver holds one row per source (name, words, target): the number of
sources must fit the driver, whatever the number of documents.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own; an empty table gives an empty mix; identical rows
each take their own place in the stream, in the mixed documents too; extra columns
do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import WORD_GAP, exclusive_sums, materialise, words

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 8192
SEED = 20_240_601


def share_targets(sizes: list[int], weights: list[int], cap: int = MAX_REPEAT) -> list[float]:
    """Targets by weight of the sum of ``sizes``, none above ``cap`` sizes."""
    out, left, open_ = [0.0] * len(sizes), sum(sizes), list(range(len(sizes)))
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] > cap * sizes[i] * w]
        for i in over or open_:
            out[i] = float(cap * sizes[i]) if over else left * weights[i] / w
        if not over:
            break
        left -= sum(cap * sizes[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


@dataclass(frozen=True)
class Source:
    rank: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def plan_sources(sizes: dict[str | None, int], block_words: int) -> list[Source]:
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    targets = share_targets([sizes[s] for s in names], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))])
    out = []
    for i, (s, t) in enumerate(zip(names, targets)):
        blocks = -(-sizes[s] // block_words)
        slots = min(MAX_REPEAT * blocks, round(t * blocks / sizes[s])) if blocks else 0
        out.append(Source(i, s, sizes[s], t, blocks, slots))
    return out


def _mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (wrapping multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Entries ``index`` of the pseudorandom permutation ``key`` of range(n): a
    four-round Feistel network, walked on until it falls below n."""
    if n <= 1:
        return index.astype(np.int64)
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _mix64(np.arange(4, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    x = index.astype(np.uint64)
    todo = np.ones(len(x), dtype=bool)
    while todo.any():
        a, b = x[todo] >> half, x[todo] & mask
        for k in keys:
            a, b = b, a ^ (_mix64(b ^ k) & mask)
        x[todo] = (a << half) | b
        todo &= x >= np.uint64(n)
    return x.astype(np.int64)


EXACT = 10**9  # numpy's hypergeometric draws need totals below this


def _draw_one(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Of ``n`` drawn without replacement, how many are of the ``good``. Beyond
    numpy's range by the normal distribution, or by the binomial one where the
    spread is small, which means that one kind is a sliver of the total."""
    total = good + bad
    if total < EXACT:
        return int(rng.hypergeometric(good, bad, n))
    share = n / total
    spread = math.sqrt(good * share * (1 - share) * (bad / (total - 1)))
    if spread > 1000:
        got = good * n // total + round(rng.normal(0, spread))
    elif good <= bad:
        got = int(rng.binomial(good, share))
    else:
        got = n - int(rng.binomial(bad, share))
    return min(max(got, n - bad, 0), good, n)


def draw_split(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """``n`` of ``counts`` drawn without replacement, per source."""
    total = int(counts.sum())
    if total < EXACT:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    out, left = np.zeros(len(counts), dtype=np.int64), int(n)
    for i, c in enumerate(counts):  # each source given those before it
        total -= int(c)
        out[i] = _draw_one(rng, int(c), total, left)
        left -= int(out[i])
    return out


def shard_draw(slots: np.ndarray, shard: int, n_shards: int, shard_slots: int, seed: int):
    """Slots of each source in the shard, and in all shards before it."""
    counts, before, lo, hi = slots.astype(np.int64), np.zeros(len(slots), np.int64), 0, n_shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = draw_split(np.random.default_rng([seed, lo, hi]), counts, (mid - lo) * shard_slots)
        if shard < mid:
            counts, hi = left, mid
        else:
            counts, before, lo = counts - left, before + left, mid
    return counts, before


def mix_slots(spark, plan: list[Source], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``(shard, position, rank, slot, pass, block)``: every slot of the mix."""
    slots = np.array([s.slots for s in plan], dtype=np.int64)
    blocks = [s.blocks for s in plan]
    n_shards = -(-int(slots.sum()) // shard_slots)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                counts, before = shard_draw(slots, int(shard), n_shards, shard_slots, seed)
                rank = np.repeat(np.arange(len(counts)), counts)
                slot = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts)])
                pas, block = np.zeros_like(slot), np.zeros_like(slot)
                for r in np.flatnonzero(counts):
                    own = rank == r
                    pas[own] = slot[own] // blocks[r]
                    for p in np.unique(pas[own]):
                        at = own & (pas == p)
                        block[at] = permute(slot[at] % blocks[r], blocks[r], hash((seed, int(r), int(p))))
                order = np.random.default_rng([seed, int(shard)]).permutation(len(rank))
                yield pd.DataFrame({"shard": shard, "position": np.arange(len(rank)), "rank": rank[order],
                                    "slot": slot[order], "pass": pas[order], "block": block[order]})

    return spark.range(n_shards).mapInPandas(draw, "shard long, position long, rank int, slot long, pass int, block long")


@dataclass
class Mix:
    """plan: the sources; placed: ``(id, th, rank, size, offset)`` per row of the
    input; slots: the mix; block_words."""

    plan: list[Source]
    placed: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """``(rank, offset, block, first, n, times)``: the words first..first+n of
        the document at ``offset`` that lie in a block, and how often it is taken."""
        L = self.block_words
        d = self.placed.where("size > 0")
        p = d.select("rank", "offset", "size", F.explode(F.sequence(
            F.floor(F.col("offset") / L), F.floor((F.col("offset") + F.col("size") - 1) / L))).alias("block"))
        first = F.greatest(F.col("block") * L - F.col("offset"), F.lit(0))
        end = F.least((F.col("block") + 1) * L - F.col("offset"), F.col("size"))
        taken = self.slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
        taken = taken.hint("merge")  # the slots' size is not known to the planner: never broadcast them
        return (p.join(taken, ["rank", "block"])
                .select("rank", "offset", "block", first.alias("first"), (end - first).alias("n"), "times"))

    def taken(self) -> DataFrame:
        """``placed`` with ``taken``: words the mix takes, repeats counted."""
        t = self.pieces().groupBy("rank", "offset").agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
        # an empty document has the place of the next one, but none of its words
        return (self.placed.join(t, ["rank", "offset"], "left")
                .withColumn("taken", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long")))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                block_words: int = BLOCK_WORDS, seed: int = SEED, row: str | None = None) -> Mix:
    """``row``: a written key of the rows that ``placed`` shall carry."""
    more = [row] if row else []
    sized = materialise(docs.select(*more, F.col(doc_id).alias("id"), F.xxhash64(text).alias("th"), F.col(source).alias("source"),
                                    F.size(words(F.col(text))).cast("long").alias("size")), "mix-sizes")
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    plan = plan_sources({r["source"]: r["size"] for r in rows}, block_words)
    spark = docs.sparkSession
    ranks = spark.createDataFrame([(s.rank, s.name) for s in plan], "rank int, name string")
    d = sized.join(F.broadcast(ranks), F.col("source").eqNullSafe(F.col("name"))).select(*more, "id", "th", "size", "rank")
    placed = materialise(exclusive_sums(d, "rank", ["id", "th"], "size", "offset", sum(r["n"] for r in rows))
                         .select(*more, "id", "th", "rank", "size", "offset"), "mix-placed")
    return Mix(plan, placed, mix_slots(spark, plan, seed=seed), block_words)


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  n_chars: str = "n_chars", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each document and each time that words
    of it are taken, with the text of the blocks taken that time (whole if all
    are) and ``n_chars``, if there, brought up to date."""
    docs = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-documents")
    mix = mix_sources(docs, doc_id, text, source, block_words, seed, "__row")
    parts = mix.pieces().groupBy("rank", "offset").agg(
        F.sort_array(F.collect_list(F.struct("first", "n", "times"))).alias("__p"))
    parts = mix.placed.where("size > 0").join(parts, ["rank", "offset"]).select(F.col("__row").alias("__at"), "__p")
    j = docs.join(parts, F.col("__row") == F.col("__at"))
    j = j.withColumn("__e", F.explode(F.sequence(F.lit(1), F.array_max(F.transform("__p", lambda p: p["times"])).cast("int"))))
    unit = F.regexp_extract_all(F.col(text), F.lit(f"[{WORD_GAP}]*[^{WORD_GAP}]+"), F.lit(0))
    j = j.withColumn("__u", unit)
    part = lambda p: F.slice(F.col("__u"), (p["first"] + 1).cast("int"), p["n"].cast("int"))
    some = F.array_join(F.flatten(F.transform(F.filter("__p", lambda p: p["times"] >= F.col("__e")), part)), "")
    whole = F.aggregate(F.filter("__p", lambda p: p["times"] >= F.col("__e")), F.lit(0).cast("long"),
                        lambda a, p: a + p["n"]) == F.size("__u")
    new = F.when(whole, F.col(text)).otherwise(F.regexp_replace(some, f"^[{WORD_GAP}]+", ""))
    j = j.withColumn("__n", new)
    put = {text: F.col("__n"), n_chars: F.length("__n").cast(dict(docs.dtypes).get(n_chars, "long"))}
    return j.select(*[put[c].alias(c) if c in put else F.col(c) for c in docs.columns if c != "__row"])
