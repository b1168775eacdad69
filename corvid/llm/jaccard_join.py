"""N-gram Jaccard join by prefix filters under several global token orders.

A document's set is its distinct 5-word shingles (64-bit hashes). Two sets with
100·|x ∩ y| >= 80·|x ∪ y| share a token among the first n - ceil(0.8 n) + 1
tokens of both, under any global order. The orders used here put rare tokens
first (by document frequency class) and break ties by different permutations of
the hash, so a passage that many documents share is at the end of each order. A
pair must share prefix tokens under all orders, pass the length filter and the
position filter, and is then verified on the whole texts.

Frequencies are counted over all documents: blocks of documents send their
distinct tokens, once each, to token buckets and get the frequency classes back.
Tokens that no other document has cannot match, so a document whose prefix holds
only such tokens is done.

Equal sets are one class with one representative. Links between representatives
are found by stars (each prefix token compares its documents with one hub) until
most groups are connected, then by all pairs that share a prefix token and are
not yet connected: exact, and a large group of near copies costs stars, not pairs.

Defined cases: a null text, or one without words, has an empty set and is linked
with nothing; rows with a null doc_id get a null component and link nothing;
repeated rows have equal sets, so they are one class, and a written row salt deals
them to blocks like any others; rows of one doc_id with other texts are documents of
their own; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import drop_folder, materialise, materialise_at, parts_for, text_bytes
from corvid.llm.components import components
from corvid.llm.hashing import Words, chunks, mix64, range_bucket, shingles

WIDTH = 5
PERCENT = 80
ORDERS = 3
STAR_ROUNDS = 2
BLOCK_BYTES = 8 << 20
BUCKET_TOKENS = 2_000_000


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(text index, token) of the distinct shingles, sorted; A-Z is lower-cased."""
    docs, toks = [], []
    for first, part in chunks(t.encode().lower() if isinstance(t, str) else b"" for t in texts):
        d, h = shingles(Words(part), width)
        docs.append(d + first)
        toks.append(h)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(toks)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 40-bit keys as four planes of delta bytes, or whole if a delta
    does not fit."""
    delta = np.diff(keys, prepend=keys[:1])
    if len(delta) and delta.max() >= 1 << 32:
        return b"w" + keys.tobytes()
    return b"d" + keys[:1].tobytes() + delta.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if data[:1] == b"w":
        return np.frombuffer(data, np.uint64, offset=1)
    delta = np.frombuffer(data, np.uint8, offset=9).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.uint64)
    return np.frombuffer(data, np.uint64, count=1, offset=1) + np.cumsum(delta)


def frequency_class(n: np.ndarray) -> np.ndarray:
    """0 for a token of one document, then about eight classes a doubling."""
    return np.where(n > 1, np.minimum(255, 1 + np.floor(8 * np.log2(np.maximum(n, 2)))), 0).astype(np.uint8)


def prefix_length(n):
    """n - ceil(0.8 n) + 1"""
    return n - (n * PERCENT + 99) // 100 + 1


def _requests(n_buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, tok = shingle_sets(pdf["text"].tolist())
        uniq, count = np.unique(tok, return_counts=True)
        at = np.searchsorted(range_bucket(uniq, n_buckets), np.arange(n_buckets + 1))
        some = np.flatnonzero(np.diff(at))
        key, count = uniq >> np.uint64(24), np.minimum(count, 255).astype(np.uint8)
        return pd.DataFrame({"bucket": some, "block": pdf["block"].iloc[0],
                             "keys": [pack_sorted(key[at[b]:at[b + 1]]) for b in some],
                             "counts": [count[at[b]:at[b + 1]].tobytes() for b in some]})
    return run


def _classes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Frequency classes of one bucket's tokens, for each block that asked."""
    keys = [unpack_sorted(k) for k in pdf["keys"]]
    every = np.concatenate(keys)
    uniq, inverse = np.unique(every, return_inverse=True)
    total = np.bincount(inverse, np.concatenate([np.frombuffer(c, np.uint8) for c in pdf["counts"]]), len(uniq))
    cls = frequency_class(total)[inverse]
    ends = np.cumsum([len(k) for k in keys])
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"],
                         "classes": [cls[e - len(k):e].tobytes() for k, e in zip(keys, ends)]})


def _prefixes(key, docs: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
    """Per document: set size and digest, and for those that can have a partner
    the prefix tokens under each order, and the text."""
    doc, tok = shingle_sets(docs["text"].tolist())
    n = np.bincount(doc, minlength=len(docs))
    first = np.cumsum(n) - n
    sums = [np.zeros(len(docs), np.uint64) for _ in range(2)]
    for k, s in enumerate(sums):
        some = n > 0
        if len(tok):
            s[some] = np.add.reduceat(mix64(tok + np.uint64(k + 1)), first[some])
    out = pd.DataFrame({"id": docs["id"].to_numpy(), "n": n.astype(np.int64), "d1": sums[0].view(np.int64), "d2": sums[1].view(np.int64)})
    cls = np.zeros(0, np.uint8)
    if len(tok):
        uniq, inverse = np.unique(tok, return_inverse=True)
        answers = np.frombuffer(b"".join(got.sort_values("bucket")["classes"]), np.uint8)
        cls = answers[inverse]
    single = np.bincount(doc[cls == 0], minlength=len(docs))
    need = prefix_length(n)
    alive = (n > 0) & (single < need)
    out["n1"], out["text"] = single.astype(np.int64), np.where(alive, docs["text"], None)
    on = alive[doc] & (cls > 0)
    doc, tok, cls = doc[on], tok[on], cls[on]
    left = np.bincount(doc, minlength=len(docs))
    start = np.cumsum(left) - left
    for k in range(ORDERS):
        perm = mix64(tok ^ np.uint64(k << 40 | k)) if k else tok
        order = np.lexsort((perm, cls, doc))
        t = tok[order].view(np.int64)
        t = t if k == 0 else t.astype(np.int32)  # later orders only need to tell tokens apart
        out[f"p{k}"] = [t[s:s + w] if a else None for s, w, a in zip(start, need - single, alive)]
    return out


def salted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(id, text, salt)``, to be written: every reader of the rows then deals
    them alike. Ids go as text: a pandas column of longs with nulls would become
    doubles."""
    return docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("salt"))


def blocked(rows: DataFrame, n_blocks: int) -> DataFrame:
    return rows.select("id", "text", F.pmod(F.xxhash64("id", "salt"), F.lit(n_blocks)).cast("int").alias("block"))


def shingle_prefixes(rows: DataFrame, kind: str) -> DataFrame:
    """``(id, n, d1, d2, n1, text, p0, p1, p2)`` per written row of ``salted``; ``kind``: the ids' type."""
    size = text_bytes(rows, "text")
    n_blocks, n_buckets = parts_for(size, BLOCK_BYTES), parts_for(size / 6, BUCKET_TOKENS, 12)
    d = blocked(rows, n_blocks).repartition(max(n_blocks, 1), "block")  # one exchange of the texts serves both passes
    asked = d.groupBy("block").applyInPandas(_requests(n_buckets), "bucket int, block int, keys binary, counts binary")
    told = asked.groupBy("bucket").applyInPandas(_classes, "block int, bucket int, classes binary")
    prefixes = ", p0 array<long>" + "".join(f", p{k} array<int>" for k in range(1, ORDERS))
    got = d.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(
        _prefixes, f"id string, n long, d1 long, d2 long, n1 long, text string{prefixes}")
    return got.withColumn("id", F.col("id").cast(kind))


def _close(nx: Column, ny: Column, px: Column, py: Column) -> Column:
    """Length filter, and position filter for a token at places px and py: the
    overlap needed is ceil(80 (nx + ny) / 180)."""
    need = F.ceil((nx + ny) * PERCENT / (100 + PERCENT))
    return ((F.least(nx, ny) * 100 >= F.greatest(nx, ny) * PERCENT) & (F.least(nx - px, ny - py) >= need))


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lo in range(0, len(b), 200):
            part = b.iloc[lo:lo + 200]
            texts = list(dict.fromkeys([*part["ta"], *part["tb"]]))
            place = {t: i for i, t in enumerate(texts)}
            doc, tok = shingle_sets(texts)
            at = np.searchsorted(doc, np.arange(len(texts) + 1))
            keep = []
            for x, y in zip(part["ta"], part["tb"]):
                x, y = place[x], place[y]
                sx, sy = tok[at[x]:at[x + 1]], tok[at[y]:at[y + 1]]
                both = len(np.intersect1d(sx, sy, assume_unique=True))
                keep.append(both * 100 >= PERCENT * (len(sx) + len(sy) - both))
            yield part.loc[keep, ["u", "v"]]


def verified(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (hub or odd one ``u``, other ``v``) that pass the other orders'
    filters and the exact test."""
    later = range(1, ORDERS)
    side = lambda n: reps.select(F.col("node").alias(n), *[F.col(f"p{k}").alias(f"p{k}{n}") for k in later])
    j = pairs.join(side("v"), "v").join(side("u"), "u")
    for k in later:
        j = j.where(F.arrays_overlap(f"p{k}u", f"p{k}v"))
    texts = lambda n: reps.select(F.col("node").alias(n), F.col("text").alias("t" + n))
    j = j.select("u", "v").join(texts("v"), "v").join(texts("u"), "u")  # texts meet only the pairs that are left
    j = j.select("u", "v", F.col("tu").alias("ta"), F.col("tv").alias("tb"))
    return j.mapInPandas(_verify, "u {0}, v {0}".format(dict(reps.dtypes)["node"]))


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``docs``."""
    rows, folder = materialise_at(salted(docs, doc_id, text), "jaccard-rows")
    sets = materialise(shingle_prefixes(rows, dict(docs.dtypes)[doc_id]), "jaccard-sets")
    drop_folder(docs.sparkSession, folder)
    same = ["n", "d1", "d2"]
    known = sets.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = materialise(known.groupBy(*same).agg(F.min("id").alias("node"), F.count("*").alias("members")), "jaccard-classes")
    reps = materialise(known.where(F.col("text").isNotNull()).join(
        classes.select(*same, "node"), [*same]).where("id = node")
        .dropDuplicates(["node", *same]).select("node", "n", "n1", "text", *[f"p{k}" for k in range(ORDERS)]), "jaccard-reps")
    tokens = materialise(reps.select("node", "n", "n1", F.posexplode("p0").alias("pos", "token"))
                         .select("token", "node", "n", (F.col("pos") + F.col("n1")).alias("at"), "n1"), "jaccard-tokens")

    links = known.select(F.col("id").alias("u"), F.col("id").alias("v")).limit(0)
    for r in range(STAR_ROUNDS):
        near = (F.col("n1") / F.col("n")) if r == 0 else F.xxhash64(F.lit(r), "node")
        hubs = materialise(tokens.groupBy("token").agg(
            F.min(F.struct(near.alias("near"), F.col("node").alias("u"), F.col("n").alias("nu"), F.col("at").alias("atu"))).alias("h"),
            F.count("*").alias("c")).where("c > 1").select("token", "h.u", "h.nu", "h.atu"), "jaccard-hubs")
        pairs = (tokens.join(hubs, "token").where(F.col("node") != F.col("u"))
                 .where(_close(F.col("n"), F.col("nu"), F.col("at"), F.col("atu")))
                 .select("u", F.col("node").alias("v")).distinct())
        links = materialise(links.union(verified(pairs, reps)), "jaccard-links")
    comp = materialise(components(links, "jaccard-comp"), "jaccard-found")

    # What the stars left apart: per token, documents outside its main component against all others.
    t = materialise(tokens.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")), "jaccard-labelled")
    each = t.groupBy("token", "component").agg(F.count("*").alias("c"))
    main = materialise(each.groupBy("token").agg(F.max(F.struct("c", "component")).alias("m"), F.count("*").alias("k"))
                       .where("k > 1").select("token", F.col("m.component").alias("main")), "jaccard-main")
    apart = materialise(t.join(main, "token"), "jaccard-apart")
    odd = apart.where("component <> main").select("token", F.col("node").alias("u"), F.col("n").alias("nu"),
                                                  F.col("at").alias("atu"), F.col("component").alias("cu"))
    rest = (odd.join(apart, "token").where((F.col("component") != F.col("cu"))
                                           & ((F.col("component") == F.col("main")) | (F.col("node") < F.col("u"))))
            .where(_close(F.col("n"), F.col("nu"), F.col("at"), F.col("atu")))
            .select("u", F.col("node").alias("v")).distinct())
    more = materialise(verified(rest, reps), "jaccard-more")
    if more.limit(1).count():
        comp = materialise(components(links.union(more), "jaccard-comp"), "jaccard-found")

    node = materialise(classes.join(comp, "node", "left").select(*same, F.coalesce("component", "node").alias("c")), "jaccard-nodes")
    got = sets.select("id", "n", "d1", "d2").join(node.withColumnsRenamed({x: "__" + x for x in same}),
                                                  (F.col("n") == F.col("__n")) & (F.col("d1") == F.col("__d1")) & (F.col("d2") == F.col("__d2")), "left")
    return got.select("id", F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"))
