"""Suffix-array dedup with a logarithmic family of indexes.

Every byte covered by a ``length``-byte string that also starts anywhere else
(in any document, the same one included) is removed.

Index: a batch of documents gets a sparse suffix array. Its suffixes are the
anchors: in every window of ``length`` bytes, the first place whose next ``GRAM``
bytes have the smallest hash. Equal windows have their anchor at the same place,
so a long match always joins two anchors with equal first GRAM bytes. Entries are
(key, document, place), in the order of the key, the hash of these bytes, which
deals suffixes evenly where their text would not.

Family: a batch is merge-scanned against itself and the levels that exist, which
gives the keys that occur twice; then levels of equal rank merge into one of the
next rank, so that n batches keep about log2(n) levels and every entry is
rewritten about log2(n) times.

Resolution: anchors with a repeated key get their context (the bytes of all the
windows that they anchor). Equal contexts of a key are counted by a partial
aggregate, so copies cost one context. The contexts of a key that differ are
compared window by window, by a 64-bit hash beside the 64-bit key: in one task up
to ``HOT`` contexts; beyond, blocks of contexts send their distinct window hashes
to hash buckets and get back which of them occur twice, so that no key ever meets
in one task.

Defined cases: a null text has 0 bytes; a text shorter than ``length`` keeps all
bytes; a text may be of any length (it is hashed in pieces); equal rows repeat each other, so their long strings go from each; a null
doc_id is a document like others; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.iterate import drop_shuffles, release
from corvid.llm import common
from corvid.llm.common import bounded_batches, drop_folder, parts_for
from corvid.llm.hashing import Rolling, mix64, range_bucket
from corvid.session import scratch_folders

LENGTH = 200
GRAM = 48
BATCHES = 2
HOT = 4000  # differing contexts of a key that one task compares
HOT_KEYS_SENT = 500_000
BLOCK_CONTEXTS = 10_000
BUCKET_WINDOWS = 500_000
CHUNK = 1 << 19  # bytes whose hashes are made at a time: about 40 MB of arrays


def pieces(texts, overlap: int, most: int = CHUNK) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (index of the text, first byte, bytes), about ``most`` bytes a list;
    a longer text is cut, and its pieces overlap, so that every window of
    ``overlap + 1`` bytes is whole in one of them."""
    part, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - overlap, 1), most):
            p = t[at:at + most + overlap]
            if part and size + len(p) > most + overlap:
                yield part
                part, size = [], 0
            part.append((i, at, p))
            size += len(p)
    if part:
        yield part


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Arrays (text index, place, key, first window, last window): the anchors
    and the windows each of them anchors, places counted in their text."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    empty = tuple(np.zeros(0, np.int64) for _ in range(5))
    if not len(size) or size.max() < length:
        return empty
    begin = np.concatenate(([0], np.cumsum(size)))
    roll = Rolling(b"".join(texts))
    h = roll.all(gram)
    low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:  # minimum over `span` places from each place on
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    rest = width - span
    low = np.minimum(low[:len(low) - rest], low[rest:]) if rest else low
    doc = np.repeat(np.arange(len(texts)), np.maximum(size - length + 1, 0))
    start = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(size - length + 1, 0)) - np.maximum(size - length + 1, 0),
                                            np.maximum(size - length + 1, 0)) + begin[doc]
    at = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]))))
    last = np.concatenate((new[1:], [len(at)])) - 1
    d, p = doc[new], at[new]
    return d, p - begin[d], h[p].view(np.int64), start[new] - begin[d], start[last] - begin[d]


def as_bytes(text: str | None) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def suffixes(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``(key, id, pos)`` of all anchors of ``docs (id, text)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = b["id"].to_numpy()
            for part in pieces(map(as_bytes, b["text"]), length - 1):
                d, p, key, _, _ = anchors([x[2] for x in part], length, gram)
                own, at = np.array([x[0] for x in part]), np.array([x[1] for x in part])
                yield pd.DataFrame({"key": key, "id": ids[own[d]], "pos": (p + at[d]).astype(np.int32)})

    return docs.select(F.col("id").cast("string"), "text").mapInPandas(run, "key long, id string, pos int").select(
        "key", F.col("id").cast(dict(docs.dtypes)["id"]).alias("id"), "pos")


def materialise_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``common.materialise_at``; the shuffles that made the table go from the disks
    with it written, and not whenever the driver next collects garbage."""
    out = common.materialise_at(df, name)
    drop_shuffles(df.sparkSession)
    return out


def materialise(df: DataFrame, name: str) -> DataFrame:
    return materialise_at(df, name)[0]


@dataclass
class SuffixIndex:
    """The family of levels; ``repeated`` collects the keys found twice."""

    spark: object
    length: int = LENGTH
    gram: int = GRAM
    levels: list[tuple[int, DataFrame, str]] = field(default_factory=list)  # (rank, entries, folder)
    repeated: list[DataFrame] = field(default_factory=list)

    def _write(self, entries: DataFrame, rank: int) -> None:
        df, path = materialise_at(entries.sortWithinPartitions("key", "id", "pos"), f"suffix-level{rank}")
        self.levels.append((rank, df, path))

    def add(self, docs: DataFrame) -> None:
        """Index a batch ``(id, text)``."""
        older = [df for _, df, _ in self.levels]
        self._write(suffixes(docs, self.length, self.gram), 0)
        new = self.levels[-1][1].select("key", F.lit(1).alias("new"))
        for df in older:
            new = new.union(df.select("key", F.lit(0)))
        seen = new.groupBy("key").agg(F.count("*").alias("n"), F.sum("new").alias("new"))
        self.repeated.append(materialise(seen.where("n > 1 AND new > 0").select("key"), "suffix-keys"))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a, pa), (_, b, pb) = self.levels[-1], self.levels[-2]
            del self.levels[-2:]
            # by range of the whole order: a key that many suffixes share is cut by document
            self._write(a.union(b).repartitionByRange("key", "id", "pos"), rank + 1)
            drop_folder(self.spark, pa)
            drop_folder(self.spark, pb)

    def drop(self) -> None:
        """Delete the levels' tables."""
        for _, _, path in self.levels:
            drop_folder(self.spark, path)
        self.levels = []

    def entries(self) -> DataFrame:
        out = self.levels[0][1]
        for _, df, _ in self.levels[1:]:
            out = out.union(df)
        return out

    def candidates(self) -> DataFrame:
        """``(id, places)``: anchors whose key occurs twice, per document."""
        keys = self.repeated[0]
        for k in self.repeated[1:]:
            keys = keys.union(k)
        keys = materialise(keys.distinct(), "suffix-repeated")
        return self.entries().join(keys, "key").groupBy("id").agg(F.collect_set("pos").alias("places"))


def contexts(found: DataFrame, length: int, gram: int) -> DataFrame:
    """``(key, id, th, start, ctx)``: for each candidate anchor the bytes of its
    windows, and where they begin."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, th, places = b["id"].to_numpy(), b["th"].to_numpy(), b["places"].tolist()
            for part in pieces(map(as_bytes, b["text"]), length - 1):
                d, p, key, lo, hi = anchors([x[2] for x in part], length, gram)
                own, at = np.array([x[0] for x in part]), np.array([x[1] for x in part])
                step = max(len(x[2]) for x in part) + 1
                want = [np.asarray(places[i], np.int64) - a for i, a, _ in part]
                want = np.concatenate([w[(w >= 0) & (w < step)] + k * step for k, w in enumerate(want)])
                on = np.flatnonzero(np.isin(d * step + p, want))
                if len(on):
                    o = own[d[on]]
                    yield pd.DataFrame({"key": key[on], "id": ids[o], "th": th[o], "start": lo[on] + at[d[on]],
                                        "ctx": [part[i][2][s:e + length] for i, s, e in zip(d[on], lo[on], hi[on])]})

    kind = dict(found.dtypes)["id"]
    return found.select(F.col("id").cast("string"), "th", "text", "places").mapInPandas(
        run, "key long, id string, th long, start long, ctx binary").withColumn("id", F.col("id").cast(kind))


def window_hashes(ctx: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context index, place in it, hash) of every window of the contexts, made
    for about ``CHUNK`` bytes of them at a time."""
    size = np.array([len(c) for c in ctx], dtype=np.int64)
    n = size - length + 1
    row = np.repeat(np.arange(len(ctx), dtype=np.int32), n)
    place = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
    h, done = np.empty(len(row), dtype=np.uint64), 0
    ends = np.flatnonzero(np.diff(np.cumsum(size) // CHUNK)) + 1
    for s, e in zip([0, *ends], [*ends, len(ctx)]):
        m = int(n[s:e].sum())
        at = (np.cumsum(size[s:e]) - size[s:e])[row[done:done + m] - s] + place[done:done + m]
        h[done:done + m] = Rolling(b"".join(ctx[s:e])).at(at, length)
        done += m
    return row, place, h


def _runs(row: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context index, first byte, end) of runs of neighbouring windows."""
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(row)])) - 1
    return row[first], place[first], place[last] + length


RUNS = "key long, c long, r array<struct<a:int,b:int>>"


def _verdicts(b: pd.DataFrame, row: np.ndarray, place: np.ndarray, twice: np.ndarray, length: int) -> pd.DataFrame:
    """Per context (key, c) the byte runs [a, b) of its repeated windows."""
    if not twice.any():
        return b.iloc[:0][["key", "c"]].assign(r=pd.Series([], dtype=object))
    r, s, e = _runs(row[twice], place[twice], length)
    at = np.concatenate(([0], np.flatnonzero(np.diff(r)) + 1, [len(r)]))
    runs = [[{"a": int(x), "b": int(y)} for x, y in zip(s[i:j], e[i:j])] for i, j in zip(at, at[1:])]
    own = r[at[:-1]]
    return pd.DataFrame({"key": b["key"].to_numpy()[own], "c": b["c"].to_numpy()[own], "r": runs})


def _compare(length: int):
    """Verdicts over contexts sorted by key, whole keys a task."""
    def solve(b: pd.DataFrame) -> pd.DataFrame:
        row, place, h = window_hashes(b["ctx"].tolist(), length)
        key = b["key"].to_numpy()[row]
        order = np.argsort(h, kind="stable")
        same = (h[order][1:] == h[order][:-1]) & (key[order][1:] == key[order][:-1])
        twice = b["times"].to_numpy()[row] > 1
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        return _verdicts(b, row, place, twice, length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            cut = int(np.searchsorted(b["key"].to_numpy(), b["key"].iloc[-1]))  # the last key may go on
            held = b.iloc[cut:].reset_index(drop=True)
            for lo, hi in _key_slices(b["key"].to_numpy()[:cut], 4096):
                yield solve(b.iloc[lo:hi].reset_index(drop=True))
        if held is not None and len(held):
            yield solve(held)

    return run


def _key_slices(keys: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Slices of about ``rows`` rows that end between keys."""
    ends = np.concatenate((np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else []
    lo = 0
    for e in ends:
        if e - lo >= rows or e == len(keys):
            yield lo, int(e)
            lo = int(e)


def _window_keys(b: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context index, place, hash of window and key) of a block's windows."""
    b.sort_values(["key", "c"], inplace=True, ignore_index=True)
    row, place, h = window_hashes(b["ctx"].tolist(), length)
    return row, place, mix64(h ^ mix64(b["key"].to_numpy().view(np.uint64)[row]))


_MARK = np.uint64(1)  # lowest bit of a hash here: the window occurs twice already


def _counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes, whether each occurs twice); sorts ``h`` in place."""
    h.sort()
    name = h >> _MARK
    new = np.concatenate(([True], name[1:] != name[:-1]))
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate((first, [len(h)])))
    last = h[first + n - 1]  # a marked one sorts last
    return name[first] << _MARK, (n > 1) | ((last & _MARK) > 0)


def compare_hot(each: DataFrame, length: int) -> DataFrame:
    """Verdicts for contexts of any number a key: blocks ask, buckets count."""
    sizes = each.agg(F.count("*").alias("n"), F.sum(F.octet_length("ctx") - length + 1).alias("w")).first()
    n_blocks, n_buckets = parts_for(sizes["n"], BLOCK_CONTEXTS), parts_for(sizes["w"] or 0, BUCKET_WINDOWS)
    d = each.select("key", "c", "times", "ctx", F.pmod(F.xxhash64("c", "key"), F.lit(n_blocks)).cast("int").alias("block"))

    def ask(b: pd.DataFrame) -> pd.DataFrame:
        row, _, h = _window_keys(b, length)
        uniq, twice = _counted(h & ~_MARK | (b["times"].to_numpy() > 1).astype(np.uint64)[row])
        uniq |= twice.astype(np.uint64)
        at = np.searchsorted(range_bucket(uniq, n_buckets), np.arange(n_buckets + 1))
        some = np.flatnonzero(np.diff(at))
        return pd.DataFrame({"bucket": some, "block": b["block"].iloc[0], "hashes": [uniq[at[k]:at[k + 1]].tobytes() for k in some]})

    def tell(b: pd.DataFrame) -> pd.DataFrame:
        names, twice = _counted(np.frombuffer(b"".join(b["hashes"]), np.uint64).copy())
        some = names[twice]
        told = []
        for x in b["hashes"]:
            own = np.frombuffer(x, np.uint64) & ~_MARK
            at = np.searchsorted(some, own)
            told.append(own[(at < len(some)) & (some[np.minimum(at, max(len(some) - 1, 0))] == own)].tobytes() if len(some) else b"")
        return pd.DataFrame({"block": b["block"], "bucket": b["bucket"], "twice": told})

    def decide(key, b: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row, place, h = _window_keys(b, length)
        some = np.frombuffer(b"".join(told.sort_values("bucket")["twice"]), np.uint64)  # sorted: buckets are ranges
        h &= ~_MARK
        at = np.searchsorted(some, h)
        return _verdicts(b, row, place, (at < len(some)) & (some[np.minimum(at, len(some) - 1)] == h) if len(some) else np.zeros(len(h), bool), length)

    asked = d.groupBy("block").applyInPandas(ask, "bucket int, block int, hashes binary")
    told = asked.groupBy("bucket").applyInPandas(tell, "block int, bucket int, twice binary")
    return d.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(decide, RUNS)


def repeated_spans(ctx: DataFrame, length: int) -> DataFrame:
    """``(id, th, s, e)`` of the repeated windows, from written contexts."""
    named = ctx.withColumn("c", F.xxhash64("ctx"))
    since = len(scratch_folders(ctx.sparkSession))
    each = materialise(named.groupBy("key", "c").agg(F.count("*").alias("times"), F.any_value("ctx").alias("ctx")), "suffix-contexts")
    hot = materialise(each.groupBy("key").count().where(F.col("count") > HOT).select("key"), "suffix-hot")
    n_hot = hot.count()
    few = F.broadcast(hot) if n_hot <= HOT_KEYS_SENT else hot
    cold = each.join(few, "key", "left_anti") if n_hot else each
    n = parts_for(each.count(), 100_000, 12)
    found = cold.repartition(n, "key").sortWithinPartitions("key").mapInPandas(_compare(length), RUNS)
    if n_hot:
        found = found.union(compare_hot(materialise(each.join(few, "key"), "suffix-hot-contexts"), length))
    found = materialise(found, "suffix-verdicts")
    release(ctx.sparkSession, keep=found, since=since)
    found = found.withColumnsRenamed({"key": "__key", "c": "__c"})
    return (named.select("key", "c", "id", "th", "start").join(found, (F.col("key") == F.col("__key")) & (F.col("c") == F.col("__c")))
            .select("id", "th", "start", F.explode("r").alias("r"))
            .select("id", "th", (F.col("start") + F.col("r.a")).alias("s"), (F.col("start") + F.col("r.b")).alias("e")))


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Union of half-open spans, sorted; touching spans become one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.concatenate((first[1:], [len(spans)])) - 1]], axis=1)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, batches: int = BATCHES, index: SuffixIndex | None = None) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` per row of
    ``docs``; spans are the removed byte ranges."""
    bounded_batches(docs.sparkSession)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))
    kept = index is not None
    index = index or SuffixIndex(docs.sparkSession, length, gram)
    for b in range(batches):
        index.add(d.where(F.pmod(F.xxhash64(F.lit("batch"), "id"), F.lit(batches)) == b).select("id", "text"))
    # Only documents with a repeated key can lose bytes; their texts are kept at hand.
    places = index.candidates().withColumnRenamed("id", "__id")
    found = materialise(d.join(places, F.col("id").eqNullSafe(F.col("__id"))).drop("__id"), "suffix-found")
    if not kept:
        index.drop()
    since = len(scratch_folders(docs.sparkSession))
    ctx = materialise(contexts(found, length, gram), "suffix-ctx")
    spans = materialise(repeated_spans(ctx, length).groupBy("id", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
                        .withColumnsRenamed({"id": "__id", "th": "__th"}), "suffix-spans")
    release(docs.sparkSession, keep=spans, since=since)
    hit = (found.select("id", "th", "text").dropDuplicates(["id", "th"])
           .join(spans, F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, th, t, s in zip(b["id"], b["th"], b["text"], b["spans"]):
                t, m = t.encode(), merge_spans(np.array([(x["s"], x["e"]) for x in s], dtype=np.int64))
                h, at = hashlib.sha256(), 0
                for s, e in m:
                    h.update(t[at:s])
                    at = e
                h.update(t[at:])
                rows.append((i, th, int((m[:, 1] - m[:, 0]).sum()), len(m), h.hexdigest(), [(int(x), int(y)) for x, y in m]))
            yield pd.DataFrame(rows, columns=["id", "th", "n_removed", "n_spans", "sha", "spans"])

    kind = dict(d.dtypes)["id"]
    done = hit.select(F.col("id").cast("string"), "th", "text", "spans").mapInPandas(
        cut, "id string, th long, n_removed long, n_spans long, sha string, spans array<struct<s:long,e:long>>")
    done = materialise(done.select(F.col("id").cast(kind).alias("__id"), F.col("th").alias("__th"), "n_removed", "n_spans", "sha", "spans"), "suffix-done")
    t = F.coalesce(F.col("text"), F.lit(""))
    base = d.select("id", "th", F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("whole"))
    j = base.join(done, F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left")
    return j.select("id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"), "spans")
