"""Best-fit packing of token sequences by linear grouping.

Only lengths matter to a packing, and they are integers up to the capacity, so
the whole plan is made from their histogram (at most ``capacity`` rows whatever
the number of documents):

1. pieces longer than ``capacity // 8`` are sorted by length and dealt into
   groups of equal cardinality; each length is rounded up to its group's largest
   (the plan with the fewest sequences over some numbers of groups and some
   allowed wastes is taken; without any configuration it is best fit throughout,
   so no plan is longer than that);
2. configurations of these few sizes are optimised (column generation: linear
   program over patterns, priced by a knapsack) and rounded down;
3. actual pieces are substituted for the rounded ones, which frees room; a
   configuration whose pieces leave more than a given waste is given up;
4. what is left and all small pieces go by best fit, longest first.

The plan is a list of runs (length, first rank, first sequence, number of
sequences, offset); a piece finds its place from the rank it has among the
pieces of its length. Ranks are dealt in two levels, so a length that a third of
all pieces share is never in one task.

Defined cases: a null or empty text is one piece that holds only the end id;
repeated rows are packed each; an empty table gives no piece; extra columns are
not kept.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import WORD_GAP, bounded_batches, exclusive_sums, materialise

CAPACITY = 4096
END_ID = 1
GROUPS = (48, 144)
WASTES = (CAPACITY, 256, 32, 0, -1)  # tokens that a configuration may leave; none is used at -1
TOKENIZER = "word_bpe_49k.json"
CACHE_BYTES = 24 << 20  # of a generation of known words; a worker keeps two
WORD_BYTES = 220        # of a known word beside its characters
CACHED_CHARS = 200
TEXT_BYTES = 1 << 20    # characters encoded at a time

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, int]:
    """The rule of byte-level tokenizers: printable bytes stand for themselves,
    the others, in order, for the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Known(dict):
    """Ids of words, as little-endian bytes; what is not known is learnt."""

    def __init__(self, encoder: "WordEncoder"):
        super().__init__()
        self.encoder, self.size = encoder, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.encoder.ids(word)
        if len(word) <= CACHED_CHARS:
            self[word] = ids
            self.size += WORD_BYTES + len(word) + len(ids)
        return ids


class WordEncoder:
    """Ids of a text as little-endian 32-bit bytes. The tokenizer drops white
    space and never merges across it, so a text's ids are those of its words
    one after the other, and words come back: they are kept, in two generations
    of bounded bytes, so that frequent words stay. A run of letters, and the
    marks after one, are separate to the tokenizer: a plain run goes to its model
    alone. The tokenizer composes (NFC) first and lower-cases then; only words of
    code points below the combining marks, which are composed already and (but for
    the dotted I) have one lower case each, are lower-cased here."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.older = Known(self), {}
        self.letters = byte_letters()
        self.find = re.compile(rf"[^{WORD_GAP}]+").findall
        self.plain = re.compile("[\\x00-\u012f\u0131-\u02ff]*").fullmatch
        self.marked = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)").fullmatch  # letters, then ASCII marks

    def words(self, text: str) -> list[str]:
        if text.isascii() or self.plain(text):
            text = text.lower()
        # str.split is fast; it splits at these four too, which the tokenizer does not drop
        return self.find(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def ids(self, word: str) -> bytes:
        if (old := self.older.get(word)) is not None:
            return old
        if self.plain(word):
            if word != (low := word.lower()):
                return self.known[low]
            if word.isalpha():
                return self.run(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))
            if m := self.marked(word):
                return self.known[m[1]] + self.known[m[2]]
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def run(self, letters: str) -> bytes:
        tokens = self.tokenizer.model.tokenize(letters)
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.known.size > CACHE_BYTES:
            self.older, self.known = self.known, Known(self)
        get = self.known.__getitem__
        return [b"".join(map(get, self.words(t))) for t in texts]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker, which later tasks find warm."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of all documents."""
    path = path or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            ids, texts = batch["id"].tolist(), [t if isinstance(t, str) else "" for t in batch["text"]]
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64) // TEXT_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts, cuts[1:]):
                rows = []
                for i, b in zip(ids[lo:hi], enc.encode(texts[lo:hi])):
                    b = memoryview(b + end)
                    for k, at in enumerate(range(0, len(b), 4 * capacity)):
                        part = b[at:at + 4 * capacity]
                        rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # ids go as text: a pandas column of longs with nulls would become doubles
    d = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return d.mapInPandas(cut, PIECES).withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)[doc_id]))


# ---- the plan, from the histogram -----------------------------------------

def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern that fits. One round per
    piece: few sizes go into a sequence, since only large ones are priced."""
    best, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        new, pick = best.copy(), np.full(capacity + 1, -1)
        for k, (s, v) in enumerate(zip(sizes, values)):
            got = best[:capacity + 1 - s] + v
            better = got > new[s:] + 1e-12
            if better.any():
                new[s:][better] = got[better]
                pick[s:][better] = k
        best = new
        picks.append(pick)
    pattern, c = np.zeros(len(sizes), dtype=np.int64), capacity
    for pick in reversed(picks):
        if pick[c] >= 0:
            pattern[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Patterns over few ``sizes`` and how often each is used (rounded down)."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    x = np.linalg.solve(basis, demand.astype(float))
    for _ in range(rounds):
        duals = np.linalg.solve(basis.T, np.ones(k))
        value, pattern = best_pattern(sizes, duals, capacity)
        if value <= 1 + 5e-4:  # within this of the linear program's optimum
            break
        step = np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        x = np.maximum(np.linalg.solve(basis, demand.astype(float)), 0)
    return [(basis[:, i].round().astype(np.int64), int(x[i] + 1e-9)) for i in np.argsort(-x)]


class Plan:
    """Runs: the piece of rank r in [rank, rank + n·q) of a length goes to sequence
    ``seq + (r - rank) % n`` at ``offset + (r - rank) // n * length``."""

    def __init__(self, capacity: int):
        self.capacity, self.next_seq, self.runs = capacity, 0, []
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, number)
        self.sorted_gaps: list[int] = []

    def put(self, length: int, rank: int, seq: int, n: int, offset: int) -> None:
        self.runs.append((length, rank, seq, n, offset))

    def leave(self, gap: int, seq: int, n: int) -> None:
        if gap > 0 and n > 0:
            if not self.gaps[gap]:
                bisect.insort(self.sorted_gaps, gap)
            self.gaps[gap].append((seq, n))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """The run of sequences with the smallest gap of at least ``length``."""
        i = bisect.bisect_left(self.sorted_gaps, length)
        if i == len(self.sorted_gaps):
            return None
        gap = self.sorted_gaps[i]
        seq, n = self.gaps[gap].pop()
        if not self.gaps[gap]:
            del self.sorted_gaps[i]
        return gap, seq, n

    def best_fit(self, length: int, rank: int, count: int) -> None:
        while count > 0:
            gap, seq, n = self.take(length) or (self.capacity, self.next_seq, -(-count // (self.capacity // length)))
            self.next_seq += n if seq == self.next_seq else 0
            q, used = gap // length, self.capacity - gap
            full = min(n, count // q)
            if full:
                self.put(length, rank, seq, full, used)
                self.leave(gap - q * length, seq, full)
                rank, count = rank + full * q, count - full * q
            if full < n:
                if count:  # fewer than q are left: one sequence gets them
                    self.put(length, rank, seq + full, 1, used)
                    self.leave(gap - count * length, seq + full, 1)
                    rank, count, full = rank + count, 0, full + 1
                self.leave(gap, seq + full, n - full)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS,
                 wastes: tuple[int, ...] = WASTES) -> Plan:
    """The plan with the fewest sequences over the numbers of groups and wastes given."""
    plans = []
    for g in groups:
        found: dict = {}
        plans += [plan_groups(histogram, capacity, g, w, found) for w in wastes]
    return min(plans, key=lambda p: p.next_seq)


def plan_groups(histogram: dict[int, int], capacity: int, groups: int, waste: int | None = None, found: dict | None = None) -> Plan:
    """One plan; ``found`` keeps the configurations, which do not depend on the waste."""
    waste = capacity if waste is None else waste
    plan = Plan(capacity)
    left: dict[int, list[tuple[int, int]]] = {}  # length: (first rank, number) of what the patterns left
    large = [l for l in sorted(histogram, reverse=True) if capacity // 8 < l < capacity]
    if capacity in histogram:
        plan.best_fit(capacity, 0, histogram[capacity])
    if large:
        total = sum(histogram[l] for l in large)
        each = -(-total // groups)
        dealt: list[list[list[int]]] = [[]]  # groups of [length, rank, number], longest first
        room = each
        for l in large:
            rank, n = 0, histogram[l]
            while n:
                if not room:
                    dealt.append([])
                    room = each
                k = min(n, room)
                dealt[-1].append([l, rank, k])
                rank, n, room = rank + k, n - k, room - k
        top = np.array([g[0][0] for g in dealt])
        sizes = np.unique(top)[::-1]
        queues = [[p for g, t in zip(dealt, top) if t == s for p in g] for s in sizes]
        demand = np.array([sum(p[2] for p in q) for q in queues])
        found = {} if found is None else found
        if "patterns" not in found:
            found["patterns"] = configurations(sizes, demand, capacity)
        for pattern, times in found["patterns"]:
            slots = [g for g in range(len(sizes)) for _ in range(pattern[g])]
            while slots and times > 0:
                n = times
                for g in set(slots):  # a stretch over which each slot has pieces of one length
                    n = min(n, queues[g][0][2] // slots.count(g) if queues[g] else 0)
                if n == 0:  # a head shorter than its slots: one sequence, piece by piece
                    n = 1
                    if any(sum(p[2] for p in queues[g]) < slots.count(g) for g in set(slots)):
                        break
                offset, tops = 0, []
                taken = {g: 0 for g in slots}
                for g in slots:  # the pieces at the heads; a sequence of its own may use up several
                    i, used = 0, taken[g] * n
                    while used >= queues[g][i][2]:
                        used -= queues[g][i][2]
                        i += 1
                    tops.append(queues[g][i][0])
                    taken[g] += 1
                if capacity - sum(tops) > waste:
                    break  # later pieces of the groups are shorter still
                for g in slots:
                    p = queues[g][0]
                    plan.put(p[0], p[1], plan.next_seq, n, offset)
                    p[1], p[2], offset = p[1] + n, p[2] - n, offset + p[0]
                    if not p[2]:
                        queues[g].pop(0)
                plan.leave(capacity - offset, plan.next_seq, n)
                plan.next_seq, times = plan.next_seq + n, times - n
        for p in (p for q in queues for p in q):
            left.setdefault(p[0], []).append((p[1], p[2]))
    for l in sorted({*left, *(l for l in histogram if l <= capacity // 8)}, reverse=True):
        for rank, n in left.get(l) or [(0, histogram[l])]:
            plan.best_fit(l, rank, n)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """``pieces`` (from a written table) with ``sequence_id`` and ``offset``."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = plan_packing(histogram, capacity, groups)
    runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 5)
    n_pieces = sum(histogram.values())
    keys = runs[:, 0].astype(np.float64) * 2.0**40 + runs[:, 1] if n_pieces < 2**40 else None
    if keys is None:
        raise ValueError("more than 2^40 pieces: pack in several calls")
    kind = dict(pieces.dtypes)["doc_id"]
    ranked = exclusive_sums(pieces.withColumn("__one", F.lit(1)), "length", ["doc_id", "piece", "ids_crc32"],
                            "__one", "__rank", n_pieces)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = runs[np.searchsorted(keys, b["length"].to_numpy() * 2.0**40 + b["__rank"].to_numpy(), side="right") - 1]
            r = b["__rank"].to_numpy() - at[:, 1]
            yield b.drop(columns=["__one", "__rank"]).assign(
                sequence_id=at[:, 2] + r % at[:, 3], offset=at[:, 4] + r // at[:, 3] * at[:, 0])

    schema = ", ".join(f"{n} {'string' if n == 'doc_id' else t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    ranked = ranked.select(*pieces.columns, "__one", "__rank").withColumn("doc_id", F.col("doc_id").cast("string"))
    return ranked.mapInPandas(place, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``."""
    bounded_batches(docs.sparkSession)
    return pack(materialise(token_pieces(docs, doc_id, text, path, capacity, end_id), "pack-pieces"), capacity, groups)
