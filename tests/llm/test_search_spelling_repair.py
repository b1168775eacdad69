"""Block matrix join, spelling variants and conversation repair against brute
force, on small tables with the cases their docstrings define."""

import hashlib
import heapq
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import block_search as B
from corvid.llm import conversation_repair as R
from corvid.llm import spelling as S


# ---- block matrix join ------------------------------------------------------------
def nearest_plain(rows, k=5):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    for q in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        a = np.array([q[1]])
        scores = []
        for i, v in ok:
            if i != q[0] and len(v) == len(q[1]):
                c = B.cosine(B.Coded(a), np.array([0]), B.Coded(np.array([v])), np.array([0]))[0]
                scores.append((-c, i))
        for r, (s, i) in enumerate(sorted(scores)[:k]):
            out.add((q[0], r + 1, i, -s))
    return out


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(B, "SLAB", 40)
    monkeypatch.setattr(B, "QUERY_GROUP", 3)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(4, 8))
    rows = [(i, (centre[i % 4] + rng.normal(size=8) * (1e-3 if i % 4 == 0 else 0.5)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(60)]                       # copies of a query's vector
    rows += [(2000 + i, [x * 2 for x in rows[100][1]]) for i in range(20)]     # the same direction: ties
    rows += [(100, rows[100][1]), (100, rows[7][1]), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(None, [1.0] * 8), (3000, None), (3050, [0.0] * 8), (3100, [1.0] * 7 + [None]), (3150, [float("nan")] + [1.0] * 7), (3200, []),
             (3250, [float("inf")] + [1.0] * 7), (3300, [1.0, 2.0]), (3301, [2.0, 1.0]), (3350, [1e200] * 8), (3351, [1e-200] * 8), (3400, [5.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, key string")
    got = {tuple(r) for r in B.nearest(df, F.col("vec_id") % 50 == 0).collect()}
    assert got == nearest_plain(rows)
    assert B.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(3000, 1500)) * rng.lognormal(size=(3000, 1))
    a, b = B.Coded(v[:20]), B.Coded(v)
    est, err = B.tile_bounds(a, slice(0, 20), b, slice(0, 3000))
    true = (v[:20] / np.linalg.norm(v[:20], axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    assert (np.abs(est - true) <= err).all() and err.max() < 0.05
    w = rng.normal(size=(6000, 64))
    best = B.Best(np.arange(30), w[:30], 6)
    for k in range(0, 6000, 2000):
        best.add(np.arange(k, k + 2000), np.arange(k, k + 2000), w[k:k + 2000])
    assert best.recomputed < 0.02 * 30 * 6000
    cos = (w[:30] / np.linalg.norm(w[:30], axis=1)[:, None]) @ (w / np.linalg.norm(w, axis=1)[:, None]).T
    for q, heap in enumerate(best.heaps):
        assert sorted(e[2] for e in heap) == sorted(np.argsort(-cos[q])[:6].tolist())


# ---- spelling ---------------------------------------------------------------------
def variants_plain(docs):
    c = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    v = {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}

    def is_near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    near = {w: [x for x in v if x != w and is_near(w, x)] for w in v}
    best = {w: min(xs, key=lambda x: (-v[x], x)) for w, xs in near.items() if xs}
    form = {w: b for w, b in best.items() if v[b] >= 2 * v[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n, len(near[w]), v.get(form.get(w))) for w, n in v.items()}


def word_docs():
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abcdeéß×"), rng.integers(4, 9))) for _ in range(60)]
    words = list(base)
    for w in base:
        for _ in range(6):
            k, x = int(rng.integers(0, len(w))), str(rng.choice(list("abcé÷")))
            words.append([w[:k] + w[k + 1:], w[:k] + x + w[k:], w[:k] + x + w[k + 1:]][int(rng.integers(0, 3))])
    texts = [" ".join(np.concatenate([rng.choice(words, 200), np.repeat(rng.choice(words, 10), 40)])) for _ in range(25)]
    docs = [(i, t if i % 3 else t.upper().replace("SS", "ß")) for i, t in enumerate(texts)]
    return docs + [(3, texts[3]), (None, texts[4]), (90, None), (91, ""), (92, "1 2 3!"), (93, "lang" * 3000 + " " + "aaaaa aaaaaa aaaaaaa " * 7)]


@pytest.mark.parametrize("levels, block", [(8, 100_000), (8, 40), (2, 25), (1, 5)])
def test_variants_equal_brute_force(spark, levels, block):
    """Shares by no, some and all levels, and by halves beyond them."""
    docs = word_docs()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n int")
    got = S.variants(df, levels=levels, block=block).collect()
    assert len({r["word"] for r in got}) == len(got)
    assert {tuple(r) for r in got} == variants_plain(docs)


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert S.variants(df).collect() == [] and S.variants(df.limit(0)).collect() == []


def test_crc_in_sql():
    con = duckdb.connect()
    for text in ("1:a", "12:été", "7:abcÿ÷"):
        got = con.execute(f"SELECT {S.crc_sql('x')} FROM (SELECT ? AS x) z, {S.CRC_TABLE_SQL} t", [text]).fetchone()[0]
        assert got == zlib.crc32(text.encode())


# ---- conversation repair ------------------------------------------------------------
PATTERN = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """Least (cost, audit, rows) over edits and insertions, by cheapest-first search
    over (rows done, initials so far); the pattern is only tested at the end."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, made, out = heapq.heappop(heap)
        if (i, made) in seen:
            continue
        seen.add((i, made))
        if i == len(rows) and PATTERN.fullmatch(made):
            return cost, audit, out
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, made, out))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, made + (role[:1] or "-"), out + ((role, text),)))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, made + r[0], out + ((r, text),)))
        if len(made) < len(rows) + 2:
            for r in ("user", "assistant"):
                heapq.heappush(heap, (cost + 5, audit + "I", i, made + r[0], out + ((r, ""),)))


def repair_plain(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        told = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        h = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", told[3]) if h == 2 else told[3]
        convs[conv] += [(turn, "user" if h == 4 else told[2], text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = set()
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).digest()))
        seen, told = set(), []
        for turn, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            told.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
            seen.add((role, text))
        turns = [r[0] for r in kept if r[0] is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(told))
        cost, audit, made = cheapest(told)
        count = Counter(t[2] for t in told)
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out.add((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
                 illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def conversations():
    rng = np.random.default_rng(6)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "maybe", "", " \t", None, "Why? \n", "a.b", "x" * 70 + "1.", "x" * 70 + "2."]
    rows = []
    for conv in range(40):
        n = int(rng.integers(1, 9))
        for turn in range(n):
            rows.append((conv, int(turn + 2 * (turn > 4)) if rng.random() < 0.9 else None, str(r) if (r := rng.choice(roles)) is not None else None,
                         str(t) if (t := rng.choice(texts)) is not None else None))
    return rows + [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, 2, None, None)] + rows[:5] + [(2**62, 0, "user", "Big id.")]


@pytest.mark.parametrize("segment, fan", [(4096, 16), (2, 2), (1, 3)])
def test_repair_equals_brute_force(spark, segment, fan):
    rows = conversations()
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, idx int")
    got = {tuple(r) for r in R.repair(df, segment=segment, fan=fan).collect()}
    assert got == repair_plain(rows)


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair(df).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert tuple(R.repair(df).first()) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_cells_do_not_depend_on_the_split():
    """One split per span gives what all splits give."""
    rng = np.random.default_rng(8)
    rows = [R.row_cells(str(rng.choice(list("suat"))), str(rng.choice(["", "", "truncated", "blank"]))) for _ in range(9)]
    cell = {(i, i + 1): rows[i] for i in range(9)}
    for n in range(2, 10):
        for i in range(10 - n):
            splits = [R.combine(cell[i, k], cell[k, i + n]) for k in range(i + 1, i + n)]
            assert all(s == splits[0] for s in splits)
            cell[i, i + n] = splits[0]
    assert R.parse(rows) == cell[0, 9]
