"""Quality rules, line dedup and the Jaccard join against brute force."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from corvid.llm import common, components, jaccard_join, line_dedup, quality
from corvid.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    a = sorted(repr([r[c] for c in cols]) for r in got.collect())
    b = sorted(repr([dict(zip(names, r))[c] for c in cols]) for r in res.fetchall())
    assert a == b


# ---- quality ----------------------------------------------------------------

def brute_quality(text):
    t = text or ""
    w = WORD.findall(t)
    windows = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cov = {i + o for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for o in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(cov)


def test_quality_counts_and_edges(spark):
    texts = [None, "", " \n\t", "a", "a b c a b c", "x x x x", "x\nx\n\ny\nx", "#$ <é|> ü*", "the of and\r\n" * 30, "w\x0bv\x0cu a b",
             " ".join(f"w{i} the" for i in range(60))]
    rows = list(enumerate(texts)) + [(None, "a b"), (1, "a b")]
    got = quality.quality_rules(docs_of(spark, [(i, t, 7) for i, t in rows], "doc_id long, text string, n_words int"))
    assert got.columns.count("n_words") == 1
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect())
    assert got == collections.Counter((i, *brute_quality(t)) for i, t in rows)
    assert quality.quality_rules(docs_of(spark, [])).collect() == []


def test_quality_verdicts(spark):
    clean = " ".join(f"word{i} of the" for i in range(40))
    rows = [(1, clean), (2, " ".join(f"word{i}$$$ of### the&&&" for i in range(40))), (3, "the same words " * 60),
            (4, " ".join(f"wrt{i}" for i in range(80))), (5, "few words")]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_rules(docs_of(spark, rows)).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (True, False), 4: (False, False), 5: (True, False)}


# ---- line dedup -------------------------------------------------------------

def brute_lines(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for j in range(len(at) - 2):
            key = tuple(lines[k] for k in at[j:j + 3])
            if key in seen:
                gone |= set(range(at[j], at[j + 3] if j + 3 < len(at) else len(lines)))
            seen.add(key)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t, len(gone))
    return out


def test_line_dedup_brute_force_and_edges(spark):
    p = "one line\ntwo line\nthree line\nfour line"
    rows = [(1, "a\n" + p + "\nb"), (2, "c\n" + p + "\n\nd"), (3, p), (4, "x\nx\nx\nx\nx"), (5, "one line\ntwo line"), (6, ""),
            (7, "one line\n\ntwo line\n \nthree line\nother"), (8, p + "\n" + p)]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == brute_lines(rows)
    odd = docs_of(spark, [(None, p, 1), (9, None, 1), (9, None, 1), (10, p, 2), (10, p, 2)], "doc_id long, text string, n_removed int")
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(odd).collect()), key=repr)
    assert got == sorted([(None, p, 0), (9, None, 0), (9, None, 0), (10, "", 4), (10, "", 4)], key=repr)
    assert line_dedup.dedup_lines(docs_of(spark, [])).collect() == []


def test_line_dedup_plan_is_native(spark):
    plan = line_dedup.dedup_lines(docs_of(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# ---- Jaccard join -----------------------------------------------------------

def brute_groups(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[a]:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(n_groups=4, copies=40, words=120):
    import random

    rng, rows = random.Random(5), []
    passage = [f"p{k}" for k in range(60)]
    for g in range(n_groups):
        base = [f"g{g}w{rng.randrange(900)}" for _ in range(words)]
        for c in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            if c % 5 == 0:
                w = w + passage
            rows.append((len(rows) + 1, " ".join(w)))
    for k in range(60):  # a passage in otherwise different texts
        rows.append((len(rows) + 1, " ".join(passage + [f"u{k}x{j}" for j in range(rng.choice([3, 8, 14, 30]))])))
    return rows


@pytest.mark.parametrize("stars", [2, 0])
def test_groups_equal_brute_force(spark, monkeypatch, stars):
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", stars)
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(jaccard_join, "BUCKET_TOKENS", 900)
    rows = near_copies()
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(docs_of(spark, rows)).collect()}
    assert got == brute_groups(rows)


def test_groups_edges(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE\ttwo"), (5, "one two three"), (6, "a b c d e"), (7, "A b c d e"), (8, " \n"),
            (9, "é b c d e"), (10, "É b c d e")]
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(docs_of(spark, rows)).collect()}
    assert got == brute_groups(rows)
    odd = docs_of(spark, [(None, "x y z"), (4, "x y z"), (4, "x y z"), (4, "other"), (3, "x y z"), (2**62 + 1, "far")])
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(odd).collect()), key=repr)
    assert got == sorted([(None, 1, None), (4, 1, 3), (4, 1, 3), (4, 1, 4), (3, 1, 3), (2**62 + 1, 1, 2**62 + 1)], key=repr)
    assert jaccard_join.similar_groups(docs_of(spark, [])).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 77)] + [(200, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 77: 50, 100: 50}


def test_exclusive_sums(spark):
    df = spark.createDataFrame([(k % 3 or None, k, 1 + k % 4) for k in range(500)], "key int, id long, v int")
    got = common.exclusive_sums(df, "key", ["id"], "v", "before", 500, 30).toPandas()
    for _, g in got.groupby("key", dropna=False):
        g = g.sort_values("before")
        assert list(g["before"]) == list(g["v"].cumsum() - g["v"])
    assert F.col is not None


def test_repeated_rows_spread_over_blocks(spark):
    rows = [(7, "the same text in every row")] * 3000 + [(None, "without an id")] * 1500 + [(i, f"text {i} of its own") for i in range(100, 1600)]
    df = docs_of(spark, rows).repartition(3)
    written = common.materialise(jaccard_join.salted(df, "doc_id", "text"), "test-rows")
    held = jaccard_join.blocked(written, 30).groupBy("block").count().collect()
    assert sum(r["count"] for r in held) == 6000 and max(r["count"] for r in held) < 2 * 200
