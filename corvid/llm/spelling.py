"""Spelling variants: words one edit apart, found with a frequency-vector trie.

The letters of the vocabulary are dealt into ``LEVELS`` groups of about equal
weight. A word's vector counts its letters of each group; the trie has one level
per group and branches on the count, so its leaves hold the words of one vector. An
inserted letter raises one count by one (a surplus), a replaced one moves one
letter from a group to another or within its group (a surplus and a deficit, or
neither). The search for the partners of a vector walks the trie depth first with
a budget of one surplus and one deficit; words of the leaves it reaches are
verified. Each pair is found once, from its shorter (or smaller) word.

The vocabulary is no one task's: words are dealt by the first levels of their path
(as many as bring the largest share below ``BLOCK`` words, counted over all words),
and a word asks every share that its budget can reach. A share that is still
larger with all levels is dealt further by halves of its words: one edit leaves the
first or the second half of the shorter word intact, so partners share a half. The
same halves index a leaf, so no leaf compares all its words with each other.

Defined cases: null and empty texts hold no words; a null doc_id counts as empty
text in the checksum; repeated rows count as often as they are there; ties of n go
to the smaller word in code-point order; forms have at least twice the word's n, so
following them ends; an empty table gives no rows; extra columns do not matter;
a run may be as long as a text.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import materialise

# Fixed values of the contract: letters of a run, and which runs lose a letter.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 97
MIN_LETTERS, MIN_COUNT = 5, 3

LEVELS = 8
BLOCK = 100_000  # words of a share

PAIR = "word string, near string, n long, near_n long"


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word)`` per run of letters of every text, after the contract's losses."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    run = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                      F.explode(F.split(low, f"[^{LETTERS}]+")).alias("run")).where("run <> ''")
    run = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return run.select(F.when(F.col("h") % DROP_EVERY == 0, lost).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: words with enough letters and occurrences, over all texts."""
    words = runs(docs, doc_id, text).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def letter_groups(words: DataFrame, levels: int = LEVELS) -> list[str]:
    """Letters dealt into groups of about equal weight (occurrences in distinct
    words). There are at most as many rows as letters."""
    weights = (words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").count()
               .orderBy(F.desc("count"), "c").collect())
    heap = [(0, k) for k in range(levels)]
    groups = [""] * levels
    for r in weights:
        total, k = heapq.heappop(heap)
        groups[k] += r["c"]
        heapq.heappush(heap, (total + r["count"], k))
    return groups


def count_of(word: str, letters: str) -> Column:
    """How many characters of ``word`` are among ``letters``."""
    return (F.length(word) - F.length(F.translate(F.col(word), letters, ""))) if letters else F.lit(0)


def one_edit(a: str, b: str) -> bool:
    """Whether one replaced code point, or one more in ``b``, is all that differs."""
    n, i = len(a), 0
    while i < n and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] if len(b) > n else i < n and a[i + 1:] == b[i + 1:]


class Leaf:
    """Words of one vector, by the halves that an edit leaves intact."""

    def __init__(self):
        self.words: list[tuple[str, int]] = []
        self.same = self.longer = None

    def partners(self, word: str, more: int):
        """Words of this leaf, with ``more`` letters than ``word``, one edit away."""
        index = self.longer if more else self.same
        if index is None:
            index = defaultdict(list)
            for entry in self.words:
                h = (len(entry[0]) - more) // 2
                index[0, entry[0][:h]].append(entry)
                index[1, entry[0][h + more:]].append(entry)
            if more:
                self.longer = index
            else:
                self.same = index
        h = len(word) // 2
        first, second = index.get((0, word[:h]), ()), index.get((1, word[h:]), ())
        seen = set()
        for entry in (*first, *second):
            if entry[0] not in seen and one_edit(word, entry[0]):
                seen.add(entry[0])
                yield entry


def build(words: list[str], counts: list[int], vectors: list[tuple]) -> dict:
    """The trie: a level per letter group, leaves at the end."""
    root: dict = {}
    for word, n, vector in zip(words, counts, vectors):
        node = root
        for c in vector[:-1]:
            node = node.setdefault(c, {})
        leaf = node.get(vector[-1])
        if leaf is None:
            leaf = node[vector[-1]] = Leaf()
        leaf.words.append((word, n))
    return root


def reach(root: dict, vector: tuple) -> list[tuple[Leaf, int]]:
    """(leaf, letters more) of the leaves within one surplus and one deficit, where
    a deficit is made up for by a surplus: partners are never shorter."""
    out, stack, last = [], [(root, 0, 0, 0)], len(vector)
    while stack:
        node, level, up, down = stack.pop()
        if level == last:
            if up >= down:
                out.append((node, up - down))
            continue
        c = vector[level]
        child = node.get(c)
        if child is not None:
            stack.append((child, level + 1, up, down))
        if not up and (child := node.get(c + 1)) is not None:
            stack.append((child, level + 1, 1, down))
        if not down and (child := node.get(c - 1)) is not None:
            stack.append((child, level + 1, up, 1))
    return out


def _columns(part: pd.DataFrame, levels: int) -> list[tuple]:
    return list(zip(*(part[f"c{k}"].tolist() for k in range(levels))))


def search_share(asked: pd.DataFrame, held: pd.DataFrame, levels: int) -> pd.DataFrame:
    rows = []
    root = build(held["word"].tolist(), held["n"].tolist(), _columns(held, levels))
    by_vector = defaultdict(list)
    for word, n, vector in zip(asked["word"].tolist(), asked["n"].tolist(), _columns(asked, levels)):
        by_vector[vector].append((word, n))
    for vector, words in by_vector.items():
        for leaf, more in reach(root, vector):
            for word, n in words:
                for near, near_n in leaf.partners(word, more):
                    if more or word < near:
                        rows.append((word, near, n, near_n))
    return pd.DataFrame(rows, columns=["word", "near", "n", "near_n"])


def _halves(word: Column, of: Column, more: int) -> list[Column]:
    """The two halves that a partner of ``of`` letters can share with ``word``."""
    h = F.floor(of / 2).cast("int")
    return [F.concat(F.lit("0"), F.substring(word, F.lit(1), h)), F.concat(F.lit("1"), F.substring(word, h + 1 + more, F.length(word)))]


def near_pairs(words: DataFrame, levels: int = LEVELS, block: int = BLOCK) -> DataFrame:
    """``(word, near, n, near_n)``: each pair of words one edit apart, once, the
    shorter (or smaller) word first. ``words (word, n)`` are distinct."""
    groups = letter_groups(words, levels)
    names = [f"c{k}" for k in range(levels)]
    v = materialise(words.select("word", "n", *[count_of("word", g).cast("int").alias(c) for c, g in zip(names, groups)]), "spelling-vectors")
    # The largest share at every depth, from one roll-up of the distinct vectors.
    depth = F.lit(levels) - F.aggregate(F.array(*[F.grouping(c).cast("int") for c in names]), F.lit(0), lambda a, x: a + x)
    sizes = (v.groupBy(*names).count().rollup(*names).agg(F.sum("count").alias("m"), depth.alias("depth"))
             .groupBy("depth").agg(F.max("m").alias("m")).collect())
    largest = {r["depth"]: r["m"] or 0 for r in sizes}
    depth = next((k for k in range(levels) if largest.get(k, 0) <= block), levels)
    pieces = max(1, -(-largest.get(depth, 0) // block)) if depth == levels else 1
    path = names[:depth]
    share = lambda moves: F.array(*[F.col(c) + F.lit(moves.get(k, 0)) for k, c in enumerate(path)]).cast("array<int>")
    # One surplus and one deficit, either of them perhaps below the levels of the path.
    moves = [{}] + [{k: m} for k in range(depth) for m in (1, -1)] + [{a: 1, b: -1} for a in range(depth) for b in range(depth) if a != b]
    ask = F.explode(F.array(*[share(m) for m in moves]))
    word, n = F.col("word"), F.length("word")
    piece = lambda keys: F.explode(F.array_distinct(F.array(*[F.pmod(F.xxhash64(k), F.lit(pieces)).cast("int") for k in keys])))
    none = F.lit(0)
    held = v.select("*", share({}).alias("share"), none.alias("piece"))
    asked = v.select("*", ask.alias("share"), none.alias("piece"))
    if pieces > 1:
        held = held.withColumn("piece", piece(_halves(word, n, 0) + _halves(word, n - 1, 1)))
        asked = asked.withColumn("piece", piece(_halves(word, n, 0)))

    def search(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return search_share(a, b, levels) if len(a) and len(b) else pd.DataFrame(columns=["word", "near", "n", "near_n"])

    got = asked.groupBy("share", "piece").cogroup(held.groupBy("share", "piece")).applyInPandas(search, PAIR)
    return got.distinct() if pieces > 1 else got


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form: pointers are doubled until each points
    at a word without one. n doubles at least with every step, so few rounds do."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        at = materialise(at.join(step, F.col("root") == F.col("__w"), "left")
                         .select("word", F.coalesce("__r", "root").alias("root"), F.col("__w").isNotNull().alias("moved")), "spelling-roots")
        if not at.agg(F.max("moved")).first()[0]:
            return at.select("word", "root")
        at = at.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", levels: int = LEVELS, block: int = BLOCK) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the vocabulary."""
    words = materialise(vocabulary(docs, doc_id, text), "spelling-words")
    pairs = materialise(near_pairs(words, levels, block), "spelling-pairs")
    both = pairs.select("word", "near", "near_n").union(pairs.select("near", "word", "n"))
    # The near word of largest n, the smallest of equals: the least of (-n, word).
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    told = words.join(best, "word", "left")
    form = F.when(-F.col("b.m") >= 2 * F.col("n"), F.col("b.w"))
    told = materialise(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
                                   F.when(form.isNotNull(), -F.col("b.m")).cast("long").alias("form_n")), "spelling-forms")
    out = told.join(_roots(told.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The checksum byte by byte: DuckDB has none. Letters beyond ASCII take two bytes.
CRC_TABLE_SQL = """(SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def crc_sql(text: str) -> str:
    """CRC-32 of a text of code points below 2048, with ``crc`` the table's column."""
    data = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] "
            "ELSE [CAST(192 + (ord(c) >> 6) AS BIGINT), CAST(128 + (ord(c) & 63) AS BIGINT)] END))")
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"


VARIANTS_SQL = f"""
WITH RECURSIVE t AS {CRC_TABLE_SQL},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[{LETTERS}]+')) AS run FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS m FROM runs GROUP BY ALL),
summed AS (SELECT run, m, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM per_doc, t),
changed AS (SELECT CASE WHEN h % {DROP_EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM summed),
v AS MATERIALIZED (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM changed WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(m) >= {MIN_COUNT}),
del AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
shorter AS (SELECT DISTINCT del.word AS a, v.word AS b FROM del JOIN v ON del.d = v.word),
near AS (SELECT DISTINCT x.word AS a, y.word AS b FROM del x JOIN del y ON x.i = y.i AND x.d = y.d AND x.word <> y.word
         UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
ranked AS (SELECT near.a, near.b, v.n, count(*) OVER (PARTITION BY near.a) AS n_near, row_number() OVER (PARTITION BY near.a ORDER BY v.n DESC, near.b) AS r
           FROM near JOIN v ON v.word = near.b),
told AS MATERIALIZED (SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 2 * v.n THEN r.b END AS form,
         CASE WHEN r.n >= 2 * v.n THEN r.n END AS form_n FROM v LEFT JOIN ranked r ON r.a = v.word AND r.r = 1),
walk(word, top) AS (SELECT word, word FROM told UNION ALL SELECT walk.word, told.form FROM walk JOIN told ON told.word = walk.top WHERE told.form IS NOT NULL)
SELECT told.word, told.form, walk.top AS root, told.n, told.n_near, told.form_n
FROM told JOIN walk ON walk.word = told.word JOIN told last ON last.word = walk.top WHERE last.form IS NULL"""
