"""Text functions and readability against fixed input/output cases and plain Python."""

import pytest
from pyspark.sql import functions as F

from corvid.functions import text as T
from corvid.operators import readability as R
from corvid.sources.text import read_lines, read_word_list

# Fixed input/output cases of the string functions.
STRIP_CASES = [("!_2bob_@", "bob"), ("1haven't", "haven't"), ("nowhere@gmail.com\\..", "nowhere@gmail.com"),
               ("", ""), ("12321.@3", ""), ("1a", "a"), ("a", "a")]
INFL_CASES = [("barts2", "barts", True), ("mope", "moped", True), ("Mill", "Mill's", True), ("raves", "rave", False)]
SAME_CASES = [("barts", "barts2", True), ("moped", "moped", True), ("Mill's", "Mill", True), ("raves", "rave", True),
              ("rav312", "rave", False), ("3_lord", "rave", False)]


def test_strip_non_alpha(spark):
    df = spark.createDataFrame(STRIP_CASES, "s string, want string")
    got = df.select("want", T.strip_non_alpha("s").alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got)


def test_is_inflection_and_same(spark):
    df = spark.createDataFrame(INFL_CASES, "a string, b string, want boolean")
    assert all(r[0] == r[1] for r in df.select(T.is_inflection_of("a", "b"), "want").collect())
    df = spark.createDataFrame(SAME_CASES, "a string, b string, want boolean")
    assert all(r[0] == r[1] for r in df.select(T.same_word("a", "b"), "want").collect())


def test_find_match(spark):
    easy = spark.createDataFrame([("barts",), ("barted",), ("farted",)], "word string")
    words = spark.createDataFrame([("bart",), ("barter",)], "word string")
    got = {r["word"]: r["matches"] for r in R.find_match(words, easy).collect()}
    assert sorted(got["bart"]) == ["barted", "barts"]
    assert got["barter"] is None


def test_tokens_match_python_split(spark):
    texts = ["a  b\tc d e", "  lead and trail  ", "", "x\x1cy　z", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.tokens("t")).collect()]
    assert got == [t.split() for t in texts]


def test_split_lines_like_text_reader(spark):
    texts = ["a\nb", "a\r\nb\rc", "a\n", "a\n\n", "", "\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.sentence_count("t")).collect()]
    assert got == [2, 3, 1, 2, 0, 1]


def _same(a, b):
    return any(x == y or y in [x + e for e in T.INFLECTION_ENDINGS] for x, y in ((a, b), (b, a)))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Six documents and a word list as text files, and what a nested loop in
    plain Python says about them."""
    from conftest import SF_SMALL
    from corvid.plans import inputs

    docs = inputs.documents(spark, SF_SMALL).orderBy("doc_id").limit(6).collect()
    base, want = tmp_path_factory.mktemp("texts"), {}
    easy = sorted({w for d in docs[:3] for w in map(_py_normalize, d["text"].split()[:60]) if w})
    (base / "easy.txt").write_text("".join(f" {w}\t\n" for w in easy), encoding="utf-8")
    for d in docs:
        (base / f"d{d['doc_id']}.txt").write_text(d["text"], encoding="utf-8")
        words = [_py_normalize(w) for w in d["text"].split()]
        hard = {w: not any(_same(w, e) for e in easy) for w in set(words)}
        lines = d["text"].split("\n")
        want[f"d{d['doc_id']}.txt"] = (len(lines), len(words), len(set(words)), sum(hard[w] for w in words))
    return str(base), easy, want


def test_readability_of_files(spark, files):
    base, easy, want = files
    keys = R.easy_keys(read_word_list(spark, f"{base}/easy.txt"))
    lines = read_lines(spark, [f"{base}/{f}" for f in want])
    for broadcast in (True, False):
        got = {r["file"].rsplit("/", 1)[1]: r for r in R.readability(lines, keys, ["file"], "line", rows_are_lines=True, broadcast=broadcast).collect()}
        assert {f: (r["sentences"], r["words"], r["difficult"]) for f, r in got.items()} == {f: (s, w, d) for f, (s, w, _, d) in want.items()}
        for f, (s, w, _, d) in want.items():
            assert got[f]["dcf"] == pytest.approx(0.1579 * (d / w) * 100 + 0.0496 * (w / s))
    u = {r["file"].rsplit("/", 1)[1]: r["unique_words"] for r in R.unique_words(lines, ["file"], "line").collect()}
    assert u == {f: n for f, (_, _, n, _) in want.items()}


def test_top_words_of_files(spark, files):
    import collections

    base, _, want = files
    lines = read_lines(spark, [f"{base}/{f}" for f in want])
    counts = collections.Counter(_py_normalize(w) for f in want for w in open(f"{base}/{f}", encoding="utf-8").read().split())
    top = R.top_words(R.compute_counts(lines, (), "line", num_partitions=3), 5).collect()
    assert [(r["word"], r["n"]) for r in top] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:5]


def test_easy_keys_are_the_closure(spark, files):
    base, easy, _ = files
    keys = {r["word"] for r in R.easy_keys(read_word_list(spark, f"{base}/easy.txt")).collect()}
    want = set(easy) | {w + e for w in easy for e in T.INFLECTION_ENDINGS}
    want |= {w[:-len(e)] for w in easy for e in T.INFLECTION_ENDINGS if w.endswith(e)}
    assert keys == want


def test_readability_partition_invariant(spark):
    from corvid.plans import inputs
    from conftest import SF_SMALL
    docs = inputs.documents(spark, SF_SMALL)
    keys = R.easy_keys(inputs.easy_words(spark, SF_SMALL))
    a = R.dale_chall(docs, keys).first()
    b = R.dale_chall(docs.repartition(7), keys).first()
    assert a == b


def _py_normalize(s):
    low = s.lower()
    i, j = 0, len(low)
    while i < j and not ("a" <= low[i] <= "z" or "A" <= low[i] <= "Z"):
        i += 1
    while j > i and not ("a" <= low[j - 1] <= "z" or "A" <= low[j - 1] <= "Z"):
        j -= 1
    return low[i:j]


def test_normalize_fast_path_is_the_strip(spark):
    """The letter-ends fast path gives exactly lower-then-strip, on ASCII
    (checked against Python) and on mixed Unicode (checked against the regex)."""
    from hypothesis import given, settings, strategies as st

    words = st.text(alphabet=st.sampled_from(list("aZz.-'_1 ") + ["é", "É", "“", "—", "ß", "K", "ı", "😀"]),
                    max_size=8)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(words, min_size=50, max_size=200))
    def check(ws):
        df = spark.createDataFrame([(w,) for w in ws], "w string")
        got = df.select("w", T.normalize_word("w").alias("fast"),
                        T.strip_non_alpha(T.to_lower_case("w")).alias("slow")).collect()
        for r in got:
            assert r["fast"] == r["slow"]
            if r["w"].isascii():
                assert r["fast"] == _py_normalize(r["w"])

    check()


def test_words_of_a_document_are_grouped_where_its_text_is(spark, tmp_path, monkeypatch):
    """Bags, maps and token counts shuffle texts once and no words, in tasks that follow
    the bytes; ids may repeat or be null (F6, F7, F10, F16, F22)."""
    from corvid.operators import sparse_ops as S
    from corvid.operators.features import bag_of_words
    from corvid.plans import inputs, q_text
    from corvid.sources import text as ST

    rows = [(k % 40 if k % 11 else None, f"a b{k % 3}, a\nc" * 50) for k in range(120)]
    spark.createDataFrame([(i, "s", t) for i, t in rows], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(ST, "TEXT_PER_TASK", sum(len(t) for _, t in rows) // (3 * cores))
    maps = S.to_map(bag_of_words(inputs.documents_by_id(spark, str(tmp_path)), "doc_id", "text"), "doc_id")
    plan = maps._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and maps.rdd.getNumPartitions() >= 3 * cores
    got = {(r["doc_id"], r["token"]): r["n"] for r in q_text.q_tokenize(spark, str(tmp_path)).collect()}
    want = {}
    for i, t in rows:
        for w in t.split():
            want[i, w] = want.get((i, w), 0) + 1
    assert got == want


def test_partitions_of_the_sweep_are_read_in_slices(spark, monkeypatch):
    """A partition is several tasks where its texts are many; all rows are scored, null
    and empty texts and equal rows included."""
    words = spark.createDataFrame([("the",), ("sea",)], "word string")
    rows = [(i % 7, None if i % 11 == 0 else "" if i % 13 == 0 else f"the sea is w{i}\nand w{i % 5} seas") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = R.dale_chall(df, R.easy_keys(words)).first()["dcf"]
    tasks, score = [], R.readability

    def watched(d, *more, **named):
        tasks.append(d.rdd.getNumPartitions())
        return score(d, *more, **named)

    monkeypatch.setattr(R, "readability", watched)
    monkeypatch.setattr(R, "SLICE_BYTES", 1000, raising=False)
    got = R.partition_sweep(df, R.easy_keys(words), (2, 5)).collect()
    assert [(r["n_partitions"], r["n_used"]) for r in got] == [(2, 2), (5, 5)]
    assert all(r["dcf"] == want for r in got)
    size = sum(len(t or "") for _, t in rows)
    assert all(n * 1000 >= size for n in tasks), tasks


def test_sweep_of_no_rows(spark):
    words = spark.createDataFrame([("the",)], "word string")
    got = R.partition_sweep(spark.createDataFrame([], "doc_id long, text string"), R.easy_keys(words), (2,)).first()
    assert (got["n_partitions"], got["n_used"], got["dcf"]) == (2, 0, None)
