"""The pipeline stage by stage against brute force."""

import collections

import numpy as np

import corpus_pipeline as P
from test_text_ops import brute_groups, brute_lines

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    start = docs.toPandas()
    clean = P.drop_toxic(spark, docs, SF)
    assert clean.columns == docs.columns
    kept = clean.toPandas()
    scored = P.toxicity.score_documents(docs, spark.read.parquet(SF + "/labels.parquet").select("doc_id", "toxic")).toPandas()
    assert set(kept["doc_id"]) == set(scored[scored["predicted"] == 0]["doc_id"]) <= set(start["doc_id"])
    more = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert P.drop_toxic(spark, more, "/root/testdata/sf0.01").count() < more.count()  # too few labels in the smallest tables

    lines = P.drop_repeated_lines(spark, clean, SF)
    got = lines.toPandas()
    want = brute_lines(list(zip(kept["doc_id"], kept["text"])))
    assert lines.columns == docs.columns and {i: t for i, t in zip(got["doc_id"], got["text"])} == {i: t for i, (t, _) in want.items()}
    assert (got["n_chars"] == got["text"].str.len()).all()

    one = P.keep_one_of_group(spark, lines, SF)
    groups = brute_groups(list(zip(got["doc_id"], got["text"])))
    left = one.toPandas()
    assert sorted(left["doc_id"]) == sorted(i for i, (_, c) in groups.items() if i == c) and one.columns == docs.columns

    mixed = P.mix(spark, one, SF)
    assert mixed.columns == docs.columns
    m = mixed.toPandas()
    words = lambda f: collections.Counter({i: sum(len(t.split()) for t in g) for i, g in f.groupby("doc_id")["text"]})
    taken = P.mixing.mix_sources(one).taken().toPandas()
    assert words(m) == collections.Counter({int(i): int(t) for i, t in zip(taken["id"], taken["taken"]) if t})

    packed = P.pack(spark, mixed, SF).toPandas().sort_values(["sequence_id", "offset"])
    assert (packed["offset"] == packed.groupby("sequence_id")["length"].cumsum() - packed["length"]).all()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
    enc = P.packing.WordEncoder(P.packing.tokenizer_path())
    tokens = sum(len(np.frombuffer(b, "<u4")) + 1 for b in enc.encode(list(m["text"])))
    assert packed["length"].sum() == tokens


def test_run(spark):
    out = P.run(spark, SF)
    assert [n for n, _ in P.STAGES][0] == "toxicity" and out.count() > 0
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)


def test_repeated_rows(spark):
    """Repeats of a document leave in the near-duplicate stage; what is left
    has its own place in the mix, null ids and other sources included."""
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (None, "p q r", "a"), (None, "p q r", "a"), (None, "p q r", "b")]
    df = spark.createDataFrame([(i, t, s, len(t)) for i, t, s in rows], "doc_id long, text string, source string, n_chars int")
    left = P.keep_one_of_group(spark, df, SF)
    assert sorted((r["doc_id"] or 0, r["source"]) for r in left.collect()) == [(0, "a"), (0, "a"), (0, "b"), (1, "a")]
    mixed = P.mix(spark, df, SF)
    assert mixed.columns == df.columns
    got = collections.Counter((r["doc_id"], r["source"]) for r in mixed.collect() for _ in r["text"].split())
    taken = P.mixing.mix_sources(df)
    want, names = collections.Counter(), {s.rank: s.name for s in taken.plan}
    for r in taken.taken().collect():
        want[(r["id"], names[r["rank"]])] += r["taken"]
    assert got == +want and {s.name: s.size for s in taken.plan} == {"a": 606, "b": 303}
