"""Registered sparse-vector queries: map-column arithmetic per document and
long-form operations between tables (bag of words of ``documents``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import vectors as V
from corvid.operators import sparse_ops as S
from corvid.operators.features import bag_of_words
from corvid.plans import inputs
from corvid.plans.registry import register
from corvid.plans.sqlfrag import norm, tokens

BOW = (f"bow AS (SELECT doc_id AS row_id, word AS feature, CAST(count(*) AS DOUBLE) AS value FROM "
       f"(SELECT doc_id, {norm('t')} AS word FROM (SELECT doc_id, unnest({tokens('text')}) AS t FROM documents)) "
       f"WHERE word <> '' GROUP BY 1, 2)")
# each document paired with the next id (an equi-join on id + 1)
PAIRS = "pairs AS (SELECT DISTINCT a.row_id AS row_id FROM bow a JOIN (SELECT DISTINCT row_id FROM bow) b ON b.row_id = a.row_id + 1)"
SCALE = 2.5
KEY = "the"


def _bow(spark, sf):
    return bag_of_words(inputs.documents_by_id(spark, sf), "doc_id", "text").withColumnRenamed("doc_id", "row_id")


def _maps(spark, sf):
    return S.to_map(_bow(spark, sf))


def _pairs(spark, sf):
    m = _maps(spark, sf)
    nxt = m.select((F.col("row_id") - 1).alias("row_id"), F.col("vec").alias("vec_b"))
    return m.withColumnRenamed("vec", "vec_a").join(nxt, "row_id")


@register("bag_of_words", f"WITH {BOW} SELECT * FROM bow")
def q_bag_of_words(spark, sf):
    return _bow(spark, sf)


@register("sv_access", f"WITH {BOW} SELECT DISTINCT b.row_id, coalesce(k.value, 0.0) AS value FROM bow b "
          f"LEFT JOIN bow k ON k.row_id = b.row_id AND k.feature = '{KEY}'")
def q_sv_access(spark, sf):
    return _maps(spark, sf).select("row_id", V.sv_access("vec", KEY).alias("value"))


@register("sv_dot", f"""WITH {BOW}, {PAIRS}
SELECT p.row_id, coalesce(sum(a.value * b.value), 0.0) AS dot FROM pairs p
LEFT JOIN bow a ON a.row_id = p.row_id LEFT JOIN bow b ON b.row_id = p.row_id + 1 AND b.feature = a.feature
GROUP BY p.row_id""")
def q_sv_dot(spark, sf):
    return _pairs(spark, sf).select("row_id", V.sv_dot("vec_a", "vec_b").alias("dot"))


def _pair_union_sql(sign: str) -> str:
    return f"""WITH {BOW}, {PAIRS},
u AS (SELECT p.row_id, a.feature, a.value FROM pairs p JOIN bow a ON a.row_id = p.row_id
      UNION ALL SELECT p.row_id, b.feature, {sign}b.value FROM pairs p JOIN bow b ON b.row_id = p.row_id + 1),
s AS (SELECT row_id, feature, sum(value) AS value FROM u GROUP BY row_id, feature)
SELECT row_id, CAST(count(*) AS INTEGER) AS n_keys, sum(value) AS total, sum(abs(value)) AS l1 FROM s GROUP BY row_id"""


def _map_summary(col):
    vals = F.map_values(col)
    return [F.size(col).alias("n_keys"),
            F.aggregate(vals, F.lit(0.0), lambda a, v: a + v).alias("total"),
            F.aggregate(vals, F.lit(0.0), lambda a, v: a + F.abs(v)).alias("l1")]


@register("sv_add", _pair_union_sql(""))
def q_sv_add(spark, sf):
    return _pairs(spark, sf).select("row_id", *_map_summary(V.sv_add("vec_a", "vec_b")))


@register("sv_sub", _pair_union_sql("-"))
def q_sv_sub(spark, sf):
    return _pairs(spark, sf).select("row_id", *_map_summary(V.sv_sub("vec_a", "vec_b")))


@register("sv_scale", f"WITH {BOW} SELECT row_id, feature, value * {SCALE!r} AS value FROM bow")
def q_sv_scale(spark, sf):
    return S.from_map(_maps(spark, sf).select("row_id", V.sv_scale("vec", SCALE).alias("vec")))


@register("sv_norm", f"WITH {BOW} SELECT row_id, round(sqrt(sum(value * value)), 9) AS l2, sum(abs(value)) AS l1, "
          "max(abs(value)) AS linf FROM bow GROUP BY row_id")
def q_sv_norm(spark, sf):
    m = _maps(spark, sf)
    return m.select("row_id", F.round(V.sv_norm("vec", 2), 9).alias("l2"), V.sv_norm("vec", 1).alias("l1"),
                    V.sv_norm("vec", "inf").alias("linf"))


BENCH_BOW = (f"bb AS (SELECT word AS feature, CAST(count(*) AS DOUBLE) AS value FROM "
             f"(SELECT {norm('t')} AS word FROM (SELECT unnest({tokens('text')}) AS t FROM benchmark)) "
             f"WHERE word <> '' GROUP BY 1)")


@register("sparse_add_long", f"""WITH {BOW}, {BENCH_BOW},
u AS (SELECT feature, value FROM bow UNION ALL SELECT feature, -{SCALE!r} * value FROM bb)
SELECT feature, sum(value) AS value FROM u GROUP BY feature""")
def q_sparse_add_long(spark, sf):
    """Table-level a + s·b by feature: word counts of all documents minus 2.5 ×
    those of the benchmark texts (union of keys)."""
    a = _bow(spark, sf).select("feature", "value")
    bench = bag_of_words(spark.read.parquet(f"{sf.rstrip('/')}/benchmark.parquet").withColumn("k", F.lit(0)), "k", "text")
    return S.add_long(a, bench.select("feature", "value"), ("feature",), "value", -SCALE)
