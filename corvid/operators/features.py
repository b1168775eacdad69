"""Feature preparation: bag of words, one-hot sparse rows, degree-2 expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import WHITESPACE, normalize_word


def bag_of_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, feature, value)``: count of each normalised word (empty word
    dropped) — the long form of a sparse vector per row."""
    w = (df.select(id_col, F.explode(F.split(text_col, WHITESPACE)).alias("t")).where(F.col("t") != "")
         .select(id_col, normalize_word("t").alias("feature")))
    return (w.where(F.col("feature") != "").groupBy(id_col, "feature")
            .agg(F.count(F.lit(1)).cast("double").alias("value")))


def onehot_sparse(df: DataFrame, id_col: str, attr_cols) -> DataFrame:
    """``(id, feature, value)`` with feature ``<attr>_<value>`` and value 1.0:
    unpivot (``stack``) of the categorical columns, no Python."""
    attr_cols = list(attr_cols)
    long = df.unpivot([id_col], attr_cols, "attr", "val")
    return long.select(id_col, F.concat_ws("_", "attr", F.col("val").cast("string")).alias("feature"),
                       F.lit(1.0).alias("value"))


def poly2_features(x) -> F.Column:
    """Degree-2 expansion of an array: x followed by x_i·x_j for i ≤ j in row order."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.size(x)
    prods = F.flatten(F.transform(F.sequence(F.lit(0), n - 1),
                                  lambda i: F.transform(F.sequence(i, n - 1),
                                                        lambda j: x[i] * x[j])))
    return F.when(n == 0, x).otherwise(F.concat(x, prods))
