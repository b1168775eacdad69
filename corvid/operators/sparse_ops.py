"""Sparse vectors at table scale: long form ``(id, feature, value)``.

Per-row arithmetic on ``map<string,double>`` columns is in
``corvid.functions.vectors`` (sv_*); these are the same operations between
whole tables, as joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_map(long: DataFrame, id_col: str = "row_id", key: str = "feature", value: str = "value") -> DataFrame:
    """Long form → ``(id, vec map<string,double>)``; one group is one row's
    features, bounded by the row itself."""
    return long.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("vec"))


def from_map(df: DataFrame, id_col: str = "row_id", vec: str = "vec") -> DataFrame:
    return df.select(id_col, F.explode(vec).alias("feature", "value"))


def add_long(a: DataFrame, b: DataFrame, keys=("feature",), value: str = "value", sign: float = 1.0) -> DataFrame:
    """Union of keys, a + sign·b: ``unionByName`` then one aggregate (no outer join)."""
    keys = list(keys)
    bb = b.select(*keys, (F.col(value) * F.lit(sign)).alias(value))
    return a.select(*keys, value).unionByName(bb).groupBy(*keys).agg(F.sum(value).alias(value))
