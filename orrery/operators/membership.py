"""Referential filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> Column:
    # Null-safe: a null key refers to a null key, as a key list lookup would.
    # It also gives the join its own shuffle key, so both inputs arrive as plain
    # shuffles and adaptive execution can split a hot key.
    return left[left_key].eqNullSafe(right[right_key])


def keep_referenced(df: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Rows whose key exists in the dimension (left semi join)."""
    keys = dim.select(F.col(dim_key or key).alias("_ref"))
    return df.join(keys, _same_key(df, keys, key, "_ref"), "left_semi")


def flag_referenced(
    df: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None, flag: str = "is_referenced"
) -> DataFrame:
    """Every row, with ``flag`` telling whether its key exists in the dimension."""
    keys = dim.select(F.col(dim_key or key).alias("_ref")).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(keys, _same_key(df, keys, key, "_ref"), "left")
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_ref", "_hit")
