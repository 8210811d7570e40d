"""Reading the tables, hash folds and other small helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """Remainder by ``n`` of the CRC-32 of the key written as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def sample_rows(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, the same ones on every run: those with the smallest hash of ``key``."""
    return df.orderBy(F.xxhash64(F.lit(17), key), key).limit(limit)
