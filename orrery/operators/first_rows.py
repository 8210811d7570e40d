"""Keep-first deduplication with an explicit row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROW_ORDER = "_row_order"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order; null keys form one group.

    The rank-1 filter lets Spark plan a group limit before the shuffle, so each
    map task sends at most one row per key and a hot key costs no more than any
    other.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def flag_repeats(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str = "is_repeat", salts: int = 256
) -> DataFrame:
    """Every row, with ``flag`` true on all but the first row of its key.

    Rows are ranked inside (key, salt) first, so a key that owns a large part of
    the table is spread over ``salts`` groups; only the leader of each salted
    group, at most ``salts`` rows per key, meets in the second ranking.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    inner = W.partitionBy(*keys, "_salt").orderBy(*order)
    led = salted.withColumn("_leads", F.row_number().over(inner) == 1)
    # Followers stay apart, each in its own salted group.
    led = led.withColumn("_pool", F.when(F.col("_leads"), F.lit(-1)).otherwise(F.col("_salt")))
    outer = W.partitionBy(*keys, "_pool").orderBy(*order)
    ranked = led.withColumn("_rank", F.row_number().over(outer))
    return ranked.withColumn(flag, ~(F.col("_leads") & (F.col("_rank") == 1))).drop(
        "_salt", "_leads", "_pool", "_rank"
    )
