"""Cohorts kept up month by month: a load reads its months and the bitmaps, never the earlier facts.

Below a folder lie ``activity``, the entities' month bitmaps as a published version, and ``amounts``, a folder a month with
one row per entity. Months may come late, again or corrected: a load replaces its months, and an amount counts only where
the bitmap has its month, so what a repeated load no longer holds is gone. One load at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.dates import month_start
from orrery.operators.activity import cohorts_of_bits, merge_months, month_bits, monthly_amounts
from orrery.sources.versions import NoVersion, open_set, publish_set


def _months(path: str) -> str:
    return f"{path}/amounts"


def load_months(
    facts: DataFrame, path: str, first: dt.date, last: dt.date, entity: str, day: str, value: str | None = None
) -> None:
    """Take the months from ``first`` to ``last`` (any day of each) from ``facts`` in the place of those held.

    The amounts come first and the bitmaps make them count, so a load that died between the two can be repeated.
    """
    spark = facts.sparkSession
    within = month_start(F.col(day)).between(*(F.lit(d.replace(day=1).isoformat()).cast("date") for d in (first, last)))
    monthly = monthly_amounts(facts.where(within), entity, day, value)
    if value:
        spread = monthly.hint("rebalance", "month")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(_months(path))
    new = month_bits(monthly)
    try:
        held = open_set(spark, path)["activity"]
    except NoVersion:
        held = new.limit(0)
    publish_set({"activity": merge_months(held, new, first, last)}, path)


def stored_cohorts(spark: SparkSession, path: str, with_amounts: bool = False) -> DataFrame:
    """The columns of ``monthly_cohorts`` over all loaded months, from the stored state alone."""
    amounts = spark.read.parquet(_months(path)) if with_amounts else None
    return cohorts_of_bits(open_set(spark, path)["activity"], amounts)
