"""Monthly cohorts: who came back, and with how much, in each later month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orrery.functions.dates import month_label, month_offset, month_start


def monthly_cohorts(df: DataFrame, entity: str, day: str, value: str | None = None) -> DataFrame:
    """``cohort_month, cohort_size, month_index, active`` (and ``total, initial_total``).

    Rows collapse to one per (entity, month) in the first aggregation, map-side,
    so the per-entity window sees at most one row per calendar month however
    active the entity is. Everyone in a cohort is active in its month 0, hence
    the cohort's size and starting value are its month-0 row. Rows without an
    entity belong to no cohort.
    """
    amount = F.sum(value) if value else F.lit(None)
    known = df.filter(F.col(entity).isNotNull())
    monthly = known.groupBy(entity, month_start(F.col(day)).alias("_month")).agg(
        F.count("*").alias("_rows"), amount.alias("_total")
    )
    started = monthly.withColumn("_start", F.min("_month").over(W.partitionBy(entity)))
    grid = (
        started.filter(F.col("_start").isNotNull())
        .groupBy("_start", month_offset(F.col("_month"), F.col("_start")).alias("month_index"))
        .agg(F.count(entity).alias("active"), F.sum("_total").alias("total"))
    )
    return cohort_table(grid)


def cohort_table(grid: DataFrame) -> DataFrame:
    """Cohort sizes and starting values beside a grid of ``_start, month_index, active, total``."""
    cohort = W.partitionBy("_start")
    month_zero = F.col("month_index") == 0
    return grid.select(
        month_label(F.col("_start")).alias("cohort_month"),
        F.max(F.when(month_zero, F.col("active"))).over(cohort).alias("cohort_size"),
        "month_index",
        "active",
        "total",
        F.max(F.when(month_zero, F.col("total"))).over(cohort).alias("initial_total"),
    )
