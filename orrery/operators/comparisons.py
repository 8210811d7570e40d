"""Comparisons across the rows of an already aggregated report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orrery.functions.ratios import ratio_or_zero


def year_over_year(report: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``prior_year`` and ``growth`` to a report with one row per period and group.

    ``period`` is a month start. The prior year is an equi-join on the shifted
    month, so gaps in the calendar stay gaps.
    """
    prior = report.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.add_months(period, 12).alias("_next"), F.col(value).alias("prior_year")
    )
    # Null-safe: a group without a name has a prior year like any other.
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.col(period) == F.col("_next"))
    joined = report.join(prior, same, "left").drop("_next", *[f"_{c}" for c in by])
    change = F.col(value) - F.col("prior_year")
    return joined.withColumn("growth", ratio_or_zero(change, F.col("prior_year")))


def share_of_total(report: DataFrame, value: str, within: Sequence[str] = (), share: str = "share") -> DataFrame:
    """Add each row's part of the total of its group, in percent, on aggregated rows."""
    whole = F.sum(value).over(W.partitionBy(*within))
    return report.withColumn(
        share, F.round(ratio_or_zero(F.col(value).cast("double") * 100.0, whole), 2)
    )
