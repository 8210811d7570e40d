"""Date grids: one row per entity and day or month it was active."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_grid(df: DataFrame, since: Column, start: dt.date, end: dt.date, day: str = "date") -> DataFrame:
    """One row per input row and day in ``[start, end)`` that is not before ``since``.

    ``sequence`` + ``explode`` instead of a range join: no shuffle, no nested loop.
    """
    last = F.date_sub(F.lit(end), 1)
    live = df.filter(since < F.lit(end)).filter(F.lit(start) < F.lit(end))
    days = F.sequence(F.greatest(since, F.lit(start)), last, F.expr("interval 1 day"))
    return live.withColumn(day, F.explode(days))


def monthly_grid(df: DataFrame, since: Column, start: dt.date, end: dt.date, month: str = "month") -> DataFrame:
    """One row per input row and month start in ``[start, end]`` not before ``since``'s month."""
    first = F.trunc(F.greatest(since, F.lit(start)), "MM")
    last = F.trunc(F.lit(end), "MM")
    live = df.filter(first <= last)
    return live.withColumn(month, F.explode(F.sequence(first, last, F.expr("interval 1 month"))))


def calendar(bounds: DataFrame, pad_days: int, default: tuple[dt.date, dt.date], day: str = "date") -> DataFrame:
    """Every day between the bounds (one row, ``lo`` and ``hi``), padded on both ends."""
    lo = F.date_sub(F.coalesce("lo", F.lit(default[0])), pad_days)
    hi = F.date_add(F.coalesce("hi", F.lit(default[1])), pad_days)
    return bounds.select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias(day))
