"""Rule tagging: split a raw table into clean rows and accounted rejects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]
REASON = "reject_reason"


def tag_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, null for a clean row."""
    reasons = [F.when(broken, F.lit(name)) for name, broken in rules]
    return df.withColumn(REASON, F.coalesce(*reasons))


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def reject_counts(**tagged: DataFrame) -> DataFrame:
    """``(table_name, reject_reason, row_count)`` over any number of tagged tables."""
    counts = [
        df.groupBy(REASON).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.coalesce(REASON, F.lit("clean")).alias(REASON), "row_count"
        )
        for name, df in tagged.items()
    ]
    return reduce(DataFrame.unionByName, counts)
