"""Which entities were active in which months, as bitmaps that add up.

A row holds the months of one entity in one word of ``WORD`` months (five years) as the bits of a long, so an entity has
as many rows as it has lived words, however active it is. Bitmaps of different times are merged by OR, map-side first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orrery.functions.dates import month_start
from orrery.operators.cohorts import cohort_table

WORD = 60


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _month_date(number: Column) -> Column:
    return F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1))


def monthly_amounts(df: DataFrame, entity: str, day: str, value: str | None = None) -> DataFrame:
    """``entity, month`` (its first day) and ``amount``, null without a value. Rows without entity or day are nobody's."""
    known = df.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
    amount = F.sum(value) if value else F.lit(None).cast("decimal(28,2)")
    return known.groupBy(F.col(entity).alias("entity"), month_start(F.col(day)).alias("month")).agg(amount.alias("amount"))


def month_bits(monthly: DataFrame) -> DataFrame:
    """``entity, word, bits`` of rows with ``entity`` and ``month``."""
    number = month_number(F.col("month"))
    numbered = monthly.select("entity", F.floor(number / WORD).cast("int").alias("word"), F.pmod(number, F.lit(WORD)).alias("_bit"))
    return numbered.groupBy("entity", "word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"))


def merge_months(held: DataFrame, new: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Bitmaps in which the months from ``first`` to ``last`` are those of ``new`` and all others those held."""
    low = F.greatest(F.lit(first.year * 12 + first.month - 1) - F.col("word") * WORD, F.lit(0))
    high = F.least(F.lit(last.year * 12 + last.month - 1) - F.col("word") * WORD, F.lit(WORD - 1))
    marked = held.withColumn("_low", low).withColumn("_high", high)
    renewed = F.expr("shiftleft(1L, _high + 1) - shiftleft(1L, _low)")
    bits = F.when(F.col("_low") <= F.col("_high"), F.col("bits").bitwiseAND(F.bitwise_not(renewed))).otherwise(F.col("bits"))
    both = marked.select("entity", "word", bits.alias("bits")).unionByName(new.select("entity", "word", "bits"))
    return both.groupBy("entity", "word").agg(F.bit_or("bits").alias("bits")).where("bits <> 0")


def cohorts_of_bits(bits: DataFrame, amounts: DataFrame | None = None) -> DataFrame:
    """The columns of ``monthly_cohorts`` from bitmaps, and from ``monthly_amounts`` of the same entities for the totals."""
    lowest = F.col("word") * WORD + F.bit_count(F.col("bits").bitwiseXOR(F.col("bits") - 1)) - 1
    started = bits.withColumn("_start", F.min(lowest).over(W.partitionBy("entity")))
    held = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit("bits", i) == 1)
    months = F.transform(held, lambda i: i + F.col("word") * WORD)
    active = started.select("entity", "_start", F.explode(months).alias("_month"))
    if amounts is None:
        active = active.withColumn("amount", F.lit(None))
    else:
        active = active.join(amounts.select("entity", month_number(F.col("month")).alias("_month"), "amount"), ["entity", "_month"], "left")
    grid = active.groupBy("_start", (F.col("_month") - F.col("_start")).alias("month_index")).agg(
        F.count("entity").alias("active"), F.sum("amount").alias("total")
    )
    return cohort_table(grid.withColumn("_start", _month_date(F.col("_start"))))
