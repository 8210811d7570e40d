"""Best touch: the one session that gets the credit for a customer's day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_daily_sessions(traffic: DataFrame) -> DataFrame:
    """The best session of each customer and day: longest, then most pages, then lowest id.

    The rank filter becomes a group limit ahead of the shuffle: each map task
    sends one row per (customer, day), so a day with very many sessions is
    reduced where it is read.
    """
    day = W.partitionBy("customer_id", "session_date").orderBy(
        F.desc("duration_seconds"), F.desc("pages_viewed"), F.asc("session_id")
    )
    ranked = traffic.withColumn("session_rank", F.row_number().over(day))
    return ranked.filter("session_rank = 1").drop("session_rank")


def attribute_sales(sales: DataFrame, traffic: DataFrame) -> DataFrame:
    """Each sale with the source and device of its customer's best session that day.

    The join key is packed into a struct on purpose. The ranked sessions are
    already partitioned by (customer, day); joining on those columns directly
    would reuse that partitioning and leave one task per hot (customer, day) of
    sales. With its own key both sides are plain shuffles, which lets adaptive
    execution split the sales of a hot day, at the price of shuffling the much
    smaller one-row-per-day session side once more.
    """
    touches = (
        best_daily_sessions(traffic.filter("customer_id is not null and session_date is not null"))
        .select(
            F.struct(F.col("customer_id").alias("c"), F.col("session_date").alias("d")).alias("_touch"),
            "traffic_source",
            "device_type",
        )
    )
    keyed = sales.withColumn("_day", F.struct(F.col("customer_id").alias("c"), F.col("order_date").alias("d")))
    return (
        keyed.join(touches, F.col("_day") == F.col("_touch"), "left")
        .withColumn("attributed_source", F.coalesce("traffic_source", F.lit("Direct/Unattributed")))
        .withColumn("attributed_device", F.coalesce("device_type", F.lit("Unknown")))
        .drop("_day", "_touch", "traffic_source", "device_type")
    )
