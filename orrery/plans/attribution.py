"""Best-touch channel attribution: what each traffic source brought in."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.dates import month_start
from orrery.functions.ratios import as_amount, ratio
from orrery.operators.touch import attribute_sales

# Report grains derived from a date column.
YEAR: dict[str, Callable[[Column], Column]] = {"year": F.year}
MONTH: dict[str, Callable[[Column], Column]] = {"month": month_start}


def channel_traffic(traffic: DataFrame, grain: Mapping[str, Callable[[Column], Column]] = {}) -> DataFrame:
    """Sessions, bounces and conversions per source (and grain)."""
    by = [make(F.col("session_date")).alias(name) for name, make in grain.items()]
    return traffic.groupBy("traffic_source", *by).agg(
        F.count("session_id").alias("total_sessions"),
        F.sum("bounced").alias("bounced_sessions"),
        F.sum("converted").alias("converted_sessions"),
    )


def channel_sales(
    sales: DataFrame, traffic: DataFrame, grain: Mapping[str, Callable[[Column], Column]] = {}
) -> DataFrame:
    """Orders, units, revenue and shipping per attributed source (and grain), cancelled sales left out."""
    kept = sales.filter(F.col("status") != "Cancelled")
    by = [make(F.col("order_date")).alias(name) for name, make in grain.items()]
    return attribute_sales(kept, traffic).groupBy("attributed_source", *by).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("line_subtotal").alias("gross_revenue"),
        F.sum("shipping_fee").alias("total_shipping_revenue"),
    )


def attribution(
    sales: DataFrame,
    traffic: DataFrame,
    grain: Mapping[str, Callable[[Column], Column]] = {},
    keep_unattributed: bool = False,
) -> DataFrame:
    """Traffic and attributed sales side by side per source.

    Sources without sessions do not appear, so unattributed revenue is left out
    unless ``keep_unattributed`` asks for it.
    """
    seen = channel_traffic(traffic, grain)
    sold = channel_sales(sales, traffic, grain).withColumnRenamed("attributed_source", "traffic_source")
    how = "full" if keep_unattributed else "left"
    revenue = F.coalesce("gross_revenue", F.lit(0))
    sessions = F.coalesce("total_sessions", F.lit(0))
    return (
        seen.join(sold, ["traffic_source", *grain], how)
        .select(
            "traffic_source",
            *grain,
            sessions.alias("total_sessions"),
            F.coalesce("bounced_sessions", F.lit(0)).alias("bounced_sessions"),
            F.round(ratio(F.col("bounced_sessions"), F.col("total_sessions")) * 100, 2).alias("bounce_rate_pct"),
            F.round(ratio(F.col("converted_sessions"), F.col("total_sessions")) * 100, 2).alias(
                "session_conversion_rate_pct"
            ),
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
            F.coalesce("total_units_sold", F.lit(0)).alias("units_sold"),
            as_amount(revenue).alias("gross_revenue"),
            F.round(ratio(revenue, sessions), 2).alias("revenue_per_session"),
            F.round(ratio(revenue, F.coalesce("total_orders", F.lit(1))), 2).alias("average_order_value"),
        )
        .orderBy(F.desc("gross_revenue"))
    )
