"""RFM segmentation: recency, frequency, money, quintiles and named segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orrery.operators.tiles import Tile, with_tiles
from orrery.session import materialize

TILES = (
    Tile("r_score", "recency_days", descending=True),
    Tile("f_score", "frequency"),
    Tile("m_score", "monetary_value"),
)


def customer_value(fact_sales: DataFrame) -> DataFrame:
    """``customer_id, last_purchase_date, frequency, monetary_value, newest`` in one pass.

    ``newest`` is the customer's last order of any status: recency counts from
    the newest order of the whole table, cancelled ones included. Lines collapse
    to orders first, so distinct orders become a plain count and a very active
    customer is spread over many (customer, order) groups.
    """
    counts = F.col("status") != "Cancelled"
    orders = fact_sales.groupBy("customer_id", "order_id").agg(
        F.max("order_date").alias("_newest"),
        F.max(F.when(counts, F.col("order_date"))).alias("_last"),
        F.sum(F.when(counts, F.col("line_subtotal"))).alias("_money"),
        F.count_if(counts).alias("_rows"),
    )
    return orders.groupBy("customer_id").agg(
        F.max("_last").alias("last_purchase_date"),
        F.count_if((F.col("_rows") > 0) & F.col("order_id").isNotNull()).alias("frequency"),
        F.sum("_money").alias("monetary_value"),
        F.max("_newest").alias("newest"),
        F.sum("_rows").alias("_rows"),
    )


def recency_table(fact_sales: DataFrame) -> DataFrame:
    """Customers with at least one counted line, their recency, frequency and money.

    Written to the shared scratch folder: it is one row per customer, and both
    the ranking and the final report read it, so the sales are scanned once. The
    newest order date is observed on that write.
    """
    newest_order = Observation()
    valued = customer_value(fact_sales).observe(newest_order, F.max("newest").alias("day"))
    valued = materialize(valued, "customer-value")
    newest = newest_order.get["day"]
    return valued.filter("_rows > 0").select(
        "customer_id",
        F.date_diff(F.lit(newest), F.col("last_purchase_date")).alias("recency_days"),
        "frequency",
        "monetary_value",
    )


# The segment names and the scores they stand for.
def segment(r: Column, f: Column) -> Column:
    """Segment name from recency and frequency scores; first match wins."""
    return (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f == 2), "Promising")
        .when((r == 3) & (f == 2), "Need Attention")
        .when((r >= 4) & (f == 1), "New Customers")
        .when((r <= 2) & (f >= 4), "Cannot Lose Them")
        .when((r <= 2) & (f == 3), "At Risk")
        .when((r == 2) & (f <= 2), "About to Sleep")
        .otherwise("Lost / Inactive")
    )


def rfm_scores(fact_sales: DataFrame, n_tiles: int = 5) -> DataFrame:
    """Customers with their three scores, before the customer attributes are joined."""
    return with_tiles(recency_table(fact_sales), "customer_id", TILES, n_tiles)


def rfm_segmentation(fact_sales: DataFrame, dim_customers: DataFrame, n_tiles: int = 5) -> DataFrame:
    """Scored customers with attributes and segment; customers missing from the dimension drop out."""
    scored = rfm_scores(fact_sales, n_tiles)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    named = dim_customers.select("customer_id", "full_name", "email", "country")
    return (
        scored.join(named, "customer_id")
        .select(
            "customer_id",
            "full_name",
            "email",
            "country",
            "recency_days",
            "frequency",
            "monetary_value",
            "r_score",
            "f_score",
            "m_score",
            ((r + f + m).cast("double") / F.lit(3.0)).alias("average_rfm_score"),
            segment(r, f).alias("rfm_segment"),
        )
        .orderBy(F.desc("monetary_value"))
    )
