"""KPI layer: named measures evaluated at any grain.

Unlike the analytics queries, the sales measures include cancelled orders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.dates import month_start
from orrery.functions.ratios import ratio_or_zero
from orrery.operators.comparisons import year_over_year


Measure = Callable[[], Column]


def _total(column: str) -> Column:
    return F.sum(column).cast("double")


SALES: dict[str, Measure] = {
    "total_revenue": lambda: _total("line_subtotal"),
    "units_sold": lambda: F.sum("quantity"),
    "average_order_value": lambda: ratio_or_zero(F.sum("line_subtotal"), F.count_distinct("order_id")),
    "customer_lifetime_value": lambda: ratio_or_zero(F.sum("line_subtotal"), F.count_distinct("customer_id")),
    "active_customers": lambda: F.count_distinct("customer_id"),
}

ADS: dict[str, Measure] = {
    "managed_ad_spend": lambda: _total("ad_spend"),
    "client_revenue_generated": lambda: _total("client_conversion_revenue"),
    "managed_roas": lambda: ratio_or_zero(F.sum("client_conversion_revenue"), F.sum("ad_spend")),
    "cost_per_acquisition": lambda: ratio_or_zero(F.sum("ad_spend"), F.sum("conversions")),
    "click_through_rate": lambda: ratio_or_zero(F.sum("clicks"), F.sum("impressions")),
}

BILLING: dict[str, Measure] = {
    "total_billing": lambda: _total("total_billing_amount"),
    "average_monthly_billing": lambda: ratio_or_zero(
        F.sum("total_billing_amount"), F.count_distinct(month_start(F.col("invoice_date")))
    ),
    "active_clients": lambda: F.count_distinct("client_id"),
}


def evaluate(
    df: DataFrame, measures: Mapping[str, Measure], by: Sequence[str] = (), only: Sequence[str] = ()
) -> DataFrame:
    """Measures per group; filters on ``df`` are the report's filter context."""
    chosen = only or tuple(measures)
    return df.groupBy(*by).agg(*[measures[name]().alias(name) for name in chosen])


def order_totals(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales lines summed per order and customer: the sales measures give the same on these rows.

    Two distinct counts make Spark repeat its input three times; on orders that
    is a fraction of the lines.
    """
    return sales.groupBy(*by, "order_id", "customer_id").agg(
        F.sum("line_subtotal").alias("line_subtotal"), F.sum("quantity").alias("quantity")
    )


def conversion_rate(sales: DataFrame, traffic: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct orders over sessions, at columns both facts carry.

    Each fact is aggregated alone and the two results are stacked and summed,
    which needs no join and keeps groups only one fact has.
    """
    orders = sales.groupBy(*by).agg(F.count_distinct("order_id").alias("orders"), F.lit(0).alias("sessions"))
    sessions = traffic.groupBy(*by).agg(F.lit(0).alias("orders"), F.count("session_id").alias("sessions"))
    both = orders.unionByName(sessions).groupBy(*by).agg(
        F.sum("orders").alias("orders"), F.sum("sessions").alias("sessions")
    )
    return both.withColumn("conversion_rate", ratio_or_zero(F.col("orders"), F.col("sessions")))


def monthly_growth(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue per month with the same month of the prior year and the growth over it."""
    monthly = sales.groupBy(*by, month_start(F.col("order_date")).alias("month")).agg(
        _total("line_subtotal").alias("total_revenue")
    )
    return year_over_year(monthly, "month", "total_revenue", by)


def signup_retention(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Active customers per month over the month's starting customers (sign-up index 0).

    The starting count keeps only the month filter; ``by`` splits the active
    count alone. Customers collapse to one row per month and group first.
    """
    month = month_start(F.col("order_date")).alias("month")
    present = sales.groupBy(month, *by, "customer_id").agg(F.bool_or(F.col("month_index") == 0).alias("_starts"))
    active = present.groupBy("month", *by).agg(F.count("customer_id").alias("active_customers"))
    starting = (
        present.groupBy("month", "customer_id")
        .agg(F.bool_or("_starts").alias("_starts"))
        .groupBy("month")
        .agg(F.count_if(F.col("_starts")).alias("starting_customers"))
    )
    joined = active.join(starting, "month", "left")
    return joined.withColumn(
        "retention", ratio_or_zero(F.col("active_customers"), F.col("starting_customers"))
    )


# Attainment thresholds and their badges.
BADGES = ((1.0, "🏆 Target Exceeded"), (0.8, "🟢 Target Met"), (0.6, "🟡 At Risk"))
LOWEST_BADGE = "🔴 Action Required"


def target_badge(attainment: Column) -> Column:
    chain = None
    for floor, badge in BADGES:
        chain = F.when(attainment >= floor, badge) if chain is None else chain.when(attainment >= floor, badge)
    return chain.otherwise(LOWEST_BADGE)


def target_attainment(managers: DataFrame, billing: DataFrame, by: Sequence[str] = ("manager_id",)) -> DataFrame:
    """Billing against targets per group of manager columns, with its badge.

    Billing is reduced to managers before it is joined, so a target is counted
    once. ``attainment`` compares all billing with the monthly targets (as the
    dashboard does); ``monthly_attainment`` uses the average month instead.
    """
    per_month = billing.groupBy("manager_id", month_start(F.col("invoice_date")).alias("_month")).agg(
        F.sum("total_billing_amount").alias("_billed")
    )
    # Months are counted per group, not per manager: stack targets and months, then sum.
    owner = managers.select("manager_id", *[c for c in by if c != "manager_id"])
    months = (
        owner.join(per_month, "manager_id", "left")
        .groupBy(*by, "_month")
        .agg(F.sum("_billed").alias("_billed"))
        .groupBy(*by)
        .agg(F.sum("_billed").alias("_billed"), F.count("_month").alias("_months"))
    )
    targets = managers.groupBy(*by).agg(F.sum("target_monthly_revenue").alias("_target"))
    billed, target = F.coalesce("_billed", F.lit(0)), F.col("_target")
    monthly = ratio_or_zero(billed, F.col("_months"))
    attained = ratio_or_zero(billed, target)
    return targets.join(months, list(by), "left").select(
        *by,
        billed.cast("double").alias("total_billing"),
        monthly.alias("average_monthly_billing"),
        target.cast("double").alias("target"),
        attained.alias("attainment"),
        target_badge(attained).alias("badge"),
        ratio_or_zero(monthly, target).alias("monthly_attainment"),
        target_badge(ratio_or_zero(monthly, target)).alias("monthly_badge"),
    )
