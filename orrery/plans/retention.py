"""Customer retention and client billing cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.ratios import as_amount, percent
from orrery.operators.cohorts import monthly_cohorts


def cohort_retention(fact_sales: DataFrame) -> DataFrame:
    """Share of each first-purchase cohort that buys again in each later month."""
    kept = fact_sales.filter(F.col("status") != "Cancelled")
    return retention_report(monthly_cohorts(kept, "customer_id", "order_date"))


def retention_report(cohorts: DataFrame) -> DataFrame:
    return cohorts.select(
        "cohort_month",
        "cohort_size",
        "month_index",
        F.col("active").alias("active_customers"),
        percent(F.col("active"), F.col("cohort_size")).alias("retention_percentage"),
    ).orderBy("cohort_month", "month_index")


def billing_cohorts(billing: DataFrame) -> DataFrame:
    """Client and revenue retention of each first-invoice cohort."""
    return billing_report(monthly_cohorts(billing, "client_id", "invoice_date", "total_billing_amount"))


def billing_report(cohorts: DataFrame) -> DataFrame:
    return cohorts.select(
        "cohort_month",
        "cohort_size",
        "month_index",
        F.col("active").alias("active_clients"),
        as_amount(F.col("total")).alias("total_billing"),
        percent(F.col("active"), F.col("cohort_size")).alias("client_retention_pct"),
        percent(F.col("total"), F.col("initial_total")).alias("revenue_retention_pct"),
    ).orderBy("cohort_month", "month_index")
