"""Agency reports: manager portfolios and channel efficiency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.dates import month_start
from orrery.functions.ratios import as_amount, cents, percent, ratio, ratio_or_zero


def client_ad_totals(ad_performance: DataFrame) -> DataFrame:
    """Spend and revenue per client, so that later joins never repeat an ad row."""
    return ad_performance.groupBy("client_id").agg(
        F.sum("ad_spend").alias("ad_spend"),
        F.sum("client_conversion_revenue").alias("client_conversion_revenue"),
    )


def manager_portfolio(
    managers: DataFrame, clients: DataFrame, billing: DataFrame, ad_performance: DataFrame
) -> DataFrame:
    """Billing and ad results of every manager's clients, by the client's primary manager.

    Both facts are reduced to clients (and months) before they meet a dimension:
    no fan-out between the facts, and joins on client-sized inputs only.
    """
    manager = F.col("primary_account_manager_id").alias("manager_id")
    owners = clients.select("client_id", manager)
    invoiced = billing.groupBy("client_id", month_start(F.col("invoice_date")).alias("_month")).agg(
        F.sum("total_billing_amount").alias("_billed")
    )
    billed = (
        owners.join(invoiced, "client_id", "left")
        .groupBy("manager_id", "_month")
        .agg(F.sum("_billed").alias("_billed"))
        .groupBy("manager_id")
        .agg(F.sum("_billed").alias("_billed"), F.count("_month").alias("_months"))
    )
    headcount = owners.groupBy("manager_id").agg(F.count_distinct("client_id").alias("_clients"))
    advertised = (
        owners.join(client_ad_totals(ad_performance), "client_id", "left")
        .groupBy("manager_id")
        .agg(F.sum("ad_spend").alias("_spend"), F.sum("client_conversion_revenue").alias("_revenue"))
    )
    spend = F.coalesce("_spend", F.lit(0))
    return (
        managers.join(headcount, "manager_id", "left")
        .join(billed, "manager_id", "left")
        .join(advertised, "manager_id", "left")
        .select(
            "manager_id",
            F.col("name").alias("manager_name"),
            "region",
            F.col("target_monthly_revenue").alias("monthly_revenue_target"),
            F.coalesce("_clients", F.lit(0)).alias("active_clients"),
            as_amount(F.coalesce("_billed", F.lit(0))).alias("total_billing_managed"),
            cents(ratio_or_zero(F.col("_billed"), F.col("_months"))).alias("avg_monthly_billing"),
            as_amount(spend).alias("client_ad_spend_managed"),
            as_amount(F.coalesce("_revenue", F.lit(0))).alias("client_conversion_revenue_generated"),
            F.round(
                F.when(spend > 0, ratio(F.coalesce("_revenue", F.lit(0)), spend)).otherwise(0.0), 2
            ).alias("overall_managed_roas"),
        )
        .orderBy(F.desc("total_billing_managed"))
    )


def channel_efficiency(campaigns: DataFrame, ad_performance: DataFrame) -> DataFrame:
    """Reach, cost and return of each marketing channel.

    Ad rows are summed per campaign before the join, which leaves one row per
    campaign to shuffle however large a campaign is.
    """
    per_campaign = ad_performance.groupBy("campaign_id").agg(
        F.sum("ad_spend").alias("spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.sum("client_conversion_revenue").alias("revenue"),
    )
    totals = (
        campaigns.select("campaign_id", "marketing_channel")
        .join(per_campaign, "campaign_id")
        .groupBy("marketing_channel")
        .agg(
            F.count_distinct("campaign_id").alias("total_campaigns"),
            *[F.sum(c).alias(c) for c in ("spend", "impressions", "clicks", "conversions", "revenue")],
        )
    )
    spend, clicks, conversions = F.col("spend"), F.col("clicks"), F.col("conversions")
    return totals.select(
        "marketing_channel",
        "total_campaigns",
        as_amount(spend).alias("total_ad_spend"),
        F.col("impressions").alias("total_impressions"),
        clicks.alias("total_clicks"),
        conversions.alias("total_conversions"),
        as_amount(F.col("revenue")).alias("conversion_revenue"),
        percent(clicks, F.col("impressions"), 3).alias("ctr_pct"),
        F.round(ratio(spend, clicks), 2).alias("avg_cpc"),
        F.round(ratio(spend, conversions), 2).alias("avg_cpa"),
        percent(conversions, clicks).alias("conversion_rate_pct"),
        F.round(ratio(F.col("revenue"), spend), 2).alias("channel_roas"),
    ).orderBy(F.desc("total_ad_spend"))
