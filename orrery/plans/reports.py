"""Report tables behind the dashboards: drill-downs, heat grids, trends, slicers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.dates import month_start
from orrery.functions.ratios import cents, ratio_or_zero
from orrery.operators.comparisons import share_of_total
from orrery.plans.agency_reports import client_ad_totals
from orrery.plans.attribution import MONTH, YEAR, attribution
from orrery.plans.measures import conversion_rate, target_attainment, target_badge
from orrery.sources.sinks import FACT_LAYOUTS, between_days

RFM_SCORES = (1, 2, 3, 4, 5)


def category_drilldown(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and lifetime value by category, product and country, with all subtotals.

    ``depth`` is 0 for the grand total, 1 for categories, 2 for products; a row
    with ``all_countries = 1`` is the total over countries. Sales are reduced to
    (product, customer) pairs before the joins. Customers are recounted at every
    product level, because one customer buys many products; over countries the
    counts add up, because the customer key is unique and has one country.
    """
    pairs = sales.groupBy("product_id", "customer_id").agg(F.sum("line_subtotal").alias("revenue"))
    described = pairs.join(products.select("product_id", "category", "product_name"), "product_id").join(
        customers.select("customer_id", "country"), "customer_id"
    )
    category, product, country = F.col("category"), F.col("product_name"), F.col("country")
    levels = described.groupingSets([[category, product, country], [category, country], [country]],
                                    category, product, country).agg(
        (2 - F.grouping(category) - F.grouping(product)).cast("int").alias("depth"),
        F.sum("revenue").alias("revenue"),
        F.count_distinct("customer_id").alias("buyers"),
    )
    depth = F.col("depth")
    return levels.groupingSets([[depth, category, product, country], [depth, category, product]],
                               depth, category, product, country).agg(
        F.grouping(country).cast("int").alias("all_countries"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        ratio_or_zero(F.sum("revenue"), F.sum("buyers")).alias("customer_lifetime_value"),
    )


def category_by_country(sales: DataFrame, products: DataFrame, customers: DataFrame, countries: Sequence[str]) -> DataFrame:
    """Wide matrix: one row per category, one revenue column per listed country; other countries are left out."""
    pairs = sales.groupBy("product_id", "customer_id").agg(F.sum("line_subtotal").alias("revenue"))
    described = pairs.join(products.select("product_id", "category"), "product_id").join(
        customers.select("customer_id", "country"), "customer_id"
    )
    return described.groupBy("category").pivot("country", list(countries)).agg(F.sum("revenue").cast("double"))


def rfm_heat_grid(sales: DataFrame, scores: DataFrame, n_tiles: int = len(RFM_SCORES)) -> DataFrame:
    """Revenue (any status) by recency score, one column per frequency score from 1 to ``n_tiles``."""
    columns = range(1, n_tiles + 1)
    spent = sales.groupBy("customer_id").agg(F.sum("line_subtotal").alias("revenue"))
    graded = spent.join(scores.select("customer_id", "r_score", "f_score"), "customer_id")
    grid = graded.groupBy("r_score").pivot("f_score", list(columns)).agg(F.sum("revenue").cast("double"))
    return grid.select("r_score", *[F.col(str(s)).alias(f"f_{s}") for s in columns])


def rfm_cell_transactions(sales: DataFrame, scores: DataFrame, r_score: int, f_score: int) -> DataFrame:
    """Sales lines of the customers in one cell of the heat grid."""
    cell = scores.filter((F.col("r_score") == r_score) & (F.col("f_score") == f_score)).select("customer_id")
    return sales.join(cell, "customer_id", "left_semi")


def portfolio_drilldown(
    managers: DataFrame, clients: DataFrame, billing: DataFrame, ad_performance: DataFrame
) -> DataFrame:
    """Region, manager and client levels with billing, spend, return and badge.

    Facts are reduced to clients first. Targets are summed over managers on
    their own, so a client row shows its manager's target and no level counts a
    target twice.
    """
    billed = billing.groupBy("client_id").agg(F.sum("total_billing_amount").alias("billed"))
    owned = (
        clients.select("client_id", "company_name", F.col("primary_account_manager_id").alias("manager_id"))
        .join(billed, "client_id", "left")
        .join(client_ad_totals(ad_performance), "client_id", "left")
    )
    named = managers.select("manager_id", "region", "name")
    levels = (
        named.join(owned, "manager_id", "left")
        .rollup("region", "name", "company_name")
        .agg(
            (3 - F.grouping("region") - F.grouping("name") - F.grouping("company_name")).cast("int").alias("depth"),
            F.sum("billed").alias("billed"),
            F.sum("ad_spend").alias("spend"),
            F.sum("client_conversion_revenue").alias("revenue"),
            F.count("client_id").alias("clients"),
        )
        .filter("depth < 3 or clients > 0")  # a manager without clients has no client row
    )
    targets = (
        managers.rollup("region", "name")
        .agg(
            (2 - F.grouping("region") - F.grouping("name")).cast("int").alias("_depth"),
            F.sum("target_monthly_revenue").alias("target"),
        )
        .select(F.col("region").alias("_region"), F.col("name").alias("_name"), "_depth", "target")
    )
    same_manager = (
        F.col("region").eqNullSafe(F.col("_region"))
        & F.col("name").eqNullSafe(F.col("_name"))
        & (F.least("depth", F.lit(2)) == F.col("_depth"))
    )
    billed_total = F.coalesce("billed", F.lit(0))
    attained = ratio_or_zero(billed_total, F.col("target"))
    return levels.join(targets, same_manager, "left").select(
        "depth",
        "region",
        F.col("name").alias("manager_name"),
        "company_name",
        billed_total.cast("double").alias("total_billing"),
        F.coalesce("spend", F.lit(0)).cast("double").alias("managed_ad_spend"),
        ratio_or_zero(F.col("revenue"), F.col("spend")).alias("managed_roas"),
        target_badge(attained).alias("badge"),
    )


def billing_heat_cells(cohorts: DataFrame) -> DataFrame:
    """The heat matrix in long form, for any number of months: cohort, month index and retention as a share."""
    return cohorts.select("cohort_month", "month_index", (F.col("revenue_retention_pct") / 100.0).alias("retention"))


def billing_heat_matrix(cohorts: DataFrame, month_indexes: Sequence[int] | None = None) -> DataFrame:
    """Revenue retention as a matrix: one row per cohort, one column per month index.

    ``cohorts`` is the billing-cohort report, already one row per cohort and
    month; without ``month_indexes`` the columns run up to its largest index.
    """
    if month_indexes is None:
        last = cohorts.agg(F.max("month_index").alias("m")).first()["m"]
        month_indexes = range((last if last is not None else -1) + 1)
    indexes = list(month_indexes)
    if not indexes:
        return cohorts.select("cohort_month").distinct()
    rate = F.sum("revenue_retention_pct") / 100.0
    wide = cohorts.groupBy("cohort_month").pivot("month_index", indexes).agg(rate)
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"m{i:03d}") for i in indexes]).orderBy("cohort_month")


def channel_by_year(sales: DataFrame, traffic: DataFrame) -> DataFrame:
    """Sessions, conversion, revenue and bounce rate per channel and year."""
    return attribution(sales, traffic, YEAR).select(
        "traffic_source", "year", "total_sessions", "session_conversion_rate_pct", "gross_revenue", "bounce_rate_pct"
    )


def channel_scatter(report: DataFrame) -> DataFrame:
    """The three coordinates of each channel, from an attribution report."""
    return report.select("traffic_source", "session_conversion_rate_pct", "bounce_rate_pct", "gross_revenue")


def channel_months(sales: DataFrame, traffic: DataFrame) -> DataFrame:
    """Sessions and attributed revenue per month over all channels."""
    return (
        attribution(sales, traffic, MONTH)
        .groupBy("month")
        .agg(F.sum("total_sessions").alias("total_sessions"), F.round(F.sum("gross_revenue"), 2).alias("gross_revenue"))
        .orderBy("month")
    )


def monthly_trend(sales: DataFrame, traffic: DataFrame) -> DataFrame:
    """Revenue and conversion rate per month; a month only one fact has still shows."""
    sold = sales.withColumn("month", month_start(F.col("order_date")))
    seen = traffic.withColumn("month", month_start(F.col("session_date")))
    revenue = sold.groupBy("month").agg(F.sum("line_subtotal").alias("revenue"))
    rates = conversion_rate(sold, seen, ["month"])
    return rates.join(revenue, "month", "left").select(
        "month",
        F.coalesce("revenue", F.lit(0)).cast("double").alias("total_revenue"),
        "orders",
        "sessions",
        "conversion_rate",
    )


def category_share(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Each category's part of total revenue, in percent."""
    per_product = sales.groupBy("product_id").agg(F.sum("line_subtotal").alias("revenue"))
    per_category = (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"))
    )
    shared = share_of_total(per_category, "revenue", share="market_share_pct")
    return shared.select("category", F.col("revenue").cast("double").alias("total_revenue"), "market_share_pct")


def actual_vs_target(managers: DataFrame, billing: DataFrame) -> DataFrame:
    """Average monthly billing against the monthly target of every manager."""
    return target_attainment(managers, billing, ["manager_id", "name"]).select(
        "manager_id",
        F.col("name").alias("manager_name"),
        cents(F.col("average_monthly_billing")).alias("average_monthly_billing"),
        F.col("target").alias("monthly_target"),
        F.round(F.col("monthly_attainment") * 100.0, 2).alias("attainment_pct"),
        F.col("monthly_badge").alias("badge"),
    )


def slice_agency(
    tables: dict[str, DataFrame],
    regions: Sequence[str] | None = None,
    managers: Sequence[str] | None = None,
    industries: Sequence[str] | None = None,
    between: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """The agency tables under a set of slicers; facts follow their clients and dates.

    Facts opened with ``keep_months`` are read from the folders of the months asked for.
    """
    sliced = dict(tables)
    if regions is not None or managers is not None:
        chosen = tables["dim_account_managers"]
        if regions is not None:
            chosen = chosen.filter(F.col("region").isin(list(regions)))
        if managers is not None:
            chosen = chosen.filter(F.col("name").isin(list(managers)))
        sliced["dim_account_managers"] = chosen
        ids = chosen.select(F.col("manager_id").alias("_m"))
        sliced["dim_clients"] = tables["dim_clients"].join(
            ids, F.col("primary_account_manager_id") == F.col("_m"), "left_semi"
        )
    if industries is not None:
        sliced["dim_clients"] = sliced["dim_clients"].filter(F.col("industry").isin(list(industries)))
    if sliced["dim_clients"] is not tables["dim_clients"]:
        ids = sliced["dim_clients"].select("client_id")
        for name in ("dim_campaigns", "fact_ad_performance", "fact_client_billing"):
            sliced[name] = tables[name].join(ids, "client_id", "left_semi")
    if between is not None:
        for name in ("fact_ad_performance", "fact_client_billing"):
            sliced[name] = between_days(sliced[name], FACT_LAYOUTS[name], *between)
    return sliced
