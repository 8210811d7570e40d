"""Agency galaxy: managers, clients, campaigns, ad performance and billing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.dates import is_weekend, weekend_days_to
from orrery.functions.ratios import money
from orrery.functions.text import strip, title_case
from orrery.operators.grids import daily_grid, monthly_grid

# The planning rules of the daily spend grid and the invoice roll.
DAYS_PER_BUDGET = 30
WEEKEND_FACTOR = 0.7
WEEKDAY_FACTOR = 1.1
MIN_DAILY_SPEND = 5.0
MARKUP_RATE = "0.15"


def build_dim_clients(raw: DataFrame) -> DataFrame:
    """Company names stripped and title-cased, industries stripped; nothing else changes."""
    return raw.withColumns(
        {"company_name": title_case(strip(F.col("company_name"))), "industry": strip(F.col("industry"))}
    )


def build_dim_account_managers(raw: DataFrame) -> DataFrame:
    return raw.withColumn("name", title_case(strip(F.col("name"))))


def build_dim_date_agency(ad_performance: DataFrame) -> DataFrame:
    """Calendar of the days that have ad performance; gaps are not filled."""
    date = F.col("date_key")
    days = ad_performance.select(F.col("date").alias("date_key")).distinct()
    return days.select(
        "date_key",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(date)).alias("quarter"),
        F.date_format(date, "EEEE").alias("day_of_week"),
        is_weekend(date).alias("is_weekend"),
    ).orderBy("date_key")


def build_agency_galaxy(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All six tables from the five raw ones, lazily."""
    return {
        "dim_account_managers": build_dim_account_managers(raw["managers"]),
        "dim_clients": build_dim_clients(raw["clients"]),
        "dim_campaigns": raw["campaigns"],
        "dim_date": build_dim_date_agency(raw["ad_performance"]),
        "fact_ad_performance": raw["ad_performance"],
        "fact_client_billing": raw["client_billing"],
    }


def expected_daily_spend(
    campaigns: DataFrame,
    clients: DataFrame,
    start: dt.date,
    end: dt.date,
    weekday_factor: float = WEEKDAY_FACTOR,
    weekend_factor: float = WEEKEND_FACTOR,
    least: float = MIN_DAILY_SPEND,
    days_per_budget: int = DAYS_PER_BUDGET,
) -> DataFrame:
    """Campaign-by-day grid from each client's onboarding, with the planned spend of the day.

    A day's share of the monthly budget times a factor for weekdays or weekends, ``least`` at least.
    """
    owned, daily, weekday, weekend = _owned_with_spend(campaigns, clients, weekday_factor, weekend_factor, least, days_per_budget)
    grid = daily_grid(owned, F.col("onboarding_date"), start, end)
    return grid.select(
        "date",
        "campaign_id",
        "client_id",
        daily.alias("daily_budget"),
        F.when(is_weekend(F.col("date")) == 1, weekend).otherwise(weekday).alias("expected_spend"),
    )


def _owned_with_spend(
    campaigns: DataFrame, clients: DataFrame, weekday_factor: float, weekend_factor: float, least: float, days_per_budget: int
) -> tuple[DataFrame, Column, Column, Column]:
    """Campaigns with their client's onboarding; a day's share of the budget, the plan of a weekday and of a weekend day."""
    onboarding = clients.select(F.col("client_id").alias("_client"), "onboarding_date")
    owned = campaigns.join(onboarding, F.col("client_id") == F.col("_client"))
    daily = F.col("monthly_ad_budget").cast("double") / F.lit(float(days_per_budget))
    weekday, weekend = (F.greatest(F.lit(least), daily * F.lit(factor)) for factor in (weekday_factor, weekend_factor))
    return owned, daily, weekday, weekend


def expected_spend_by_month(
    campaigns: DataFrame,
    clients: DataFrame,
    start: dt.date,
    end: dt.date,
    weekday_factor: float = WEEKDAY_FACTOR,
    weekend_factor: float = WEEKEND_FACTOR,
    least: float = MIN_DAILY_SPEND,
    days_per_budget: int = DAYS_PER_BUDGET,
) -> DataFrame:
    """The grid of ``expected_daily_spend`` counted by month: how many days of a campaign have which amount.

    The days of a month are counted from its bounds, so no day becomes a row. Campaigns that share id, client and
    budget meet before their months are listed, each with its onboarding days and how often they occur; nothing is
    shuffled after that.
    """
    owned, daily, weekday, weekend = _owned_with_spend(campaigns, clients, weekday_factor, weekend_factor, least, days_per_budget)
    live = owned.filter(F.col("onboarding_date") < F.lit(end)).filter(F.lit(start) < F.lit(end))
    key = ["campaign_id", "client_id", "daily_budget"]
    begun = live.select(
        "campaign_id", "client_id", daily.alias("daily_budget"), weekday.alias("_weekday"), weekend.alias("_weekend"),
        F.greatest("onboarding_date", F.lit(start)).alias("_since"),
    )
    begun = begun.groupBy(*key, "_weekday", "_weekend", "_since").agg(F.count("*").alias("_times"))
    plans = begun.groupBy(*key, "_weekday", "_weekend").agg(F.collect_list(F.struct("_since", "_times")).alias("_begun"))
    last = F.date_sub(F.lit(end), 1)
    months = F.sequence(F.trunc(F.array_min("_begun._since"), "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    until = F.least(F.last_day("month"), last)

    def add(total: Column, begin: Column) -> Column:
        first, times = F.greatest(begin["_since"], F.col("month")), begin["_times"]
        days = F.greatest(F.lit(0), F.datediff(until, first) + 1)
        off = F.when(days > 0, weekend_days_to(until) - weekend_days_to(F.date_sub(first, 1))).otherwise(0)
        return F.struct((total["days"] + times * days).alias("days"), (total["off"] + times * off).alias("off"))

    none = F.struct(F.lit(0).cast("long").alias("days"), F.lit(0).cast("long").alias("off"))
    counted = plans.select(*key, "_weekday", "_weekend", "_begun", F.explode(months).alias("month")).select(
        "month", *key, "_weekday", "_weekend", F.when(F.size("_begun") == 1, add(none, F.col("_begun")[0]))
        .otherwise(F.aggregate("_begun", none, add)).alias("_n"),  # nearly always one: compiled, the fold is not
    )

    def amount(spend: str, days: Column) -> Column:
        return F.struct(F.col(spend).alias("expected_spend"), days.alias("days"))

    both = F.array(amount("_weekday", F.col("_n.days") - F.col("_n.off")), amount("_weekend", F.col("_n.off")))
    same = F.col("_weekday").eqNullSafe(F.col("_weekend"))
    amounts = F.when(same, F.array(amount("_weekday", F.col("_n.days")))).otherwise(both)
    return counted.select("month", *key, F.inline(amounts)).filter("days > 0")


def monthly_invoices(
    clients: DataFrame, campaigns: DataFrame, start: dt.date, end: dt.date, consulting: Column
) -> DataFrame:
    """One invoice per client and month from onboarding on: retainer, 15 % budget markup, consulting.

    ``consulting`` is an amount computed from the client's columns.
    """
    budgets = campaigns.groupBy(F.col("client_id").alias("_client")).agg(
        F.sum("monthly_ad_budget").alias("_budget")
    )
    funded = clients.join(budgets, F.col("client_id") == F.col("_client"), "left")
    markup = F.coalesce(F.col("_budget"), F.lit(0)) * F.lit(MARKUP_RATE).cast("decimal(4,2)")
    billed = funded.withColumns(
        {
            "retainer_billing": money(F.col("monthly_retainer_fee")),
            "ad_management_markup": money(markup),
            "consulting_billing": money(consulting),
        }
    )
    months = monthly_grid(billed, F.col("onboarding_date"), start, end, "invoice_date")
    return months.select(
        "invoice_date",
        F.concat(
            F.lit("INV-"), F.date_format("invoice_date", "yyyyMM"), F.lit("-"),
            F.col("client_id").cast("string"),
        ).alias("invoice_id"),
        "client_id",
        F.col("primary_account_manager_id").alias("manager_id"),
        "retainer_billing",
        "ad_management_markup",
        "consulting_billing",
        money(
            F.col("retainer_billing") + F.col("ad_management_markup") + F.col("consulting_billing")
        ).alias("total_billing_amount"),
    )
