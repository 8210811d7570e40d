from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orrery.plans import measures, reports
from orrery.plans.attribution import MONTH, YEAR, attribution, channel_sales
from orrery.plans.checks import AGENCY_CHECKS, RETAIL_CHECKS, Reference, run_checks, verdict
from orrery.plans.retention import billing_cohorts, cohort_retention
from orrery.plans.rfm import rfm_segmentation, segment
from orrery.sources import samples
from orrery.sources.sinks import FACT_LAYOUTS, open_tables, publish

FACT = "k string"


def _orphans(spark, facts, keys):
    tables = {
        "fact": spark.createDataFrame([(k,) for k in facts], FACT),
        "dim": spark.createDataFrame([(k,) for k in keys], FACT),
    }
    return run_checks(tables, [Reference("fact", "k", "dim", "k")]).first().violations


@pytest.mark.parametrize(
    "facts,keys,expected",
    [
        (["a", "b", "b", None], ["a"], 2),
        (["a", "b"], ["a", None], 0),
        (["a", None], [], 2),
        ([], [], 0),
        ([None], ["a"], 0),
        (["a"], ["a", "a"], 0),
        (["z", "z", "z"], ["a"], 3),
    ],
)
def test_references_follow_not_in(spark, facts, keys, expected):
    assert _orphans(spark, facts, keys) == expected


def test_there_are_23_checks_per_division():
    assert len(RETAIL_CHECKS) == len(AGENCY_CHECKS) == 23
    assert len({c.name for c in RETAIL_CHECKS}) == len({c.name for c in AGENCY_CHECKS}) == 23


@pytest.mark.parametrize(
    "tables,checks,masked",
    [
        # A null key in a dimension hides its orphans, as NOT IN does.
        (samples.retail_with_faults, RETAIL_CHECKS, {"Null Check: dim_customers.customer_id",
         "Null Check: dim_date.date_key", "Uniqueness Check: dim_products.product_id",
         "Uniqueness Check: dim_date.date_key", "Referential Integrity: fact_sales -> dim_products"}),
        (samples.agency_with_faults, AGENCY_CHECKS, {"Null Check: dim_account_managers.manager_id",
         "Null Check: dim_campaigns.campaign_id", "Null Check: dim_date.date_key",
         "Uniqueness Check: dim_clients.client_id", "Uniqueness Check: dim_date.date_key",
         "Uniqueness Check: fact_client_billing.invoice_id", "Referential Integrity: dim_campaigns -> dim_clients",
         "Referential Integrity: fact_client_billing -> dim_clients"}),
    ],
)
def test_seeded_faults_are_found(spark, sample_dir, tables, checks, masked):
    report = run_checks(tables(spark, sample_dir), checks)
    passed = {r.test_name for r in report.filter("status = 'PASSED'").collect()}
    assert passed == masked
    assert not verdict(report).first().all_passed


def test_rfm_on_tiny_data(spark):
    d, m = dt.date, Decimal
    sales = spark.createDataFrame(
        [
            ("c1", "o1", d(2024, 1, 1), "Completed", m(10)), ("c1", "o1", d(2024, 1, 1), "Completed", m(5)),
            ("c1", "o2", d(2024, 1, 8), "Returned", m(1)), ("c2", "o3", d(2024, 1, 9), "Pending", m(7)),
            ("c3", "o4", d(2024, 1, 31), "Cancelled", m(99)), ("ghost", "o5", d(2024, 1, 2), "Completed", m(3)),
            ("c2", "o6", d(2024, 1, 1), None, m(50)),
        ],
        "customer_id string, order_id string, order_date date, status string, line_subtotal decimal(18,2)",
    )
    customers = spark.createDataFrame(
        [(c, c.upper(), None, "UK") for c in ("c1", "c2", "c3")],
        "customer_id string, full_name string, email string, country string",
    )
    got = {r.customer_id: (r.recency_days, r.frequency, float(r.monetary_value)) for r in
           rfm_segmentation(sales, customers).collect()}
    # Recency counts from the newest order of any status.
    assert got == {"c1": (23, 2, 16.0), "c2": (22, 1, 7.0)}


def test_segments_cover_the_grid(spark):
    grid = spark.range(1, 6).select(F.col("id").alias("r")).withColumn("f", F.explode(F.sequence(F.lit(1), F.lit(5))))
    names = {(r.r, r.f): r.s for r in grid.select("r", "f", segment(F.col("r"), F.col("f")).alias("s")).collect()}
    assert names[(5, 5)] == "Champions" and names[(3, 4)] == "Loyal Customers" and names[(4, 2)] == "Promising"
    assert names[(3, 2)] == "Need Attention" and names[(5, 1)] == "New Customers" and names[(1, 5)] == "Cannot Lose Them"
    assert names[(2, 3)] == "At Risk" and names[(2, 1)] == "About to Sleep"
    assert names[(3, 1)] == names[(1, 2)] == "Lost / Inactive"


def test_month_zero_retention_is_full(spark, sample_dir):
    rows = cohort_retention(samples.fact_sales(spark, sample_dir)).filter("month_index = 0").collect()
    assert rows and all(r.retention_percentage == 100.0 and r.active_customers == r.cohort_size for r in rows)
    rows = billing_cohorts(samples.fact_client_billing(spark, sample_dir)).filter("month_index = 0").collect()
    assert rows and all(r.revenue_retention_pct == r.client_retention_pct == 100.0 for r in rows)


@pytest.mark.parametrize("grain", [{}, YEAR, MONTH])
def test_attribution_keeps_all_revenue(spark, sample_dir, grain):
    sales, traffic = samples.event_sales(spark, sample_dir), samples.fact_web_traffic(spark, sample_dir)
    total = sales.filter("status <> 'Cancelled'").agg(F.sum("line_subtotal")).first()[0]
    attributed = channel_sales(sales, traffic, grain).agg(F.sum("gross_revenue")).first()[0]
    assert attributed == total
    full = attribution(sales, traffic, grain, keep_unattributed=True)
    assert round(sum(r.gross_revenue for r in full.collect()), 2) == float(total)
    assert "Direct/Unattributed" not in {r.traffic_source for r in attribution(sales, traffic, grain).collect()}


def test_target_badges(spark):
    values = [1.2, 1.0, 0.85, 0.8, 0.7, 0.6, 0.59, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    badges = [r[0].split(" ", 1)[1] for r in df.select(measures.target_badge(F.col("v"))).collect()]
    assert badges == ["Target Exceeded"] * 2 + ["Target Met"] * 2 + ["At Risk"] * 2 + ["Action Required"] * 2


def test_a_target_is_counted_once_at_every_level(spark, sample_dir):
    t = samples.agency(spark, sample_dir)
    total = t["dim_account_managers"].agg(F.sum("target_monthly_revenue")).first()[0]
    by_region = measures.target_attainment(t["dim_account_managers"], t["fact_client_billing"], ["region"])
    assert round(by_region.agg(F.sum("target")).first()[0], 2) == float(total)


def test_drilldown_levels(spark, sample_dir):
    sales, products = samples.fact_sales(spark, sample_dir), samples.dim_products(spark, sample_dir)
    drill = reports.category_drilldown(sales, products, samples.dim_customers(spark, sample_dir)).cache()
    grand = drill.filter("depth = 0 and all_countries = 1").collect()
    assert len(grand) == 1
    for depth in (0, 1, 2):
        for every in (0, 1):
            part = drill.filter(f"depth = {depth} and all_countries = {every}").agg(F.sum("total_revenue")).first()[0]
            assert part == pytest.approx(grand[0].total_revenue, rel=1e-12)


def test_heat_matrix_spans_all_months_by_default(spark, sample_dir):
    cohorts = billing_cohorts(samples.fact_client_billing(spark, sample_dir))
    wide = reports.billing_heat_matrix(cohorts)
    last = cohorts.agg(F.max("month_index")).first()[0]
    assert len(wide.columns) == last + 2
    assert wide.filter("m000 = 1.0").count() == wide.count()


def test_slicers(spark, sample_dir):
    t = samples.agency(spark, sample_dir)
    name = t["dim_account_managers"].filter("manager_id = 2").first()["name"]
    dates = (dt.date(1996, 1, 1), dt.date(1996, 12, 31))
    sliced = reports.slice_agency(t, managers=[name], between=dates)
    billing = sliced["fact_client_billing"]
    assert {r[0] for r in billing.select("manager_id").distinct().collect()} == {2}
    low, high = billing.agg(F.min("invoice_date"), F.max("invoice_date")).first()
    assert dates[0] <= low and high <= dates[1]
    assert reports.slice_agency(t)["dim_clients"] is t["dim_clients"]


def test_date_slicer_reads_only_its_months(spark, sample_dir, tmp_path):
    t = samples.agency(spark, sample_dir)
    names = ("fact_ad_performance", "fact_client_billing")
    publish({name: t[name] for name in names}, str(tmp_path))
    spoilt = 0
    for folder in [d for name in names for d in (tmp_path / name).glob("*_month=*")]:
        if "1996-03" <= folder.name.split("=")[1][:7] <= "1996-05":
            continue
        for file in folder.glob("*.parquet"):  # whoever opens it fails
            file.write_bytes(b"not parquet")
            (folder / f".{file.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt > 0
    stored = open_tables(spark, str(tmp_path), names, {name: t[name].schema for name in names}, keep_months=True)
    between = (dt.date(1996, 3, 10), dt.date(1996, 5, 20))
    sliced = reports.slice_agency({**t, **stored}, between=between)
    for name in names:
        plain = t[name].filter(F.col(FACT_LAYOUTS[name].month_of).between(*between))
        assert sliced[name].columns == plain.columns
        assert sliced[name].count() == plain.count() > 0
        assert sliced[name].exceptAll(plain).isEmpty()
