from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures
from orrery.operators.first_rows import ROW_ORDER
from orrery.operators.rejects import clean_rows, reject_counts, rejected_rows
from orrery.plans import agency_model, retail_model
from orrery.plans.agency_reports import channel_efficiency, manager_portfolio
from orrery.plans.retention import billing_cohorts
from orrery.sources import samples


def test_products_outside_the_price_range_are_dropped(spark):
    raw = fixtures.retail_raw(spark, products=fixtures.PRODUCTS)
    got = {r.product_id: r.product_name for r in retail_model.build_dim_products(raw["products"]).collect()}
    assert got == {"PRD101": "Laptop Pro", "PRD102": "Chinos"}


def test_customers_are_deduplicated_and_standardised(spark):
    raw = fixtures.retail_raw(spark, customers=fixtures.CUSTOMERS)
    customers = retail_model.build_dim_customers(raw["customers"], default_email="none@shop.test")
    got = {r.customer_id: tuple(r)[1:] for r in customers.collect()}
    assert got == {
        "CUST101": ("John Smith", "john.smith@example.com", "United States", dt.date(2024, 1, 15)),
        "CUST102": ("Jane Doe", "jane@example.com", "Canada", dt.date(2024, 1, 1)),
        "CUST103": ("", "none@shop.test", "United Kingdom", dt.date(2024, 10, 31)),
    }


def test_sessions_need_values_and_a_known_customer(spark):
    raw = fixtures.retail_raw(spark, customers=fixtures.CUSTOMERS, sessions=fixtures.SESSIONS)
    customers = retail_model.build_dim_customers(raw["customers"])
    got = retail_model.build_fact_web_traffic(raw["sessions"], customers).collect()
    assert {r.session_id for r in got} == {"SESS001", "SESS005"}
    tagged = retail_model.tag_sessions(raw["sessions"], customers)
    assert {r.session_id: r.reject_reason for r in rejected_rows(tagged).collect()} == {
        "SESS002": "bad_session_value", "SESS003": "unknown_customer", "SESS004": "bad_session_value",
    }


def test_sales_lines(spark):
    d = Decimal
    raw = fixtures.retail_raw(
        spark,
        products=fixtures.PRODUCTS,
        customers=fixtures.CUSTOMERS,
        orders=[
            ("O1", "CUST101", "03/15/2024", "on HOLD", d(5)),
            ("O1", "CUST102", "2024-09-09", "Completed", d(6)),
            ("O2", "CUST103", "2024-09-01", None, d(7)),
            ("O3", "CUST999", "2024-09-01", "Completed", d(8)),
            ("O4", "CUST101", "2031-01-01", "Completed", d(9)),
        ],
        order_items=[
            ("I1", "O1", "PRD101", 2, d("10.50")),
            ("I2", "O1", "PRD999", 1, d("10.00")),
            ("I3", "O1", "PRD102", -1, d("10.00")),
            ("I4", "O2", "PRD102", 3, d("1.10")),
            ("I4", "O2", "PRD102", 3, d("1.10")),
            ("I5", "O3", "PRD101", 1, d("1.00")),
            ("I6", "O4", "PRD101", 1, d("1.00")),
        ],
    )
    galaxy = retail_model.build_retail_galaxy(raw)
    got = sorted(
        (r.order_item_id, r.customer_id, r.status, r.line_subtotal, r.month_index) for r in galaxy["fact_sales"].collect()
    )
    line = ("I4", "CUST103", "Completed", d("3.30"), 0)
    assert got == [("I1", "CUST101", "On hold", d("21.00"), 2), line, line]
    reasons = {
        (r.table_name, r.reject_reason): r.row_count
        for r in reject_counts(**retail_model.tag_retail_raw(raw)).collect() if r.reject_reason != "clean"
    }
    assert reasons == {
        ("customers", "duplicate_customer"): 1,
        ("products", "bad_price"): 2,
        ("orders", "duplicate_order"): 1,
        ("orders", "unknown_customer"): 1,
        ("orders", "no_valid_date"): 1,
        ("order_items", "bad_item_value"): 1,
        ("order_items", "unknown_product"): 1,
    }


def test_null_keys_refer_to_null_keys(spark):
    d = Decimal
    raw = fixtures.retail_raw(
        spark,
        products=fixtures.PRODUCTS,
        customers=[*fixtures.CUSTOMERS, (None, "no id", None, "UK", "2024-01-01")],
        orders=[(None, None, "2024-02-01", "Completed", d(1)), (None, "CUST101", "2024-02-01", "Completed", d(1))],
        order_items=[("I1", None, "PRD101", 1, d(1))],
    )
    sales = retail_model.build_retail_galaxy(raw)["fact_sales"].collect()
    assert [(r.order_item_id, r.order_id, r.customer_id, r.month_index) for r in sales] == [("I1", None, None, 1)]


def test_calendar_falls_back_when_there_are_no_dates(spark):
    galaxy = retail_model.build_retail_galaxy(fixtures.retail_raw(spark, products=fixtures.PRODUCTS))
    dates = galaxy["dim_date"]
    row = dates.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(row) == (dt.date(2023, 12, 27), dt.date(2027, 1, 5), 1106)
    new_year = dates.filter("date_key = date'2024-01-06'").first()
    assert (new_year.day_of_week, new_year.day_name, new_year.month_short, new_year.quarter_name, new_year.is_weekend) == (
        6, "Saturday", "Jan", "Q1", 1,
    )


@pytest.mark.parametrize("table,fact", [("orders", None), ("sessions", "fact_web_traffic"), ("products", "dim_products")])
def test_clean_and_rejected_rows_add_up(spark, sample_dir, table, fact):
    raw = samples.retail_raw(spark, sample_dir)
    tagged = retail_model.tag_retail_raw(raw)[table]
    clean, rejected = clean_rows(tagged).count(), rejected_rows(tagged).count()
    assert rejected > 0 and clean + rejected == raw[table].count()
    if fact:
        assert clean == retail_model.build_retail_galaxy(raw)[fact].count()


def test_the_model_does_not_depend_on_the_partitioning(spark, sample_dir):
    def fingerprint(parts):
        raw = {n: df.repartition(parts) for n, df in samples.retail_raw(spark, sample_dir).items()}
        sales = retail_model.build_retail_galaxy(raw, order=[ROW_ORDER])["fact_sales"]
        return sales.agg(F.count("*"), F.sum(F.xxhash64(*sales.columns).cast("decimal(38,0)"))).first()

    assert fingerprint(1) == fingerprint(13)


def test_agency_names_are_cleaned(spark):
    galaxy = agency_model.build_agency_galaxy(fixtures.agency_raw(spark))
    assert {r.company_name for r in galaxy["dim_clients"].collect()} == {"Acme Marketing Agency Corp", "Globex Corp"}
    assert {r.name for r in galaxy["dim_account_managers"].collect()} == {"Michael Chang", "Jane Smith"}
    assert [(str(r.date_key), r.quarter, r.day_of_week, r.is_weekend) for r in galaxy["dim_date"].collect()] == [
        ("2024-03-01", "Q1", "Friday", 0), ("2024-03-02", "Q1", "Saturday", 1),
    ]


def test_agency_reports_on_the_small_fixture(spark):
    t = agency_model.build_agency_galaxy(fixtures.agency_raw(spark))
    ads, billing = t["fact_ad_performance"], t["fact_client_billing"]
    google = channel_efficiency(t["dim_campaigns"], ads).filter("marketing_channel = 'Google Ads'").first()
    assert (google.ctr_pct, google.avg_cpc, google.avg_cpa, google.conversion_rate_pct, google.channel_roas) == (
        2.4, 1.25, 33.33, 3.75, 8.0,
    )
    assert [tuple(r) for r in billing_cohorts(billing).collect()] == [("2024-03", 2, 0, 2, 25800.0, 100.0, 100.0)]
    top = manager_portfolio(t["dim_account_managers"], t["dim_clients"], billing, ads).first()
    assert (top.manager_id, top.active_clients, top.total_billing_managed, top.overall_managed_roas) == (
        "M1", 1, 17000.0, 8.0,
    )


def test_managers_without_clients_show_zeros(spark):
    t = agency_model.build_agency_galaxy(fixtures.agency_raw(spark))
    idle = spark.createDataFrame([("M9", "idle", "EMEA", Decimal(1))], t["dim_account_managers"].schema)
    report = manager_portfolio(
        t["dim_account_managers"].unionAll(idle), t["dim_clients"], t["fact_client_billing"], t["fact_ad_performance"]
    )
    row = report.filter("manager_id = 'M9'").first()
    assert (row.active_clients, row.total_billing_managed, row.avg_monthly_billing, row.overall_managed_roas) == (
        0, 0.0, 0.0, 0.0,
    )


def test_limits_are_parameters(spark):
    raw = fixtures.retail_raw(
        spark,
        customers=[("CUST1", "A", "a@b.c", "US", "2031-02-03")],
        products=[("PRD1", "Big", "X", Decimal("7000.00"))],
        orders=[("ORD1", "CUST1", "2031-05-06", "completed", Decimal("1.00"))],
        order_items=[("OI1", "ORD1", "PRD1", 1, Decimal("7000.00"))],
        sessions=[("S1", "CUST1", "2031-05-06", "Email", "Mobile", 3, 10, 0, 0)],
    )
    later = {"latest": dt.date(2035, 12, 31), "max_price": 10_000}
    galaxy = retail_model.build_retail_galaxy(raw, **later)
    assert [galaxy[t].count() for t in ("dim_customers", "dim_products", "fact_sales", "fact_web_traffic")] == [1] * 4
    assert galaxy["dim_customers"].first()["signup_date"] == dt.date(2031, 2, 3)
    assert {r.reject_reason for r in reject_counts(**retail_model.tag_retail_raw(raw, **later)).collect()} == {"clean"}
    assert retail_model.build_retail_galaxy(raw)["fact_sales"].count() == 0


def test_spend_by_month_counts_the_daily_grid_without_listing_days(spark):
    """Repeated campaigns and clients, spans that begin and end inside months, budgets below the least and missing."""
    day = dt.date
    clients = spark.createDataFrame(
        [(1, day(2023, 12, 30)), (1, day(2024, 1, 17)), (1, day(2024, 1, 17)), (2, day(2024, 2, 29)), (3, None), (4, day(2030, 1, 1))],
        "client_id long, onboarding_date date",
    )
    campaigns = spark.createDataFrame(
        [(10, 1, 300.0), (10, 1, 300.0), (10, 1, 900.0), (11, 2, 1.0), (12, 2, None), (13, 3, 60.0), (14, 4, 60.0), (15, 9, 60.0)],
        "campaign_id long, client_id long, monthly_ad_budget double",
    )
    key = ["month", "campaign_id", "client_id", "daily_budget", "expected_spend"]
    for start, end in ((day(1969, 12, 1), day(1970, 2, 10)), (day(2024, 1, 10), day(2024, 4, 6)), (day(2024, 3, 1), day(2024, 3, 1))):
        moved = clients.withColumn("onboarding_date", F.expr("onboarding_date - interval 54 years").cast("date")) if end.year == 1970 else clients
        grid = agency_model.expected_daily_spend(campaigns, moved, start, end).withColumn("month", F.trunc("date", "month"))
        days = {tuple(r) for r in grid.groupBy(*key).agg(F.count("*").alias("days")).collect()}
        months = agency_model.expected_spend_by_month(campaigns, moved, start, end)
        assert months.columns == [*key, "days"]
        assert sorted(map(tuple, months.collect()), key=repr) == sorted(days, key=repr)
    assert "interval 1 day" not in months._jdf.queryExecution().toString().lower()


def test_registered_spend_lists_no_days(spark, sample_dir):
    from orrery.registry.queries import QUERIES

    plan = QUERIES["expected_daily_spend"](spark, sample_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Some(INTERVAL '1' DAY)" not in plan and "INTERVAL '1' DAY" not in plan


def test_large_raw_tables_land_without_a_shuffle(spark, sample_dir, monkeypatch):
    """A table read in splits lands as they are; a query lands only the tables it reads."""
    from orrery.registry.queries import QUERIES

    landed = []

    def keep(df, name):
        landed.append((name, "repartition" in df._jdf.queryExecution().logical().toString().lower()))
        return df

    monkeypatch.setattr(samples, "materialize", keep)
    samples._landed.cache_clear()
    try:
        QUERIES["rejected_orders"](spark, sample_dir)
        assert sorted(landed) == [("landed-customers", True), ("landed-orders", True)]
        samples._landed.cache_clear()
        landed.clear()
        monkeypatch.setattr(samples, "DEALT_BELOW", 0)
        QUERIES["sane_items"](spark, sample_dir)
        assert sorted(landed) == [("landed-order_items", False), ("landed-products", False)]
    finally:
        samples._landed.cache_clear()


def test_row_counts_build_each_table_once(spark):
    raw = fixtures.retail_raw(spark, products=fixtures.PRODUCTS, customers=fixtures.CUSTOMERS)
    galaxy = retail_model.build_retail_galaxy(raw)
    counts = retail_model.galaxy_row_counts(galaxy)
    assert {tuple(r) for r in counts.collect()} == {(name, df.count()) for name, df in galaxy.items()}
    assert counts.inputFiles() and all("galaxy-counts" in f for f in counts.inputFiles())
