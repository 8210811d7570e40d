"""End-to-end runs: raw files to published galaxy, checks and analytics."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.dates import EARLIEST, LATEST
from orrery.operators.rejects import REASON, reject_counts, rejected_rows
from orrery.plans.agency_model import build_agency_galaxy, build_dim_date_agency
from orrery.plans.agency_reports import channel_efficiency, manager_portfolio
from orrery.plans.attribution import attribution
from orrery.plans.checks import AGENCY_CHECKS, RETAIL_CHECKS, Check, run_checks, verdict
from orrery.plans.retail_model import (
    DATED,
    DEFAULT_EMAIL,
    MAX_PRICE,
    SEQ,
    build_dim_customers,
    build_dim_date,
    build_dim_products,
    build_fact_sales,
    build_fact_web_traffic,
    dim_date_between,
    tag_retail_raw,
)
from orrery.plans.retention import billing_cohorts, cohort_retention
from orrery.plans.rfm import rfm_segmentation
from orrery.schemas import AGENCY, RETAIL
from orrery.sources.raw import read_agency_raw, read_retail_raw, set_apart
from orrery.sources.sinks import (
    FACT_LAYOUTS,
    export_all,
    export_csv,
    open_tables,
    publish,
    required_columns,
    run_named,
    save_check_report,
    swap_in,
    to_layout,
)

log = logging.getLogger(__name__)

# The agency calendar has its own shape, so it is published under its own name.
AGENCY_RENAMES = {"dim_date": "dim_date_agency"}


class ChecksFailed(RuntimeError):
    """A published galaxy did not pass its data-quality suite."""


class DuplicateKeys(ChecksFailed):
    """A primary key repeats; such a load is never accepted."""


def retail_queries(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    sales, traffic = tables["fact_sales"], tables["fact_web_traffic"]
    return {
        "cohort_retention": lambda: cohort_retention(sales),
        "rfm_segmentation": lambda: rfm_segmentation(sales, tables["dim_customers"]),
        "attribution_analysis": lambda: attribution(sales, traffic),
    }


def retail_results(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What is replaced together with the retail tables and computed from them: the calendar and two results."""
    queries = retail_queries(stored)
    return {
        "dim_date": build_dim_date(stored["dim_customers"], stored["fact_sales"], stored["fact_web_traffic"]),
        "rfm_segmentation_results": queries["rfm_segmentation"](),
        "cohort_retention_results": queries["cohort_retention"](),
    }


def agency_results(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What is replaced together with the agency tables and computed from them: the calendar and three results."""
    queries = agency_queries(stored)
    return {
        "dim_date": build_dim_date_agency(stored["fact_ad_performance"]),
        "manager_portfolio_results": queries["manager_portfolio"](),
        "campaign_channel_results": queries["campaign_channel"](),
        "client_billing_cohorts": queries["client_billing_cohorts"](),
    }


def agency_queries(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    managers, clients = tables["dim_account_managers"], tables["dim_clients"]
    billing, ads = tables["fact_client_billing"], tables["fact_ad_performance"]
    return {
        "manager_portfolio": lambda: manager_portfolio(managers, clients, billing, ads),
        "campaign_channel": lambda: channel_efficiency(tables["dim_campaigns"], ads),
        "client_billing_cohorts": lambda: billing_cohorts(billing),
    }


def _store(
    tables: Mapping[str, DataFrame],
    layouts: Mapping[str, T.StructType],
    root: str,
    by_month: bool,
    rename: Mapping[str, str] = {},
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Publish tables in their declared layout and open the stored copies; a null in a required column stops it."""
    typed = {name: to_layout(df, layouts[name]) for name, df in tables.items()}
    required = {name: required_columns(layouts[name]) for name in typed}
    loaded = publish(typed, root, rename, FACT_LAYOUTS if by_month else {}, required=required)
    schemas = {rename.get(name, name): df.schema for name, df in typed.items()}
    stored = open_tables(loaded.sparkSession, root, list(schemas), schemas)
    return {name: stored[rename.get(name, name)] for name in typed}, loaded


def store_retail(
    raw: Mapping[str, DataFrame],
    root: str,
    order: Sequence[str] = SEQ,
    default_email: str = DEFAULT_EMAIL,
    by_month: bool = True,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
    max_price: float = MAX_PRICE,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build and publish the retail galaxy in three steps: dimensions, facts, calendar.

    Each step reads the stored result of the one before: customers are
    deduplicated once although both facts need them, and the calendar takes its
    bounds from stored facts instead of building them a second time.
    """
    dims, loaded_dims = _store(
        {
            "dim_customers": build_dim_customers(raw["customers"], order, default_email, earliest, latest),
            "dim_products": build_dim_products(raw["products"], max_price),
        },
        RETAIL, root, by_month,
    )
    customers, products = dims["dim_customers"], dims["dim_products"]
    facts, loaded_facts = _store(
        {
            "fact_sales": build_fact_sales(raw["orders"], raw["order_items"], products, customers, order, earliest, latest),
            "fact_web_traffic": build_fact_web_traffic(raw["sessions"], customers, earliest, latest),
        },
        RETAIL, root, by_month,
    )
    dates, loaded_dates = _store(
        {"dim_date": build_dim_date(customers, facts["fact_sales"], facts["fact_web_traffic"])},
        RETAIL, root, by_month,
    )
    return {**dims, **facts, **dates}, loaded_dims.unionAll(loaded_facts).unionAll(loaded_dates)


def store_agency(
    raw: Mapping[str, DataFrame], root: str, by_month: bool = True
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build and publish the agency galaxy; the calendar comes from the stored ad performance."""
    galaxy = build_agency_galaxy(dict(raw))
    galaxy.pop("dim_date")
    tables, loaded = _store(galaxy, AGENCY, root, by_month)
    dates, loaded_dates = _store(
        {"dim_date": build_dim_date_agency(tables["fact_ad_performance"])}, AGENCY, root, by_month, AGENCY_RENAMES
    )
    return {**tables, **dates}, loaded.unionAll(loaded_dates)


def _check_and_publish(
    tables: dict[str, DataFrame],
    checks: Sequence[Check],
    queries: Callable[[Mapping[str, DataFrame]], dict[str, Callable[[], DataFrame]]],
    staged: str,
    out: str,
    on_fail: str,
    rename: Mapping[str, str] = {},
    processed: bool = False,
) -> bool:
    """Check staged tables, then make them the warehouse and run the reports on it.

    A load that is refused changes nothing but the validation report; its tables
    stay in the staged folder for inspection.
    """
    report = run_checks(tables, checks)
    spark = report.sparkSession
    save_check_report(report, f"{out}/validation_report")
    report = spark.read.option("header", True).csv(f"{out}/validation_report")
    repeated = report.filter("status = 'FAILED' and test_name like 'Uniqueness%'").collect()
    if repeated:
        raise DuplicateKeys("; ".join(f"{r.test_name}: {r.details}" for r in repeated))
    result = verdict(report).first()
    if not result["all_passed"]:
        message = f"{result['failed_checks']} data-quality checks failed, see {out}/validation_report"
        if on_fail == "raise":
            raise ChecksFailed(message)
        log.warning(message)
    swap_in(spark, staged, f"{out}/warehouse")
    schemas = {rename.get(name, name): df.schema for name, df in tables.items()}
    live = open_tables(spark, f"{out}/warehouse", list(schemas), schemas)
    if processed:
        export_all(live, f"{out}/processed")
    run_named(queries({name: live[rename.get(name, name)] for name in tables}), f"{out}/results")
    return bool(result["all_passed"])


def export_retail(galaxy: Mapping[str, DataFrame], root: str) -> None:
    """A retail galaxy as CSV, each table built once.

    The first and last day are observed while the tables that the calendar spans are written; they are not built again for it.
    """
    seen = {name: Observation() for name in DATED}
    for name, df in galaxy.items():
        if name in DATED:
            first, last = (bound(DATED[name]).cast("string").alias(a) for bound, a in ((F.min, "lo"), (F.max, "hi")))
            df = df.observe(seen[name], first, last)
        if name != "dim_date":
            export_csv(df, f"{root}/{name}")
    spans = [(found.get["lo"], found.get["hi"]) for found in seen.values()]
    spark = next(iter(galaxy.values())).sparkSession
    days = spark.createDataFrame(spans, "lo string, hi string")
    bounds = days.agg(F.min("lo").cast("date").alias("lo"), F.max("hi").cast("date").alias("hi"))
    export_csv(dim_date_between(bounds), f"{root}/dim_date")


def _staging(out: str) -> str:
    return f"{out}/staged-{uuid.uuid4().hex[:12]}"


def quarantine_retail(raw: dict[str, DataFrame], out: str, order: Sequence[str] = SEQ, **limits) -> DataFrame:
    """Store the rejected rows of every raw table with their reason; returns the counts per rule.

    ``limits`` are those of ``tag_retail_raw``.
    """
    tagged = tag_retail_raw(raw, order, **limits)
    # Clean rows are counted while the others are written, and those from what is stored: no table is tagged twice.
    clean = {name: Observation() for name in tagged}
    seen = {name: df.observe(clean[name], F.count_if(F.col(REASON).isNull()).alias("n")) for name, df in tagged.items()}
    rejected = {name: rejected_rows(df).drop(*order) for name, df in seen.items()}
    report = publish(rejected, out, layouts={})
    stored = open_tables(report.sparkSession, out, list(rejected), {name: df.schema for name, df in rejected.items()})
    rest = [(name, "clean", clean[name].get["n"]) for name in tagged if clean[name].get["n"]]
    accounted = report.sparkSession.createDataFrame(rest, f"table_name string, {REASON} string, row_count long")
    return reject_counts(**stored).unionByName(accounted)


def run_retail(
    spark: SparkSession,
    raw: str,
    out: str,
    on_fail: str = "warn",
    default_email: str = DEFAULT_EMAIL,
    quarantine: bool = False,
    by_month: bool = True,
    processed: bool = False,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
    max_price: float = MAX_PRICE,
    reject_malformed: bool = False,
) -> bool:
    """Raw retail files to warehouse, validation report and results; True when all checks passed.

    The load is staged and checked before it replaces the warehouse. ``processed`` also
    exports every model table as CSV.

    ``quarantine`` also stores the rejected rows and their counts per rule, which
    reads the raw files once more. ``by_month`` splits the facts into a folder per
    month; turn it off when a month is much smaller than a file should be.
    ``earliest``, ``latest`` and ``max_price`` bound what counts as a valid date and price.
    ``reject_malformed`` keeps lines with too few or too many fields out of the model and
    quarantines them with their text; without it they are read as far as they go.
    """
    tables = read_retail_raw(spark, raw, keep_malformed=reject_malformed)
    limits = {"earliest": earliest, "latest": latest, "max_price": max_price}
    if quarantine:
        export_csv(quarantine_retail(tables, f"{out}/quarantine", **limits), f"{out}/reject_counts")
    staged = _staging(out)
    tables = {name: set_apart(df)[0] for name, df in tables.items()}
    stored, _ = store_retail(tables, staged, default_email=default_email, by_month=by_month, **limits)
    return _check_and_publish(stored, RETAIL_CHECKS, retail_queries, staged, out, on_fail, processed=processed)


def run_agency(
    spark: SparkSession, raw: str, out: str, on_fail: str = "warn", by_month: bool = True, processed: bool = False
) -> bool:
    """Raw agency files to warehouse, validation report and results, as in ``run_retail``."""
    staged = _staging(out)
    stored, _ = store_agency(read_agency_raw(spark, raw), staged, by_month)
    return _check_and_publish(
        stored, AGENCY_CHECKS, agency_queries, staged, out, on_fail, AGENCY_RENAMES, processed
    )
