"""Headline queries at one scale factor; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Each query is
built and run to the end (``noop`` sink) ``BENCH_RUNS`` times in turn and the best
time counts: the first round pays for class loading and code generation, which a
long-lived session does not. ``agency_pipeline`` is the whole agency run: CSV files
to stored galaxy, 23 checks, three exported reports (its input files are written
before the clock starts; a month of this data is too small for a folder of its own).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import partial

from pyspark.sql import SparkSession

from orrery.plans.pipeline import run_agency
from orrery.registry.queries import QUERIES
from orrery.session import build_session
from orrery.sources import samples
from orrery.sources.sinks import export_csv

HEADLINE = (
    "rfm_segments", "retention_cohorts", "channel_attribution",
    "manager_leaderboard", "channel_grid", "client_billing_cohorts",
    "retail_checks", "agency_checks",
    "model_products", "model_customers", "model_sales", "model_traffic", "agency_calendar", "reject_accounting",
    "sales_kpis_by_status", "conversion_by_day", "revenue_growth", "signup_cohort_retention",
    "ad_kpis_by_channel", "target_attainment_by_manager",
    "category_drilldown", "portfolio_drilldown", "monthly_trend", "expected_daily_spend", "monthly_invoices",
)


def agency_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    for name, df in samples.agency_raw(spark, sf_dir).items():
        export_csv(df.repartition(spark.sparkContext.defaultParallelism), f"{folder}/{name}.csv")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "orrery-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    agency_files(spark, sf_dir, f"{folder}/raw")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    jobs = {name: partial(run, name) for name in HEADLINE}
    jobs["agency_pipeline"] = lambda: run_agency(spark, f"{folder}/raw", f"{folder}/out")
    best: dict[str, float] = {}
    for _ in range(runs):
        for name, job in jobs.items():
            start = time.perf_counter()
            job()
            took = time.perf_counter() - start
            best[name] = min(took, best.get(name, took))
            print(f"{name:32s} {took:7.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": {name: round(took, 3) for name, took in best.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "runs": runs,
        "statistic": "best of runs",
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
