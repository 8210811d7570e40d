"""Publishing tables, exporting results, saving reports and views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.dates import month_start


class RowCountMismatch(RuntimeError):
    """What was stored differs from what was sent."""


class NullsInRequired(RuntimeError):
    """A column that must have a value everywhere has none in some rows."""


@dataclass(frozen=True)
class Layout:
    """How a table is laid out on storage: split by the month of a date column."""

    month_of: str
    partition: str


# The facts are filtered by date; their dimensions are read whole.
FACT_LAYOUTS = {
    "fact_sales": Layout("order_date", "order_month"),
    "fact_web_traffic": Layout("session_date", "session_month"),
    "fact_ad_performance": Layout("date", "date_month"),
    "fact_client_billing": Layout("invoice_date", "invoice_month"),
}


def between_days(df: DataFrame, layout: Layout, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``; a month column is filtered too, which prunes folders, and left off."""
    kept = df.filter(F.col(layout.month_of).between(first, last))
    if layout.partition in df.columns:
        kept = kept.filter(F.col(layout.partition).between(first.replace(day=1), last)).drop(layout.partition)
    return kept


def to_layout(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Project and cast to a declared table layout."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields])


def _stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    # With the schema given, counting takes one job that reads file footers only.
    return spark.read.schema(schema).parquet(path).count()


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def swap_in(spark: SparkSession, staged: str, live: str) -> None:
    """Make a staged folder the live one; what was live stays beside it as ``<live>_previous``.

    Two renames in one file system: no data is copied, and a run that dies between
    them leaves the old tables whole under the previous name.
    """
    fs, new = file_system(spark, staged)
    now, old = file_system(spark, live)[1], file_system(spark, f"{live}_previous")[1]
    if fs.exists(now):
        if fs.exists(old):
            fs.delete(old, True)
        if not fs.rename(now, old):
            raise OSError(f"cannot set {live} aside")
    if not fs.rename(new, now):
        if fs.exists(old):
            fs.rename(old, now)
        raise OSError(f"cannot move {staged} to {live}")


def required_columns(layout: T.StructType) -> list[str]:
    """The columns of a declared layout that must not be null."""
    return [f.name for f in layout.fields if not f.nullable]


def write_table(
    df: DataFrame, path: str, layout: Layout | None = None, mode: str = "overwrite", required: Sequence[str] = ()
) -> int:
    """Write one Parquet table and verify the stored row count; returns the rows written.

    The written rows are counted by an observation on the write itself, and the
    stored ones come from the Parquet footers, so verifying costs no extra scan.
    Nulls in ``required`` columns are counted by the same observation, and raise
    ``NullsInRequired`` once the rows are stored: stage what must not be seen then.
    A partitioned table is rebalanced first: adaptive execution merges small
    months into one file and splits a month that is too large for one task.
    """
    spark, schema = df.sparkSession, df.schema
    before = _stored_rows(spark, path, schema) if mode == "append" and _exists(spark, path) else 0
    if layout is not None:
        df = df.withColumn(layout.partition, month_start(F.col(layout.month_of)))
        df = df.hint("rebalance", layout.partition)
    # Observed behind the last shuffle: tasks there count once even if an executor
    # is lost, while repeated map tasks would be counted twice.
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in required]
    writer = df.observe(seen, F.count(F.lit(1)).alias("n"), *nulls).write.mode(mode)
    if layout is not None:
        writer = writer.partitionBy(layout.partition)
    writer.parquet(path)
    written, stored = seen.get["n"], _stored_rows(spark, path, schema) - before
    if written != stored:
        raise RowCountMismatch(f"{path}: {written} rows sent, {stored} stored")
    empty = {c: seen.get[f"null {c}"] for c in required if seen.get[f"null {c}"]}
    if empty:
        raise NullsInRequired(f"{path}: no value in " + ", ".join(f"{n} rows of {c}" for c, n in empty.items()))
    return written


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    rename: Mapping[str, str] = {},
    layouts: Mapping[str, Layout] = FACT_LAYOUTS,
    mode: str = "overwrite",
    required: Mapping[str, Sequence[str]] = {},
) -> DataFrame:
    """Replace (or append to) a set of tables below ``root``; one report row per table.

    The tables are written at the same time, so that small dimensions do not
    wait for each other's last task.
    """
    def load(item: tuple[str, DataFrame]) -> tuple[str, int]:
        name, df = item
        target = rename.get(name, name)
        return target, write_table(df, f"{root}/{target}", layouts.get(name), mode, required.get(name, ()))

    with ThreadPoolExecutor(len(tables)) as pool:
        rows = list(pool.map(load, tables.items()))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, rows_loaded long")


def open_tables(
    spark: SparkSession,
    root: str,
    names: Sequence[str],
    schemas: Mapping[str, T.StructType] = {},
    keep_months: bool = False,
) -> dict[str, DataFrame]:
    """Read published tables back, with their declared schema where given.

    Month partition columns are left off; a filter on the date still prunes by
    row-group statistics. With ``keep_months`` they stay, so that ``between_days``
    reads the folders of its months only.
    """
    months = [layout.partition for layout in FACT_LAYOUTS.values()]

    def opened(name: str) -> DataFrame:
        reader = spark.read.schema(schemas[name]) if name in schemas else spark.read
        table = reader.parquet(f"{root}/{name}")
        return table if keep_months else table.drop(*months)

    return {name: opened(name) for name in names}


def save_as_tables(
    tables: Mapping[str, DataFrame], root: str | None = None, rename: Mapping[str, str] = {}
) -> DataFrame:
    """Truncate-load catalog tables and verify their row counts.

    Files go below ``root``, or to the catalog's own location without it.
    """
    rows = []
    for name, df in tables.items():
        spark, target = df.sparkSession, rename.get(name, name)
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if root is not None:
            writer = writer.option("path", f"{root}/{target}")
        writer.saveAsTable(target)
        stored = spark.table(target).count()
        if stored != seen.get["n"]:
            raise RowCountMismatch(f"{target}: {seen.get['n']} rows sent, {stored} stored")
        rows.append((target, stored))
    return spark.createDataFrame(rows, "table_name string, rows_loaded long")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header and ISO dates, one file per task."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def export_all(tables: Mapping[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        export_csv(df, f"{root}/{name}")


def run_named(queries: Mapping[str, Callable[[], DataFrame]], root: str) -> list[str]:
    """Run named queries in order and export each as ``<name>_results``; an error stops the run."""
    paths = []
    for name, query in queries.items():
        paths.append(f"{root}/{name}_results")
        export_csv(query(), paths[-1])
    return paths


def save_check_report(report: DataFrame, path: str) -> None:
    """The validation report as ``test_name, status, details`` in check order."""
    # Bounded by the number of declared checks, so one file is right here.
    export_csv(report.orderBy("check_no").select("test_name", "status", "details").coalesce(1), path)


# Channel attribution as SQL text over catalog tables, for the saved view.
ATTRIBUTION_SQL = """
with touch as (
  select customer_id, session_date,
         min_by(traffic_source, struct(-duration_seconds as d, -pages_viewed as p, session_id as s)) as source
  from identifier({traffic})
  where customer_id is not null and session_date is not null
  group by customer_id, session_date
), sold as (
  select t.source,
         count(distinct s.order_id) as total_orders,
         sum(s.quantity) as units_sold,
         sum(s.line_subtotal) as revenue
  from identifier({sales}) s
  -- Null-safe, though neither side has nulls here: the join then has shuffle keys of its own, not those of the
  -- grouping in touch, and adaptive execution can split a hot customer and day.
  join touch t on s.customer_id <=> t.customer_id and s.order_date <=> t.session_date
  where s.status <> 'Cancelled'
  group by t.source
), seen as (
  select traffic_source, count(session_id) as total_sessions,
         sum(bounced) as bounced_sessions, sum(converted) as converted_sessions
  from identifier({traffic})
  group by traffic_source
)
select traffic_source,
       total_sessions,
       bounced_sessions,
       round(try_divide(cast(bounced_sessions as double), total_sessions) * 100, 2) as bounce_rate_pct,
       round(try_divide(cast(converted_sessions as double), total_sessions) * 100, 2)
         as session_conversion_rate_pct,
       coalesce(total_orders, 0) as total_orders,
       coalesce(units_sold, 0) as units_sold,
       round(cast(coalesce(revenue, 0) as double), 2) as gross_revenue,
       round(try_divide(cast(coalesce(revenue, 0) as double), total_sessions), 2) as revenue_per_session,
       round(cast(coalesce(revenue, 0) as double) / coalesce(total_orders, 1), 2) as average_order_value
from seen left join sold on seen.traffic_source = sold.source
"""


def save_attribution_view(
    spark: SparkSession, sales_table: str, traffic_table: str, view: str = "view_marketing_attribution"
) -> DataFrame:
    """Create or replace the saved attribution view over two catalog tables, and return it."""
    def quoted(name: str) -> str:
        return "'" + name.replace("'", "''") + "'"

    body = ATTRIBUTION_SQL.format(sales=quoted(sales_table), traffic=quoted(traffic_table))
    spark.sql(f"create or replace view identifier({quoted(view)}) as {body}")
    return spark.table(view)
