"""Data-quality suites: declared checks, evaluated together as one Spark job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The names of the checks and the texts of their details, in the classes and the constants below.


@dataclass(frozen=True)
class NotNull:
    """No row of ``table`` has a null in any of ``columns``."""

    table: str
    columns: tuple[str, ...]
    label: str

    @property
    def name(self) -> str:
        return f"Null Check: {self.label}"

    detail = "Found %d null values in PK."


@dataclass(frozen=True)
class Unique:
    """No value of ``column`` repeats; nulls are ignored."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"Uniqueness Check: {self.table}.{self.column}"

    detail = "Found %d duplicate primary keys."


@dataclass(frozen=True)
class Reference:
    """Every non-null ``column`` of ``table`` exists in ``dim.dim_column`` (SQL ``NOT IN`` rules)."""

    table: str
    column: str
    dim: str
    dim_column: str

    @property
    def name(self) -> str:
        return f"Referential Integrity: {self.table} -> {self.dim}"

    detail = "Found %d orphaned records."


@dataclass(frozen=True)
class Value:
    """No row satisfies the ``broken`` condition (a SQL expression)."""

    table: str
    broken: str
    label: str
    detail: str = "Found %d records with negative or zero values."

    @property
    def name(self) -> str:
        return f"Logical Value Check: {self.label}"


@dataclass(frozen=True)
class Arithmetic:
    """A derived column agrees with its formula (``broken`` is the violation)."""

    table: str
    broken: str
    label: str
    detail: str

    @property
    def name(self) -> str:
        return f"Calculation Check: {self.label}"


Check = NotNull | Unique | Reference | Value | Arithmetic


# Report texts that differ from a check's default one.
NEGATIVE = "Found %d records with negative values."
SUBTOTAL_OFF = "Found %d records where subtotal does not match qty * price."
BILLING_OFF = "Found %d records where total billing does not match sum of details."


def _not_null(table: str, *columns: str) -> NotNull:
    return NotNull(table, columns, f"{table}.{columns[0]}")


RETAIL_CHECKS: tuple[Check, ...] = (
    _not_null("dim_customers", "customer_id"),
    _not_null("dim_products", "product_id"),
    _not_null("dim_date", "date_key"),
    _not_null("fact_sales", "order_item_id"),
    _not_null("fact_web_traffic", "session_id"),
    Unique("dim_customers", "customer_id"),
    Unique("dim_products", "product_id"),
    Unique("dim_date", "date_key"),
    Unique("fact_sales", "order_item_id"),
    Unique("fact_web_traffic", "session_id"),
    Reference("fact_sales", "customer_id", "dim_customers", "customer_id"),
    Reference("fact_sales", "product_id", "dim_products", "product_id"),
    Reference("fact_sales", "order_date", "dim_date", "date_key"),
    Reference("fact_web_traffic", "customer_id", "dim_customers", "customer_id"),
    Reference("fact_web_traffic", "session_date", "dim_date", "date_key"),
    Value("fact_sales", "quantity <= 0", "fact_sales.quantity"),
    Value("fact_sales", "unit_price <= 0", "fact_sales.unit_price"),
    Value("dim_products", "base_price <= 0", "dim_products.base_price"),
    Value("fact_web_traffic", "pages_viewed <= 0", "fact_web_traffic.pages_viewed"),
    Value("fact_web_traffic", "duration_seconds < 0", "fact_web_traffic.duration_seconds"),
    Value("fact_web_traffic", "bounced not in (0, 1)", "fact_web_traffic.bounced (binary check)"),
    Value("fact_web_traffic", "converted not in (0, 1)", "fact_web_traffic.converted (binary check)"),
    Arithmetic("fact_sales", "abs(line_subtotal - quantity * unit_price) > 0.01", "line_subtotal", SUBTOTAL_OFF),
)

AGENCY_CHECKS: tuple[Check, ...] = (
    _not_null("dim_account_managers", "manager_id"),
    _not_null("dim_clients", "client_id"),
    _not_null("dim_campaigns", "campaign_id"),
    _not_null("dim_date", "date_key"),
    _not_null("fact_ad_performance", "campaign_id", "date"),
    _not_null("fact_client_billing", "invoice_id"),
    Unique("dim_account_managers", "manager_id"),
    Unique("dim_clients", "client_id"),
    Unique("dim_campaigns", "campaign_id"),
    Unique("dim_date", "date_key"),
    Unique("fact_client_billing", "invoice_id"),
    Reference("dim_clients", "primary_account_manager_id", "dim_account_managers", "manager_id"),
    Reference("dim_campaigns", "client_id", "dim_clients", "client_id"),
    Reference("fact_ad_performance", "date", "dim_date", "date_key"),
    Reference("fact_ad_performance", "campaign_id", "dim_campaigns", "campaign_id"),
    Reference("fact_client_billing", "client_id", "dim_clients", "client_id"),
    Reference("fact_client_billing", "manager_id", "dim_account_managers", "manager_id"),
    Value(
        "dim_account_managers", "target_monthly_revenue < 0", "dim_account_managers.target_monthly_revenue", NEGATIVE
    ),
    Value("dim_clients", "monthly_retainer_fee < 0", "dim_clients.monthly_retainer_fee", NEGATIVE),
    Value("dim_campaigns", "monthly_ad_budget < 0", "dim_campaigns.monthly_ad_budget", NEGATIVE),
    Value("fact_ad_performance", "ad_spend < 0", "fact_ad_performance.ad_spend", NEGATIVE),
    Value(
        "fact_client_billing", "total_billing_amount < 0", "fact_client_billing.total_billing_amount", NEGATIVE
    ),
    Arithmetic(
        "fact_client_billing",
        "abs(total_billing_amount - (retainer_billing + ad_management_markup + consulting_billing)) > 0.01",
        "billing_sum",
        BILLING_OFF,
    ),
)


def _entry(number: int, key: Column | None, fact: int, dim: int) -> Column:
    """What a row adds to a check; a key goes as two independent hashes, which fit a key of any type in 16 bytes."""
    hashes = [F.lit(None).cast("long")] * 2 if key is None else [
        F.when(key.isNotNull(), F.xxhash64(key)), F.when(key.isNotNull(), F.xxhash64(F.lit(number), key))
    ]
    return F.struct(
        F.lit(number).alias("check_no"),
        hashes[0].alias("key"),
        hashes[1].alias("key2"),
        F.lit(fact).cast("long").alias("n"),
        F.lit(dim).cast("long").alias("in_dim"),
    )


def _comparable(column: str, own: T.DataType, other: T.DataType) -> Column:
    """A key column so that equal keys of both sides of a reference hash alike: as it is where the types agree."""
    if own == other:
        return F.col(column)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return F.col(column).cast("long" if isinstance(own, whole) and isinstance(other, whole) else "string")


def _entries(number: int, check: Check, table: str, tables: dict[str, DataFrame]) -> list[Column]:
    """What one row of ``table`` adds to a check: an entry per broken rule, key or reference, or null."""
    match check:
        case NotNull() if check.table == table:
            broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in check.columns])
            return [F.when(broken, _entry(number, None, 1, 0))]
        case Value() | Arithmetic() if check.table == table:
            return [F.when(F.expr(check.broken), _entry(number, None, 1, 0))]
        case Unique() if check.table == table:
            key = F.col(check.column)
            return [F.when(key.isNotNull(), _entry(number, key, 1, 0))]
        case Reference() if table in (check.table, check.dim):
            fact, dim = tables[check.table].schema[check.column].dataType, tables[check.dim].schema[check.dim_column].dataType
            found = [_entry(number, _comparable(check.column, fact, dim), 1, 0)] if check.table == table else []
            return found + ([_entry(number, _comparable(check.dim_column, dim, fact), 0, 1)] if check.dim == table else [])
    return []


def check_counts(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``check_no, violations`` for every check, from one scan of each table.

    All tables' entries meet in one aggregate by check and key, which counts a hot
    key where it is read; a reference is broken where a key has fact rows and no
    dimension row, so there is no join. Keys are never turned into text: they are
    compared by 128 bits of hash, and the aggregate handles fixed-width numbers only.
    """
    spark = next(iter(tables.values())).sparkSession
    # A seed for each check, so that one without entries reports zero.
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    seed = spark.range(0, len(checks), 1, 1).select(
        F.col("id").cast("int").alias("check_no"), none.alias("key"), none.alias("key2"), zero.alias("n"), zero.alias("in_dim")
    )
    pieces = [seed]
    for table, df in tables.items():
        entries = [entry for i, check in enumerate(checks) for entry in _entries(i, check, table, tables)]
        if entries:
            pieces.append(df.select(F.inline(F.array(*entries))).where("check_no is not null"))
    per_key = reduce(DataFrame.unionAll, pieces).groupBy("check_no", "key", "key2").agg(
        F.sum("n").alias("n"), F.sum("in_dim").alias("in_dim")
    )
    keyed = F.col("key").isNotNull()
    totals = per_key.groupBy("check_no").agg(
        F.sum("n").alias("rows"),
        F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("repeats"),
        F.sum(F.when(keyed & (F.col("in_dim") == 0), F.col("n")).otherwise(0)).alias("missing"),
        F.sum("in_dim").alias("dim_rows"),
        F.sum(F.when(keyed, F.lit(0)).otherwise(F.col("in_dim"))).alias("dim_nulls"),
    )
    orphans = F.when(F.col("dim_rows") == 0, F.col("rows")).when(F.col("dim_nulls") > 0, F.lit(0)).otherwise(F.col("missing"))

    def numbers(kind: type) -> list[int]:
        return [i for i, check in enumerate(checks) if isinstance(check, kind)]

    violations = (
        F.when(F.col("check_no").isin(numbers(Unique)), F.col("repeats"))
        .when(F.col("check_no").isin(numbers(Reference)), orphans)
        .otherwise(F.col("rows"))
    )
    return totals.select("check_no", violations.cast("long").alias("violations"))


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``check_no, test_name, status, violations, details``, one row per check, lazily.

    A reference follows SQL ``NOT IN``: everything is an orphan when the
    dimension is empty, nothing is when the dimension holds a null key.
    """
    totals = check_counts(tables, checks)
    names = F.array(*[F.lit(c.name) for c in checks])
    details = F.array(*[F.lit(c.detail) for c in checks])
    at = F.col("check_no") + 1
    return totals.select(
        at.alias("check_no"),
        F.element_at(names, at).alias("test_name"),
        F.when(F.col("violations") == 0, "PASSED").otherwise("FAILED").alias("status"),
        "violations",
        F.replace(F.element_at(details, at), F.lit("%d"), F.col("violations").cast("string")).alias("details"),
    ).orderBy("check_no")


def verdict(report: DataFrame) -> DataFrame:
    """One row: ``all_passed`` and the number of failed checks."""
    return report.agg(
        F.bool_and(F.col("status") == "PASSED").alias("all_passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed_checks"),
    )
