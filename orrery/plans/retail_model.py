"""Retail galaxy: raw customers, products, orders, items and sessions to a star per fact.

Every builder takes raw tables whose no-value tokens are already null and whose
numeric columns are typed (see ``sources.raw``). ``order`` names the columns that
give the raw row order that keep-first deduplication needs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.dates import (
    EARLIEST,
    LATEST,
    clean_date,
    is_weekend,
    month_offset,
)
from orrery.functions.ratios import money
from orrery.functions.text import (
    COUNTRY_NAMES,
    capitalize,
    default_then_strip,
    map_values,
    title_case,
)
from orrery.operators.first_rows import ROW_ORDER, flag_repeats, keep_first
from orrery.operators.grids import calendar
from orrery.operators.membership import flag_referenced, keep_referenced
from orrery.operators.rejects import REASON, Rule, clean_rows, tag_rejects
from orrery.session import materialize
from orrery.sources.raw import MALFORMED, MALFORMED_REASON, set_apart

# The builders filter with plain predicates, which reach the file scan; the tag_*
# functions name the rule each dropped row broke. Tests hold the two together.

# Defaults and limits of the cleansing rules.
MAX_PRICE = 5000
DEFAULT_PRODUCT = "Unknown Product"
DEFAULT_CATEGORY = "General"
DEFAULT_NAME = "Missing Name"
DEFAULT_COUNTRY = "Unknown"
DEFAULT_STATUS = "Completed"
DEFAULT_SOURCE = "Organic"
DEFAULT_DEVICE = "Desktop"
DEFAULT_SIGNUP = dt.date(2024, 1, 1)
CALENDAR_DEFAULT = (dt.date(2024, 1, 1), dt.date(2026, 12, 31))
CALENDAR_PAD_DAYS = 5

# The placeholder address is a deployment choice; pass your own.
DEFAULT_EMAIL = "no-email@example.com"

SEQ = (ROW_ORDER,)


# -- products ---------------------------------------------------------------

def product_rules(max_price: float = MAX_PRICE) -> list[Rule]:
    price = F.col("base_price")
    return [
        ("bad_price", (price <= 0) | (price > max_price)),
        ("missing_price", price.isNull()),
    ]


def tag_products(raw: DataFrame, max_price: float = MAX_PRICE) -> DataFrame:
    return tag_rejects(raw, product_rules(max_price))


def build_dim_products(raw: DataFrame, max_price: float = MAX_PRICE) -> DataFrame:
    """Products with ``0 < price <= max_price``; all columns kept, no deduplication."""
    kept = raw.filter((F.col("base_price") > 0) & (F.col("base_price") <= max_price))
    return kept.withColumns(
        {
            "product_name": default_then_strip(F.col("product_name"), DEFAULT_PRODUCT),
            "category": default_then_strip(F.col("category"), DEFAULT_CATEGORY),
        }
    )


# -- customers --------------------------------------------------------------

def tag_customers(
    raw: DataFrame, order: Sequence[str] = SEQ, earliest: dt.date = EARLIEST, latest: dt.date = LATEST
) -> DataFrame:
    """Every raw customer; repeats rejected, defaulted sign-up dates noted in ``signup_defaulted``."""
    flagged = flag_repeats(raw, ["customer_id"], order)
    tagged = tag_rejects(flagged, [("duplicate_customer", F.col("is_repeat"))]).drop("is_repeat")
    return tagged.withColumn("signup_defaulted", clean_date(F.col("signup_date"), earliest, latest).isNull())


def build_dim_customers(
    raw: DataFrame,
    order: Sequence[str] = SEQ,
    default_email: str = DEFAULT_EMAIL,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
) -> DataFrame:
    """One row per customer id: first row wins, then names, emails, countries and dates are cleaned."""
    first = keep_first(raw, ["customer_id"], order)
    return first.select(
        "customer_id",
        title_case(default_then_strip(F.col("full_name"), DEFAULT_NAME)).alias("full_name"),
        F.lower(default_then_strip(F.col("email"), default_email)).alias("email"),
        map_values(default_then_strip(F.col("country"), DEFAULT_COUNTRY), COUNTRY_NAMES).alias("country"),
        F.coalesce(clean_date(F.col("signup_date"), earliest, latest), F.lit(DEFAULT_SIGNUP)).alias("signup_date"),
    )


# -- sales ------------------------------------------------------------------

def item_rules() -> list[Rule]:
    quantity, price = F.col("quantity"), F.col("unit_price")
    return [
        ("bad_item_value", (quantity <= 0) | (price <= 0)),
        ("missing_item_value", quantity.isNull() | price.isNull()),
    ]


def sane_items(raw: DataFrame) -> DataFrame:
    return raw.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def tag_orders(
    raw: DataFrame,
    dim_customers: DataFrame,
    order: Sequence[str] = SEQ,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
) -> DataFrame:
    """Every raw order with the first rule it breaks: repeat, no valid date, unknown customer."""
    dated = raw.withColumn("order_date", clean_date(F.col("order_date"), earliest, latest))
    known = flag_referenced(flag_repeats(dated, ["order_id"], order), "customer_id", dim_customers)
    rules = [
        ("duplicate_order", F.col("is_repeat")),
        ("no_valid_date", F.col("order_date").isNull()),
        ("unknown_customer", ~F.col("is_referenced")),
    ]
    return tag_rejects(known, rules).drop("is_repeat", "is_referenced")


def tag_items(raw: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Every raw order item with the first rule it breaks: bad or missing values, unknown product."""
    known = flag_referenced(raw, "product_id", dim_products)
    rules = [*item_rules(), ("unknown_product", ~F.col("is_referenced"))]
    return tag_rejects(known, rules).drop("is_referenced")


def build_fact_sales(
    orders: DataFrame,
    items: DataFrame,
    dim_products: DataFrame,
    dim_customers: DataFrame,
    order: Sequence[str] = SEQ,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
) -> DataFrame:
    """Order lines with their order's date and status and the months since sign-up.

    Customers are joined to orders, not to lines: the inner join drops unknown
    customers and brings the sign-up date at once, on the smaller table.
    """
    # Parsed before the ranking: the filter on the date can't pass it, so the text is parsed once, and the date is smaller.
    parsed = orders.withColumn("order_date", clean_date(F.col("order_date"), earliest, latest))
    dated = keep_first(parsed, ["order_id"], order).filter("order_date is not null")
    signups = dim_customers.select(F.col("customer_id").alias("_cust"), "signup_date")
    placed = dated.join(signups, F.col("customer_id").eqNullSafe(F.col("_cust"))).select(
        F.col("order_id").alias("_order"),
        "customer_id",
        "order_date",
        money(F.col("shipping_fee")).alias("shipping_fee"),
        capitalize(default_then_strip(F.col("status"), DEFAULT_STATUS)).alias("status"),
        F.greatest(F.lit(0), month_offset(F.col("order_date"), F.col("signup_date"))).alias("month_index"),
    )
    sold = keep_referenced(sane_items(items), "product_id", dim_products)
    lines = sold.join(placed, F.col("order_id").eqNullSafe(F.col("_order")))
    return lines.select(
        "order_item_id",
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "quantity",
        "unit_price",
        money(F.col("quantity") * F.col("unit_price")).alias("line_subtotal"),
        "shipping_fee",
        "status",
        "month_index",
    )


# -- web traffic ------------------------------------------------------------

def session_rules() -> list[Rule]:
    pages, seconds = F.col("pages_viewed"), F.col("duration_seconds")
    return [
        ("no_valid_date", F.col("session_date").isNull()),
        ("bad_session_value", (pages <= 0) | (seconds < 0)),
        ("missing_session_value", pages.isNull() | seconds.isNull()),
    ]


def tag_sessions(
    raw: DataFrame, dim_customers: DataFrame, earliest: dt.date = EARLIEST, latest: dt.date = LATEST
) -> DataFrame:
    """Every raw session with the first rule it breaks: date, values, unknown customer."""
    dated = raw.withColumn("session_date", clean_date(F.col("session_date"), earliest, latest))
    known = flag_referenced(dated, "customer_id", dim_customers)
    rules = [*session_rules(), ("unknown_customer", ~F.col("is_referenced"))]
    return tag_rejects(known, rules).drop("is_referenced")


def build_fact_web_traffic(
    raw: DataFrame, dim_customers: DataFrame, earliest: dt.date = EARLIEST, latest: dt.date = LATEST
) -> DataFrame:
    """Sessions of known customers with a valid date, pages and duration."""
    sane = raw.filter((F.col("pages_viewed") > 0) & (F.col("duration_seconds") >= 0))
    dated = sane.withColumn("session_date", clean_date(F.col("session_date"), earliest, latest)).filter("session_date is not null")
    return keep_referenced(dated, "customer_id", dim_customers).select(
        "session_id",
        "customer_id",
        "session_date",
        default_then_strip(F.col("traffic_source"), DEFAULT_SOURCE).alias("traffic_source"),
        default_then_strip(F.col("device_type"), DEFAULT_DEVICE).alias("device_type"),
        "pages_viewed",
        "duration_seconds",
        "bounced",
        "converted",
    )


# -- calendar ---------------------------------------------------------------

def date_bounds(*columns: tuple[DataFrame, str]) -> DataFrame:
    """One row ``lo, hi`` over several date columns; nulls ignored, null when there are no dates."""
    each = [df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")) for df, c in columns]
    return reduce(DataFrame.unionByName, each).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def build_dim_date(dim_customers: DataFrame, fact_sales: DataFrame, fact_web_traffic: DataFrame) -> DataFrame:
    """Gapless calendar over sign-ups, orders and sessions, padded by five days."""
    return dim_date_between(
        date_bounds((dim_customers, "signup_date"), (fact_sales, "order_date"), (fact_web_traffic, "session_date"))
    )


def dim_date_between(bounds: DataFrame) -> DataFrame:
    """The calendar of one row ``lo, hi``."""
    date = F.col("date")
    return calendar(bounds, CALENDAR_PAD_DAYS, CALENDAR_DEFAULT).select(
        date.alias("date_key"),
        "date",
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(date)).alias("quarter_name"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.date_format(date, "MMM").alias("month_short"),
        F.dayofmonth(date).alias("day"),
        (F.weekday(date) + 1).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        is_weekend(date).alias("is_weekend"),
    )


def build_retail_galaxy(
    raw: dict[str, DataFrame],
    order: Sequence[str] = SEQ,
    default_email: str = DEFAULT_EMAIL,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
    max_price: float = MAX_PRICE,
) -> dict[str, DataFrame]:
    """All five tables from the five raw ones, lazily."""
    products = build_dim_products(raw["products"], max_price).drop(*order)
    customers = build_dim_customers(raw["customers"], order, default_email, earliest, latest)
    sales = build_fact_sales(raw["orders"], raw["order_items"], products, customers, order, earliest, latest)
    traffic = build_fact_web_traffic(raw["sessions"], customers, earliest, latest)
    return {
        "dim_customers": customers,
        "dim_products": products,
        "dim_date": build_dim_date(customers, sales, traffic),
        "fact_sales": sales,
        "fact_web_traffic": traffic,
    }


#: The tables whose dates the calendar spans.
DATED = {"dim_customers": "signup_date", "fact_sales": "order_date", "fact_web_traffic": "session_date"}


def galaxy_row_counts(galaxy: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of a retail galaxy's tables, each built once.

    The pass that counts a table also finds its first and last day, so the calendar's rows are counted without
    building the tables it spans again.
    """
    def counted(name: str) -> DataFrame:
        day = F.col(DATED[name]) if name in DATED else F.lit(None).cast("date")
        rows = galaxy[name].agg(F.count("*").alias("row_count"), F.min(day).alias("lo"), F.max(day).alias("hi"))
        return rows.select(F.lit(name).alias("table_name"), "row_count", "lo", "hi")

    seen = materialize(reduce(DataFrame.unionAll, [counted(name) for name in galaxy if name != "dim_date"]), "galaxy-counts")
    dates = dim_date_between(seen.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    days = dates.agg(F.count("*").alias("row_count")).select(F.lit("dim_date").alias("table_name"), "row_count")
    return seen.select("table_name", "row_count").unionAll(days)


def _as_tagged(malformed: DataFrame, tagged: DataFrame) -> DataFrame:
    """Malformed rows in the columns of a tagged table; dates stay unread and notes empty."""
    have = {f.name: f.dataType for f in malformed.schema.fields}
    columns = [F.col(f.name) if have.get(f.name) == f.dataType else F.lit(None).cast(f.dataType).alias(f.name) for f in tagged.schema.fields]
    return malformed.select(*columns, MALFORMED)


def tag_retail_raw(
    raw: dict[str, DataFrame],
    order: Sequence[str] = SEQ,
    earliest: dt.date = EARLIEST,
    latest: dt.date = LATEST,
    max_price: float = MAX_PRICE,
) -> dict[str, DataFrame]:
    """Every raw table with its ``reject_reason`` column: clean plus rejected rows add up to the input.

    Malformed lines (of tables read with ``keep_malformed``) are rejected as such, and take part in no other rule: a
    broken line is nobody's first row. Then all tagged tables have the lines' text in a last column.
    """
    if any(MALFORMED in df.columns for df in raw.values()):
        apart = {name: set_apart(df) for name, df in raw.items()}
        tagged = tag_retail_raw({name: good for name, (good, _) in apart.items()}, order, earliest, latest, max_price)
        return {
            name: df.withColumn(MALFORMED, F.lit(None).cast("string")).unionByName(
                _as_tagged(apart[name][1], df).withColumns({REASON: F.lit(MALFORMED_REASON), MALFORMED: F.col(MALFORMED)})
            )
            for name, df in tagged.items()
        }
    customers = tag_customers(raw["customers"], order, earliest, latest)
    products = tag_products(raw["products"], max_price)
    # Deduplication never removes an id, so the raw customers name all known ones without being ranked again.
    known_customers, known_products = raw["customers"], clean_rows(products)
    return {
        "customers": customers,
        "products": products,
        "orders": tag_orders(raw["orders"], known_customers, order, earliest, latest),
        "order_items": tag_items(raw["order_items"], known_products),
        "sessions": tag_sessions(raw["sessions"], known_customers, earliest, latest),
    }
