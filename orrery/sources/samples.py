"""The sample tables seen as galaxy tables, clean and dirty.

Adapters from the generic order/event tables to the retail and agency layouts.
They are what the registered queries, the tests and the benchmark read.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.dates import month_offset, month_start
from orrery.functions.ratios import money
from orrery.operators.first_rows import ROW_ORDER
from orrery.plans.agency_model import build_dim_date_agency
from orrery.plans.retail_model import build_dim_date
from orrery.schemas import RETAIL_RAW
from orrery.session import materialize
from orrery.sources.raw import normalize
from orrery.sources.sinks import file_system

SOURCES = ("Google Ads", "Facebook Ads", "Organic Search", "Direct", "Email", "Referral")
DEVICES = ("Desktop", "Mobile", "Tablet")
RAW_COUNTRIES = ("US", "USA", "US of A", "UK", " U.K. ", "Canada", "N/A", "usa")
CLIENT_TIERS = ("Platinum", "Gold", "Silver")
# Orders are moved by this many days so that they fall inside the accepted dates.
DATE_SHIFT_DAYS = 9131
MANAGERS = 7
CAMPAIGN_CLIENTS = 150


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    # The schema is looked up once: inferring it costs a job per read.
    path = f"{root}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _pick(values: tuple[str, ...], key: Column) -> Column:
    """Value number ``key % len(values)``."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def _every(key: Column, n: int) -> Column:
    return F.pmod(key, F.lit(n)) == 0


def _plus_days(start: dt.date, days: Column) -> Column:
    return F.date_add(F.lit(start), days.cast("int"))


# -- retail, clean ------------------------------------------------------------

def _signup(customer: Column) -> Column:
    return _plus_days(dt.date(1995, 1, 1), F.pmod(customer * 37, F.lit(2000)))


def dim_customers(spark: SparkSession, root: str) -> DataFrame:
    nation = load(spark, root, "nation").select("n_nationkey", "n_name")
    return load(spark, root, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        _signup(F.col("c_custkey")).alias("signup_date"),
    )


def dim_products(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        money(F.col("p_retailprice")).alias("base_price"),
    )


def fact_sales(spark: SparkSession, root: str) -> DataFrame:
    """Order lines; the line id repeats, which the uniqueness check is meant to find."""
    orders = load(spark, root, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_orderstatus"
    )
    lines = load(spark, root, "lineitem")
    quantity, price = F.col("l_quantity").cast("int"), money(F.col("l_extendedprice"))
    status = F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "Pending")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        "order_date",
        quantity.alias("quantity"),
        price.alias("unit_price"),
        money(quantity * price).alias("line_subtotal"),
        money(money(F.col("l_tax")) * 100).alias("shipping_fee"),
        status.otherwise("Cancelled").alias("status"),
        F.greatest(F.lit(0), month_offset(F.col("order_date"), _signup(F.col("o_custkey")))).alias("month_index"),
    )


def fact_web_traffic(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("event_id")
    return load(spark, root, "events").filter(F.col("event_type") != "purchase").select(
        key.alias("session_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("session_date"),
        _pick(SOURCES, key).alias("traffic_source"),
        _pick(DEVICES, key).alias("device_type"),
        (F.pmod(key, F.lit(15)) + 1).cast("int").alias("pages_viewed"),
        F.floor("value").cast("int").alias("duration_seconds"),
        (F.col("event_type") == "error").cast("int").alias("bounced"),
        (F.col("event_type") == "signup").cast("int").alias("converted"),
    )


def event_sales(spark: SparkSession, root: str) -> DataFrame:
    """Purchases from the event table: sales that meet sessions on the same customer and day."""
    key = F.col("event_id")
    quantity, price = (F.pmod(key, F.lit(4)) + 1).cast("int"), money(F.col("value"))
    return load(spark, root, "events").filter(F.col("event_type") == "purchase").select(
        key.alias("order_item_id"),
        F.expr("event_id div 2").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.pmod(key, F.lit(200)).alias("product_id"),
        F.col("ts").cast("date").alias("order_date"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        money(quantity * price).alias("line_subtotal"),
        F.lit("5.00").cast("decimal(18,2)").alias("shipping_fee"),
        F.when(_every(key, 7), "Cancelled").otherwise("Completed").alias("status"),
    )


def retail(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    customers, sales = dim_customers(spark, root), fact_sales(spark, root)
    traffic = fact_web_traffic(spark, root)
    return {
        "dim_customers": customers,
        "dim_products": dim_products(spark, root),
        "dim_date": build_dim_date(customers, sales, traffic),
        "fact_sales": sales,
        "fact_web_traffic": traffic,
    }


def retail_with_faults(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The clean tables with faults seeded by key, at least one per kind of check."""
    clean = retail(spark, root)
    customer, product = F.col("customer_id"), F.col("product_id")
    order, session = F.col("order_id"), F.col("session_id")
    sales = clean["fact_sales"].withColumns(
        {
            "order_item_id": F.when(~_every(order, 211), F.col("order_item_id")),
            "quantity": F.when(_every(order, 101), -F.col("quantity")).otherwise(F.col("quantity")),
            "unit_price": F.when(_every(order, 307), F.lit(0)).otherwise(F.col("unit_price")).cast("decimal(18,2)"),
            "line_subtotal": F.when(_every(order, 997), F.col("line_subtotal") + F.lit("0.02").cast("decimal(18,2)"))
            .otherwise(F.col("line_subtotal")),
            "customer_id": F.when(_every(order, 503), -customer - 1).when(~_every(order, 509), customer),
        }
    )
    traffic = clean["fact_web_traffic"].withColumns(
        {
            "session_id": F.when(_every(session, 13), F.lit(None)).when(_every(session, 17), F.lit(1)).otherwise(session),
            "pages_viewed": F.when(_every(session, 19), 0).otherwise(F.col("pages_viewed")),
            "duration_seconds": F.when(_every(session, 23), -30).otherwise(F.col("duration_seconds")),
            "bounced": F.when(_every(session, 29), 2).otherwise(F.col("bounced")),
            "converted": F.when(_every(session, 31), 3).otherwise(F.col("converted")),
        }
    )
    return {
        "dim_customers": clean["dim_customers"].withColumn(
            "customer_id", F.when(_every(customer, 10), F.lit(10)).otherwise(customer)
        ),
        "dim_products": clean["dim_products"].withColumns(
            {
                "product_id": F.when(~_every(product, 400), product),
                "base_price": F.when(_every(product, 50), F.lit(0)).otherwise(F.col("base_price")).cast("decimal(18,2)"),
            }
        ),
        "dim_date": clean["dim_date"].filter(F.col("day") != 29),
        "fact_sales": sales,
        "fact_web_traffic": traffic,
    }


# -- retail, dirty ------------------------------------------------------------

def _spelled(day: Column, key: Column) -> Column:
    """A date as text in one of the spellings (or non-dates) raw files use."""
    return (
        F.when(_every(key, 200), "202-01-01")
        .when(_every(key, 100), "NULL")
        .when(_every(key, 90), "0202-01-01")
        .when(_every(key, 70), "invalid_date")
        .when(_every(key, 55), "2019-12-31")
        .when(_every(key, 4), F.date_format(day, "MM/dd/yyyy"))
        .when(_every(key, 9), F.date_format(day, "dd/MM/yyyy"))
        .when(_every(key, 13), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:30:00")))
        .when(_every(key, 17), F.date_format(day, "dd-MMM-yyyy"))
        .when(_every(key, 19), F.concat(F.date_format(day, "MM/dd/yy"), F.lit(" 09:15 PM")))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def _twice(df: DataFrame, key: Column, every: int) -> DataFrame:
    """Repeat one row in ``every``; ``copy`` tells the copies apart, ``_row_order`` orders them."""
    copies = F.when(_every(key, every), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    doubled = df.withColumn("copy", F.explode(copies))
    return doubled.withColumn(ROW_ORDER, key * 2 + F.col("copy"))


def customers_raw(spark: SparkSession, root: str) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    rows = _twice(load(spark, root, "customer"), key, 50)
    spelled_name = (
        F.when(F.col("copy") == 1, F.concat(name, F.lit(" duplicate")))
        .when(_every(key, 70), "")
        .when(_every(key, 15), F.concat(F.lit(" \t "), F.lower(name), F.lit("  ")))
        .when(_every(key, 11), F.concat(F.lit("mary-jane o'brien 3RD "), key.cast("string")))
        .otherwise(F.lower(name))
    )
    return rows.select(
        F.concat(F.lit("CUST"), key.cast("string")).alias("customer_id"),
        spelled_name.alias("full_name"),
        F.when(_every(key, 95), "").otherwise(F.concat(F.lit(" "), F.upper(name), F.lit("@EXAMPLE.COM"))).alias("email"),
        _pick(RAW_COUNTRIES, key).alias("country"),
        _spelled(_plus_days(dt.date(2021, 1, 1), F.pmod(key * 37, F.lit(2000))), key).alias("signup_date"),
        ROW_ORDER,
    )


def products_raw(spark: SparkSession, root: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    return load(spark, root, "part").select(
        F.concat(F.lit("PRD"), key.cast("string")).alias("product_id"),
        F.when(_every(key, 60), "   ")
        .when(_every(key, 40), "")
        .when(_every(key, 5), F.concat(F.lit("  "), name, F.lit(" ")))
        .otherwise(name)
        .alias("product_name"),
        F.when(_every(key, 33), "").otherwise(F.col("p_type")).alias("category"),
        F.when(_every(key, 100), "-50.00")
        .when(_every(key, 77), "NaN")
        .when(_every(key, 49), "99999.99")
        .otherwise(money(F.col("p_retailprice")).cast("string"))
        .alias("base_price"),
        key.alias(ROW_ORDER),
    )


def orders_raw(spark: SparkSession, root: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = _twice(load(spark, root, "orders"), key, 80)
    customer = F.col("o_custkey").cast("string")
    day = F.date_add(F.col("o_orderdate").cast("date"), DATE_SHIFT_DAYS)
    return rows.select(
        F.concat(F.lit("ORD"), key.cast("string")).alias("order_id"),
        F.when(_every(key, 111), F.concat(F.lit("CUSTX"), customer))
        .otherwise(F.concat(F.lit("CUST"), customer))
        .alias("customer_id"),
        _spelled(day, key).alias("order_date"),
        F.when(F.col("copy") == 1, "Returned")
        .when(_every(key, 60), "")
        .when(_every(key, 61), "on HOLD")
        .when(status == "F", "completed")
        .when(status == "O", " Pending ")
        .otherwise("CANCELLED")
        .alias("status"),
        F.concat(F.pmod(key, F.lit(20)).cast("string"), F.lit(".50")).alias("shipping_fee"),
        ROW_ORDER,
    )


def order_items_raw(spark: SparkSession, root: str) -> DataFrame:
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    return load(spark, root, "lineitem").select(
        F.concat_ws("-", order, line).alias("order_item_id"),
        F.concat(F.lit("ORD"), order.cast("string")).alias("order_id"),
        F.concat(F.lit("PRD"), part.cast("string")).alias("product_id"),
        F.when(_every(order + line, 250), "-1")
        .when(_every(order, 251), "")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(_every(part, 97), "0").otherwise(money(F.col("l_extendedprice")).cast("string")).alias("unit_price"),
    )


def sessions_raw(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("event_id")
    user = F.col("user_id").cast("string")
    return load(spark, root, "events").select(
        F.concat(F.lit("SESS"), key.cast("string")).alias("session_id"),
        F.concat(F.when(_every(key, 120), "CUSTX").otherwise("CUST"), user).alias("customer_id"),
        _spelled(F.col("ts").cast("date"), key).alias("session_date"),
        F.when(_every(key, 45), "").otherwise(_pick(SOURCES, key)).alias("traffic_source"),
        F.when(_every(key, 46), "N/A").otherwise(F.concat(F.lit(" "), _pick(DEVICES, key))).alias("device_type"),
        F.when(_every(key, 300), "-2").otherwise((F.pmod(key, F.lit(15)) + 1).cast("string")).alias("pages_viewed"),
        F.when(_every(key, 350), "-30").otherwise(F.floor("value").cast("string")).alias("duration_seconds"),
        (F.col("event_type") == "error").cast("int").cast("string").alias("bounced"),
        (F.col("event_type") == "signup").cast("int").cast("string").alias("converted"),
    )


RAW_VIEWS = {
    "customers": customers_raw,
    "products": products_raw,
    "orders": orders_raw,
    "order_items": order_items_raw,
    "sessions": sessions_raw,
}


def retail_raw_text(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The dirty raw tables as text, as a file would hold them."""
    return {name: view(spark, root) for name, view in RAW_VIEWS.items()}


#: Tables of fewer stored bytes may come as one task, and are dealt out when they land; larger ones are read in splits.
DEALT_BELOW = 16 << 20
RAW_TABLES = {"customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem", "sessions": "events"}


def _stored_bytes(spark: SparkSession, path: str) -> int:
    fs, target = file_system(spark, path)
    return fs.getContentSummary(target).getLength()


@cache
def _landed(spark: SparkSession, root: str, name: str) -> DataFrame:
    text = RAW_VIEWS[name](spark, root)
    if _stored_bytes(spark, f"{root}/{RAW_TABLES[name]}.parquet") < DEALT_BELOW:
        text = text.repartition(spark.sparkContext.defaultParallelism)
    return materialize(text, f"landed-{name}")


def raw_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One dirty raw table after no-value tokens are nulled and numbers typed.

    The text is landed in the scratch folder once per session, as raw data would
    be, so that the cleansing rules filter stored columns instead of the
    expressions that spell them.
    """
    return normalize(_landed(spark, root, name), RETAIL_RAW[name])


def retail_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, root, name) for name in RAW_VIEWS}


# -- agency ---------------------------------------------------------------------

def dim_account_managers(spark: SparkSession, root: str) -> DataFrame:
    nation, region = load(spark, root, "nation"), load(spark, root, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return load(spark, root, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("manager_id"),
        F.col("s_name").alias("name"),
        F.col("r_name").alias("region"),
        money(F.greatest(money(F.col("s_acctbal")), F.lit(0)) * 10).alias("target_monthly_revenue"),
    )


def dim_clients(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey")
    return load(spark, root, "customer").select(
        key.alias("client_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        _pick(CLIENT_TIERS, key).alias("client_tier"),
        F.abs(money(F.col("c_acctbal"))).alias("monthly_retainer_fee"),
        _plus_days(dt.date(1995, 1, 1), F.pmod(key, F.lit(1500))).alias("onboarding_date"),
        F.pmod(key, F.lit(MANAGERS)).alias("primary_account_manager_id"),
    )


def dim_campaigns(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "part").select(
        F.col("p_partkey").alias("campaign_id"),
        F.pmod("p_partkey", F.lit(CAMPAIGN_CLIENTS)).alias("client_id"),
        F.col("p_name").alias("campaign_name"),
        F.col("p_type").alias("marketing_channel"),
        money(money(F.col("p_retailprice")) * 10).alias("monthly_ad_budget"),
    )


def fact_ad_performance(spark: SparkSession, root: str) -> DataFrame:
    part, quantity = F.col("l_partkey"), F.col("l_quantity").cast("long")
    price = money(F.col("l_extendedprice"))
    return load(spark, root, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        part.alias("campaign_id"),
        F.pmod(part, F.lit(CAMPAIGN_CLIENTS)).alias("client_id"),
        money(price * money(F.col("l_discount"))).alias("ad_spend"),
        (quantity * (F.pmod(part, F.lit(20)) + 30)).alias("impressions"),
        quantity.alias("clicks"),
        F.pmod(F.col("l_linenumber"), F.lit(3)).cast("long").alias("conversions"),
        price.alias("client_conversion_revenue"),
    )


def fact_client_billing(spark: SparkSession, root: str) -> DataFrame:
    total = money(F.col("o_totalprice"))
    retainer = money(total * F.lit("0.60").cast("decimal(4,2)"))
    markup = money(total * F.lit("0.15").cast("decimal(4,2)"))
    return load(spark, root, "orders").select(
        month_start(F.col("o_orderdate")).alias("invoice_date"),
        F.concat(F.lit("INV"), F.col("o_orderkey").cast("string")).alias("invoice_id"),
        F.col("o_custkey").alias("client_id"),
        F.pmod("o_custkey", F.lit(MANAGERS)).alias("manager_id"),
        retainer.alias("retainer_billing"),
        markup.alias("ad_management_markup"),
        money(total - retainer - markup).alias("consulting_billing"),
        total.alias("total_billing_amount"),
    )


def agency(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    ads = fact_ad_performance(spark, root)
    return {
        "dim_account_managers": dim_account_managers(spark, root),
        "dim_clients": dim_clients(spark, root),
        "dim_campaigns": dim_campaigns(spark, root),
        "dim_date": build_dim_date_agency(ads),
        "fact_ad_performance": ads,
        "fact_client_billing": fact_client_billing(spark, root),
    }


def agency_with_faults(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The agency tables with faults seeded by key, at least one per kind of check."""
    clean = agency(spark, root)
    client, campaign, manager = F.col("client_id"), F.col("campaign_id"), F.col("manager_id")
    target, fee, budget = F.col("target_monthly_revenue"), F.col("monthly_retainer_fee"), F.col("monthly_ad_budget")
    owner, total = F.col("primary_account_manager_id"), F.col("total_billing_amount")
    return {
        "dim_account_managers": clean["dim_account_managers"].withColumns(
            {
                "target_monthly_revenue": F.when(_every(manager, 9), -target - 1).otherwise(target),
                "manager_id": F.when(_every(manager, 6), F.lit(6)).otherwise(manager),
            }
        ),
        "dim_clients": clean["dim_clients"].withColumns(
            {
                "monthly_retainer_fee": F.when(_every(client, 40), -fee - 1).otherwise(fee),
                "primary_account_manager_id": F.when(_every(client, 31), F.lit(-5)).otherwise(owner),
                "client_id": F.when(~_every(client, 37), client),
            }
        ),
        "dim_campaigns": clean["dim_campaigns"].withColumns(
            {
                "monthly_ad_budget": F.when(_every(campaign, 41), -budget).otherwise(budget),
                "campaign_id": F.when(_every(campaign, 43), F.lit(43)).otherwise(campaign),
            }
        ),
        "dim_date": clean["dim_date"].filter(F.col("month") != 2),
        "fact_ad_performance": clean["fact_ad_performance"].withColumns(
            {
                "ad_spend": F.when(_every(campaign, 47), -F.col("ad_spend") - 1).otherwise(F.col("ad_spend")),
                "date": F.when(~_every(campaign, 59), F.col("date")),
            }
        ),
        "fact_client_billing": clean["fact_client_billing"].withColumns(
            {
                "total_billing_amount": F.when(_every(client, 53), -total)
                .when(_every(client, 67), total + 1)
                .otherwise(total),
                "manager_id": F.when(_every(client, 71), F.lit(-1)).otherwise(manager),
                "invoice_id": F.when(~_every(client, 73), F.col("invoice_id")),
            }
        ),
    }


def agency_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Agency inputs with padded, lower-case names."""
    clean = agency(spark, root)
    pad = F.lit("  ")
    return {
        "managers": clean["dim_account_managers"].withColumn("name", F.concat(pad, F.lower("name"), pad)),
        "clients": clean["dim_clients"].withColumns(
            {
                "company_name": F.concat(F.lit("\t"), F.lower("company_name"), F.lit(" o'hara inc ")),
                "industry": F.concat(pad, F.col("industry"), pad),
            }
        ),
        "campaigns": clean["dim_campaigns"],
        "ad_performance": clean["fact_ad_performance"],
        "client_billing": clean["fact_client_billing"],
    }
