from __future__ import annotations

import datetime as dt
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orrery.operators.cohorts import monthly_cohorts
from orrery.operators.comparisons import share_of_total, year_over_year
from orrery.operators.first_rows import flag_repeats, keep_first
from orrery.operators.grids import daily_grid, monthly_grid
from orrery.operators.membership import flag_referenced, keep_referenced
from orrery.operators.tiles import Tile, with_tiles
from orrery.operators.touch import attribute_sales, best_daily_sessions
from orrery.plans.retail_model import build_fact_sales
from orrery.session import materialize


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_keep_first_follows_the_order_and_groups_nulls(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), (None, 5, "n2"), (None, 2, "n1"), ("b", 4, "only")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(4)
    assert {r.v for r in keep_first(df, ["k"], ["o"]).collect()} == {"first", "n1", "only"}


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as o")
    assert _plan(keep_first(df, ["k"], ["o"])).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("salts", [1, 4, 256])
def test_flag_repeats_marks_all_but_the_first(spark, salts):
    # One key owns a third of the rows.
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", i) for i in random.Random(1).sample(range(900), 900)]
    df = spark.createDataFrame(rows, "k string, o long")
    flagged = flag_repeats(df, ["k"], ["o"], salts=salts)
    first = {}
    for k, o in rows:
        first[k] = min(o, first.get(k, o))
    got = flagged.collect()
    assert len(got) == len(rows)
    assert {r.o for r in got if not r.is_repeat} == set(first.values())


def test_references_match_null_with_null(spark):
    facts = spark.createDataFrame([("a",), (None,), ("x",)], "k string")
    dims = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(str(r.k) for r in keep_referenced(facts, "k", dims).collect()) == ["None", "a"]
    flags = {r.k: r.is_referenced for r in flag_referenced(facts, "k", dims).collect()}
    assert flags == {"a": True, None: True, "x": False}


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 13, 500])
def test_tiles_equal_ntile(spark, n):
    rng = random.Random(n)
    rows = [
        (f"c{i:04d}", rng.choice([1, 1, 1, 2, 9]), rng.choice([None, 5, 7]), rng.randint(0, 10**6) / 100)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id string, freq int, gap int, money double")
    tiles = [Tile("t1", "freq"), Tile("t2", "gap", descending=True), Tile("t3", "money"), Tile("t4", "gap")]
    mine = with_tiles(df, "id", tiles, 5)
    expected = df.select(
        "*",
        F.ntile(5).over(W.orderBy("freq", "id")).alias("t1"),
        F.ntile(5).over(W.orderBy(F.desc_nulls_last("gap"), "id")).alias("t2"),
        F.ntile(5).over(W.orderBy("money", "id")).alias("t3"),
        F.ntile(5).over(W.orderBy(F.asc_nulls_first("gap"), "id")).alias("t4"),
    )
    assert sorted(mine.collect()) == sorted(expected.select(mine.columns).collect(), key=lambda r: r.id)


def test_tiles_never_gather_the_table(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as v")
    plan = _plan(with_tiles(df, "id", [Tile("t", "v")], 5))
    assert "SinglePartition" not in plan and "Window" not in plan


def test_ties_spread_over_the_ranking_partitions(spark, monkeypatch):
    """All rows share one metric value; the unique key must still split them evenly."""
    placed = []

    def keep(df, name):
        placed.append(materialize(df, name))
        return placed[-1]

    monkeypatch.setattr("orrery.operators.tiles.materialize", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(80000).selectExpr("id", "1 as v")
        tiles = with_tiles(df, "id", [Tile("t", "v")], 5).groupBy("t").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(tuple(r) for r in tiles) == [(t, 16000) for t in range(1, 6)]
    sizes = [r["count"] for r in placed[0].groupBy(F.shiftright("place", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000


def test_monthly_cohorts(spark):
    d = dt.date
    rows = [
        ("a", d(2024, 1, 5), 10), ("a", d(2024, 1, 9), 5), ("a", d(2024, 3, 1), 1),
        ("b", d(2024, 1, 31), 5), ("c", d(2024, 2, 1), 8),
    ]
    got = monthly_cohorts(spark.createDataFrame(rows, "e string, d date, v int"), "e", "d", "v").collect()
    assert {tuple(r) for r in got} == {
        ("2024-01", 2, 0, 2, 20, 20), ("2024-01", 2, 2, 1, 1, 20), ("2024-02", 1, 0, 1, 8, 8),
    }


def _touch_data(spark):
    d = dt.date(2024, 1, 1)
    sessions = [
        (1, "a", d, 100, 5, "Email", "Mobile"), (2, "a", d, 200, 1, "Direct", "Tablet"),
        (3, "a", d, 200, 1, "Referral", "Desktop"), (4, None, d, 999, 9, "Ghost", "Desktop"),
    ]
    sales = [(1, "a", d), (2, "b", d), (3, None, d)]
    traffic = spark.createDataFrame(
        sessions,
        "session_id int, customer_id string, session_date date, duration_seconds int, pages_viewed int, "
        "traffic_source string, device_type string",
    )
    return spark.createDataFrame(sales, "order_id int, customer_id string, order_date date"), traffic


def test_best_session_ties_go_to_the_lowest_id(spark):
    _, traffic = _touch_data(spark)
    assert {r.session_id for r in best_daily_sessions(traffic).collect()} == {2, 4}


def test_sales_without_a_session_are_unattributed(spark):
    sales, traffic = _touch_data(spark)
    got = {r.order_id: (r.attributed_source, r.attributed_device) for r in attribute_sales(sales, traffic).collect()}
    unattributed = ("Direct/Unattributed", "Unknown")
    assert got == {1: ("Direct", "Tablet"), 2: unattributed, 3: unattributed}


@contextmanager
def _tiny_skew_limits(spark):
    """Settings under which kilobytes count as a skewed partition and nothing is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _ran_with_split(df, n_rows) -> bool:
    assert len(df.collect()) == n_rows
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_customer_day_is_split(spark):
    """A third of the sales sits on one (customer, day); its join partition must be split."""
    with _tiny_skew_limits(spark):
        keys = "case when id % 3 = 0 then 'hot' else concat('c', id % 5000) end as customer_id"
        sales = spark.range(0, 60000, 1, 8).selectExpr(
            "id as order_id", keys, "date'2024-01-01' as order_date", "cast(id as string) as note"
        )
        traffic = spark.range(0, 20000, 1, 8).selectExpr(
            "id as session_id", keys, "date'2024-01-01' as session_date", "id % 50 as duration_seconds",
            "id % 7 as pages_viewed", "'Email' as traffic_source", "'Mobile' as device_type",
        )
        assert _ran_with_split(attribute_sales(sales, traffic), 60000)


@pytest.mark.parametrize("hot", ["order_id", "product_id", "customer_id"])
def test_a_hot_key_in_the_sales_model_is_split(spark, hot):
    """A third of the lines in one order, on one product, or a third of the orders of one customer."""
    def key(name, values):
        return f"case when '{hot}' = '{name}' and id % 3 = 0 then 0 else id % {values} end"

    with _tiny_skew_limits(spark):
        items = spark.range(0, 60000, 1, 8).selectExpr(
            "cast(id as string) as order_item_id", f"{key('order_id', 30000)} as order_id",
            f"{key('product_id', 500)} as product_id", "1 as quantity", "cast(2 as decimal(18,2)) as unit_price",
        )
        orders = spark.range(0, 30000, 1, 8).selectExpr(
            "id as order_id", f"{key('customer_id', 5000)} as customer_id", "'2024-01-01' as order_date",
            "repeat(cast(id as string), 5) as status", "cast(1 as decimal(18,2)) as shipping_fee", "id as _row_order",
        )
        customers = spark.range(5000).selectExpr("id as customer_id", "date'2024-01-01' as signup_date")
        products = spark.range(500).selectExpr("id as product_id")
        assert _ran_with_split(build_fact_sales(orders, items, products, customers), 60000)


def test_grids(spark):
    d = dt.date
    rows = [("early", d(2023, 6, 1)), ("mid", d(2024, 1, 3)), ("late", d(2024, 1, 5)), ("after", d(2024, 2, 9))]
    df = spark.createDataFrame(rows, "k string, since date")
    days = daily_grid(df, F.col("since"), d(2024, 1, 1), d(2024, 1, 5)).groupBy("k").count().collect()
    assert {tuple(r) for r in days} == {("early", 4), ("mid", 2)}
    months = monthly_grid(df, F.col("since"), d(2024, 1, 1), d(2024, 2, 20)).groupBy("k").count().collect()
    assert {tuple(r) for r in months} == {("early", 2), ("mid", 2), ("late", 2), ("after", 1)}
    assert daily_grid(df, F.col("since"), d(2024, 1, 5), d(2024, 1, 5)).count() == 0


def test_year_over_year_and_share(spark):
    d = dt.date
    rows = [(d(2023, 1, 1), 10.0), (d(2024, 1, 1), 15.0), (d(2024, 2, 1), 5.0)]
    report = spark.createDataFrame(rows, "month date, revenue double")
    got = {r.month: (r.prior_year, r.growth) for r in year_over_year(report, "month", "revenue").collect()}
    assert got == {d(2023, 1, 1): (None, 0.0), d(2024, 1, 1): (10.0, 0.5), d(2024, 2, 1): (None, 0.0)}
    grouped = spark.createDataFrame([(None, d(2023, 1, 1), 10.0), (None, d(2024, 1, 1), 20.0), ("a", d(2024, 1, 1), 7.0)], "g string, month date, revenue double")
    grown = {(r.g, r.month): r.growth for r in year_over_year(grouped, "month", "revenue", ["g"]).collect()}
    assert grown == {(None, d(2023, 1, 1)): 0.0, (None, d(2024, 1, 1)): 1.0, ("a", d(2024, 1, 1)): 0.0}
    shares = sorted(r.share for r in share_of_total(report, "revenue").collect())
    assert shares == [16.67, 33.33, 50.0]
