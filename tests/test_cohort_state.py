"""Cohorts kept up month by month against the full run."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from orrery.operators.cohorts import monthly_cohorts
from orrery.plans.cohort_state import load_months, stored_cohorts

LAYOUT = "who string, day date, paid decimal(18,2)"


def _rows(seed: int, n: int = 600):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = dt.date(2019, 1, 1) + dt.timedelta(days=rng.randrange(0, 3200))
        rows.append((rng.choice(["hot", None, *(f"e{k}" for k in range(60))]), day, Decimal(rng.randrange(10**6)) / 100))
    return rows


def _full(spark, rows, value=None):
    df = spark.createDataFrame(rows, LAYOUT)
    return sorted(map(tuple, monthly_cohorts(df, "who", "day", value).collect()))


def _load(spark, rows, path, first, last, value=None):
    load_months(spark.createDataFrame(rows, LAYOUT), path, first, last, "who", "day", value)


def test_loads_in_any_order_equal_the_full_run(spark, tmp_path):
    rows, path = _rows(1), str(tmp_path)
    cuts = [dt.date(2023, 1, 1), dt.date(2019, 1, 1), dt.date(2020, 6, 1), dt.date(2021, 2, 1)]
    ends = [dt.date(2030, 12, 31), dt.date(2020, 5, 31), dt.date(2021, 1, 31), dt.date(2022, 12, 31)]
    for first, last in zip(cuts, ends):
        _load(spark, rows, path, first, last, "paid")
    assert sorted(map(tuple, stored_cohorts(spark, path, True).collect())) == _full(spark, rows, "paid")
    assert sorted(map(tuple, stored_cohorts(spark, path).collect())) == _full(spark, rows)


def test_a_month_can_be_repeated_and_corrected(spark, tmp_path):
    rows, path = _rows(2), str(tmp_path)
    _load(spark, rows, path, dt.date(2019, 1, 1), dt.date(2030, 1, 1), "paid")
    month = lambda r: (r[1].year, r[1].month)
    gone = [r for r in rows if month(r) != (2021, 5) and month(r) != (2019, 1)] + [("new", dt.date(2021, 5, 9), Decimal("7.00"))]
    for _ in range(2):
        _load(spark, gone, path, dt.date(2021, 5, 1), dt.date(2021, 5, 31), "paid")
        _load(spark, gone, path, dt.date(2019, 1, 15), dt.date(2019, 1, 15), "paid")  # a month without rows any more
    assert sorted(map(tuple, stored_cohorts(spark, path, True).collect())) == _full(spark, gone, "paid")


def test_a_load_reads_its_months_only(spark, tmp_path):
    rows, state, facts = _rows(3), str(tmp_path / "state"), str(tmp_path / "facts")
    spark.createDataFrame(rows, LAYOUT).withColumn("m", F.trunc("day", "MM")).write.partitionBy("m").parquet(facts)
    _load(spark, rows, state, dt.date(2019, 1, 1), dt.date(2022, 12, 31))
    for file in (tmp_path / "facts").glob("m=20*/*.parquet"):
        if not file.parent.name.startswith("m=2023-"):
            file.write_bytes(b"spoilt")
    for file in (tmp_path / "facts").glob("m=20*/.*.crc"):
        file.unlink()
    late = spark.read.schema(f"{LAYOUT}, m date").parquet(facts).where("m between '2023-01-01' and '2023-12-31'")
    load_months(late, state, dt.date(2023, 1, 1), dt.date(2023, 12, 31), "who", "day")
    assert sorted(map(tuple, stored_cohorts(spark, state).collect())) == _full(spark, [r for r in rows if r[1].year <= 2023])


def test_empty_loads_and_wide_months(spark, tmp_path):
    _load(spark, [], str(tmp_path), dt.date(2020, 1, 1), dt.date(2020, 1, 31), "paid")
    assert stored_cohorts(spark, str(tmp_path)).count() == 0
    rows = [("a", dt.date(1969, 12, 31), Decimal(1)), ("a", dt.date(2024, 12, 1), Decimal(2)), ("b", dt.date(2024, 12, 31), None), ("b", None, Decimal(3)), (None, dt.date(2024, 12, 1), Decimal(4))]
    _load(spark, rows, str(tmp_path), dt.date(1, 1, 1), dt.date(9999, 12, 31), "paid")
    got = sorted(map(tuple, stored_cohorts(spark, str(tmp_path), True).collect()))
    assert got == [("1969-12", 1, 0, 1, Decimal(1), Decimal(1)), ("1969-12", 1, 660, 1, Decimal(2), Decimal(1)), ("2024-12", 1, 0, 1, None, None)]
