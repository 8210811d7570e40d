from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orrery.functions.dates import clean_date, month_offset, parse_date_flexible
from orrery.functions.ratios import percent, ratio, ratio_or_zero
from orrery.functions.text import (
    COUNTRY_NAMES,
    capitalize,
    default_then_strip,
    map_values,
    na_to_null,
    strip,
    title_case,
)
from orrery.plans import retail_model
from orrery.sources import samples

DATES = {
    "2024-05-15": dt.date(2024, 5, 15),
    "12/25/2025": dt.date(2025, 12, 25),
    "2026-02-28": dt.date(2026, 2, 28),
    "invalid_date": None,
    "25/12/2025": dt.date(2025, 12, 25),
    "05/06/2024": dt.date(2024, 5, 6),
    "202-01-01": None,
    "2024/5/6": dt.date(2024, 5, 6),
    "20240506": dt.date(2024, 5, 6),
    "13-05-2024": dt.date(2024, 5, 13),
    "May 3 2024": dt.date(2024, 5, 3),
    "September 3, 2024": dt.date(2024, 9, 3),
    "3 May 2024": dt.date(2024, 5, 3),
    "2024-05-06 10:30:00": dt.date(2024, 5, 6),
    "31/12/2024 09:15": dt.date(2024, 12, 31),
    "9/4/2024 10:30 AM": dt.date(2024, 9, 4),
    "9/4/2024 11:30pm": dt.date(2024, 9, 4),
    "05/06/24": dt.date(2024, 5, 6),
    "25.12.25": dt.date(2025, 12, 25),
    "05/06/98": dt.date(1998, 5, 6),
    "2024.05.06": dt.date(2024, 5, 6),
    "20240506 10:30": dt.date(2024, 5, 6),
    "03-Apr-2024": dt.date(2024, 4, 3),
    "03-Apr-24": dt.date(2024, 4, 3),
    "Monday, January 1, 2024": dt.date(2024, 1, 1),
    "Mon Jan 1 2024 3:05 PM": dt.date(2024, 1, 1),
    "2024-05-06 10:30:00 UTC": dt.date(2024, 5, 6),
    "2024-05-06T10:30:00Z": dt.date(2024, 5, 6),
    "2024-05-06 10:30:00.250": dt.date(2024, 5, 6),
    "10:30": None,
    "10:30 PM": None,
    "May 3": None,
    "2024-02-30": None,
    "13/13/2024": None,
    "": None,
    None: None,
}


def _apply(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("c"))).collect()]


def test_mixed_dates(spark):
    found = _apply(spark, DATES, lambda c: parse_date_flexible(c).cast("date"))
    assert dict(zip(DATES, found)) == DATES


def test_dates_that_are_none(spark):
    values = ["98-02Z", "35-10", "24-1", "2024-01-01 3:00 p", "05/2024", "12:30", "m", "~p", "", None, "2024-13-01", "31/02/2024"]
    assert _apply(spark, values, parse_date_flexible) == [None] * len(values)


def test_half_days_zones_and_centuries(spark):
    at = dt.datetime
    want = {
        "1/2/2024 3:04 PM": at(2024, 1, 2, 15, 4), "1/2/24 12:00 a.m.": at(2024, 1, 2), "2024-05-06 3:04:05pm GMT": at(2024, 5, 6, 15, 4, 5),
        "11-11-11": at(2011, 11, 11), "31.12.99": at(1999, 12, 31), "20240203T101500Z": None, "2024-05-06T10:00:00Z": at(2024, 5, 6, 10),
        "2024-05-06T10:00:00+02:00": at(2024, 5, 6, 8), "Thursday, 9 May 2024 3:00 pm": at(2024, 5, 9, 15), "20240203 10:15": at(2024, 2, 3, 10, 15),
    }
    assert dict(zip(want, _apply(spark, list(want), parse_date_flexible))) == want


def test_a_date_is_parsed_once(spark, sample_dir):
    """Few replacements in the plan however often the parsed date is used."""
    raw = samples.retail_raw(spark, sample_dir)
    galaxy = retail_model.build_retail_galaxy(raw)
    for name, dates in (("dim_customers", 1), ("fact_sales", 2), ("fact_web_traffic", 1)):
        plan = galaxy[name]._jdf.queryExecution().optimizedPlan().toString()
        # Names, countries and statuses take some too.
        assert plan.count("regexp_replace") <= 10 * dates + 6, name
    text = spark.createDataFrame([("1/2/2024",)], "c string")
    one = text.select(clean_date(F.col("c")).alias("d")).where("d > '2024-01-01' and year(d) = 2024")
    assert one._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 10


def test_date_patterns_are_parameters(spark):
    found = _apply(spark, ["3|5|2024", "May 3 2024"], lambda c: parse_date_flexible(
        c, named=("d MMMM yyyy",), turns=((r"^(\d+)\|(\d+)\|(\d{4})", "$3-$2-$1"),)).cast("date"))
    assert found == [dt.date(2024, 5, 3), None]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("0202-01-01", None),
        ("2019-12-31", None),
        ("2020-01-01", dt.date(2020, 1, 1)),
        ("2027-12-31", dt.date(2027, 12, 31)),
        ("2027-12-31 10:00:00", None),
        ("2028-01-01", None),
    ],
)
def test_date_bounds_look_at_the_time_of_day(spark, text, expected):
    assert _apply(spark, [text], clean_date) == [expected]


def test_title_case_starts_after_any_non_letter(spark):
    names = ["o'brien", "mary-jane ABC", "3rd street", "", "john  SMITH", "élodie müller"]
    assert _apply(spark, names, title_case) == [
        "O'Brien", "Mary-Jane Abc", "3Rd Street", "", "John  Smith", "Élodie Müller",
    ]


def test_strip_takes_any_whitespace(spark):
    assert _apply(spark, ["\t a b \n", " x ", ""], strip) == ["a b", "x", ""]


def test_default_comes_before_strip(spark):
    values = [None, "   ", " a "]
    assert _apply(spark, values, lambda c: default_then_strip(c, "General")) == ["General", "", "a"]


def test_capitalize_lowers_the_rest(spark):
    assert _apply(spark, ["on HOLD", "COMPLETED", "", "x"], capitalize) == ["On hold", "Completed", "", "X"]


def test_country_names_match_exactly(spark):
    values = ["US", "US of A", "U.K.", "usa", "Canada"]
    assert _apply(spark, values, lambda c: map_values(c, COUNTRY_NAMES)) == [
        "United States", "United States", "United Kingdom", "usa", "Canada",
    ]


def test_no_value_tokens(spark):
    values = ["", "NULL", "N/A", "nan", "None", "null ", "0", None]
    assert _apply(spark, values, na_to_null) == [None, None, None, None, None, "null ", "0", None]


def test_month_offset_ignores_the_day(spark):
    row = spark.range(1).select(
        month_offset(F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2023, 12, 31))),
        month_offset(F.lit(dt.date(2023, 11, 30)), F.lit(dt.date(2024, 1, 1))),
    ).first()
    assert tuple(row) == (3, -2)


@pytest.mark.parametrize(
    "a,b,digits,expected",
    [(29319557165, 1264925491, 2, 23.18), (2770885, 2800, 2, 989.60), (2770885, 147300, 2, 18.81)],
)
def test_published_ratios(spark, a, b, digits, expected):
    assert spark.range(1).select(F.round(ratio(F.lit(a), F.lit(b)), digits)).first()[0] == expected


def test_published_retention(spark):
    assert spark.range(1).select(percent(F.lit(20450575), F.lit(20225575))).first()[0] == 101.11


def test_zero_denominators(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)), ratio_or_zero(F.lit(1), F.lit(0)), ratio_or_zero(F.lit(1), F.lit(None))
    ).first()
    assert tuple(row) == (None, 0.0, 0.0)


def test_whole_numbers_with_a_point_are_not_cast_to_int_first(spark):
    from pyspark.sql import types as T

    from orrery.sources.raw import normalize

    texts = ["2", "2.0", " 2.0 ", "2.", "-1.0", "+3", "2.5", "1e3", ".", "x", "N/A", "99999999999.0", "99999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    typed = normalize(df, T.StructType([T.StructField("n", T.IntegerType())]))
    assert [r.n for r in typed.collect()] == [2, 2, 2, 2, -1, 3, None, 1000, None, None, None, None, None, None]
    assert "Contains(" in typed._jdf.queryExecution().optimizedPlan().toString()
