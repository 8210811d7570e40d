"""Date parsing and calendar expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates outside these bounds count as corrupt.
EARLIEST = dt.date(2020, 1, 1)
LATEST = dt.date(2027, 12, 31)

# Spellings with a month name, once commas, dots, hyphens and the weekday are gone; a time of day may follow.
NAMED_PATTERNS = ("MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy", "d MMM yy", "yyyy MMM d")
TIME_OF_DAY = "[ h:mm[:ss] a][ H:mm[:ss]]"
# Numeric spellings turned into year-month-day, which the plain cast understands (with or without a time of day):
# year first, year month day without separators, day first (a leading number that cannot be a month), month first.
# Groups of the alternatives that do not match are empty. A leading ~ asks for the century of a two-digit year.
NUMERIC_TURNS = (
    (
        r"^(?:(\d{4})[/.](\d{1,2})[/.](\d{1,2})(?!\d)|(\d{4})(\d{2})(\d{2})(?=$|[ T])"
        r"|(1[3-9]|2\d|3[01])[-/.](\d{1,2})[-/.](\d{4}|\d\d(?!\d))|(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d\d(?!\d)))",
        "~$1$4$9$12-$2$5$8$10-$3$6$7$11",
    ),
)
_SUFFIX = r"(?i)\s*(?:([ap])\.?m\.?)?\s*(?:UTC|GMT|(?<=\d)Z)?$"
_WEEKDAY_OR_BREAK = r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?[,.]?\s+|[\s,./-]+"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it.

    The optimizer copies an expression to every place that mentions it; a lambda variable is a value.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_date_flexible(
    col: Column,
    named: Sequence[str] = NAMED_PATTERNS,
    turns: Sequence[tuple[str, str]] = NUMERIC_TURNS,
) -> Column:
    """Timestamp from mixed date spellings (month first when ambiguous), null when unparseable.

    ``named`` lists the patterns with a month name, ``turns`` the rewritings of numeric dates. A text without a year is
    null, UTC and GMT at its end are left off; two-digit years from 70 belong to the last century. Numeric dates are
    rearranged as text by one expression with a group for each part and cast: no formatter, no exception for a bad
    value. Each step is bound to a variable, so a parse costs three replacements wherever it is copied to.
    """
    patterns = "".join(f"[{p}]" for p in named) + TIME_OF_DAY
    half_days = "yyyy-M-d h:mm[:ss] a"

    def spelled(text: Column) -> Column:
        def read(words: Column) -> Column:
            return F.when(words.rlike(r"\d{4}|\p{L} ?\d\d\b"), F.try_to_timestamp(words, F.lit(patterns)))

        return bound(F.trim(F.regexp_replace(text, _WEEKDAY_OR_BREAK, " ")), read)

    def dated(text: Column) -> Column:
        turned = text
        for shape, parts in turns:
            turned = F.regexp_replace(turned, shape, parts)

        def read(day: Column) -> Column:
            lead = F.translate(F.substring(day, 1, 5), "0123456789", "9999999999")
            return F.when(F.endswith(day, F.lit("m")), F.try_to_timestamp(day, F.lit(half_days))).when(
                lead.isin("9999", "9999-"), day.try_cast("timestamp")
            )

        def century(day: Column) -> Column:
            year = F.when(F.substring(day, 4, 1) != "-", "").when(F.substring(day, 2, 1) < "7", "20").otherwise("19")
            return F.when(F.startswith(day, F.lit("~")), F.concat(year, F.substr(day, F.lit(2)))).otherwise(day)

        return bound(turned, lambda day: bound(century(day), read))

    def half_day(text: Column) -> Column:
        marked = F.right(text, F.lit(2)).isin("~a", "~p", "~A", "~P")
        return F.when(marked, F.concat(F.substring_index(text, "~", 1), F.lit(" "), F.right(text, F.lit(1)), F.lit("m"))).otherwise(text)

    def parse(text: Column) -> Column:
        return F.when(text.rlike("[A-Za-z]{3}"), spelled(text)).otherwise(dated(text))

    text = F.rtrim(F.regexp_replace(F.trim(col), _SUFFIX, "~$1"), F.lit("~"))  # what follows ~ is the half of the day
    return bound(text, lambda t: bound(half_day(t), parse))


def in_bounds(ts: Column, earliest: dt.date = EARLIEST, latest: dt.date = LATEST) -> Column:
    """Whether a timestamp lies between ``earliest`` and midnight of ``latest``."""
    # The SQL function evaluates its input once, Column.between twice.
    return F.call_function("between", ts, F.lit(earliest).cast("timestamp"), F.lit(latest).cast("timestamp"))


def clean_date(col: Column, earliest: dt.date = EARLIEST, latest: dt.date = LATEST) -> Column:
    """Date from mixed spellings; null when unparseable or out of bounds (compared with the time of day)."""
    return bound(parse_date_flexible(col), lambda ts: F.when(in_bounds(ts, earliest, latest), ts.cast("date")))


def month_offset(later: Column, earlier: Column) -> Column:
    """Calendar months between two dates, ignoring the day of the month."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def is_weekend(day: Column) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.when(F.weekday(day) >= 5, F.lit(1)).otherwise(F.lit(0))


def weekend_days_to(day: Column) -> Column:
    """Saturdays and Sundays from Monday, 5 January 1970, to ``day``; negative before, so differences count any span."""
    days = F.unix_date(day) - 3
    return (F.floor(days / 7) * 2 + F.greatest(F.lit(0), F.pmod(days, F.lit(7)) - 5)).cast("long")
