"""Text cleansing expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strings a raw file uses for "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Country spellings that are replaced, matched exactly.
COUNTRY_NAMES = {
    "US": "United States",
    "USA": "United States",
    "US of A": "United States",
    "UK": "United Kingdom",
    "U.K.": "United Kingdom",
}


def na_to_null(col: Column) -> Column:
    """Null for any of the no-value tokens, otherwise the text unchanged."""
    return F.when(~col.isin(*NA_TOKENS), col)


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only knows blanks)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def default_then_strip(col: Column, default: str) -> Column:
    """Default first, strip second: a blank-only text ends empty, not defaulted."""
    return strip(F.coalesce(col, F.lit(default)))


def title_case(col: Column) -> Column:
    """Capital after every non-letter (``O'Brien``, ``Mary-Jane``, ``3Rd``).

    ``initcap`` alone only starts words at blanks, so it is applied to each run
    of letters separately.
    """
    runs = F.regexp_extract_all(col, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def capitalize(col: Column) -> Column:
    """First character upper, the rest lower (``on HOLD`` becomes ``On hold``)."""
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substr(col, F.lit(2))))


def map_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace whole values found in ``mapping``; leave the others as they are."""
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(lookup, col), col)
