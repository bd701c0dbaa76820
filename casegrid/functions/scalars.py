"""Column expressions for text, numbers and dates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# (label, lowest value, highest value), both ends inclusive, None = open.
Band = tuple[str, int | None, int | None]

# The labels, bounds and patterns that results are compared on.
AGE_BANDS: tuple[Band, ...] = (
    ("Children", None, 17),
    ("Young adults", 18, 24),
    ("Adults", 25, 64),
    ("Seniors", 65, None),
)
DATE_PATTERN = "yyyy MMM dd hh:mm:ss a"
# The characters that Python's str.strip() removes.
WHITESPACE = "".join(filter(str.isspace, map(chr, range(0x3001))))


def matches_text(text: Column, needle: str) -> Column:
    """Case-insensitive substring test; NULL text gives NULL."""
    return F.contains(F.lower(text), F.lit(needle.lower()))


def _within(value, low: int | None, high: int | None):
    """The band's test, for a Spark column or a pandas series alike."""
    if low is None:
        return value <= high
    if high is None:
        return value >= low
    return (value >= low) & (value <= high)


def band(value: Column, bands: Sequence[Band] = AGE_BANDS, default: str | None = "Unknown") -> Column:
    """Label of the first band that holds ``value``."""
    labels = [F.when(_within(value, low, high), F.lit(label)) for label, low, high in bands]
    return F.coalesce(*labels, F.lit(default))


def band_udf(bands: Sequence[Band] = AGE_BANDS) -> Callable[[Column], Column]:
    """`band` as a vectorised Python UDF (Arrow batches); no band gives NULL."""

    @F.pandas_udf("string")
    def label(value: pd.Series) -> pd.Series:
        out = pd.Series(None, index=value.index, dtype=object)
        for name, low, high in bands:
            out[_within(value, low, high) & out.isna()] = name
        return out

    return label


def year_of(when: Column, pattern: str = DATE_PATTERN) -> Column:
    """Year of a date text, or of a timestamp; unparseable text gives NULL."""
    return F.year(F.try_to_timestamp(when, F.lit(pattern)))


def parse_money(text: Column) -> Column:
    """`$52,806` -> 52806.0; text that is no amount gives NULL."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")
