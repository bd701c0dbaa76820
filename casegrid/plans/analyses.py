"""The five incident analyses, from cleaned tables to the result table.

Inputs come from `casegrid.sources` (or any DataFrame with the same columns). Incident numbers may
repeat: all analyses keep the same row of a number, the most complete one; among equally complete ones
``order_by`` decides (columns of the incidents, such as the reported date), then the fields' values.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions import year_of
from casegrid.operators.contains import contains_count
from casegrid.operators.counts import banded_count, token_frequency
from casegrid.operators.nearest import nearest_summary
from casegrid.operators.rows import dedup, quoted, valid_point, valid_points
from casegrid.operators.shares import top_share, top_share_sql
from casegrid.operators.stats import corr_slices, rate_table, weighted_mean_by

ID = "DR_NO"


# The fields of an incident that the analyses use.
FIELDS = ("DATE OCC", "Crm Cd Desc", "Vict Age", "Vict Descent", "Mocodes", "LAT", "LON")


def unique_incidents(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per incident number: the one that lacks the fewest of FIELDS, then the least by ``order_by``.

    A NULL, a blank text and a place that is zero, not finite or out of range are lacking.
    """
    fields = [c for c in FIELDS if c in df.columns]
    place = valid_point(F.col("LAT"), F.col("LON")) if {"LAT", "LON"} <= set(fields) else None
    lacking = F.lit(0)
    for field in fields:
        if field in ("LAT", "LON") and place is not None:
            there = place
        elif dict(df.dtypes)[field] == "string":
            there = F.coalesce(F.trim(F.col(quoted(field))) != "", F.lit(False))
        else:
            there = F.col(quoted(field)).isNotNull()
        lacking = lacking + F.when(there, 0).otherwise(1)
    extra = [c for c in order_by if c not in (ID, *fields)]
    return dedup(df.select(ID, *map(quoted, extra), *map(quoted, fields)), [ID], [lacking, *order_by])


def _incidents(df: DataFrame, order_by: Sequence[str], *columns: str) -> DataFrame:
    return unique_incidents(df, order_by).select(ID, *map(quoted, columns))


def victims_by_age(
    incidents: DataFrame, offence: str = "aggravated assault", python_udf: bool = False, order_by: Sequence[str] = ()
) -> DataFrame:
    """(Age Group, count): incidents of an offence per age band of the victim."""
    rows = _incidents(incidents, order_by, "Crm Cd Desc", "Vict Age")
    return banded_count(rows, "Crm Cd Desc", offence, "Vict Age", label="Age Group", python_udf=python_udf)


def victims_by_descent(
    incidents: DataFrame, descent_codes: DataFrame, k: int = 3, sql: bool = False, order_by: Sequence[str] = ()
) -> DataFrame:
    """(year, Victim Descent, #, %): the k largest descent groups of each year."""
    rows = _incidents(incidents, order_by, "DATE OCC", "Vict Descent")
    build = top_share_sql if sql else top_share
    shares = build(
        rows, descent_codes, year_of(F.col("DATE OCC")), "Vict Descent", "Vict Descent", "Vict Descent Full", k
    )
    return shares.select(
        "year",
        F.col("name").alias("Victim Descent"),
        F.col("count").alias("#"),
        F.format_number("share", 1).alias("%"),
    )


def method_frequency(
    incidents: DataFrame,
    method_codes: DataFrame,
    join_hint: str | None = None,
    trim_tokens: bool = False,
    blank_as_unknown: bool = False,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """(Code, Description, Frequency): how often each method code occurs."""
    rows = _incidents(incidents, order_by, "Mocodes")
    return token_frequency(rows, "Mocodes", method_codes, join_hint, trim_tokens, blank_as_unknown)


def nearest_station(incidents: DataFrame, stations: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """(division, average_distance, #): incidents nearest to each station, mean distance in km."""
    summary = nearest_summary(
        valid_points(_incidents(incidents, order_by, "LAT", "LON")),
        stations,
        lon="LON",
        lat="LAT",
        site_id="DIVISION",
        site_lon="x",
        site_lat="y",
    )
    return summary.select(
        F.col("site").alias("division"),
        F.format_number(F.col("mean_m") / 1000, 3).alias("average_distance"),
        F.col("count").alias("#"),
    ).orderBy(F.desc("#"), "division")


def community_rates(
    incidents: DataFrame,
    blocks: DataFrame,
    income: DataFrame,
    years: Collection[int] | None = None,
    n_years: float = 2.0,
    boundary: str = "exclude",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """(COMM, Total_Population, Avg_Income, Total_Crimes, Crimes_Per_Person) per community.

    ``blocks`` has COMM, ZCTA20, POP20 and coordinates, which may be NULL: such a block counts for population and
    income, but holds no incident; ``income`` has zip and income. ``years`` keeps
    only incidents of these years; None keeps all, of whatever year.
    """
    populated = blocks.filter(
        F.col("COMM").isNotNull() & F.col("ZCTA20").isNotNull() & (F.col("POP20") > 0)
    )
    means = weighted_mean_by(populated, "COMM", "POP20", "ZCTA20", income, "zip", "income")
    if years is None:
        rows = _incidents(incidents, order_by, "LAT", "LON")
    else:
        rows = _incidents(incidents, order_by, "DATE OCC", "LAT", "LON")
        rows = rows.filter(year_of(F.col("DATE OCC")).isin(*years))
    counts = contains_count(
        rows, populated.filter("coordinates IS NOT NULL").select("COMM", "coordinates"), lon="LON", lat="LAT", key="COMM", boundary=boundary
    )
    return rate_table(means, counts, "COMM", n_years).select(
        "COMM",
        F.col("total_weight").alias("Total_Population"),
        F.col("mean").alias("Avg_Income"),
        F.col("count").alias("Total_Crimes"),
        F.col("rate").alias("Crimes_Per_Person"),
    )


def income_correlations(rates: DataFrame, k: int = 10) -> DataFrame:
    """(slice, n, corr) of income and incident rate over all communities, the k richest and k poorest."""
    return corr_slices(rates, "Avg_Income", "Crimes_Per_Person", "COMM", k)
