"""Row-level cleaning: union, de-duplication, coordinate filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegrid.functions.geo import on_earth


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def union_incidents(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name; the column sets must be equal."""
    return reduce(DataFrame.unionByName, tables)


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the least by ``order_by``, then by the remaining columns; a NULL is larger than any value.

    Spark keeps only the first row of every key per input partition before the shuffle
    (``WindowGroupLimit``), so a key with very many copies is no burden. Select the columns you need
    first: all of them are compared.
    """
    named = [c for c in order_by if isinstance(c, str)]
    ordered = [*order_by, *[c for c in df.columns if c not in keys and c not in named]]
    if not ordered:
        return df.distinct()
    place = F.row_number().over(
        Window.partitionBy(*map(quoted, keys)).orderBy(
            *[(F.col(quoted(c)) if isinstance(c, str) else c).asc_nulls_last() for c in ordered]
        )
    )
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def valid_points(df: DataFrame, lat: str = "LAT", lon: str = "LON") -> DataFrame:
    """Rows with both coordinates present, finite and in range, and neither of them zero."""
    return df.filter(valid_point(F.col(quoted(lat)), F.col(quoted(lon))))


def valid_point(lat: Column, lon: Column) -> Column:
    return on_earth(lon, lat) & F.coalesce((lat != 0) & (lon != 0), F.lit(False))
