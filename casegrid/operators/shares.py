"""The largest groups of every year and their share of the year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted


def _inputs(
    df: DataFrame, lookup: DataFrame, year: Column, code: str, lookup_code: str, lookup_name: str
) -> tuple[DataFrame, DataFrame]:
    return (
        df.select(year.alias("year"), F.col(quoted(code)).alias("code")),
        lookup.select(F.col(quoted(lookup_code)).alias("code"), F.col(quoted(lookup_name)).alias("name")),
    )


def top_share(
    df: DataFrame,
    lookup: DataFrame,
    year: Column,
    code: str,
    lookup_code: str,
    lookup_name: str,
    k: int = 3,
) -> DataFrame:
    """(year, name, count, share): groups of rank <= k per year, share in percent of the year's rows.

    Rows are counted per (year, code) before they meet the lookup, so neither a hot code nor a hot year
    reaches the join. Rows whose code is not in the lookup count nowhere. Ties of rank k all stay.
    The year's total is an aggregate joined back, so that no task holds all groups of a year.
    """
    rows, names = _inputs(df, lookup, year, code, lookup_code, lookup_name)
    per_code = rows.groupBy("year", "code").agg(F.count("*").alias("n"))
    groups = per_code.join(names, "code").groupBy("year", "name").agg(F.sum("n").alias("count"))
    totals = groups.groupBy(F.col("year").alias("total_year")).agg(F.sum("count").alias("total"))
    by_count = Window.partitionBy("year").orderBy(F.desc("count"))
    top = groups.withColumn("rank", F.rank().over(by_count)).filter(F.col("rank") <= k)
    return (
        top.join(totals, F.col("year").eqNullSafe(F.col("total_year")))
        .select("year", "name", "count", (F.col("count") / F.col("total") * 100).alias("share"))
        .orderBy(F.desc("year"), F.desc("count"), "name")
    )


_TOP_SHARE = """
WITH per_code AS (
    SELECT year, code, count(*) AS n FROM {rows} GROUP BY year, code
),
per_name AS (
    SELECT p.year, l.name, sum(p.n) AS count
    FROM per_code p JOIN {names} l ON p.code = l.code
    GROUP BY p.year, l.name
),
totals AS (
    SELECT year, sum(count) AS total FROM per_name GROUP BY year
),
ranked AS (
    SELECT *, rank() OVER (PARTITION BY year ORDER BY count DESC) AS place FROM per_name
)
SELECT r.year, r.name, r.count, r.count / t.total * 100 AS share
FROM ranked r JOIN totals t ON r.year <=> t.year
WHERE r.place <= {k}
ORDER BY r.year DESC, r.count DESC, r.name
"""


def top_share_sql(
    df: DataFrame,
    lookup: DataFrame,
    year: Column,
    code: str,
    lookup_code: str,
    lookup_name: str,
    k: int = 3,
) -> DataFrame:
    """`top_share` as one SQL statement."""
    rows, names = _inputs(df, lookup, year, code, lookup_code, lookup_name)
    return df.sparkSession.sql(_TOP_SHARE, rows=rows, names=names, k=k)
