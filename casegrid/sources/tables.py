"""Readers for delimited and line-oriented files at any URI that Spark can open.

Every column is read as text and cast with ``try_cast``: no inference pass over the data, leading
zeros stay, and a bad value becomes NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions import parse_money
from casegrid.operators.rows import quoted, union_incidents

# Column names of the incident files and their types.
INCIDENT_TYPES = {
    "DR_NO": "string",
    "DATE OCC": "string",
    "Crm Cd Desc": "string",
    "Vict Age": "int",
    "Vict Descent": "string",
    "Mocodes": "string",
    "LAT": "double",
    "LON": "double",
}


def read_lookup(spark: SparkSession, path: str, types: Mapping[str, str], sep: str = ",") -> DataFrame:
    """The named columns of a delimited file with a header line; blanks around header names are ignored."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    raw = raw.toDF(*[name.strip() for name in raw.columns])
    return raw.select(*[F.col(quoted(name)).try_cast(kind).alias(name) for name, kind in types.items()])


def read_incidents(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One or more incident files as one table, restricted to ``columns``."""
    if isinstance(paths, str):
        paths = [paths]
    types = {name: INCIDENT_TYPES[name] for name in (columns or INCIDENT_TYPES)}
    return union_incidents(*[read_lookup(spark, path, types) for path in paths])


def parse_code_dictionary(lines: DataFrame, digits: int = 4) -> DataFrame:
    """Lines ``dddd description`` as (Code, Description); lines that start with no code are dropped.

    A longer number gives its first digits as code, and no description.
    """
    line = F.col(lines.columns[0])
    # The patterns of a code and of a description.
    code, description = rf"^(\d{{{digits}}})", rf"^\d{{{digits}}}\s+(.+)$"
    return lines.filter(line.rlike(code)).select(
        F.regexp_extract(line, code, 1).alias("Code"), F.regexp_extract(line, description, 1).alias("Description")
    )


def read_code_dictionary(spark: SparkSession, path: str, digits: int = 4) -> DataFrame:
    return parse_code_dictionary(spark.read.text(path), digits)


def parse_income(table: DataFrame, zip_code: str = "Zip Code", income: str = "Estimated Median Income") -> DataFrame:
    """(zip, income) with money text turned into doubles; rows without an amount are dropped."""
    return table.select(
        F.col(quoted(zip_code)).alias("zip"), parse_money(F.col(quoted(income))).alias("income")
    ).filter(F.col("income").isNotNull())


def read_income(spark: SparkSession, path: str) -> DataFrame:
    return parse_income(
        read_lookup(spark, path, {"Zip Code": "string", "Estimated Median Income": "string"}, sep=";")
    )
