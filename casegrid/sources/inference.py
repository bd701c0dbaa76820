"""Types of text columns, found in one pass over all rows, and the rows that do not have them.

Kinds form a lattice: int under bigint under double, date under timestamp, and everything under string. A column's
kind is the least that its values fit, apart from a stated share of misfits. What is kept per column is a
number of fitting values for each kind, so partial results of tasks are added up and no row is kept or sorted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted

#: From the least kind to the greatest; every value is a string.
KINDS = ("boolean", "int", "bigint", "double", "date", "timestamp", "string")
WHOLE, NUMBER = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DAY, MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"
ZEROS = r"^[+-]?0[0-9]"
BAD_LINE = "_bad_line"


def _text(column: str) -> Column:
    """The value without blanks around it; NULL if nothing is left."""
    return F.nullif(F.trim(F.col(quoted(column)).cast("string")), F.lit(""))


def fits(value: Column, kind: str, keep_zeros: bool = False) -> Column:
    """Whether a text is a value of ``kind``; with ``keep_zeros`` a number that begins with a needless 0 is a string only."""
    number = F.lit(True) if not keep_zeros else ~value.rlike(ZEROS)
    checks = {
        "boolean": lambda: F.lower(value).isin("true", "false"),
        "int": lambda: value.rlike(WHOLE) & number & value.try_cast("int").isNotNull(),
        "bigint": lambda: value.rlike(WHOLE) & number & value.try_cast("bigint").isNotNull(),
        "double": lambda: value.rlike(NUMBER) & number,
        "date": lambda: value.rlike(DAY) & value.try_cast("date").isNotNull(),
        "timestamp": lambda: value.rlike(MOMENT) & value.try_cast("timestamp_ntz").isNotNull(),
        "string": lambda: F.lit(True),
    }
    return checks[kind]()


def profile_columns(raw: DataFrame, keep_zeros: bool = False, tolerance: float = 0.0) -> DataFrame:
    """(column, kind, n_values, n_blank, n_misfits), a row for each column of ``raw``; one reading of it.

    NULL and blank texts fit every kind and are counted apart; a column of nothing else, or of an empty table, is a
    string. At most the share ``tolerance`` of a column's values may misfit its kind.
    """
    sums, described = [F.count(F.lit(1)).alias("n")], []
    for k, column in enumerate(raw.columns):
        value = _text(column)
        sums.append(F.count(value).alias(f"v{k}"))
        sums += [F.count_if(fits(value, kind, keep_zeros)).alias(f"{kind}{k}") for kind in KINDS[:-1]]
        n, kind, misfits = F.col(f"v{k}"), F.lit("string"), F.lit(0).cast("long")
        for narrower in reversed(KINDS[:-1]):
            enough = (n > 0) & (n - F.col(f"{narrower}{k}") <= n * F.lit(float(tolerance)))
            kind = F.when(enough, narrower).otherwise(kind)
            misfits = F.when(enough, n - F.col(f"{narrower}{k}")).otherwise(misfits)
        described.append(
            F.struct(
                F.lit(column).alias("column"), kind.alias("kind"), n.alias("n_values"), (F.col("n") - n).alias("n_blank"), misfits.alias("n_misfits")
            )
        )
    return raw.agg(*sums).select(F.inline(F.array(*described)))


def infer_types(raw: DataFrame, keep_zeros: bool = False, tolerance: float = 0.0) -> dict[str, str]:
    """Each column's kind by `profile_columns`."""
    return {r["column"]: r["kind"] for r in profile_columns(raw, keep_zeros, tolerance).collect()}  # one row per column


def split_typed(raw: DataFrame, types: Mapping[str, str], keep_zeros: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with the named columns as ``types``, rejected rows as text with ``misfits``, the names of the columns at fault).

    Types may be any of Spark's; those that are no kind of `KINDS` are judged by their cast alone.
    """
    misfits = []
    for name, kind in types.items():
        value = _text(name)
        there = value.try_cast(kind).isNotNull()
        good = fits(value, kind, keep_zeros) & (there | F.lit(kind == "string")) if kind in KINDS else there
        misfits.append(F.when(value.isNotNull() & ~good, F.lit(name)))
    at_fault = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    cast = [F.col(quoted(n)).alias(n) if t == "string" else _text(n).try_cast(t).alias(n) for n, t in types.items()]
    names = [quoted(c) for c in raw.columns if c != "misfits"]
    return raw.filter(F.size(at_fault) == 0).select(*cast), raw.select(*names, at_fault.alias("misfits")).filter(F.size("misfits") > 0)


@dataclass(frozen=True)
class Inferred:
    """``rows`` have the inferred types; ``rejected`` are rows with a misfit; ``bad_lines`` have another number of fields."""

    types: dict[str, str]
    rows: DataFrame
    rejected: DataFrame
    bad_lines: DataFrame


def read_inferred(spark: SparkSession, path: str, sep: str = ",", keep_zeros: bool = False, tolerance: float = 0.0) -> Inferred:
    """A delimited file with a header line; types come from all its rows, lines that do not fit the header apart."""
    options = {"header": True, "sep": sep, "columnPruning": False}
    header = spark.read.options(**options).csv(path).columns
    schema = ", ".join(f"{quoted(name)} string" for name in [*header, BAD_LINE])
    lines = spark.read.options(**options, columnNameOfCorruptRecord=BAD_LINE).schema(schema).csv(path)
    whole = lines.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    whole = whole.toDF(*[name.strip() for name in header])
    types = infer_types(whole, keep_zeros, tolerance)
    rows, rejected = split_typed(whole, types, keep_zeros)
    # Spark refuses to read bad lines alone, so that no field is left out: nothing of the first one is put to the line
    nothing = F.substring(F.coalesce(F.col(quoted(header[0])), F.lit("")), 1, 0)
    bad_lines = lines.filter(F.col(BAD_LINE).isNotNull()).select(F.concat(F.col(BAD_LINE), nothing).alias("line"))
    return Inferred(types, rows, rejected, bad_lines)
