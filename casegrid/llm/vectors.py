"""Which rows of a vector table take part, and their components as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted


def usual_length(table: DataFrame, vector_col: str) -> int | None:
    """The length that most vectors have (the larger of two equally common ones); None without a vector that has components."""
    sizes = table.filter(F.col(quoted(vector_col)).isNotNull()).select(F.size(F.col(quoted(vector_col))).alias("length"))
    common = sizes.filter("length > 0").groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    return common and common["length"]


def finite_vectors(table: DataFrame, length: int, id_col: str, vector_col: str, **others: str) -> DataFrame:
    """(id, vec array<double>, others) of the rows whose vector has ``length`` finite components. Only these columns are read."""
    vec = F.col(quoted(vector_col)).cast("array<double>")
    rows = table.select(F.col(quoted(id_col)).alias("id"), vec.alias("vec"), *[F.col(quoted(c)).alias(n) for n, c in others.items()])
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec").isNotNull() & (F.size("vec") == length) & F.coalesce(finite, F.lit(False)))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column of rows of ``length`` doubles as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)


def floors(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers; a ValueError where one is beyond ``limit``, so that no sum can overflow."""
    scaled = np.floor(scale * x)
    if len(scaled) and np.abs(scaled).max() > limit:
        raise ValueError(f"a component is larger than {limit / scale:.0f}, beyond which sums do not fit 64 bits")
    return scaled.astype(np.int64)
