"""Weighted means, rates and correlations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted


def weighted_mean_by(
    df: DataFrame, key: str, weight: str, join_on: str, lookup: DataFrame, lookup_on: str, value: str
) -> DataFrame:
    """(key, total_weight, mean): sum(weight * value) / sum(weight) per key, value from ``lookup``.

    Weights are summed per (key, join_on) before the join: a join value that many rows share arrives
    as one row per key. Keys without positive weight or without a mean are dropped. A value listed
    twice in ``lookup`` counts twice.
    """
    weights = df.groupBy(F.col(quoted(key)).alias(key), F.col(quoted(join_on)).alias("_on")).agg(
        F.sum(quoted(weight)).alias("_w")
    )
    values = lookup.select(F.col(quoted(lookup_on)).alias("_on"), F.col(quoted(value)).alias("_v"))
    total = F.sum("_w")
    return (
        weights.join(values, "_on")
        .groupBy(quoted(key))
        .agg(total.alias("total_weight"), F.try_divide(F.sum(F.col("_w") * F.col("_v")), total).alias("mean"))
        .filter((F.col("total_weight") > 0) & F.col("mean").isNotNull())
    )


def rate_table(means: DataFrame, counts: DataFrame, key: str, n_years: float = 2.0) -> DataFrame:
    """`weighted_mean_by` joined with (key, count): yearly ``rate`` per unit of weight. Keys in both only."""
    return means.join(counts, key).withColumn(
        "rate", F.col("count") / F.lit(n_years) / F.col("total_weight")
    )


def corr_safe(x: str, y: str) -> Column:
    """Pearson correlation as an aggregate; NULL where a column is constant or there are no rows.

    Rows with a NULL in either column are left out.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)).cast("double"), F.when(both, F.col(y)).cast("double")
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


@dataclass
class Moments:
    """Mergeable: how many pairs, both means, and the sums of squares and products around them."""

    n: int = 0
    x: float = 0.0
    y: float = 0.0
    xx: float = 0.0
    xy: float = 0.0
    yy: float = 0.0

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray) -> Moments:
        if not len(x):
            return cls()
        dx, dy = x - x[0], y - y[0]  # a constant column has a spread of exactly zero
        at_x, at_y = dx.mean(), dy.mean()
        dx, dy = dx - at_x, dy - at_y
        return cls(len(x), x[0] + at_x, y[0] + at_y, dx @ dx, dx @ dy, dy @ dy)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        dx, dy, w = other.x - self.x, other.y - self.y, self.n * other.n / n
        return Moments(
            n,
            self.x + dx * other.n / n,
            self.y + dy * other.n / n,
            self.xx + other.xx + dx * dx * w,
            self.xy + other.xy + dx * dy * w,
            self.yy + other.yy + dy * dy * w,
        )

    def correlation(self) -> float | None:
        spread = math.sqrt(self.xx) * math.sqrt(self.yy)
        return self.xy / spread if spread != 0 else None  # NaN stays NaN


def _moments(rows: pa.Table | pa.RecordBatch) -> Moments:
    both = pc.and_(pc.is_valid(rows.column("x")), pc.is_valid(rows.column("y")))
    rows = rows.filter(both)
    return Moments.of(rows.column("x").to_numpy(zero_copy_only=False), rows.column("y").to_numpy(zero_copy_only=False))


def _first(rows: pa.Table, k: int, largest: bool) -> pa.Table:
    """The ``k`` rows with the largest or least x as Spark orders them: NaN above all numbers, NULL below; then by key and y."""
    x = rows.column("x")
    null, nan = pc.is_null(x).cast("int8"), pc.fill_null(pc.is_nan(x), False).cast("int8")
    table = rows.append_column("null", null).append_column("nan", nan)
    one, other = ("ascending", "descending") if largest else ("descending", "ascending")
    keys = [("null", one), ("nan", other), ("x", other), ("key", "ascending"), ("y", "ascending")]
    return rows.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start")[:k])


def corr_slices(table: DataFrame, x: str, y: str, key: str, k: int = 10) -> DataFrame:
    """(slice, n, corr) over all rows, the k largest x and the k smallest x; ties go to the least key.

    One reading of ``table``: each task keeps the moments of its rows and two heaps of ``k`` rows, and hands on these 2k + 1 rows;
    one task merges them. NULL is the smallest x; rows with a NULL in either column count in n but not in the correlation,
    which is NULL where a column is constant or there are no rows.
    """
    key_kind = table.schema[key].dataType.simpleString()
    rows = table.select(
        F.col(quoted(x)).cast("double").alias("x"), F.col(quoted(y)).cast("double").alias("y"), F.col(quoted(key)).alias("key")
    )
    names = ["slice", "x", "y", "key", "n", "moments"]
    labels = {"top": f"top{k}", "bottom": f"bottom{k}"}

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, moments, heaps, schema = 0, Moments(), {}, None
        for batch in batches:
            schema = batch.schema
            n += batch.num_rows
            moments = moments.merged(_moments(batch))
            for name in labels:
                both = pa.Table.from_batches([*(heaps[name].to_batches() if name in heaps else ()), batch])
                heaps[name] = _first(both, k, name == "top").combine_chunks()
        if schema is None:
            return
        empty = pa.nulls(1, schema.field("key").type)
        found = pa.array([list(astuple(moments))], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(["all"]), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64()), empty, pa.array([n]), found], names=names)
        for name, heap in heaps.items():
            for batch in heap.to_batches():
                size = batch.num_rows
                rest = [pa.nulls(size, pa.int64()), pa.nulls(size, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array([name] * size), *batch.columns, *rest], names=names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        out = [("all", 0, None), *((label, 0, None) for label in labels.values())]
        if held:
            parts = pa.Table.from_batches(held)  # 2k + 1 rows of each task
            of = lambda name: parts.filter(pc.equal(parts.column("slice"), name))
            moments = Moments()
            for values in of("all").column("moments").to_pylist():
                moments = moments.merged(Moments(*values))
            out = [("all", sum(of("all").column("n").to_pylist()), moments.correlation())]
            for name, label in labels.items():
                heap = _first(of(name).select(["x", "y", "key"]), k, name == "top")
                out.append((label, heap.num_rows, _moments(heap).correlation()))
        kinds = (pa.string(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["slice", "n", "corr"])

    partial = rows.mapInArrow(kept, f"slice string, x double, y double, key {key_kind}, n long, moments array<double>")
    return partial.repartition(1).mapInArrow(merged, "slice string, n long, corr double")
