"""Whitening of embeddings from the covariance of their distinct vectors, weighted by how often each occurs.

Components become whole numbers x = floor(scale * c) + offset. Equal x vectors are one row with a count, pre-aggregated
before the shuffle, so a vector that a third of all rows share is one row. The fit weighs each distinct vector by its count
(or by one): counts and sums are exact integers; a vector is centred as (n * x - S) / n, whose numerator is exact, before a
weighted matrix product adds it to its task's covariance. Only matrices of the size of the covariance come to the driver, one
row of it after the other, already summed over the tasks. Each distinct vector is whitened once and joined back to its rows.

Vectors travel as bytes: each x - offset in the fewest bytes (1, 2, 4 or 8) that hold the whole vector, so equal
vectors are equal bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.llm.groups import beside_groups
from casegrid.llm.vectors import finite_vectors, floors, matrix, usual_length
from casegrid.operators.storage import stored

#: The largest scaled component, so that sums over 2**23 rows and more fit 64 bits.
LARGEST = 1 << 40
#: Components of the vectors that are worked on at once.
BLOCK_COMPONENTS = 1 << 20
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def pack(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest integers that hold all of it."""
    most = np.maximum(x, -1 - x).max(axis=1)
    kind = np.searchsorted([1 << 7, 1 << 15, 1 << 31], most, side="right")
    out: list[bytes] = [b""] * len(x)
    for k, width in enumerate(_WIDTHS):
        rows = np.flatnonzero(kind == k)
        for row, values in zip(rows.tolist(), x[rows].astype(width)):
            out[row] = values.tobytes()
    return out


def unpack(keys: list[bytes], length: int) -> np.ndarray:
    out = np.empty((len(keys), length), np.int64)
    widths = np.array([len(key) // length for key in keys], np.int64)
    for width in _WIDTHS:
        rows = np.flatnonzero(widths == np.dtype(width).itemsize)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(keys[r] for r in rows), width).reshape(len(rows), length)
    return out


@dataclass(frozen=True)
class Whitening:
    """``basis`` has a unit eigenvector per column and ``variances`` their eigenvalues, falling; ``rows`` is n and ``sums`` S,
    over the fit's weights and with the offset; ``trace`` is the sum of all eigenvalues."""

    rows: int
    sums: list[int]
    offset: int
    basis: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def known(self) -> np.ndarray:
        """Which components have a variance beyond rounding."""
        return self.variances > self.trace * len(self.sums) * np.finfo(float).eps

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of each row of x (without its offset), exact; Python's integers where 64 bits could overflow."""
        sums = [s - self.rows * self.offset for s in self.sums]
        most = self.rows * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, sums), default=0)
        kind = np.int64 if most < 1 << 62 else object
        return x.astype(kind) * self.rows - np.array(sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The components of each row; NaN where a component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.known, 1 / np.sqrt(self.variances), np.nan)
        return self.centred(x) @ self.basis * scale

    def squares(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of squares of `deviations`; None where it does not fit 64 bits."""
        u = self.deviations(x)
        most = int(np.abs(u).max(initial=0))
        if most * most * max(1, u.shape[1]) >= 1 << 63:
            u = u.astype(object)
        return [s if s < 1 << 63 else None for s in (u * u).sum(axis=1).tolist()]


def _blocks(batches: Iterator[pa.RecordBatch], decode: Callable[[pa.RecordBatch], np.ndarray], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, their matrix) of a bounded number of rows at a time."""
    step = max(1, BLOCK_COMPONENTS // max(1, length))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            yield part, decode(part)


def _weights(part: pa.RecordBatch, once: bool) -> np.ndarray:
    return np.ones(part.num_rows, np.int64) if once else part.column("n").to_numpy()


def _sums(vectors: DataFrame, decode, length: int, once: bool, kind: type) -> list:
    """The weighted sum of every dimension; exact where ``decode`` gives integers."""
    spark_kind = "long" if kind is np.int64 else "double"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, kind)
        for part, x in _blocks(batches, decode, length):
            total += _weights(part, once) @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], names=["i", "s"])

    of = vectors.mapInArrow(summed, f"i long, s {spark_kind}").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    out = [0] * length
    for i, s in zip(of.column("i").to_pylist(), of.column("s").to_pylist()):
        out[i] = s
    return out


def _products(vectors: DataFrame, decode, length: int, once: bool) -> np.ndarray:
    """The sum of weight * c * c' over all rows, c being what ``decode`` makes of a row: already centred."""

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length))
        for part, c in _blocks(batches, decode, length):
            total += (c * _weights(part, once)[:, None]).T @ c
        task = np.full(length, TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(task), pa.array([row.tobytes() for row in total])], names=["i", "task", "row"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist()):
                row = np.frombuffer(row)
                if i != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total.tobytes()])], names=["i", "row"])
                    at, total = i, np.zeros(length)
                total = total + row  # in the order of the tasks: the same sum in every run
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total.tobytes()])], names=["i", "row"])

    rows = vectors.mapInArrow(multiplied, "i long, task long, row binary").repartition("i").sortWithinPartitions("i", "task")
    found = rows.mapInArrow(added, "i long, row binary").toArrow()
    out = np.zeros((length, length))
    for i, row in zip(found.column("i").to_pylist(), found.column("row").to_pylist()):
        out[i] = np.frombuffer(row)
    return out


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(x, n): each distinct packed vector and how many of ``rows`` (id, x) have it."""
    return rows.groupBy("x").agg(F.count("*").alias("n"))


def packed_vectors(table: DataFrame, length: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x binary) of the vectors that take part, without the offset."""
    schema = T.StructType([T.StructField("id", table.schema[id_col].dataType), T.StructField("x", T.BinaryType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, c in _blocks(batches, lambda b: matrix(b.column("vec"), length), length):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(pack(floors(c, scale, LARGEST)), pa.binary())], names=["id", "x"])

    return finite_vectors(table, length, id_col, vector_col).mapInArrow(packed, schema)


def fit_whitening(vectors: DataFrame, length: int, offset: int, components: int, once: bool = False) -> Whitening | None:
    """From distinct (x, n); ``once`` weighs each by one instead of its count. None for no vectors.

    Components are ordered by falling eigenvalue; each eigenvector's sign makes its largest entry positive.
    """
    rows = vectors.count() if once else vectors.agg(F.sum("n")).first()[0]
    if not rows:
        return None

    def decode(part: pa.RecordBatch) -> np.ndarray:
        return unpack(part.column("x").to_pylist(), length)

    sums = [s + rows * offset for s in _sums(vectors, decode, length, once, np.int64)]
    bare = Whitening(rows, sums, offset, np.empty((length, 0)), np.empty(0), 0.0)
    covariance = _products(vectors, lambda part: bare.centred(decode(part)), length, once) / rows
    values, basis = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    basis = basis[:, order]
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return Whitening(rows, sums, offset, basis, np.maximum(values[order], 0), float(np.trace(covariance)))


def identity_error(vectors: DataFrame, model: Whitening, once: bool = False) -> float:
    """The largest entry of the covariance of the whitened vectors minus the identity, over components with a variance."""
    known = np.flatnonzero(model.known)
    if not len(known):
        return 0.0

    def decode(part: pa.RecordBatch) -> np.ndarray:
        return matrix(part.column("z"), len(model.variances))[:, known]

    mean = np.array(_sums(vectors, decode, len(known), once, np.float64)) / model.rows
    covariance = _products(vectors, lambda part: decode(part) - mean, len(known), once) / model.rows
    return float(np.abs(covariance - np.eye(len(known))).max())


def whitened_vectors(vectors: DataFrame, model: Whitening, length: int) -> DataFrame:
    """(x, n, deviation, z) of distinct (x, n): each is whitened once."""

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, lambda b: unpack(b.column("x").to_pylist(), length), length):
            z = pa.array(list(model.whitened(x)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.squares(x), pa.int64()), z], names=["x", "n", "deviation", "z"])

    return vectors.select("x", "n").mapInArrow(whitened, "x binary, n long, deviation long, z array<double>")


def whiten(
    table: DataFrame,
    components: int = 32,
    scale: int = 64,
    offset: int = 1_000_000,
    once: bool = False,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component from 1.

    ``n`` is the number of vectors in the fit, ``deviation`` the sum over dimensions of (n * x - S)^2, exact (NULL where it does
    not fit 64 bits), ``explained`` a component's share of all variance. Vectors that are NULL, hold a NULL or non-finite
    entry, or have another length than most take no part; repeated rows and NULL ids do, with a row each. A component
    without variance (vectors that are all alike, fewer vectors than dimensions) has NULL in ``whitened`` and does not count
    in ``identity_error``. An empty table gives no rows. An entry beyond 2**40 / scale is a ValueError.
    """
    kind = table.schema[id_col].dataType
    length = usual_length(table, vector_col)
    if length is not None:
        rows = stored(packed_vectors(table, length, scale, id_col, vector_col))
        vectors = stored(distinct_vectors(rows))
        model = fit_whitening(vectors, length, offset, components, once)
    if length is None or model is None:
        schema = f"id {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], schema)
    done = stored(whitened_vectors(vectors, model, length))
    error = identity_error(done, model, once)
    explained = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else 0.0) for v in model.variances])
    rows = beside_groups(rows, done, "x", "n").select("id", "deviation", F.posexplode("z").alias("place", "whitened"))
    return rows.select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        F.nanvl("whitened", F.lit(None).cast("double")).alias("whitened"),
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
