"""Vector compression: one byte for each part of a vector, by codebooks of whole numbers.

Components become floor(scale * x); a vector's equal consecutive parts are each replaced by the number of the nearest
entry in the part's codebook. Distances are not computed for each vector: within a block of vectors every dimension
has a dictionary of the distinct integers that occur there. Their squared differences to all entries are tabulated
once, a vector holds its dictionary codes, and a part's distances are gathered from the tables by code and added up. Blocks
have a bounded number of components, so dictionaries and tables are bounded too, whatever the range of values.

All sums are sums of integers: results do not depend on how rows are dealt to tasks. Tasks hand on one row per
entry; a codebook's new entries are the only thing the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.llm.groups import beside_groups
from casegrid.llm.vectors import finite_vectors, floors, matrix, usual_length
from casegrid.operators.storage import stored

#: Components of the vectors that are worked on at once, and the most vectors among them.
BLOCK_COMPONENTS, BLOCK_VECTORS = 1 << 20, 1 << 14


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (part, entry, position within the part); without a vector to begin with there are no entries."""

    entries: np.ndarray
    scale: int

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and position, with commas between."""
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def integers(self, vectors: np.ndarray) -> np.ndarray:
        return floors(vectors, self.scale, isqrt((1 << 62) // max(1, self.length)) // 2)

    def blocks(self, vectors: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """(rows, their integers) of a bounded number of rows at a time."""
        step = max(1, min(BLOCK_VECTORS, BLOCK_COMPONENTS // max(1, self.length)))
        for low in range(0, len(vectors), step):
            yield slice(low, low + step), self.integers(vectors[low : low + step])

    def assigned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(part, row) arrays of the nearest entry, the first of equally near ones, and its squared distance."""
        n_parts, n_entries, width = self.entries.shape
        nearest = np.empty((n_parts, len(x)), np.int64)
        least = np.empty((n_parts, len(x)), np.int64)
        for part, entries in enumerate(self.entries):
            distance = np.zeros((len(x), n_entries), np.int64)
            for k in range(width):
                values, codes = np.unique(x[:, part * width + k], return_inverse=True)
                squares = (values[:, None] - entries[None, :, k]) ** 2
                distance += squares[codes]
            nearest[part] = distance.argmin(axis=1)
            least[part] = distance[np.arange(len(x)), nearest[part]]
        return nearest, least


def _totals(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums): the vectors assigned to an entry, and the sum of their parts, one row per task."""
    n_parts, n_entries, width = books.entries.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((n_parts, n_entries), np.int64)
        sums = np.zeros(books.entries.shape, np.int64)
        for batch in batches:
            for _, x in books.blocks(matrix(batch.column(0), books.length)):
                nearest, _ = books.assigned(x)
                for part, entry in enumerate(nearest):
                    n[part] += np.bincount(entry, minlength=n_entries)
                    np.add.at(sums[part], entry, x[:, part * width : (part + 1) * width])
        part, entry = np.nonzero(n)
        arrays = [pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "n", "sums"])

    return vectors.select("vec").mapInArrow(summed, "part long, entry long, n long, sums array<long>")


def fit_codebooks(
    table: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Codebooks:
    """Codebooks that begin as the parts of the vectors with the ``entries`` smallest ids and are moved ``rounds`` times.

    A NULL id is larger than others; of equal ids the smaller vector comes first. A round replaces each entry by the
    componentwise floor of the mean of the parts nearest to it; unused entries stay. Vectors that are NULL, hold a NULL
    or non-finite component, or have another length than most take no part; that length must be a multiple of ``parts``.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must lie in 1..256")
    length = usual_length(table, vector_col)
    if length is None:
        return Codebooks(np.empty((parts, 0, 0), np.int64), scale)
    if length % parts:
        raise ValueError(f"vectors of {length} components do not have {parts} equal parts")
    vectors = finite_vectors(table, length, id_col, vector_col)
    first = vectors.orderBy(F.asc_nulls_last("id"), "vec").limit(entries).toArrow().column("vec").combine_chunks()
    width = length // parts
    if not len(first):
        return Codebooks(np.empty((parts, 0, width), np.int64), scale)
    limits = Codebooks(np.empty((parts, 0, width), np.int64), scale)
    start = limits.integers(matrix(first, length))
    books = Codebooks(start.reshape(-1, parts, width).transpose(1, 0, 2).copy(), scale)
    for _ in range(rounds):
        sums = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)]
        moved = _totals(vectors, books).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).toArrow()
        of = lambda name: moved.column(name).to_numpy()
        new = books.entries.copy()
        new[of("part"), of("entry")] = np.stack([of(f"s{k}") // of("n") for k in range(width)], axis=1)
        books = Codebooks(new, scale)
    return books


def encode_vectors(table: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding", **others: str) -> DataFrame:
    """(id, code binary, error, others) of every vector that takes part: a byte for each part, and the squared distance.

    ``others`` are further columns of the table by their new names. Repeated rows have a row each.
    """
    columns = [T.StructField(name, table.schema[c].dataType) for name, c in others.items()]
    schema = T.StructType([T.StructField("id", table.schema[id_col].dataType), *columns, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    if not books.length or not books.entries.shape[1]:
        return table.sparkSession.createDataFrame([], schema)
    vectors = finite_vectors(table, books.length, id_col, vector_col, **others).select("id", *others, "vec")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in books.blocks(matrix(batch.column("vec"), books.length)):
                nearest, least = books.assigned(x)
                codes = pa.array(map(bytes, nearest.T.astype(np.uint8)), pa.binary())
                same = [column.slice(rows.start, len(x)) for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*same, codes, pa.array(least.sum(axis=0))], names=schema.names)

    return vectors.mapInArrow(encoded, schema)


def decode_vectors(codes: DataFrame, books: Codebooks) -> DataFrame:
    """(id, vec): the entries' components that the ``code`` of each row stands for, as doubles."""
    schema = T.StructType([codes.schema["id"], T.StructField("vec", T.ArrayType(T.DoubleType()))])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.arange(books.entries.shape[0])
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            vec = books.entries[parts[None, :], code].reshape(batch.num_rows, -1) / books.scale
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(vec), pa.list_(pa.float64()))], names=["id", "vec"])

    return codes.select("id", "code").mapInArrow(decoded, schema)


def compress_vectors(
    table: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error, label_error) of each row that takes part, and the codebooks; ``label_error`` is the sum of
    the errors of all rows with the label, NULLs together. See `fit_codebooks` for what takes part; an empty table gives no rows."""
    books = fit_codebooks(table, parts, entries, rounds, scale, id_col, vector_col)
    coded = stored(encode_vectors(table, books, id_col, vector_col, label=label_col))
    by_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")))
    return beside_groups(coded, by_label, "label", "_n").drop("_n").select("id", "label", "code", "error", "label_error"), books
