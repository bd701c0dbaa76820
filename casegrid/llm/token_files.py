"""Token ids in bit-packed binary files: written in id order by Spark, read back with random access.

File format (little-endian), one or more files per task:

    magic "CGBP" | u32 bits per id | u32 ids per block | u32 part | u32 sequence in part | u64 documents
    | u64 ids | i64 document ids | u8 1 where the document id is NULL | u64 first id of each document, then the end
    | u64 byte offset of each block in the payload, then the end | payload

Every id takes the fewest bits that hold the vocabulary. 64 ids fill exactly ``bits`` 64-bit words, so a
block of ids starts at a word, and numpy packs or unpacks all groups of 64 at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casegrid.llm.common import with_text
from casegrid.llm.subwords import subwords
from casegrid.operators.storage import stored

MAGIC, HEAD = b"CGBP", struct.Struct("<4s4I2Q")
LANES, BLOCK_IDS, FILE_IDS = 64, 1 << 14, 1 << 22
#: Where ids take whole bytes, the groups of 64 are arrays of such integers.
_WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Any number of ids below 2**bits; the last group of 64 is filled up with zeros."""
    groups = -(-len(ids) // LANES)
    if bits in _WHOLE:
        return ids.astype(_WHOLE[bits]).tobytes().ljust(groups * bits * 8, b"\0")
    lanes = np.zeros((groups, LANES), np.uint64)
    lanes.ravel()[: len(ids)] = ids
    words = np.zeros((groups, bits), np.uint64)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(payload: bytes, bits: int, count: int) -> np.ndarray:
    if bits in _WHOLE:
        return np.frombuffer(payload, _WHOLE[bits])[:count].astype(np.uint32)
    words = np.frombuffer(payload, "<u8").reshape(-1, bits)
    ids = np.empty((len(words), LANES), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 64)
        lane_ids = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lane_ids = lane_ids | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, lane] = lane_ids & mask
    return ids.ravel()[:count]


def file_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray, bits: int, part: int, sequence: int) -> bytes:
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    blocks = -(-len(ids) // BLOCK_IDS)
    payload = pack(ids, bits)
    offsets = np.minimum(np.arange(blocks + 1) * (BLOCK_IDS // LANES * bits * 8), len(payload)).astype("<u8")
    return b"".join(
        (
            HEAD.pack(MAGIC, bits, BLOCK_IDS, part, sequence, len(doc_ids), len(ids)),
            np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
            np.array([i is None for i in doc_ids], "u1").tobytes(),
            starts.tobytes(),
            offsets.tobytes(),
            payload,
        )
    )


class TokenFile:
    """One file's content; any object with slices of bytes will do (bytes, mmap)."""

    def __init__(self, content):
        head = HEAD.unpack(bytes(content[: HEAD.size]))
        if head[0] != MAGIC:
            raise ValueError("no token file")
        self.bits, self.block_ids, self.part, self.sequence, self.documents, self.n_ids = head[1:]
        at = HEAD.size

        def array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            end = at + np.dtype(kind).itemsize * count
            found, at = np.frombuffer(bytes(content[at:end]), kind), end
            return found

        self.doc_ids, self.null_ids = array("<i8", self.documents), array("u1", self.documents)
        self.starts = array("<u8", self.documents + 1).astype(np.int64)
        self.offsets = array("<u8", -(-self.n_ids // self.block_ids) + 1).astype(np.int64)
        self._content, self._payload = content, at

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids start..end-1: only the blocks that hold them are unpacked."""
        if end <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, -(-end // self.block_ids)
        low, high = (self._payload + int(self.offsets[k]) for k in (first, last))
        base = first * self.block_ids
        found = unpack(bytes(self._content[low:high]), self.bits, min(last * self.block_ids, self.n_ids) - base)
        return found[start - base : end - base]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
    file_ids: int = FILE_IDS,
) -> None:
    """Writes every row's ids, with ``end_id`` after each, in ascending order of ``id_col``.

    Spark range-partitions the rows by id and writes the files through its own output committer, so a
    lost executor's files are written anew. A NULL or empty text has no ids but ``end_id``; NULL ids come
    first; rows with one id stand in the order of a hash of their text, equal rows side by side. A file
    holds about ``file_ids`` ids and never splits a document. An empty table writes no token file.
    """
    spark = docs.sparkSession
    tie = F.xxhash64("text")
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_text(docs, id_col, text_col).repartitionByRange(count, "id", tie).sortWithinPartitions("id", tie)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer_file)
        bits = bits_for(max(encoder.vocabulary, (end_id or 0) + 1))
        tail = b"" if end_id is None else struct.pack("<I", end_id)
        part, sequence = TaskContext.get().partitionId(), 0
        doc_ids, pieces, held = [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4")
            content = file_bytes(doc_ids, [len(p) // 4 for p in pieces], ids, bits, part, sequence)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + tail
                doc_ids.append(key)
                pieces.append(ids)
                held += len(ids) // 4
                if held >= file_ids:
                    yield flush()
                    doc_ids, pieces, held, sequence = [], [], 0, sequence + 1
        if doc_ids:
            yield flush()

    # The text sink writes a string's bytes as they are; the line feed after them is beyond the payload.
    contents = rows.mapInArrow(files, "content binary").select(F.col("content").cast("string").alias("value"))
    contents.write.option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) per document, from the files alone.

    ``start`` counts the ids of all documents before it. ``ids`` are little-endian unsigned 32-bit
    bytes, ``ids_crc32`` is their checksum. Without ``with_ids`` only the checksums are kept.
    """
    schema = "part long, sequence long, doc_id long, local_start long, n_tokens long, ids_crc32 long" + (
        ", ids binary" * with_ids
    )
    names = [field.split()[0] for field in schema.split(", ")]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer().to_pybytes())
                ids = file.ids(0, file.n_ids).astype("<u4", copy=False)
                raw, starts = memoryview(ids.tobytes()), file.starts
                pieces = [raw[4 * a : 4 * b] for a, b in zip(starts[:-1], starts[1:])]
                n = file.documents
                columns = [
                    pa.array(np.full(n, file.part, np.int64)),
                    pa.array(np.full(n, file.sequence, np.int64)),
                    pa.array(file.doc_ids.astype(np.int64), mask=file.null_ids.astype(bool)),
                    pa.array(starts[:-1]),
                    pa.array(np.diff(starts)),
                    pa.array(np.fromiter(map(zlib.crc32, pieces), np.int64, n)),
                ]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in pieces], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    contents = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 1")
    )
    found = stored(contents.select("content").mapInArrow(documents, schema))
    # ids before a file: totals of earlier parts (one row per task of the writer), then of earlier files of its part
    files = found.groupBy("part", "sequence").agg(F.sum("n_tokens").alias("held"))
    parts = files.groupBy("part").agg(F.sum("held").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before_part"))
    within = Window.partitionBy("part").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.withColumn("before_file", F.coalesce(F.sum("held").over(within), F.lit(0))).join(parts, "part")
    return found.join(bases, ["part", "sequence"]).select(
        "doc_id",
        (F.col("before_part") + F.col("before_file") + F.col("local_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *["ids"] * with_ids,
    )
