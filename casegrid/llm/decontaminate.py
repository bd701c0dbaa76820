"""Benchmark decontamination: a prefix-filtered containment join of item windows with documents.

A window of an item is contained in a document if its words stand there in a row. Windows are sets of
word shingles; ordered by how often they occur in all documents, the rarest shingle of a window is its
necessary prefix: a document without it cannot contain the window. Documents are joined with the
windows on this one shingle; the place of the shingle in the window then gives the only start possible
there (positional bound), the start must leave room for the whole window (length bound), and the
item-sized stretch of words is compared word by word.

Windows are indexed in shards of at most ``SHARD_WINDOWS``, so what is broadcast is bounded; a larger
benchmark means more passes over the documents, not a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import lean, with_text, word_chunks, words_of

SHINGLE, SHARD_WINDOWS = 3, 150_000
_ID_BITS = 21

def item_windows(benchmark: DataFrame, window: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words): the distinct windows of every item; a shorter item is one window, an empty one none."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    items.append(item)
                    found.append(b" ".join(words[at : at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(found, pa.binary())], names=["item_id", "words"])

    return with_text(benchmark, item_col, text_col).mapInArrow(lean(windows), "item_id long, words binary").distinct()


class WindowIndex:
    """Windows of one shard as word numbers, by length; 0 stands for a word that no window has."""

    def __init__(self, rows: list[tuple[bytes, list[int]]]):
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[list[int], list[int]]]] = {}
        for text, items in rows:
            words = text.split()
            ids = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in words]
            by_length.setdefault(len(words), []).append((ids, items))
        self.groups = []
        for length, found in sorted(by_length.items()):
            size = min(SHINGLE, length)
            matrix = np.array([ids for ids, _ in found], np.int64)
            codes = np.stack([shingle_codes(matrix[:, k : k + size]) for k in range(length - size + 1)], axis=1)
            self.groups.append({"length": length, "size": size, "windows": matrix, "codes": codes, "items": [i for _, i in found]})
        #: shingle size to the sorted codes that occur in windows; their frequencies are counted in the same order
        self.vocabulary = {
            size: np.unique(np.concatenate([g["codes"].ravel() for g in self.groups if g["size"] == size]))
            for size in {g["size"] for g in self.groups}
        }

    def choose_prefixes(self, counts: dict[int, np.ndarray]) -> None:
        """Keeps the rarest shingle of each window, ties to the smaller code, sorted for look-up."""
        for group in self.groups:
            codes, vocabulary = group.pop("codes"), self.vocabulary[group["size"]]
            rarity = counts[group["size"]][np.searchsorted(vocabulary, codes)]
            offset = np.lexsort((codes, rarity), axis=1)[:, 0]
            prefix = codes[np.arange(len(codes)), offset]
            order = np.argsort(prefix, kind="stable")
            group |= {"prefix": prefix[order], "window": order, "offset": offset[order]}

    def number(self, words: Iterator[bytes], count: int) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, count)


def shingle_codes(columns: np.ndarray) -> np.ndarray:
    code = columns[..., 0]
    for k in range(1, columns.shape[-1]):
        code = (code << _ID_BITS) | columns[..., k]
    return code


def _places(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts whose ``size`` words all occur in windows, and their codes."""
    if len(ids) < size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(ids) - size + 1
    known = ids[:n] > 0
    for k in range(1, size):
        known &= ids[k : n + k] > 0
    at = np.flatnonzero(known)
    return at, shingle_codes(np.stack([ids[at + k] for k in range(size)], axis=-1))


def _flat(index: WindowIndex, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all documents with a 0 after each, and the documents' starts."""
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    parted = chain.from_iterable(chain(words, (b"",)) for words in docs)
    return index.number(parted, int(starts[-1])), starts


def _count_shingles(docs: DataFrame, index: WindowIndex) -> dict[int, np.ndarray]:
    """How often each shingle of the shard's windows occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        counts = {size: np.zeros(len(codes), np.int64) for size, codes in index.vocabulary.items()}
        for batch in batches:
            for _, held in word_chunks(t.as_py() for t in batch.column("text")):
                ids, _ = _flat(index, held)
                for size, vocabulary in index.vocabulary.items():
                    codes = _places(ids, size)[1]
                    at = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
                    counts[size] += np.bincount(at[vocabulary[at] == codes], minlength=len(vocabulary))
        for size, found in counts.items():
            seen = np.flatnonzero(found)
            arrays = [pa.array(np.full(len(seen), size, np.int64)), pa.array(seen), pa.array(found[seen])]
            yield pa.RecordBatch.from_arrays(arrays, names=["size", "place", "n"])

    totals = {size: np.zeros(len(codes), np.int64) for size, codes in index.vocabulary.items()}
    rows = docs.select("text").mapInArrow(lean(counted), "size long, place long, n long")
    for row in rows.groupBy("size", "place").agg(F.sum("n").alias("n")).collect():  # at most the shard's shingles
        totals[row["size"]][row["place"]] = row["n"]
    return totals


def _joined(index: WindowIndex, ids: np.ndarray) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """(group, starts, windows) of verified occurrences in one chunk."""
    for size in index.vocabulary:
        at, codes = _places(ids, size)
        for group in (g for g in index.groups if g["size"] == size):
            low = np.searchsorted(group["prefix"], codes, "left")
            many = np.searchsorted(group["prefix"], codes, "right") - low
            hit = np.flatnonzero(many)
            if not len(hit):
                continue
            many = many[hit]
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            entry = np.repeat(low[hit], many) + nth
            start = np.repeat(at[hit], many) - group["offset"][entry]
            fits = (start >= 0) & (start + group["length"] <= len(ids))
            start, window = start[fits], group["window"][entry[fits]]
            for k in range(group["length"]):  # the 0 between documents is in no window
                same = ids[start + k] == group["windows"][window, k]
                start, window = start[same], window[same]
            yield group, start, window


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_FOUND = "id long, digest binary, n_words long, spans array<struct<start:int,end:int>>, items array<long>"


def _matched(docs: DataFrame, index: WindowIndex) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for _, held in word_chunks(t.as_py() for t in batch.column("text")):
                ids, starts = _flat(index, held)
                edges = np.zeros(len(ids) + 1, np.int64)
                own: list[set] = [set() for _ in held]
                for group, start, window in _joined(index, ids):
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + group["length"], -1)
                    doc = np.searchsorted(starts, start, "right") - 1
                    for d, w in set(zip(doc.tolist(), window.tolist())):
                        own[d].update(group["items"][w])
                hit = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
                turns = np.flatnonzero(hit[1:] != hit[:-1])
                per_doc: list[list] = [[] for _ in held]
                for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
                    d = int(np.searchsorted(starts, a, "right")) - 1
                    per_doc[d].append({"start": a - int(starts[d]), "end": b - int(starts[d])})
                n_words.extend(map(len, held))
                spans.extend(per_doc)
                items.extend(sorted(s) for s in own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("digest"),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, _SPANS),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                names=["id", "digest", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(lean(found), _FOUND)


def _shards(windows: DataFrame, shard_windows: int) -> Iterator[WindowIndex]:
    """Indexes of at most about ``shard_windows`` windows each; the driver holds one at a time."""
    merged = windows.groupBy("words").agg(F.collect_set("item_id").alias("items")).persist()
    try:
        count = -(-merged.count() // shard_windows)
        for shard in range(count):
            rows = merged.filter(F.pmod(F.xxhash64("words"), F.lit(count)) == shard).collect()
            if rows:
                yield WindowIndex([(bytes(row["words"]), row["items"]) for row in sorted(rows)])
    finally:
        merged.unpersist()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_windows: int = SHARD_WINDOWS,
    with_row: bool = False,
) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs``, ``with_row`` also the 64-bit hash of its text, row.

    ``spans`` are the maximal stretches [start, end) of words that lie in an occurrence of some window,
    ``items`` the ids of the items with such windows. Words are runs of digits, ASCII letters (case
    folded) and non-ASCII characters. NULL and empty texts have no words and no spans; items without
    words match nothing; a window of an item with a NULL id gives spans but no item. Repeated rows are
    judged each; an empty benchmark leaves all documents clean.
    """
    digest = F.xxhash64("text").cast("string").cast("binary") if with_row else F.md5("text").cast("binary")
    rows = with_text(docs, id_col, text_col).withColumn("digest", digest)
    parts = []
    for index in _shards(item_windows(benchmark, window, item_col, item_text_col), shard_windows):
        index.choose_prefixes(_count_shingles(rows, index))
        parts.append(_matched(rows, index))
    if not parts:
        parts = [_matched(rows, WindowIndex([]))]
    found = parts[0]
    if len(parts) > 1:
        found = _merged(parts)
    row = [F.col("digest").cast("string").cast("long").alias("row")] if with_row else []
    return found.select(F.col("id").alias("doc_id"), *row, "n_words", "spans", "items")


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Rows of all shards put together: equal rows of a document have equal results in every shard."""
    union = parts[0].withColumn("copy", F.lit(1))
    for part in parts[1:]:
        union = union.unionByName(part.withColumn("copy", F.lit(0)))
    grouped = union.groupBy("id", "digest").agg(
        F.max("n_words").alias("n_words"),
        F.sum("copy").cast("int").alias("copies"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return grouped.withColumn("spans", joined_spans("spans")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )


def joined_spans(column: str):
    """Sorted spans with overlapping and touching ones put together."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(done, span):
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(
            touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.col(column), empty, step)
