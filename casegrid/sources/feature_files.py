"""Whole GeoJSON feature collections, whatever their line breaks, read by byte ranges.

A range does not know whether it starts inside a string, nor how deep. So each range is first summed up for both cases:
whether it has an odd number of quotes, and how many brackets more it opens than it closes. A running sum over a file's ranges
gives every range its start, and each then reads the features that open in it, the last one beyond its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casegrid.sources.features import PROPERTIES, geojson_features

RANGE_BYTES = 16 << 20
#: A feature of a collection is an object in the array that is a member of the collection.
FEATURE_DEPTH = 2
_QUOTE, _BACKSLASH, _COMMA, _OPEN, _CLOSE, _LIST = b'"\\,{}['
_STEPS = np.zeros(256, np.int64)
_STEPS[list(b"{[")], _STEPS[list(b"}]")] = 1, -1

Read = Callable[[int, int], bytes]


def _reader(uri: str) -> Read:
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    file = system.open_input_file(path)
    return lambda start, length: file.read_at(length, start)


def _before(read: Read, start: int) -> tuple[int, int]:
    """How many backslashes are just before ``start``, and the last byte there that is no white space (0 if none)."""
    length = 64
    while True:
        data = read(max(0, start - length), min(length, start))
        slashes, solid = len(data) - len(data.rstrip(b"\\")), data.rstrip()
        if start <= length or (slashes < len(data) and solid):
            return slashes, solid[-1] if solid else 0
        length *= 16


def _quoted(data: np.ndarray, inside: bool, slashes: int) -> np.ndarray:
    """For each byte whether a string goes on after it. A quote after an odd number of backslashes ends nothing."""
    at = np.flatnonzero(data == _QUOTE)
    place = np.arange(-1, len(data))
    place[0] -= slashes
    last = np.maximum.accumulate(np.where(np.append(False, data == _BACKSLASH), -1 - slashes, place))
    run = at - 1 - last[at]  # backslashes between the last other byte before the quote and the quote
    flips = np.zeros(len(data), np.uint8)
    flips[at[run % 2 == 0]] = 1
    return (np.cumsum(flips) + inside) % 2 == 1


def _summary(read: Read, start: int, end: int) -> tuple[int, int, int]:
    """(1 if a string that is not closed begins or ends here, depth gained if outside at the start, if inside)."""
    data = np.frombuffer(read(start, end - start), np.uint8)
    inside, steps = _quoted(data, False, _before(read, start)[0]), _STEPS[data]
    return int(inside[-1]), int(steps[~inside].sum()), int(steps[inside].sum())


def _features(read: Read, start: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the features that open from ``start`` to ``end``; one that the file does not end is left out."""
    slashes, solid = _before(read, start)
    more = 0
    while True:
        raw = read(start, end - start + more)
        data = np.frombuffer(raw, np.uint8)
        steps = np.where(_quoted(data, inside, slashes), 0, _STEPS[data])
        after = depth + np.cumsum(steps)
        opens = np.flatnonzero((data[: end - start] == _OPEN) & (steps[: end - start] != 0) & (after[: end - start] == FEATURE_DEPTH + 1))
        closes = np.flatnonzero((data == _CLOSE) & (steps != 0) & (after == FEATURE_DEPTH))
        if len(opens) and (not len(closes) or closes[-1] < opens[-1]) and len(raw) == end - start + more:
            more = max(1 << 16, 4 * more)  # the last one goes on
            continue
        break
    for first, k in zip(opens, np.searchsorted(closes, opens)):
        ahead = raw[:first].rstrip()
        if k < len(closes) and (ahead[-1] if ahead else solid) in (_LIST, _COMMA):  # not a member of an object
            yield start + int(first), raw[first : closes[k] + 1]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(uri, start, *_summary(_reader(uri), start, end), end) for uri, start, end in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "start", "odd", "outside", "inside", "end"])


def _read_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start, end, inside, depth in zip(*(c.to_pylist() for c in batch.columns)):
            for at, text in _features(_reader(uri), start, end, inside, depth):
                yield pa.RecordBatch.from_arrays([pa.array([text.decode("utf-8", "replace")]), pa.array([uri]), pa.array([at])], names=["text", "path", "at"])


def read_feature_texts(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(text, path, at): each feature of the collections as its own text, with its file and place in it.

    Files are opened by ``pyarrow.fs``. Rows do not depend on ``range_bytes``; a feature may be longer than a range.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"), "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end")).repartition("path", "start")
    summed = ranges.mapInArrow(_summed, "path string, start long, odd long, outside long, inside long, end long")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    started = summed.withColumn("within", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1)
    gained = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    placed = started.withColumn("depth", F.coalesce(F.sum(gained).over(earlier), F.lit(0)))
    placed = placed.select("path", "start", "end", "within", "depth").repartition("path", "start")
    return placed.mapInArrow(_read_features, "text string, path string, at long")


def read_feature_collections(
    spark: SparkSession, path: str | list[str], properties: str = PROPERTIES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """`geojson_features` of whole collections."""
    return geojson_features(read_feature_texts(spark, path, range_bytes).select("text"), properties, marker='"Feature"')
