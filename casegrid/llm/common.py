"""What the operators share: Arrow mapping over texts as bytes, and 64-bit hashes of words.

Texts travel as binary columns, so that words are split and lower-cased as bytes (ASCII rules only, at
C speed). Word hashes come from BLAKE2b through a bounded cache: equal words have equal hashes on
every executor and in every run.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted

#: Words of the newer and of the older half of a cache.
CACHED_WORDS = 80_000
CHUNK_WORDS = 1 << 18

#: Bytes of words as they are compared: digits, small ASCII letters and all of non-ASCII; the rest parts words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most so many rows, for work that takes many times the memory of its row."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def give_back() -> None:
    """Forgets the words' hashes and returns to the system what this process has freed; Arrow's and C's allocators would keep it."""
    forget_hashes()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` for mapInArrow, after which its process gives back memory. Processes are reused from stage to stage, and what
    they hold or have freed would stay with them while the next stage needs it elsewhere in the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def word_chunks(texts: Iterable[bytes | None], split=None) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each row) in runs of rows with about CHUNK_WORDS words."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append((split or words_of)(text))
        size += len(held[-1])
        if size >= CHUNK_WORDS:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def with_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id long, text binary) of every row; nothing else is read, so other columns may have any name."""
    return df.select(
        F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("binary").alias("text")
    )


#: Caches of other kinds. Workers are reused from stage to stage, so whoever fills one cache empties the others.
OTHER_CACHES: list[dict] = []


class WordHashes(dict):
    """word (bytes) to its 64-bit hash. When it is full, the words become the older half and what was there is forgotten; an
    older word that is met again is among the newer ones."""

    def __init__(self):
        super().__init__()
        self._older: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        value = self._older.get(word)
        if value is None:
            value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= CACHED_WORDS:
            self._older = dict(self)
            super().clear()
        self[word] = value
        return value

    def clear(self) -> None:
        super().clear()
        self._older = {}


_WORD_HASHES = WordHashes()


def forget_hashes() -> None:
    _WORD_HASHES.clear()


def hash_words(words: list[bytes]) -> np.ndarray:
    for cache in OTHER_CACHES:
        cache.clear()
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))


#: Fixed odd multipliers of the mixing steps below.
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _STEP
    return (values ^ (values >> np.uint64(27))) * _MIX


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n consecutive words, one per start; empty if there are fewer."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = mixed(hashes[: len(hashes) - n + 1])
    for i in range(1, n):
        out = mixed(out ^ hashes[i : len(hashes) - n + 1 + i]) + np.uint64(i)
    return out


def sliding_hash(hashes: np.ndarray, n: int, multiplier: int) -> np.ndarray:
    """A polynomial hash (mod 2**64) of each n consecutive words, in time that does not grow with n."""
    m = len(hashes)
    if m < n:
        return np.empty(0, np.uint64)
    powers, inverses = _powers(multiplier | 1, m), _powers(pow(multiplier | 1, -1, 1 << 64), m)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(mixed(hashes) * powers)])
    return mixed((sums[n:] - sums[:-n]) * inverses[: m - n + 1])


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, np.uint64(base))
    powers[0] = 1
    return np.multiply.accumulate(powers)
