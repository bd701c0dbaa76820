"""Toxicity by two class-conditional Kneser-Ney models.

Each class has a bigram model that interpolates with the class's word model; both classes' word models
back off to the same counts: in how many different contexts a word occurs in the whole corpus, labelled
or not. What falls below one and the same rate in both classes is discounted wholly, so that both models
judge a rare expression alike. The score is a logistic function of the difference of the two log-likelihoods
per word and of the single words that differ most.

Words and pairs are counted exactly, as rows of Spark tables keyed by 64-bit hashes; contexts are counted from sorted
blocks of the distinct pairs' hashes, each of which holds the word's place where the word is in the model. Pairs of two
such words travel to be counted in like blocks, named by both places; for that each task has all of the model's words, 8
bytes each. Of these tables the models
need no more than what either class has beyond the discount: a pair below it adds nothing, and a word below it
has its contexts in both likelihoods alike, so that they cancel. That part is sent out in shards of a bounded
number of words and pairs; each word of a text is looked up in the one shard that has its cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import hash_words, lean, mixed, with_text, word_chunks
from casegrid.llm.labelled import fit_logistic, labelled
from casegrid.operators.storage import stored

DISCOUNT = 6.0
#: Logs of ratios beyond which a word counts as telling.
TELLING = (1.0, 2.0, 3.0, 4.0)
#: At most so many labelled rows set the two numbers that turn a likelihood ratio into a score.
CALIBRATION_ROWS = 20_000
#: A shard has about so many words and pairs at most; a task sums up so many words, or pairs, before it hands them on.
SHARD_WORDS, SHARD_PAIRS, HELD, PARTED = 1 << 20, 1 << 22, 1 << 19, 1 << 22
#: Distinct pairs are dealt by ranges of their hashes: at least so many, one more for each so many bytes of text.
BUCKETS, BUCKET_BYTES = 1 << 10, 1 << 26
#: Words whose contexts travel as one row.
COUNTED = 1 << 12
_START = np.uint64(0x5851F42D4C957F2D)
_START_KEY = int(_START)  # below 2**63, so the same as a long


@dataclass(frozen=True)
class Places:
    """Hashes of the words of a run of documents and of the words before them; ``doc`` numbers the documents."""

    word: np.ndarray
    before: np.ndarray
    doc: np.ndarray


def places(docs: list[list[bytes]]) -> Places:
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    hashes = hash_words([word for words in docs for word in words])
    before = np.concatenate([[_START], hashes[:-1]]) if len(hashes) else hashes.copy()
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = _START
    return Places(hashes, before, np.repeat(np.arange(len(docs)), lengths))


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) ^ word)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``keys`` (at least one) and where in it the runs of equal keys begin."""
    order = np.argsort(keys)
    ordered = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _batches(names: list[str], columns: list[np.ndarray], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[low : low + rows]) for c in columns], names=names)


_WORDS, _PAIRS = "key long, n0 long, n1 long", "before long, word long, n0 long, n1 long"
_BLOCKS = "bucket long, kind int, first long, width int, steps binary"
#: A fixed odd multiplier.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, words before, labels or -1) of texts, in runs of some HELD words."""
    held, size = [], 0
    for batch in batches:
        labels = batch.column("label").fill_null(-1).to_numpy()
        for first, docs in word_chunks(t.as_py() for t in batch.column("text")):
            at = places(docs)
            held.append((at.word, at.before, labels[first + at.doc].astype(np.int8)))
            size += len(at.word)
            if size >= HELD:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*held)))


def _by_class(label: np.ndarray, order: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    return [np.add.reduceat((label == c)[order].astype(np.int64), first) for c in (0, 1)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each class has each word; the start of a text counts as a word before."""
    for word, before, label in _tokens(batches):
        starts = before == _START
        keys, label = np.append(word, before[starts]), np.append(label, label[starts])
        order, first = _runs(keys)
        yield from _batches(["key", "n0", "n1"], [keys[order[first]].view(np.int64), *_by_class(label, order, first)])


def _bits(keys: Iterator[np.ndarray]) -> np.ndarray:
    """A bitmap of 2**24 places: a word whose place is empty is not among ``keys``."""
    flags = np.zeros(1 << 24, bool)
    for some in keys:
        flags[some >> np.uint64(40)] = True
    return np.packbits(flags)


def _marked(bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    place = words >> np.uint64(40)
    return (bits[place >> np.uint64(3)] << (place & np.uint64(7)).astype(np.uint8)) & 128 != 0


def _place_bits(n_kept: int) -> int:
    return max(1, n_kept.bit_length())


def _scrambled(keys: np.ndarray, bits: int) -> np.ndarray:
    """A bijection of the numbers below 2**bits (an even number of bits) that spreads them evenly; see `_restored`."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64(bits // 2)
    keys = keys * _SPREAD & mask
    return (keys ^ (keys >> half)) * _SPREAD & mask


def _restored(keys: np.ndarray, bits: int) -> np.ndarray:
    mask, half, back = np.uint64((1 << bits) - 1), np.uint64(bits // 2), np.uint64(pow(int(_SPREAD), -1, 1 << 64))
    keys = keys * back & mask
    return (keys ^ (keys >> half)) * back & mask


def _added(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Distinct keys in order and the sums of their counts, from (keys, n0, n1) with at least one key."""
    keys, *counts = map(np.concatenate, zip(*held))
    order, first = _runs(keys)
    return [keys[order[first]], *(np.add.reduceat(n[order], first, dtype=np.int64) for n in counts)]


def _count_pairs(shared, buckets: int):
    """How often each class has each pair of words, in blocks. A pair is never more frequent than its words, so those of
    other words than the kept ones are left out: first by the bitmap, then by their places, which make up the pair's key."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, flags = shared.value
        bits, held, size = _place_bits(len(kept)), [], 0
        for word, before, label in _tokens(batches):
            both = _marked(flags, word) & _marked(flags, before)
            word, before, label = _find(kept, word[both]), _find(kept, before[both]), label[both]
            both = (word < len(kept)) & (before < len(kept))
            if not both.any():
                continue
            keys = _scrambled((before[both] << bits | word[both]).astype(np.uint64), 2 * bits)
            held.append(_added([[keys, *(label[both] == c for c in (0, 1))]]))
            size += len(held[-1][0])
            if size >= PARTED // 4:
                held = [_added(held)]
                size = len(held[0][0])
                if size >= PARTED // 8:
                    yield from _counted_blocks(held[0], 2 * bits, buckets)
                    held, size = [], 0
        if held:
            yield from _counted_blocks(_added(held), 2 * bits, buckets)

    return counted


def _counted_blocks(held: list[np.ndarray], bits: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """`_blocks` of sorted keys below 2**bits, each with the counts of its keys for both classes."""
    keys, *counts = held
    at = 0
    for batch in _blocks(([keys],), buckets, bits):
        packed = []
        for width, steps in zip(batch.column("width").to_pylist(), batch.column("steps")):
            n = np.stack([c[at : at + len(steps.as_buffer()) // width + 1] for c in counts])
            packed.append(n.astype(np.min_scalar_type(n.max())).tobytes())
            at += n.shape[1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], names=[*batch.schema.names, "counts"])


def _sum_pairs(shared, discounts: tuple[float, float]):
    """(before, word, n0, n1) of the pairs that either class has beyond its discount, from blocks in the order of their
    buckets. A task holds the keys of one bucket."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, _ = shared.value
        bits, held, at = _place_bits(len(kept)), [], None

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                keys, *counts = _added(held)
                over = (counts[0] > discounts[0]) | (counts[1] > discounts[1])
                places = _restored(keys[over], 2 * bits).astype(np.int64)
                pair = [kept[places >> bits].view(np.int64), kept[places & ((1 << bits) - 1)].view(np.int64)]
                yield from _batches(["before", "word", "n0", "n1"], [*pair, *(n[over] for n in counts)])

        for batch in batches:
            for bucket, _, first, width, steps, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    yield from done()
                    held, at = [], bucket
                keys = _unpacked(first, width, steps)
                counts = np.frombuffer(packed, f"<u{len(packed) // (2 * len(keys))}").reshape(2, -1)
                held.append([keys, *counts])
        yield from done()

    return summed


#: The low bits of the key of a pair whose word is in the model: the word's place. The others are the pair's hash.
_PLACE = np.uint64((1 << 21) - 1)


def _merge(keys: list[np.ndarray]) -> int:
    """Leaves one array, of the distinct keys in order, and tells how many they are."""
    together = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    keys.clear()
    together.sort()
    first = np.concatenate([[True], together[1:] != together[:-1]])[: len(together)]
    keys.append(together[first])
    return len(keys[0])


def _distinct_pairs(kept: np.ndarray, cell: tuple[int, int], buckets: int):
    """Keys of the distinct pairs whose word is in the cell (parts, part), in sorted blocks. Pairs with a word in ``kept``
    (sorted) have its place in their key; of the others only the number will matter."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh = ([], []), 0
        for word, before, _ in _tokens(batches):
            if cell[0] > 1:
                here = word.view(np.int64) % cell[0] == cell[1]
                word, before = word[here], before[here]
            pair, place = _pair(before, word), _find(kept, word).astype(np.uint64)
            known = place < len(kept)
            for keys, new in zip(held, (pair[known] & ~_PLACE | place[known], pair[~known])):
                keys.append(np.unique(new))
                fresh += len(keys[-1])
            if fresh >= PARTED // 4:
                fresh = 0
                if sum(map(_merge, held)) >= PARTED / 2:
                    yield from _blocks(held, buckets)
                    held = [], []
        if sum(map(_merge, held)):
            yield from _blocks(held, buckets)

    return told


def _blocks(held, buckets: int, bits: int = 64) -> Iterator[pa.RecordBatch]:
    """One row for each bucket, a range of the keys below 2**bits: the first key, and the steps to the others in as few
    bytes as the longest needs."""
    shift = np.uint64(max(0, bits + 1 - buckets.bit_length()))
    rows = []
    for kind, (keys,) in enumerate(held):
        bucket = keys >> shift
        bounds = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keys) else []
        for low, high in zip(bounds[:-1], bounds[1:]):
            steps = np.diff(keys[low:high])
            width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
            packed = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
            rows.append((int(bucket[low]), kind, int(keys[low].view(np.int64)), width, packed))
    for low in range(0, len(rows), 1024):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows[low : low + 1024]), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "first", "width", "steps"])


def _unpacked(first: int, width: int, packed: bytes) -> np.ndarray:
    steps = np.zeros((len(packed) // width + 1, 8), np.uint8)
    steps[1:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    steps = steps.view("<u8").ravel()
    steps[0] = np.int64(first).view(np.uint64)
    return np.add.accumulate(steps)


def _count_contexts(n_kept: int):
    """From blocks in the order of their buckets: contexts of the words by place, some COUNTED places in a row; the
    pairs of all other words in a row with part -1. A task holds the keys of one bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, others, held, at = np.zeros(n_kept, np.int64), 0, ([], []), None

        def done() -> int:
            if held[0]:
                contexts[:] += np.bincount((np.unique(np.concatenate(held[0])) & _PLACE).astype(np.int64), minlength=n_kept)
            return len(np.unique(np.concatenate(held[1]))) if held[1] else 0

        for batch in batches:
            for bucket, kind, *block in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    others, held, at = others + done(), ([], []), bucket
                held[kind].append(_unpacked(*block))
        others += done()
        parts = [(-1, np.array([others]).tobytes())]
        parts += [(low // COUNTED, contexts[low : low + COUNTED].tobytes()) for low in range(0, n_kept, COUNTED)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*parts)], names=["part", "contexts"])

    return counted


def _sum_contexts(kept: np.ndarray):
    """(key, contexts) of the words; the pairs of other words have a NULL key."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for part, packed in zip(*(c.to_pylist() for c in batch.columns)):
                sums[part] = sums.get(part, 0) + np.frombuffer(packed, np.int64)
        for part, contexts in sums.items():
            keys = pa.nulls(1, pa.int64()) if part < 0 else pa.array(kept[part * COUNTED :][: len(contexts)].view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, pa.array(contexts)], names=["key", "contexts"])

    return summed


def _contexts(texts: DataFrame, kept: np.ndarray, cell: tuple[int, int], buckets: int) -> DataFrame:
    blocks = texts.mapInArrow(lean(_distinct_pairs(kept, cell, buckets)), _BLOCKS)
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket")
    counts = dealt.mapInArrow(lean(_count_contexts(len(kept))), "part long, contexts binary").repartition("part")
    return stored(counts.mapInArrow(lean(_sum_contexts(kept)), "key long, contexts long"))


@dataclass
class Model:
    """Class 0 is ordinary, class 1 toxic. ``words`` (key, contexts, n0, n1, kept0, kept1) has the words that either
    class has beyond its discount, and the start of a text; ``pairs`` (before, word, n0, n1) likewise. Of the pairs
    that begin with a word, kept is what the discount leaves."""

    words: DataFrame
    pairs: DataFrame
    totals: np.ndarray
    discounts: np.ndarray
    backoff: np.ndarray
    contexts: int  # of all words together
    split: int  # words are in so many parts, pairs in its square
    coefficients: np.ndarray | None = None

    def shards(self) -> Iterator[Shard]:
        """One for each part of the words and each part of the words before them."""
        for i in range(self.split):
            for j in range(self.split):
                part = lambda name: F.pmod(F.col(name), F.lit(self.split))
                words = self.words.filter(part("key").isin(i, j)).toArrow()
                pairs = self.pairs.filter((part("word") == i) & (part("before") == j)).toArrow()
                keys, table = _sorted(_long(words, "key"), words, ("n0", "n1", "kept0", "kept1", "contexts"))
                pair_keys, pair_table = _sorted(_pair(_long(pairs, "before"), _long(pairs, "word")), pairs, ("n0", "n1"))
                table[4, -1] = 1  # any number will do: it cancels
                yield Shard(keys, table, pair_keys, pair_table, self.totals, self.discounts, self.backoff, max(1, self.contexts), (self.split, i, j))


def _long(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy().astype(np.int64).view(np.uint64)


def _sorted(keys: np.ndarray, rows: pa.Table, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their values, with a column of zeros for what is not among them."""
    order = np.argsort(keys)
    table = np.zeros((len(names), len(keys) + 1))
    for row, name in zip(table, names):
        row[:-1] = rows.column(name).to_numpy()[order]
    return keys[order], table


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each in ``keys``, or their number."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    place = np.searchsorted(keys, wanted)
    return np.where(keys[np.minimum(place, len(keys) - 1)] == wanted, place, len(keys))


@dataclass
class Shard:
    """What the words of one cell need of a `Model`; the last column of each table is for what it does not have."""

    keys: np.ndarray
    table: np.ndarray  # n0, n1, kept0, kept1, contexts
    pair_keys: np.ndarray
    pair_table: np.ndarray  # n0, n1
    totals: np.ndarray
    discounts: np.ndarray
    backoff: np.ndarray
    contexts: int
    cell: tuple[int, int, int]

    def sums(self, docs: list[list[bytes]], leave_out: np.ndarray | None = None) -> np.ndarray:
        """Sums over the words of each document that are in this cell: log P(word | toxic) - log P(word | ordinary);
        1; how far that goes beyond each of TELLING. ``leave_out`` has the documents' labels: their own counts
        are then taken out of their class.
        """
        at = places(docs)
        pair = _pair(at.before, at.word)
        own = None if leave_out is None else [_own_counts(at.doc, k) for k in (at.word, at.before, pair)]
        word, before, doc = at.word, at.before, at.doc
        split, i, j = self.cell
        if split > 1:
            here = (word.view(np.int64) % split == i) & (before.view(np.int64) % split == j)
            word, before, pair, doc = word[here], before[here], pair[here], doc[here]
            own = None if own is None else [n[here] for n in own]
        w, b, p = _find(self.keys, word), _find(self.keys, before), _find(self.pair_keys, pair)
        shared = self.table[4][w] / self.contexts
        logs = []
        for c in (0, 1):
            n_word, n_before, n_pair = self.table[c][w], self.table[c][b], self.pair_table[c][p]
            if own is not None:
                mine = leave_out[doc] == c
                n_word, n_before, n_pair = (n - mine * m for n, m in zip((n_word, n_before, n_pair), own))
            single = np.maximum(n_word - self.discounts[c], 0) / max(1, self.totals[c]) + self.backoff[c] * shared
            n_before = np.maximum(n_before, 1)
            direct = np.clip(np.maximum(n_pair - self.discounts[c], 0) / n_before, 0, 1)
            back = np.clip(1 - self.table[2 + c][b] / n_before, 0.01, 1)
            logs.append(np.log(direct + back * single))
        ratio = logs[1] - logs[0]
        columns = [ratio, np.ones(len(ratio)), *(np.maximum(ratio - least, 0) for least in TELLING)]
        return np.stack([np.bincount(doc, column, minlength=len(docs)) for column in columns], axis=1)


def _own_counts(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each word, how often its document has it."""
    _, number = np.unique(keys, return_inverse=True)
    _, inverse, n = np.unique(doc << 32 | number, return_inverse=True, return_counts=True)
    return n[inverse]


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    calibration_rows: int = CALIBRATION_ROWS,
) -> Model:
    """The two models, from the labelled rows for which ``usable`` (over ``id``) holds and from all texts."""
    train = labelled(docs, labels, label, usable, id_col=id_col, text_col=text_col).select("text", "label")
    counts = [F.sum(n).alias(n) for n in ("n0", "n1")]
    words = stored(train.mapInArrow(lean(_count_words), _WORDS).groupBy("key").agg(*counts))
    no_start = F.col("key") != _START_KEY
    totals = np.array([n or 0 for n in words.filter(no_start).agg(*counts).first()], float)
    #: The same rate in both classes: DISCOUNT occurrences in the smaller one.
    discounts = DISCOUNT * np.maximum(1, totals) / max(1.0, totals.min())
    words = words.filter((F.col("n0") > float(discounts[0])) | (F.col("n1") > float(discounts[1])) | ~no_start)
    words = stored(words)
    size = words.count()
    parts = max(1, -(-size // SHARD_WORDS))
    part = lambda i: np.sort(_long(words.filter(F.pmod("key", F.lit(parts)) == i).select("key").toArrow(), "key"))
    texts = with_text(docs, id_col, text_col).select("text", F.lit(None).cast("int").alias("label"))
    measured = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, 1 << (measured // BUCKET_BYTES).bit_length())
    every = np.sort(np.concatenate([part(i) for i in range(parts)]))
    kept = docs.sparkSession.sparkContext.broadcast((every, _bits([every])))
    blocks = train.mapInArrow(lean(_count_pairs(kept, buckets)), f"{_BLOCKS}, counts binary")
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket")
    pairs = stored(dealt.mapInArrow(lean(_sum_pairs(kept, tuple(map(float, discounts)))), _PAIRS))
    contexts = reduce(DataFrame.union, [_contexts(texts, part(i), (parts, i), buckets) for i in range(parts)])
    n_contexts = contexts.agg(F.sum("contexts")).first()[0] or 0
    left = [F.greatest(F.col(f"n{c}") - float(discounts[c]), F.lit(0.0)) for c in (0, 1)]
    kept = pairs.groupBy(F.col("before").alias("key")).agg(*[F.sum(left[c]).alias(f"kept{c}") for c in (0, 1)])
    words = stored(words.join(contexts, "key", "left").join(kept, "key", "left").fillna(0))
    beyond = words.filter(no_start).agg(*map(F.sum, left)).first()
    split = max(parts, int(np.ceil(np.sqrt(pairs.count() / SHARD_PAIRS))))
    backoff = 1 - np.array([n or 0.0 for n in beyond]) / np.maximum(1, totals)
    model = Model(words, pairs, totals, discounts, backoff, n_contexts, split)
    model.coefficients = _calibrated(model, labelled(docs, labels, label, usable, calibration_rows, id_col, text_col))
    return model


def _summed(rows: DataFrame, model: Model, leave_out: bool = False) -> DataFrame:
    """(id, row, label, sums) of each of ``rows`` (id, text, label); ``row`` is the hash of its text."""
    rows = rows.select("id", F.xxhash64("text").alias("row"), "label", "text")

    def by(shared):
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                labels = np.array(batch.column("label").to_pylist(), np.int64) if leave_out else None
                for first, held in word_chunks(t.as_py() for t in batch.column("text")):
                    x = shared.value.sums(held, labels[first : first + len(held)] if leave_out else None)
                    same = [batch.column(c).slice(first, len(held)) for c in range(3)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(list(x), pa.list_(pa.float64()))], names=["id", "row", "label", "sums"])

        return rows.mapInArrow(lean(summed), "id long, row long, label int, sums array<double>")

    found = [by(rows.sparkSession.sparkContext.broadcast(shard)) for shard in model.shards()]
    if len(found) == 1:
        return found[0]
    every = found[0].withColumn("one", F.lit(1))
    for more in found[1:]:
        every = every.unionByName(more.withColumn("one", F.lit(0)))
    columns = [F.sum(F.col("sums")[k]) / F.sum("one") for k in range(2 + len(TELLING))]  # equal rows have equal sums
    one = every.groupBy("id", "row", "label").agg(F.array(*columns).alias("sums"), F.sum("one").alias("n"))
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("id", "row", "label", "sums")


def _calibrated(model: Model, rows: DataFrame) -> np.ndarray:
    """Logistic coefficients from likelihoods in which each row's own counts are left out."""
    found = _summed(rows, model, leave_out=True).select("label", "sums").toArrow()
    y = found.column("label").to_numpy().astype(np.int64)
    if not len(y) or y.min() == y.max():  # nothing to compare: the rate of the class there is
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.02
        return np.array([0.0] * (2 + len(TELLING)) + [np.log(rate / (1 - rate))])
    x = np.array(found.column("sums").to_pylist())
    x = np.hstack([10 * x[:, :1] / np.maximum(1, x[:, 1:2]), np.log1p(x[:, 1:])])
    order = np.lexsort((y, *x.T))  # the same sums in every run
    return fit_logistic(x[order], y[order], ridge=1e-5)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, score) of every row, 0 to 1; a NULL or empty text has the score of a ratio of 0.

    ``row`` is the hash of the text. Repeated rows have the same score. Without labels of both classes all rows
    get the classes' rate.
    """
    rows = with_text(docs, id_col, text_col).withColumn("label", F.lit(None).cast("int"))
    of = lambda k: F.col("sums")[k]
    features = [10 * of(0) / F.greatest(F.lit(1.0), of(1)), *(F.log1p(of(k)) for k in range(1, 2 + len(TELLING)))]
    logit = sum((f * float(c) for f, c in zip(features, model.coefficients)), F.lit(float(model.coefficients[-1])))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), logit))))
    return _summed(rows, model).select(F.col("id").alias("doc_id"), "row", score.alias("score"))
