"""Substring de-duplication with suffix automata of reference shards.

A word goes if a stretch of at least ``least`` words around it also stands in a document with a smaller id.
An automaton of the whole corpus, against which every document is streamed, would cost documents
times shards. So documents meet only the shards that can match:

1. Each window of ``least`` words selects the smallest hash among its runs of half as many words (its anchor).
   Equal windows select equal anchors, so a match always shares an anchor, with the same words around it.
2. The words that any window with this anchor can reach are the anchor's context. Equal contexts are
   counted together: in every document but the first of them all its words go. Thousands of copies are one row.
3. The distinct contexts of one anchor are a reference shard. In order of their first document they stream
   through a suffix automaton of those before them; the matching statistics give the maximal spans of at
   least ``least`` words. Then they join the automaton.
4. An anchor with more than ``SHARD_CONTEXTS`` contexts (a passage in very many documents) would make an unbounded
   shard. Its windows are compared by 128-bit hashes in a grouped count instead, which splits over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import _powers, hash_words, lean, mixed, slices, with_text
from casegrid.operators.storage import fits_broadcast, stored

SHARD_CONTEXTS = 400
#: Fixed odd multipliers of two independent polynomial hashes.
_FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_OFFSET = np.uint64(0xA0761D6478BD642F)


class SuffixAutomaton:
    """Substrings of all sequences added so far; states are numbers, transitions one dict per state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: Iterable) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def _extend(self, last: int, symbol) -> int:
        following, link, length = self.next, self.link, self.length
        known = following[last].get(symbol)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, symbol, known)
        state = len(length)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in following[at]:
            following[at][symbol] = state
            at = link[at]
        if at != -1:
            known = following[at][symbol]
            link[state] = known if length[known] == length[at] + 1 else self._clone(at, symbol, known)
        return state

    def _clone(self, at: int, symbol, known: int) -> int:
        following, link, length = self.next, self.link, self.length
        clone = len(length)
        following.append(dict(following[known]))
        length.append(length[at] + 1)
        link.append(link[known])
        link[known] = clone
        while at != -1 and following[at].get(symbol) == known:
            following[at][symbol] = clone
            at = link[at]
        return clone

    def matches(self, sequence: Iterable) -> Iterator[int]:
        """For each place the length of the longest substring that ends there and has been added."""
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        for symbol in sequence:
            while state and symbol not in following[state]:
                state = link[state]
                matched = length[state]
            step = following[state].get(symbol)
            if step is not None:
                state, matched = step, matched + 1
            yield matched


def repeated_spans(automaton: SuffixAutomaton, sequence: list, least: int) -> tuple[list[tuple[int, int]], bool]:
    """Maximal spans [start, end) covered by matches of at least ``least`` symbols, and whether every stretch
    of ``least`` symbols matches (the automaton then has nothing to learn from the sequence)."""
    spans: list[tuple[int, int]] = []
    missing = len(sequence) - least + 1
    for at, matched in enumerate(automaton.matches(sequence)):
        if matched >= least:
            missing -= 1
            start = at + 1 - matched
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, at + 1))
    return spans, missing <= 0


class Hashed:
    """Hashes of any stretch of a sequence of word hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        zero = np.zeros(1, np.uint64)
        self._sums, self._back = [], []
        for k, multiplier in enumerate((_FIRST, _SECOND)):
            values = mixed(words + _OFFSET * np.uint64(k)) * _powers(multiplier, n + 1)[:n]
            self._sums.append(np.concatenate([zero, np.add.accumulate(values)]))
            self._back.append(_powers(pow(multiplier, -1, 1 << 64), n + 1))

    def stretch(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        sums = (self._sums[which][end] - self._sums[which][start]) * self._back[which][start]
        return mixed(sums ^ mixed((end - start).astype(np.uint64)))


def anchors(hashed: Hashed, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the selected runs, and their hashes."""
    run, n = least // 2, len(hashed.words)
    starts = np.arange(n - run + 1)
    runs = hashed.stretch(starts, starts + run, 0)
    windows = np.lib.stride_tricks.sliding_window_view(runs, least - run + 1)
    places = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return places, runs[places]


def reach(places: np.ndarray, least: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Context [start, end) of anchors: what windows with them can cover."""
    return np.maximum(places - (least - least // 2), 0), np.minimum(places + least, n)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space, unchanged."""
    return (text or b"").split()


_ANCHORS = "id long, row long, place int, anchor long, context long"


def _anchor_rows(rows: DataFrame, least: int) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for key, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text.as_py())
                if key is None or len(words) < least:
                    continue
                hashed = Hashed(hash_words(words))
                places, runs = anchors(hashed, least)
                contexts = hashed.stretch(*reach(places, least, len(words)), 1)
                n = len(places)
                parts = (np.full(n, key), np.full(n, row), places.astype(np.int32), runs.view(np.int64), contexts.view(np.int64))
                for column, part in zip(out, parts):
                    column.append(part)
            if out[0]:
                arrays = [pa.array(np.concatenate(column)) for column in out]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "row", "place", "anchor", "context"])

    return rows.mapInArrow(lean(found), _ANCHORS)


_WORDS = "anchor long, context long, first long, hot boolean, words binary"


def _context_words(rows: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The word hashes of the contexts that ``wanted`` (id, row, place, anchor, context, hot) names."""
    ids = wanted.select("id", "row").distinct()
    rows = rows.join(F.broadcast(ids), ["id", "row"], "left_semi") if fits_broadcast(ids) else rows
    asked = wanted.groupBy("id", "row").agg(F.collect_list(F.struct("place", "anchor", "context", "hot")).alias("asked"))
    rows = rows.dropDuplicates(["id", "row"]).join(asked, ["id", "row"]).select("id", "text", "asked")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = hash_words(words_of(text.as_py()))
                asked = asked.as_py()
                starts, ends = reach(np.array([a["place"] for a in asked]), least, len(words))
                cut = [words[a:b].astype("<u8").tobytes() for a, b in zip(starts, ends)]
                columns = [[a[name] for a in asked] for name in ("anchor", "context", "hot")]
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_()))]
                arrays = [*arrays[:2], pa.array([key] * len(asked), pa.int64()), arrays[2], pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "first", "hot", "words"])

    return rows.mapInArrow(lean(found), _WORDS)


_FOUND = "anchor long, context long, start int, end int"


def _by_automata(contexts: DataFrame, least: int) -> DataFrame:
    """Spans of each context that stand in a context of the same anchor with a smaller first document."""
    rows = contexts.select("anchor", "first", "context", "words").repartition("anchor").sortWithinPartitions("anchor", "first")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        out = []
        for anchor, shard in groupby(rows, key=lambda row: row[0]):
            automaton = SuffixAutomaton()
            for _, same in groupby(shard, key=lambda row: row[1]):
                new = []
                for _, _, context, raw in same:
                    words = np.frombuffer(raw, "<u8").tolist()
                    spans, nothing_new = repeated_spans(automaton, words, least)
                    out.extend((anchor, context, a, b) for a, b in spans)
                    if not nothing_new:
                        new.append(words)
                for words in new:  # texts of one document are no reference to each other
                    automaton.add(words)
            if len(out) >= 10_000:
                yield _spans_batch(out)
                out = []
        if out:
            yield _spans_batch(out)

    return rows.mapInArrow(lean(found), _FOUND)


def _spans_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "start", "end"])


def _by_windows(contexts: DataFrame, least: int) -> DataFrame:
    """The same for anchors with very many contexts: equal windows by their hashes, first documents by a count."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "first", "start", "w0", "w1"]
        for batch in slices(batches):
            words = [np.frombuffer(w.as_py(), "<u8") for w in batch.column("words")]
            parts = [_window_hashes(w, least) for w in words]
            counts = [len(p[0]) for p in parts]
            arrays = [pa.array(np.repeat(batch.column(n).to_numpy(), counts)) for n in names[:3]]
            arrays.append(pa.array(np.concatenate([np.arange(c, dtype=np.int32) for c in counts])))
            arrays += [pa.array(np.concatenate([p[k] for p in parts]).view(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    windows = contexts.select("anchor", "context", "first", "words").mapInArrow(
        lean(found), "anchor long, context long, first long, start int, w0 long, w1 long"
    )
    windows = stored(windows)
    firsts = windows.groupBy("w0", "w1").agg(F.min("first").alias("least"), F.max("first").alias("most"))
    shared = firsts.filter("least < most").drop("most")
    return windows.join(shared, ["w0", "w1"]).filter("least < first").select(
        "anchor", "context", "start", (F.col("start") + least).alias("end")
    )


def _window_hashes(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    hashed = Hashed(words)
    starts = np.arange(len(words) - least + 1)
    return hashed.stretch(starts, starts + least, 0), hashed.stretch(starts, starts + least, 1)


def repeated_passages(rows: DataFrame, least: int, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """(id, row, start, end): spans of words to remove, overlapping ones among them, of (id, row, text) rows."""
    places = stored(_anchor_rows(rows, least))
    contexts = places.groupBy("anchor", "context").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    groups = contexts.groupBy("anchor").agg(
        F.count("*").alias("contexts"),
        F.min("first").alias("least"),
        F.max("first").alias("most_first"),
        F.max("last").alias("most"),
    )
    shared = contexts.drop("last").join(groups.filter("least < most").drop("most"), "anchor")
    known = stored(places.join(shared, ["anchor", "context"]))
    back, ahead = least - least // 2, least
    whole = known.filter("id > first").select(
        "id", "row", F.greatest(F.col("place") - back, F.lit(0)).alias("start"), (F.col("place") + ahead).alias("end")
    )
    single = known.filter("id = first and contexts > 1 and least < most_first")
    wanted = single.groupBy("anchor", "context").agg(
        F.min(F.struct("id", "row", "place")).alias("at"), F.first(F.col("contexts") > shard_contexts).alias("hot")
    )
    wanted = stored(wanted.select("at.id", "at.row", "at.place", "anchor", "context", "hot"))
    words = stored(_context_words(rows, wanted, least))
    spans = _by_automata(words.filter("not hot"), least).union(_by_windows(words.filter("hot"), least))
    # a context starts at the document's first word or ``back`` words before its anchor
    partial = single.select("id", "row", "place", "anchor", "context").join(spans, ["anchor", "context"]).select(
        "id",
        "row",
        (F.greatest(F.col("place") - back, F.lit(0)) + F.col("start")).alias("start"),
        (F.greatest(F.col("place") - back, F.lit(0)) + F.col("end")).alias("end"),
    )
    return whole.union(partial)


_OUT = "doc_id long, row long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, text binary"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def remove_repeated(
    docs: DataFrame,
    least: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_contexts: int = SHARD_CONTEXTS,
) -> DataFrame:
    """(doc_id, row, n_words, n_removed, spans, text) of every row; ``row`` is Spark's xxhash64 of the text's bytes.

    ``spans`` are the maximal removed stretches [start, end) of words, ``text`` the other words joined by one space
    each. Windows are judged on the input. NULL and empty texts have no words. Rows with a NULL id neither lose
    words nor take any from others; rows of one id do not count as repeats of each other, and each keeps
    what its own text keeps. An empty table gives no rows.
    """
    rows = with_text(docs, id_col, text_col).select("id", F.xxhash64("text").alias("row"), "text")
    spans = repeated_passages(rows, least, shard_contexts)
    # few numbers for each row: spans of one task are joined before the shuffle, all at the end
    per_row = spans.groupBy("id", "row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, n_removed, out, kept = [], [], [], []
            for text, spans in zip(batch.column(2), batch.column(3).to_pylist()):
                words = words_of(text.as_py())
                edges = np.zeros(len(words) + 1, np.int64)
                for span in spans or ():
                    edges[span["start"]] += 1
                    edges[min(span["end"], len(words))] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                out.append([{"start": a, "end": b} for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())])
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if n_removed[-1] else words))
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, _SPANS), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["doc_id", "row", "n_words", "n_removed", "spans", "text"])

    joined = rows.join(per_row, rows["id"].eqNullSafe(per_row["id"]) & rows["row"].eqNullSafe(per_row["row"]), "left")
    found = joined.select(rows["id"], rows["row"], rows["text"], "spans").mapInArrow(lean(removed), _OUT)
    return found.withColumn("text", F.col("text").cast("string"))
