"""Best-fit packing of tokenised documents into sequences of fixed capacity.

The plan is made on the histogram of piece lengths, which has at most ``capacity`` rows however many
pieces there are:

1. Large pieces are grouped linearly: sorted by length, cut into groups of equal cardinality, and each
   rounded up to the longest of its group, so that only a few sizes remain.
2. Configurations of these few sizes are chosen one after the other, each the fullest that the remaining
   pieces allow and used as often as they allow.
3. Actual lengths are put in place of the rounded ones; the room that this frees counts.
4. Small pieces go, longest first, to the open sequences that they fit best.

The plan is a list of runs (so many sequences with the same contents). Spark counts every piece's rank
among the pieces of its length, without a task that sees all of them, and reads its place off the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import lean, slices, with_text
from casegrid.llm.subwords import subwords
from casegrid.operators.storage import stored

#: Pieces longer than this part of a sequence are large.
LARGE_PART = 8
#: Sizes that the large pieces are rounded to.
SIZES = 48

Item = tuple[int, int]  # length, pieces of it in each sequence


@dataclass(frozen=True)
class Run:
    """``count`` sequences, each holding ``items`` in this order."""

    count: int
    items: tuple[Item, ...]

    @property
    def used(self) -> int:
        return sum(length * n for length, n in self.items)


def linear_groups(counts: Mapping[int, int], sizes: int) -> list[list[Item]]:
    """Lengths with their counts, longest first, cut into at most ``sizes`` groups of equal cardinality."""
    total = sum(counts.values())
    share = -(-total // sizes) if total else 0
    groups: list[list[Item]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                groups.append([])
                room = share
            taken = min(left, room)
            groups[-1].append((length, taken))
            left, room = left - taken, room - taken
    return groups


def fullest(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size fill ``capacity`` best, with at least one of the first size still there."""
    first = next(k for k, n in enumerate(left) if n)
    room = capacity - sizes[first]
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    came_by = np.full(room + 1, -1)  # the size that reaches a fill first
    for k in range(first, len(sizes)):
        size = sizes[k]
        for _ in range(min(left[k] - (k == first), room // size)):
            new = np.zeros_like(reached)
            new[size:] = reached[: room + 1 - size]
            new &= ~reached
            # a fill reached by this size through this size counts its pieces: stop once nothing is new
            if not new.any():
                break
            came_by[new] = k
            reached |= new
    chosen = [0] * len(sizes)
    chosen[first] = 1
    fill = int(np.flatnonzero(reached)[-1])
    while fill:
        chosen[came_by[fill]] += 1
        fill -= sizes[came_by[fill]]
    return chosen


def configurations(groups: list[list[Item]], capacity: int) -> list[tuple[int, list[int]]]:
    """(multiplicity, pieces from each group) until no large piece is left."""
    sizes = [group[0][0] for group in groups]
    left = [sum(n for _, n in group) for group in groups]
    found = []
    while any(left):
        chosen = fullest(sizes, left, capacity)
        times = min(n // c for n, c in zip(left, chosen) if c)
        found.append((times, chosen))
        left = [n - times * c for n, c in zip(left, chosen)]
    return found


def substituted(groups: list[list[Item]], found: list[tuple[int, list[int]]]) -> Iterator[Run]:
    """The configurations with actual lengths, cut where a group passes on to its next length."""
    queues = [list(reversed(group)) for group in groups]
    for times, chosen in found:
        slots = []  # per piece of the configuration: its lengths over the sequences
        for queue, need in zip(queues, chosen):
            for _ in range(need):
                slot, wanted = [], times
                while wanted:
                    length, n = queue.pop()
                    taken = min(n, wanted)
                    slot.append((length, taken))
                    wanted -= taken
                    if n > taken:
                        queue.append((length, n - taken))
                slots.append(slot)
        ends = sorted({int(end) for slot in slots for end in np.cumsum([n for _, n in slot])})
        at, places = 0, [0] * len(slots)
        passed = [0] * len(slots)
        for end in ends:
            contents: dict[int, int] = defaultdict(int)
            for s, slot in enumerate(slots):
                contents[slot[places[s]][0]] += 1
                passed[s] += end - at
                if passed[s] == slot[places[s]][1]:
                    places[s], passed[s] = places[s] + 1, 0
            yield Run(end - at, tuple(sorted(contents.items(), reverse=True)))
            at = end


def plan_packing(counts: Mapping[int, int], capacity: int, large_part: int = LARGE_PART, sizes: int = SIZES) -> list[Run]:
    """Runs that hold every piece of the histogram once; lengths must lie in 1..capacity."""
    large = {length: n for length, n in counts.items() if n and capacity // large_part < length < capacity}
    done = [Run(counts[capacity], ((capacity, 1),))] if counts.get(capacity) else []
    groups = linear_groups(large, sizes)
    open_runs: dict[int, list[Run]] = defaultdict(list)  # by room
    for run in substituted(groups, configurations(groups, capacity)):
        open_runs[capacity - run.used].append(run)
    rooms = sorted(room for room in open_runs)

    def put(run: Run) -> None:
        room = capacity - run.used
        if room not in open_runs or not open_runs[room]:
            if bisect_left(rooms, room) == len(rooms) or rooms[bisect_left(rooms, room)] != room:
                insort(rooms, room)
        open_runs[room].append(run)

    for length in sorted((x for x, n in counts.items() if n and x <= capacity // large_part), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                put(Run(left // each, ((length, each),)))
                left -= left // each * each
                continue
            room = rooms[at]
            run = open_runs[room].pop()
            if not open_runs[room]:
                rooms.pop(at)
            each = min(room // length, left)
            taken = min(run.count, left // each)
            put(Run(taken, (*run.items, (length, each))))
            if taken < run.count:
                put(Run(run.count - taken, run.items))
            left -= taken * each
    return done + [run for room in sorted(open_runs) for run in open_runs[room]]


class Places:
    """The plan read by (length, rank): which sequence, at which offset."""

    def __init__(self, runs: list[Run]):
        ranks: dict[int, int] = defaultdict(int)
        rows, first = [], 0
        for run in runs:
            offset = 0
            for length, each in run.items:
                rows.append((length, ranks[length], first, each, offset))
                ranks[length] += run.count * each
                offset += length * each
            first += run.count
        rows.sort()
        columns = np.array(rows, np.int64).reshape(-1, 5).T
        self.lengths, self.ranks, self.first, self.each, self.offsets = (np.ascontiguousarray(c) for c in columns)
        self.sequences = first

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ids and offsets. Lengths stay below 2**20 and ranks below 2**43."""
        keys = (self.lengths << 43) | self.ranks
        at = np.searchsorted(keys, (lengths << 43) | ranks, "right") - 1
        nth = ranks - self.ranks[at]
        return self.first[at] + nth // self.each[at], self.offsets[at] + nth % self.each[at] * lengths


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
_OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids, with its task (``part``) and its number among the
    task's pieces of its length (``nth``). Store it before use: both hold for one evaluation only."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = subwords(tokenizer_file), np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    held = ids[at : at + 4 * capacity]
                    length = len(held) // 4
                    rows.append((key, piece, at // 4, length, zlib.crc32(held), part, seen[length]))
                    seen[length] += 1
            yield _batch(_PIECES, list(zip(*rows)) or [[]] * 7)

    return with_text(docs, id_col, text_col).mapInArrow(lean(pieces), _PIECES)


def _batch(schema: str, columns) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    arrays = [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def pack_pieces(pieces: DataFrame, capacity: int, large_part: int = LARGE_PART, sizes: int = SIZES) -> DataFrame:
    """Stored `cut_pieces` with ``sequence_id`` and ``offset``; only the histogram reaches the driver."""
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("held"))
    histogram = {row["length"]: row["n"] for row in per_part.groupBy("length").agg(F.sum("held").alias("n")).collect()}
    places = Places(plan_packing(histogram, capacity, large_part, sizes))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    shared = pieces.sparkSession.sparkContext.broadcast(places)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(name).to_numpy() for name in ("length", "rank"))
            sequence, offset = shared.value.find(lengths, ranks)
            columns = [batch.column(k) for k in range(5)] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _OUT.split(", ")])

    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    return ranked.mapInArrow(lean(placed), _OUT)


def best_fit_packing(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    A row's ids are those of its text and ``end_id``; only rows of more than ``capacity`` ids are cut.
    NULL and empty texts are one piece of one id. Repeated rows and NULL ids are packed like any others;
    an empty table gives no rows. Offsets in a sequence leave no gap.
    """
    return pack_pieces(stored(cut_pieces(docs, tokenizer_file, end_id, capacity, id_col, text_col)), capacity)
