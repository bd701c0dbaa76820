"""Worker processes are reused: what a task has freed must not stay with its process."""

import ctypes
import os
import random
import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pytest

from casegrid.llm import common, jaccard, packing, subwords, substring
from casegrid.llm.queries import word_tokenizer


class Rows:
    """Keeps the task that it is given instead of running it."""

    def mapInArrow(self, task, schema):
        self.task = task
        return self

    def dropDuplicates(self, columns):
        return self

    @property
    def sparkSession(self):
        return self

    sparkContext = sparkSession

    def broadcast(self, value):
        self.value = value
        return self


def described(rows):
    jaccard._described(rows, 5)


def nodes(rows):
    jaccard._nodes(rows, np.ones(1 << jaccard.RARITY_BITS, np.int64), 5, 80)


def batches():
    rng = random.Random(3)
    words = [f"{rng.randrange(1 << 60):x}" for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=150)).encode() for _ in range(10_000)]
    return pa.table({"id": pa.array(range(len(texts))), "text": pa.array(texts, pa.binary())}).to_batches()


def held_mb():
    with open("/proc/self/smaps_rollup") as found:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", found.read())[1]) / 1024


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory cannot be read here")
@pytest.mark.parametrize("operator", [described, nodes])
def test_a_finished_task_leaves_little_to_give_back(operator):
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is None:
        pytest.skip("another C library")
    rows = Rows()
    operator(rows)
    made = iter(batches())
    trim(0)
    assert sum(batch.num_rows for batch in rows.task(made))
    left = held_mb()
    pa.default_memory_pool().release_unused()
    trim(0)
    assert left - held_mb() < 6


def made_of(operator, monkeypatch, table):
    """The batches that the task of ``operator`` makes of one batch."""
    rows = Rows()
    monkeypatch.setattr(packing, "with_text", lambda *_: rows)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: packing.TaskContext)
    monkeypatch.setattr(packing.TaskContext, "partitionId", lambda: 0)
    operator(rows)
    return list(rows.task(iter(table.combine_chunks().to_batches())))


@pytest.mark.parametrize("operator", [lambda rows: substring._anchor_rows(rows, 4), lambda rows: packing.cut_pieces(rows, word_tokenizer(), 1, 64)])
def test_a_batch_of_many_rows_makes_batches_of_few(monkeypatch, operator):
    texts = pa.array([b"one two three four five six"] * 3_000, pa.binary())
    numbers = pa.array(range(3_000))
    columns = {"id": numbers, "text": texts} if operator.__code__.co_names[0] == "packing" else {"id": numbers, "row": numbers, "text": texts}
    made = made_of(operator, monkeypatch, pa.table(columns))
    assert sum(len(set(batch.column(0).to_pylist())) for batch in made) == 3_000
    assert max(len(set(batch.column(0).to_pylist())) for batch in made) <= 512


def test_a_finished_task_keeps_no_hashes():
    rows = Rows()
    described(rows)
    assert sum(batch.num_rows for batch in rows.task(iter(batches())))
    assert not common._WORD_HASHES and not common._WORD_HASHES._older


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(common, "CACHED_WORDS", 50)
    words = [b"w%d" % k for k in range(400)]
    mixed = [word for w in words for word in (b"often", w)]
    monkeypatch.setattr(common, "blake2b", lambda word, digest_size: hashed.append(word) or blake2b(word, digest_size=digest_size))
    hashed = []
    common.forget_hashes()
    found = common.hash_words(mixed).tolist()
    assert found == [int.from_bytes(blake2b(word, digest_size=8).digest(), "little") for word in mixed]
    assert hashed.count(b"often") == 1 and len(hashed) == 401
    assert len(common._WORD_HASHES) <= 50 and len(common._WORD_HASHES._older) <= 50
    common.forget_hashes()


def test_composed_words_take_no_room_from_others(monkeypatch):
    monkeypatch.setattr(subwords, "CACHED_WORDS", 20)
    encoder = subwords.Subwords(word_tokenizer())
    text = " ".join(f"often{a}{b}" for a in "!.,;:?" for b in "!.,;:?)")
    ids = encoder.encode(text.encode())
    assert np.frombuffer(ids, "<u4").tolist() == encoder._tokenizer.encode(text, add_special_tokens=False).ids
    assert b"often" in encoder._words and not any(word.startswith(b"often") and word != b"often" for word in encoder._words)
    assert len(encoder._words._composed) <= 10
