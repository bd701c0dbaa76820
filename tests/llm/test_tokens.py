"""Token files and packing against plain versions with the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casegrid.llm import subwords
from casegrid.llm.packing import Places, best_fit_packing, plan_packing
from casegrid.llm.subwords import Subwords
from casegrid.llm.token_files import TokenFile, file_bytes, pack, read_token_files, unpack, write_token_files
from casegrid.operators.storage import scratch_path

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def plain_ids(library, text, end):
    return library.encode(text or "", add_special_tokens=False).ids + [end]


@settings(max_examples=60, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_words_are_encoded_as_whole_texts_are(text):
    library, encoder = Tokenizer.from_file(FILE), Subwords(FILE)
    whole = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == whole


def test_a_full_cache_keeps_frequent_words(monkeypatch):
    monkeypatch.setattr(subwords, "CACHED_WORDS", 20)
    encoder, made = Subwords(FILE), []
    one = encoder._word
    monkeypatch.setattr(encoder, "_word", lambda word: made.append(word) or one(word))
    rare = [f"r{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)]
    text = " ".join(f"often Often, {word}" for word in rare)
    ids = np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()
    assert ids == Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert made.count(b"often") == made.count(b"Often,") == 1 and len(made) == 403  # and one comma


def test_ids_of_whole_bytes_are_plain_integers():
    ids = np.random.default_rng(2).integers(0, 1 << 16, 1 << 20, dtype=np.uint32)
    packed = pack(ids, 16)
    assert packed == ids.astype("<u2").tobytes() and unpack(packed, 16, len(ids)).tolist() == ids.tolist()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 400), st.integers(0, 2**32))
def test_packed_ids_come_back(bits, count, seed):
    ids = np.random.default_rng(seed).integers(0, 2**bits, count, dtype=np.uint64)
    assert unpack(pack(ids, bits), bits, count).tolist() == ids.tolist()


def test_random_access_reads_the_blocks_that_it_needs():
    rng = np.random.default_rng(1)
    lengths = [0, 5, 40_000, 1, 20_000]
    ids = rng.integers(0, 49_408, sum(lengths))
    file = TokenFile(file_bytes([3, 4, None, 6, 7], lengths, ids, 16, 0, 2))
    start = 0
    for k, n in enumerate(lengths):
        assert file.document(k).tolist() == ids[start : start + n].tolist()
        start += n
    assert file.ids(16_380, 16_390).tolist() == ids[16_380:16_390].tolist()
    assert (file.part, file.sequence, file.null_ids.tolist()) == (0, 2, [0, 0, 1, 0, 0])
    with pytest.raises(ValueError):
        TokenFile(b"x" * 64)


def test_files_hold_all_rows_in_order(spark, documents, awkward, library):
    docs = documents(awkward)
    path = scratch_path(docs)
    write_token_files(docs, path, FILE, end_id=2, partitions=3, file_ids=1000)
    found = sorted(read_token_files(spark, path).collect(), key=lambda r: r["start"])
    at = 0
    texts = defaultdict(list)
    for i, text in awkward:
        texts[i].append(plain_ids(library, text, 2))
    ids = [r["doc_id"] for r in found]
    assert ids == sorted([i for i, _ in awkward], key=lambda i: (i is not None, i))
    for row in found:
        own = np.frombuffer(row["ids"], "<u4").tolist()
        assert row["start"] == at and row["n_tokens"] == len(own) and row["ids_crc32"] == zlib.crc32(row["ids"])
        texts[row["doc_id"]].remove(own)
        at += len(own)
    assert not any(texts.values())


def test_no_rows_make_no_tokens(spark, documents):
    docs = documents([])
    path = scratch_path(docs)
    write_token_files(docs, path, FILE, end_id=2)
    assert read_token_files(spark, path).count() == 0
    assert best_fit_packing(docs, FILE, end_id=1).count() == 0


def held(runs):
    counts = defaultdict(int)
    for run in runs:
        for length, n in run.items:
            counts[length] += n * run.count
    return dict(counts)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 300), max_size=30), st.integers(2, 12), st.integers(1, 20))
def test_a_plan_holds_every_piece_once(counts, large_part, sizes):
    runs = plan_packing(counts, 100, large_part, sizes)
    assert held(runs) == counts
    assert all(run.used <= 100 and run.count > 0 for run in runs)


def first_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        for k, room in enumerate(rooms):
            if room >= length:
                rooms[k] -= length
                break
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_about_as_short_as_first_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [min(4096, int(rng.lognormvariate(6 + seed / 3, 1)) + 1) for _ in range(1500)]
    counts = defaultdict(int)
    for length in lengths:
        counts[length] += 1
    sequences = sum(run.count for run in plan_packing(counts, 4096))
    assert -(-sum(lengths) // 4096) <= sequences <= 1.02 * first_fit_decreasing(lengths, 4096) + 1


def test_places_follow_the_plan():
    runs = plan_packing({70: 3, 30: 4, 10: 5}, 100)
    places = Places(runs)
    taken = defaultdict(list)
    for length, n in ((70, 3), (30, 4), (10, 5)):
        sequence, offset = places.find(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            taken[s].append((o, length))
    for pieces in taken.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 100


def test_packed_pieces_are_the_documents(spark, documents, awkward, library):
    rows = best_fit_packing(documents(awkward), FILE, end_id=1, capacity=256).collect()
    expected = []
    for i, text in awkward:
        ids = np.array(plain_ids(library, text, 1), "<u4")
        for piece, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            expected.append((i, piece, at, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
