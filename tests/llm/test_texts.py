"""Decontamination, substring de-duplication, Jaccard join and near copies against brute force."""

import random
import re
from itertools import combinations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casegrid.llm import groups, jaccard
from casegrid.llm.components import components
from casegrid.llm.decontaminate import find_contamination
from casegrid.llm.jaccard import jaccard_components
from casegrid.llm.substring import SuffixAutomaton, remove_repeated, repeated_spans


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small(text))


def brute_contamination(docs, items, window):
    out = []
    for i, text in docs:
        words, hit, found = item_words(text), set(), set()
        for item, item_text in items:
            own = item_words(item_text)
            n = min(window, len(own))
            windows = {tuple(own[p : p + n]) for p in range(len(own) - n + 1)} if own else set()
            for p in range(len(words) - n + 1):
                if n and tuple(words[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    if item is not None:
                        found.add(item)
        out.append((i, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def contamination(spark, documents, docs, items, **options):
    table = spark.createDataFrame(items, "item_id long, text string, words string")
    found = find_contamination(documents(docs), table, window=4, **options).collect()
    return sorted(
        ((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in found), key=str
    )


@pytest.mark.parametrize("shard_windows", [150_000, 7])
def test_contamination_equals_brute_force(spark, documents, awkward, shard_windows):
    rng = random.Random(2)
    vocabulary = ["a", "b", "c", "Dé", "e5", "f"]
    docs = awkward + [(20 + k, " ".join(rng.choice(vocabulary) for _ in range(60))) for k in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 9]))), "w") for k in range(8)]
    items += [(8, None, "w"), (9, "", "w"), (10, "??", "w"), (0, items[1][1], "w"), (None, "A b C dé e5", "w"), (11, "one TWO", "w")]
    found = contamination(spark, documents, docs, items, shard_windows=shard_windows)
    assert found == brute_contamination(docs, [i[:2] for i in items], 4)


def test_without_items_or_documents_nothing_is_contaminated(spark, documents):
    assert contamination(spark, documents, [(1, "a b c d e"), (2, None)], []) == [(1, 5, 0, []), (2, 0, 0, [])]
    assert contamination(spark, documents, [], [(1, "a b c d", "w")]) == []


# --- substrings


def brute_kept(docs, least):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, words in split:
        if i is not None:
            for p in range(len(words) - least + 1):
                window = tuple(words[p : p + least])
                first[window] = min(i, first.get(window, i))
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - least + 1):
            if i is not None and first[tuple(words[p : p + least])] < i:
                gone.update(range(p, p + least))
        out.append((i, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return sorted(out, key=str)


def kept(documents, docs, least, **options):
    found = remove_repeated(documents(docs), least, **options).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in found), key=str)


@pytest.mark.parametrize("shard_contexts", [400, 2])
def test_removed_passages_equal_brute_force(documents, awkward, shard_contexts):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(30)]
    docs = list(awkward)
    for k in range(40):
        words = [rng.choice("uvwxyz") for _ in range(rng.choice([5, 20, 60]))]
        at = rng.randrange(len(words))
        cut = sorted(rng.sample(range(31), 2))
        docs.append((rng.randrange(100, 130), " ".join(words[:at] + passage[cut[0] : cut[1]] + words[at:])))
    assert kept(documents, docs, 10, shard_contexts=shard_contexts) == brute_kept(docs, 10)


def test_no_documents_lose_nothing(documents):
    assert kept(documents, [], 10) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=14), max_size=5), st.text("abc", max_size=20), st.integers(2, 6))
def test_matching_statistics(added, text, least):
    automaton = SuffixAutomaton()
    for sequence in added:
        automaton.add(sequence)
    longest = []
    for end in range(1, len(text) + 1):
        longest.append(max((n for n in range(end + 1) if any(text[end - n : end] in s for s in added)), default=0))
    assert list(automaton.matches(text)) == longest
    spans, nothing_new = repeated_spans(automaton, list(text), least)
    starts = [p for p in range(len(text) - least + 1) if any(text[p : p + least] in s for s in added)]
    covered = {q for p in starts for q in range(p, p + least)}
    assert {q for a, b in spans for q in range(a, b)} == covered
    assert nothing_new == (len(starts) == max(0, len(text) - least + 1))


# --- Jaccard


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", small(text))
    n = min(size, len(words))
    return frozenset(tuple(words[p : p + n]) for p in range(len(words) - n + 1)) if words else frozenset()


def brute_components(docs, size, percent):
    named = [(i, shingles(t, size)) for i, t in docs]
    parent = {i: i for i, _ in named if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, x), (j, y) in combinations([n for n in named if n[0] is not None], 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in named), key=str)


def near_copies(rng, base, edits, vocabulary):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


@pytest.mark.parametrize("size, percent, few", [(3, 90, 512), (5, 80, 2), (2, 60, 512)])
def test_components_equal_brute_force(documents, awkward, monkeypatch, size, percent, few):
    monkeypatch.setattr(groups, "FEW", few)  # large groups are split, blocks are small
    monkeypatch.setattr(groups, "SPLIT", 1000 if few > 2 else 10)
    monkeypatch.setattr(jaccard, "BLOCK", 256 if few > 2 else 3)
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(3000)]
    docs = list(awkward)
    for n in (8, 40, 150):
        base = [rng.choice(vocabulary) for _ in range(n)]
        docs += [(100 + 40 * n + k, near_copies(rng, base, rng.randrange(8), vocabulary)) for k in range(25)]
    base = [rng.choice("abcdefg") for _ in range(60)]  # few words: many common shingles
    docs += [(9000 + k, near_copies(rng, base, 3, "abcdefg")) for k in range(25)]
    found = jaccard_components(documents(docs), size, percent).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str)
    assert got == brute_components(docs, size, percent)


def test_no_documents_no_components(documents):
    assert jaccard_components(documents([])).count() == 0


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 101)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 103: 100}


def test_sets_of_shingles_are_made_for_a_few_texts_at_a_time():
    class Rows:
        def mapInArrow(self, function, schema):
            self.function = function

    rows = Rows()
    jaccard._described(rows, 3)
    texts = [f"one two w{k % 700}".encode() for k in range(1300)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1301), pa.int64()), pa.array(texts)], names=["id", "text"])
    *described, counts = rows.function(iter([batch, batch.slice(0, 0)]))
    assert max(b.num_rows for b in described) <= 512
    found = pa.Table.from_batches(described).to_pydict()
    assert found["id"] == list(range(1301)) and found["n"] == [1] * 1300 + [0] and len(set(found["node"])) == 701
    assert sum(counts.column("n").to_pylist()) == 1300
