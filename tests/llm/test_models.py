"""Toxicity and quality: held-out accuracy, and defined results where there is little to learn from."""

import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casegrid.llm import toxicity
from casegrid.llm.common import hash_words
from casegrid.llm.labelled import fit_logistic, sigmoid
from casegrid.llm.quality import N_FEATURES, describe, fit_quality, preference_pairs, score_quality
from casegrid.llm.queries import op9_quality, remainder
from casegrid.llm.toxicity import fit_toxicity, score_toxicity

SF_DIR = "/root/testdata/sf0.01"
LABELS = "doc_id long, toxic int, quality int, text string"


def labelled_corpus(seed=1, n=600):
    """Every third text has a few words of a small set; half of the texts are labelled."""
    rng = random.Random(seed)
    usual = [f"word{k}" for k in range(300)]
    bad = ["vile", "nasty", "rotten"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(usual) for _ in range(rng.randrange(20, 80))]
        toxic = int(i % 3 == 0)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic, None, "x"))
    return docs, labels


def test_toxic_texts_are_told_from_others(spark, documents):
    docs, labels = labelled_corpus()
    known = [row for row in labels if row[0] % 2] + [labels[1], (None, 1, 1, "x"), (5, None, None, "x"), (7, 9, 9, "x")]
    model = fit_toxicity(documents(docs), spark.createDataFrame(known, LABELS), usable=remainder(4) != 2)
    more = documents([*docs, (-1, None), (-2, ""), (-3, "!?"), (-1, None)])
    scores = [(r["doc_id"], r["score"]) for r in score_toxicity(more, model).collect()]
    held = [(i, s) for i, s in scores if i is not None and i >= 0 and (zlib.crc32(str(i).encode()) % 4 == 2 or i % 2 == 0)]
    wrong = [i for i, s in held if (s >= 0.3) != (i % 3 == 0)]
    assert len(held) > 250 and len(wrong) < 0.05 * len(held)
    assert len({s for i, s in scores if i < 0}) == 1 and all(0 <= s <= 1 for _, s in scores)


def test_labels_that_may_not_be_used_change_nothing(spark, documents):
    docs, labels = labelled_corpus(n=120)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t, q, x) for i, t, q, x in labels]
    scores = []
    for known in (labels, turned):
        model = fit_toxicity(documents(docs), spark.createDataFrame(known, LABELS), usable=remainder(4) != 2)
        scores.append({r["doc_id"]: round(r["score"], 9) for r in score_toxicity(documents(docs), model).collect()})
    assert scores[0] == scores[1]


@pytest.mark.parametrize("labels", [[], [(0, 1, 1, "x"), (1, 1, 1, "x")]])
def test_without_two_classes_every_text_scores_alike(spark, documents, labels):
    docs, table = documents([(0, "a b"), (1, "c"), (2, None)]), spark.createDataFrame(labels, LABELS)
    toxic = score_toxicity(docs, fit_toxicity(docs, table, usable=F.lit(True))).collect()
    assert len({r["score"] for r in toxic}) == 1 and len(toxic) == 3
    quality = score_quality(docs, fit_quality(docs, table, usable=F.lit(True))).collect()
    assert [r["score"] for r in quality] == [0.5] * 3


def test_no_documents_no_scores(spark, documents):
    docs, table = documents([]), spark.createDataFrame([], LABELS)
    assert score_toxicity(docs, fit_toxicity(docs, table, usable=F.lit(True))).count() == 0
    assert score_quality(docs, fit_quality(docs, table, usable=F.lit(True))).count() == 0


def test_held_out_quality_on_the_driver_tables(spark):
    found = op9_quality(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").filter("held_out")
    total, right = found.selectExpr("count(*)", "count_if(predicted = quality)").first()
    assert total > 100 and right >= 0.97 * total


def test_pairs_hold_a_good_and_a_bad_document_each():
    labels = np.array([1, 0, 1, 1, 0, 1])
    good, bad = preference_pairs(labels, 100)
    assert len(set(zip(good.tolist(), bad.tolist()))) == len(good) == 8
    assert set(labels[good]) == {1} and set(labels[bad]) == {0}
    assert len(preference_pairs(labels, 3)[0]) == 3 and len(preference_pairs(np.ones(4), 10)[0]) == 0


def test_features_are_finite(awkward):
    for _, text in awkward:
        features = describe(None if text is None else text.encode())
        assert features.shape == (N_FEATURES,) and np.isfinite(features).all()


def test_logistic_regression_finds_its_own_coefficients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20_000, 2))
    y = rng.random(20_000) < sigmoid(x @ np.array([2.0, -1.0]) + 0.5)
    assert np.allclose(fit_logistic(x, y.astype(float), ridge=0), [2, -1, 0.5], atol=0.1)


def exact_counts(docs, labels):
    """Words, pairs (by class) and contexts of each word, counted plainly."""
    words, pairs, contexts = Counter(), Counter(), {}
    for i, text in docs:
        before = None
        for word in (text or "").split():
            if i in labels:
                words[word, labels[i]] += 1
                pairs[before, word, labels[i]] += 1
            contexts.setdefault(word, set()).add(before)
            before = word
    return words, pairs, {word: len(of) for word, of in contexts.items()}


def key(word):
    return int(hash_words([word.encode()]).view(np.int64)[0]) if word else toxicity._START_KEY


@pytest.fixture(scope="module")
def many_contexts():
    """"often" follows 3,000 different words; its pairs and words beyond the discount are few."""
    docs = [(k, f"a{k} often b{k % 40} c{k % 40}") for k in range(3000)] + [(None, "a0 often z often"), (-1, None)]
    return docs, {k: int(k % 5 == 0) for k in range(0, 3000, 2)}


def test_model_counts_are_exact_whatever_the_number_of_words(spark, documents, many_contexts):
    docs, labels = many_contexts
    table = spark.createDataFrame([(i, t, None, "x") for i, t in labels.items()], LABELS)
    model = fit_toxicity(documents(docs), table, usable=F.lit(True))
    words, pairs, contexts = exact_counts(docs, labels)
    over = {w for w, c in words if words[w, c] > model.discounts[c]}
    found = {r["key"]: r for r in model.words.collect() if r["key"] != toxicity._START_KEY}
    assert found.keys() == {key(w) for w in over} and len(over) > 40
    for w in over:
        assert [found[key(w)][n] for n in ("n0", "n1")] == [words[w, 0], words[w, 1]]
    over = {(b, w) for b, w, c in pairs if pairs[b, w, c] > model.discounts[c]}
    found = {(r["before"], r["word"]): (r["n0"], r["n1"]) for r in model.pairs.collect()}
    assert found == {(key(b), key(w)): (pairs[b, w, 0], pairs[b, w, 1]) for b, w in over} and len(over) > 20


def test_shards_of_the_model_score_like_the_whole(spark, documents, monkeypatch):
    docs, labels = labelled_corpus(n=200)
    docs, table = documents([*docs, (3, docs[3][1]), (None, "vile nasty"), (None, "vile nasty"), (-1, None)]), spark.createDataFrame(labels, LABELS)
    whole = fit_toxicity(docs, table, usable=remainder(4) != 2)
    monkeypatch.setattr(toxicity, "SHARD_WORDS", whole.words.count() // 2)
    parts = fit_toxicity(docs, table, usable=remainder(4) != 2)
    assert whole.split == 1 and parts.split > 1
    one, many = (sorted((str(r["doc_id"]), r["score"]) for r in score_toxicity(docs, m).collect()) for m in (whole, parts))
    assert [i for i, _ in one] == [i for i, _ in many] and np.allclose([s for _, s in one], [s for _, s in many], atol=1e-6)


@pytest.mark.parametrize("parted", [1 << 18, 50])
def test_contexts_of_a_word_are_counted_without_a_limit(spark, documents, many_contexts, monkeypatch, parted):
    monkeypatch.setattr(toxicity, "PARTED", parted)
    docs, labels = many_contexts
    table = spark.createDataFrame([(i, t, None, "x") for i, t in labels.items()], LABELS)
    model = fit_toxicity(documents(docs), table, usable=F.lit(True))
    contexts = exact_counts(docs, labels)[2]
    found = {r["key"]: r["contexts"] for r in model.words.collect()}
    assert found[key("often")] == contexts["often"] == 3001 and found[key("b2")] == 1
    assert model.contexts == sum(contexts.values())


@pytest.mark.parametrize("buckets", [2, 1024])
def test_blocks_of_hashes_come_back(buckets):
    rng = np.random.default_rng(3)
    keys = np.unique(np.append(rng.integers(0, 2**64, 5000, np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)))
    held, found = [[keys], [keys[:0]]], []
    for batch in toxicity._blocks(held, buckets):
        for bucket, kind, *block in zip(*(c.to_pylist() for c in batch.columns)):
            part = toxicity._unpacked(*block)
            assert kind == 0 and set((part >> np.uint64(65 - buckets.bit_length())).tolist()) == {bucket}
            found.append(part)
    assert np.concatenate(found).tolist() == keys.tolist()


def test_bitmap_has_all_keys_and_few_others():
    rng = np.random.default_rng(4)
    keys, others = rng.integers(0, 2**64, (2, 5000), np.uint64)
    bits = toxicity._bits([keys[:10], keys[10:]])
    assert toxicity._marked(bits, keys).all() and toxicity._marked(bits, others).mean() < 0.01


@pytest.mark.parametrize("parted", [1 << 22, 400])
def test_counts_of_pairs_travel_in_few_bytes(monkeypatch, parted):
    monkeypatch.setattr(toxicity, "PARTED", parted)
    rng = random.Random(5)
    some = [f"word{k}" for k in range(300)]
    texts = [" ".join(rng.choice(some) for _ in range(200)) for _ in range(400)]
    labels = [rng.choice((0, 0, 1)) for _ in texts]
    kept = np.unique(np.append(hash_words([w.encode() for w in some[:200]]), toxicity._START))
    shared = SimpleNamespace(value=(kept, toxicity._bits([kept])))
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts]), pa.array(labels, pa.int32())], names=["text", "label"])
    blocks = pa.Table.from_batches(toxicity._count_pairs(shared, 64)(iter([batch])))
    entries = sum(len(steps) // width + 1 for steps, width in zip(blocks["steps"].to_pylist(), blocks["width"].to_pylist()))
    assert entries > 20_000 and sum(len(x) for c in ("steps", "counts") for x in blocks[c].to_pylist()) <= 4 * entries
    words, pairs, _ = exact_counts(list(enumerate(texts)), dict(enumerate(labels)))
    dealt = blocks.sort_by("bucket").to_batches(max_chunksize=7)
    found = pa.Table.from_batches(toxicity._sum_pairs(shared, (1.0, 1.0))(iter(dealt)))
    found = {(b, w): (n0, n1) for b, w, n0, n1 in zip(*(c.to_pylist() for c in found.columns))}
    known = {None, *some[:200]}
    over = {(b, w) for b, w, c in pairs if {b, w} <= known and pairs[b, w, c] > 1}
    assert found == {(key(b), key(w)): (pairs[b, w, 0], pairs[b, w, 1]) for b, w in over} and len(over) > 2000


@pytest.mark.parametrize("bits", [2, 10, 34, 62])
def test_scrambled_keys_are_restored(bits):
    keys = np.unique(np.random.default_rng(6).integers(0, 1 << bits, 3000, np.uint64))
    spread = toxicity._scrambled(keys, bits)
    assert len(np.unique(spread)) == len(keys) and int(spread.max()) < 1 << bits
    assert toxicity._restored(spread, bits).tolist() == keys.tolist()
