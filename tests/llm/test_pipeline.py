"""The pipeline's stages against plain versions, on documents with planted cases."""

import random

import pytest
from test_texts import brute_components, brute_contamination, brute_kept, near_copies

import corpus_pipeline

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables like the driver's: toxic documents, near copies, shared passages and leaked items among others."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(900)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, items = text(60), [text(14), text(30), text(3)]
    docs, toxic = [], []
    for i in range(240):
        own = text(rng.randrange(30, 120)).split()
        if i % 6 == 0:
            toxic.append(i)
            for _ in range(4):
                own[rng.randrange(len(own))] = rng.choice(["vile", "nasty", "rotten"])
        elif i % 10 == 1:
            own += passage.split()
        elif i % 20 == 3:
            own = own[:20] + items[i % 3].split() + own[20:]
        docs.append((i, " ".join(own)))
    docs += [(300 + k, near_copies(rng, docs[2][1].split(), k % 3, words)) for k in range(6)]
    docs += [(400, docs[4][1]), (401, docs[4][1]), (402, ""), (403, None), (None, text(50)), (404, passage)]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]
    labels = [(i, 1, int(i in toxic)) for i in range(240)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    benchmark = list(enumerate(items))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, set(toxic), benchmark


def stage(name, spark, rows, folder):
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    if name != "packing":
        assert found.dtypes == docs.dtypes
    return sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)


def test_toxic_documents_go(spark, folder):
    path, docs, toxic, _ = folder
    left = {i for i, _ in stage("toxicity", spark, docs, path)}
    gone = {i for i, _ in docs} - left
    assert len(gone & toxic) >= 0.9 * len(toxic) and len(gone - toxic) <= 0.02 * len(docs)


def test_one_of_each_group_stays(spark, folder):
    path, docs, _, _ = folder
    groups = {i: c for i, _, c in brute_components(docs, 5, 80)}
    expected = sorted(((i, t) for i, t in docs if groups[i] in (i, None)), key=str)
    assert stage("near_copies", spark, docs, path) == expected
    assert len(docs) - len(expected) >= 4


def test_repeated_passages_go(spark, folder):
    path, docs, _, _ = folder
    brute = {i: (removed, kept) for i, _, removed, kept in brute_kept(docs, 50)}
    expected = [(i, brute[i][1] if brute[i][0] else t) for i, t in docs if not (brute[i][0] and not brute[i][1])]
    assert stage("repeated_passages", spark, docs, path) == sorted(expected, key=str)
    assert sum(removed > 0 for removed, _ in brute.values()) > 10


def test_leaked_items_go(spark, folder):
    path, docs, _, items = folder
    hit = {i for i, _, n, _ in brute_contamination(docs, items, 10) if n}
    assert stage("decontamination", spark, docs, path) == sorted(((i, t) for i, t in docs if i not in hit), key=str)
    assert len(hit) > 5


def test_the_whole_run_packs_what_is_left(spark, folder):
    path, docs, toxic, _ = folder
    found = corpus_pipeline.run(spark, path).collect()
    ids = {r["doc_id"] for r in found}
    assert ids < {i for i, _ in docs} and not {300, 303, 400, 401} & ids
    assert len(ids & toxic) <= 0.1 * len(toxic) and all(r["offset"] + r["length"] <= 4096 for r in found)


def test_every_stage_takes_an_empty_table(spark, folder):
    path, *_ = folder
    for name, _ in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], DOCUMENTS)
        assert dict(corpus_pipeline.STAGES)[name](spark, docs, path).count() == 0


def test_rows_are_judged_by_their_text_too(spark, folder):
    """Toxic and contaminated rows with a NULL id go; a clean row stays that shares its id with one that goes."""
    path, docs, toxic, items = folder
    bad = "vile nasty rotten vile nasty " + docs[0][1]
    clean, leaked = docs[2][1], f"x {items[1][1]} y"
    left = stage("toxicity", spark, [*docs, (None, bad), (0, clean), (900, bad)], path)
    assert (None, bad) not in left and (900, bad) not in left and (0, clean) in left
    left = stage("decontamination", spark, [(None, leaked), (7, leaked), (7, clean), (None, clean), (None, None)], path)
    assert left == sorted([(7, clean), (None, clean), (None, None)], key=str)


def test_near_copies_are_told_by_id_and_text(spark, folder):
    """A clean row stays that shares its id with a copy; copies with a NULL id go, and rows that repeat one."""
    path, docs, _, _ = folder
    t, u, v = docs[2][1], docs[3][1], docs[5][1]
    rows = [(1, t), (2, t), (2, u), (None, t), (None, v), (None, v), (1, t), (9, None), (9, None), (8, ""), (None, None)]
    left = [(1, t), (2, u), (None, v), (9, None), (9, None), (8, ""), (None, None)]
    assert stage("near_copies", spark, rows, path) == sorted(left, key=str)


@pytest.mark.parametrize("name", ["toxicity", "near_copies", "repeated_passages", "decontamination"])
def test_extra_columns_of_any_name_stay(spark, folder, name):
    path, docs, _, _ = folder
    plain = stage(name, spark, docs, path)
    extra = ["_text", "_gone", "_row", "_id", "_key", "key", "a.b", "row", "group", "stays"]
    schema = DOCUMENTS + "".join(f", `{c}` long" for c in extra)
    rows = [(i, t, "en", "s", None if t is None else len(t), *range(len(extra))) for i, t in docs]
    found = dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame(rows, schema), path)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra]
    out = found.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == plain
    assert all(tuple(r)[5:] == tuple(range(len(extra))) for r in out)
