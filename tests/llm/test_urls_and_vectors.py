"""URL filter and nearest neighbours on small tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrid.llm import neighbours
from casegrid.llm.neighbours import nearest_neighbours
from casegrid.llm.queries import RULES
from casegrid.llm.url_filter import judge_urls

PAGES = "page_id long, url string, host string, path string, verdict int, n long"


def judged(spark, urls, rules=RULES):
    rows = [(k, url, "h", "p", 1, 1) for k, url in enumerate(urls)]
    found = judge_urls(spark.createDataFrame(rows, PAGES), rules)
    return [tuple(r)[1:5] for r in sorted(found.collect())]


def test_rules_hosts_and_paths(spark):
    urls = [
        "https://A.Example.ORG/en/2?x=/es/", "http://example.org/es/1#f", "http://notexample.org/es/", "x://example.org/en/17",
        "http://fr.com/fr/1", "http://fr.com/de/1", "http://example.org", None, "example.org/es/1", "", "http://b.org?q",
    ]
    assert judged(spark, urls) == [
        ("a.example.org", "/en/2", "org/", "allow"),
        ("example.org", "/es/1", "example.org/es/", "block"),
        ("notexample.org", "/es/", "org/", "allow"),
        ("example.org", "/en/17", "example.org/en/1", "block"),
        ("fr.com", "/fr/1", "com/fr/", "allow"),
        ("fr.com", "/de/1", "com/de/", "block"),
        ("example.org", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b.org", "", None, "allow"),
    ]


def test_pages_of_a_blocked_template_are_blocked(spark):
    """The rule names single articles of a section that is otherwise unlabelled; sections alike are merged."""
    urls = [f"http://h.net/ads/{k}" for k in range(60)] + [f"http://h.net/news/{k}" for k in range(60)]
    urls += [f"http://h.net/spam/x{k}.php" for k in range(60)]
    rules = [*[(f"h.net/spam/x{k}.php", "block") for k in range(0, 60, 2)], ("h.net/news/", "allow")]
    verdicts = {u: v for u, (_, _, _, v) in zip(urls, judged(spark, urls, rules))}
    assert all(verdicts[f"http://h.net/spam/x{k}.php"] == "block" for k in range(60))
    assert all(verdicts[f"http://h.net/{s}/{k}"] == "allow" for s in ("ads", "news") for k in range(60))


def test_templates_generalise_variable_segments(spark):
    urls = [f"http://h.net/blog/{k}/name{k}.html" for k in range(50)] + ["http://h.net/about"] * 50
    rows = [(k, url, "h", "p", 1, 1) for k, url in enumerate(urls)]
    found = judge_urls(spark.createDataFrame(rows, PAGES), []).select("template").distinct().collect()
    assert {r["template"] for r in found} == {"h.net/blog/#/name#.html", "h.net/about"}


def test_no_python_and_no_pages(spark):
    found = judge_urls(spark.createDataFrame([], PAGES), RULES)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))


# --- vectors

VECTORS = "vec_id long, embedding array<float>, node long, vec string, q long"


def brute(rows, k):
    usable = {}
    for i, vector in rows:
        if i is None or vector is None or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        vector = np.array(vector, np.float32).astype(float)
        if i not in usable or tuple(vector) < tuple(usable[i]):
            usable[i] = vector
    out = {}
    for q in (i for i in usable if i % 20 == 0):
        near = sorted(((-float(usable[q] @ v), i) for i, v in usable.items() if i != q))[:k]
        out[q] = [(i, -s) for s, i in near]
    return out


def found_near(spark, rows, k=20):
    table = spark.createDataFrame([(i, v, 1, "x", 1) for i, v in rows], VECTORS)
    out = {}
    for r in sorted(nearest_neighbours(table, F.col("node") % 20 == 0, k).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def close(found, expected):
    assert found.keys() == expected.keys()
    for q in expected:
        assert [i for i, _ in found[q]] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in expected[q]], atol=1e-12)


def test_few_vectors_with_bad_ones_and_ties(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0])]
    rows += [(7, [float("inf"), 1.0]), (20, [-1.0, 2.0]), (8, [30.0, -4.0]), (1, [1.0, 0.0]), (None, [1.0, 1.0]), (-20, [0.5, 0.5])]
    close(found_near(spark, rows), brute(rows, 20))
    assert found_near(spark, []) == {}
    assert found_near(spark, [(0, [1.0])]) == {}


@pytest.mark.parametrize("unequal", [False, True])
def test_recall_against_brute_force(spark, unequal):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    vectors = centres[rng.integers(0, 12, 2500)] + rng.normal(size=(2500, 24))
    vectors[:800] = vectors[0] + 0.01 * rng.normal(size=(800, 24))  # a third lies in one place
    if not unequal:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(zip(range(2500), vectors.astype(np.float32).astype(float).tolist()))
    random.Random(1).shuffle(rows)
    found, expected = found_near(spark, rows), brute(rows, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in near}) for q, near in expected.items())
    assert all(len(near) == 20 for near in found.values())
    assert hits >= 0.9 * 20 * len(expected)


def test_queries_of_closed_groups_need_no_sampled_row(spark, monkeypatch):
    """Each group fills its own lists, so no link leads into it."""
    monkeypatch.setattr(neighbours, "SAMPLE", 4)
    rng = np.random.default_rng(3)
    sizes = [33, 40, 60, 120, 200] * 3
    vectors = np.repeat(rng.normal(size=(len(sizes), 24)), sizes, axis=0)
    vectors += 0.01 * rng.normal(size=vectors.shape)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors.astype(np.float32).astype(float).tolist()))
    found, expected = found_near(spark, rows), brute(rows, 20)
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in near}) for q, near in expected.items())
    assert hits >= 0.95 * 20 * len(expected)


@pytest.mark.parametrize("lengths", ["one", "six orders"])
def test_recall_with_very_unequal_lengths(spark, lengths):
    """One vector 20,000 times as long as the others, or lengths over six orders of magnitude."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(40, 24))[rng.integers(0, 40, 2400)] + 0.5 * rng.normal(size=(2400, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if lengths == "one":
        vectors[7] *= 20_000
    else:
        vectors *= 10 ** rng.uniform(-3, 3, (2400, 1))
    rows = list(zip(range(2400), vectors.astype(np.float32).astype(float).tolist()))
    found, expected = found_near(spark, rows), brute(rows, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in near}) for q, near in expected.items())
    assert hits >= 0.9 * 20 * len(expected)


def test_vectors_of_another_length_take_no_part(spark):
    rows = [(k, [float(k), 1.0]) for k in range(30)]
    odd = [(100, [1.0]), (120, [1.0, 2.0, 3.0]), (140, []), (41, [9.0] * 5)]
    close(found_near(spark, rows + odd), brute(rows, 20))
