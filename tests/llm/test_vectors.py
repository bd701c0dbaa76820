"""Vector codes and whitening against plain versions on small tables."""

import math
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrid.llm import codebooks, groups, whitening
from casegrid.llm.codebooks import compress_vectors, decode_vectors, encode_vectors, fit_codebooks
from casegrid.llm.groups import beside_groups
from casegrid.llm.whitening import pack, unpack, whiten

VECTORS = "vec_id long, embedding array<float>, label int, id long, code string, error long, x long, n long, z string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "c", 7, 7, 7, "z") for i, v, label in rows], VECTORS)


def kept(rows):
    return [
        (i, [float(np.float32(c)) for c in v], label)
        for i, v, label in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]


def clustered(n, length, seed=0, copies=0):
    """Vectors in a few clusters; the last ``copies`` of them are one vector."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(6, length))[rng.integers(0, 6, n)] + 0.2 * rng.normal(size=(n, length))
    if copies:
        x[-copies:] = x[0]
    return [(int(i), v.tolist(), None if i % 5 == 0 else int(i) % 3) for i, v in zip(rng.permutation(n), x)]


AWKWARD = [
    (900, None, 1), (901, [float("nan")] + [0.0] * 7, 1), (902, [None] + [0.0] * 7, 1), (903, [float("-inf")] + [0.0] * 7, None),
    (3, [0.5, -0.5] * 4, 2), (3, [0.5, -0.5] * 4, 2), (None, [-0.001] * 8, None), (904, [0.0] * 8, None), (905, [9000.0] + [-9000.0] * 7, 4),
]


def plain_codes(rows, parts, entries, rounds):
    order = sorted(kept(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[math.floor(256 * c) for c in v] for _, v, _ in order]
    width = len(x[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in x]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def near(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(book) for book in books]
        for p in range(parts):
            held = {}
            for v in cut:
                held.setdefault(near(v[p], p)[1], []).append(v[p])
            for k, members in held.items():
                new[p][k] = tuple(sum(column) // len(members) for column in zip(*members))
        books = new
    coded = []
    for (i, _, label), v in zip(order, cut):
        best = [near(v[p], p) for p in range(parts)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(far for far, _ in best)))
    by_label = {}
    for _, label, _, error in coded:
        by_label[label] = by_label.get(label, 0) + error
    digest = sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(map(repr, ((i, label, code, error, by_label[label]) for i, label, code, error in coded))), digest


@pytest.mark.parametrize("block", [1 << 20, 64])
@pytest.mark.parametrize("rows", [clustered(150, 8, copies=50) + AWKWARD, AWKWARD, clustered(3, 8)], ids=["many", "awkward", "few"])
def test_codes_equal_plain_ones(spark, monkeypatch, rows, block):
    monkeypatch.setattr(codebooks, "BLOCK_COMPONENTS", block)
    table = table_of(spark, rows).repartition(5)
    coded, books = compress_vectors(table, parts=4, entries=16, rounds=2)
    found = sorted(repr((r["id"], r["label"], r["code"].hex(), r["error"], r["label_error"])) for r in coded.collect())
    assert (found, books.sha256()) == plain_codes(rows, 4, 16, 2)


def test_codes_of_empty_tables_and_other_lengths(spark):
    coded, books = compress_vectors(table_of(spark, []))
    assert coded.count() == 0 and books.sha256() == sha256(b"").hexdigest()
    assert compress_vectors(table_of(spark, [(1, None, 1), (2, [], 1), (3, [float("nan")] * 4, 1)]), parts=4)[0].count() == 0
    rows = clustered(20, 8)
    odd = [(50, [1.0] * 4, 1), (51, [], 1), (-1, [1.0] * 16, 1)]
    coded, _ = compress_vectors(table_of(spark, rows + odd), parts=4)
    assert sorted(r["id"] for r in coded.collect()) == list(range(20))
    with pytest.raises(ValueError, match="equal parts"):
        fit_codebooks(table_of(spark, rows), parts=3)
    with pytest.raises(Exception, match="beyond which sums do not fit"):
        fit_codebooks(table_of(spark, [*rows, (99, [1e30] * 8, 1)]), parts=4)


def test_decoded_vectors_have_the_error_that_is_told(spark):
    rows = clustered(200, 8)
    table = table_of(spark, rows)
    books = fit_codebooks(table, parts=4, entries=32, rounds=4)
    coded = encode_vectors(table, books)
    back = {r["id"]: np.array(r["vec"]) for r in decode_vectors(coded, books).collect()}
    errors = {r["id"]: r["error"] for r in coded.collect()}
    total = 0
    for i, v, _ in kept(rows):
        x = np.floor(256 * np.array(v))
        assert ((x - 256 * back[i]) ** 2).sum() == errors[i]
        total += ((x - x.mean()) ** 2).sum()
    assert sum(errors.values()) < 0.2 * total


# --- groups


@pytest.mark.parametrize("fits", [True, False])
def test_rows_meet_their_group(spark, monkeypatch, fits):
    monkeypatch.setattr(groups, "fits_broadcast", lambda df: fits)
    monkeypatch.setattr(groups, "SPLIT", 10)
    monkeypatch.setattr(groups, "FEW", 10)
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, None).when(F.col("id") < 700, 0).otherwise(F.col("id") % 30).alias("k"))
    counted = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    found = beside_groups(rows, counted, "k", "n")
    assert found.columns == ["id", "k", "n", "total"]
    totals = {r["k"]: (r["n"], r["total"]) for r in counted.collect()}
    out = found.collect()
    assert sorted(r["id"] for r in out) == list(range(1000))
    assert all((r["n"], r["total"]) == totals[r["k"]] for r in out)


def test_a_large_group_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(groups, "fits_broadcast", lambda df: False)
    rows = spark.range(8000).select("id", F.lit(1).alias("k"))
    counted = rows.groupBy("k").agg(F.count("*").alias("n"))
    parts = beside_groups(rows, counted, "k", "n").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in parts) < 3 * min(r["count"] for r in parts)
    assert len(parts) > 1


# --- whitening


def plain_whitening(rows, components, weights_once=False):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in kept(rows)], object)
    fit = np.array(sorted(set(map(tuple, x))), object) if weights_once else x
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((fit * n - sums) / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    z = ((x * n - sums) / n).astype(float) @ basis[:, order] / np.sqrt(values[order])
    return n, ((x * n - sums) ** 2).sum(axis=1).tolist(), z, values[order] / values.sum()


@pytest.mark.parametrize("once", [False, True])
@pytest.mark.parametrize("block", [1 << 20, 40])
def test_whitened_vectors_equal_plain_ones(spark, monkeypatch, once, block):
    monkeypatch.setattr(whitening, "BLOCK_COMPONENTS", block)
    rows = clustered(300, 8, seed=3, copies=100) + AWKWARD[:8]
    found = whiten(table_of(spark, rows).repartition(5), components=6, once=once).collect()
    n, deviations, z, explained = plain_whitening(rows, 6, once)
    assert {r["n"] for r in found} == {n} and {r["component"] for r in found} == set(range(1, 7))
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    for r in found:
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12
    ids = [i for i, _, _ in kept(rows)]
    ours = sorted((repr(r["id"]), r["deviation"], r["component"], r["whitened"]) for r in found)
    signs = {}
    for k in range(6):
        mine = sorted((i, d, w) for i, d, c, w in ours if c == k + 1)
        theirs = sorted((repr(i), d, w) for i, d, w in zip(ids, deviations, z[:, k].tolist()))
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in theirs])
        signs[k] = np.sign(a @ b)
        assert np.allclose(a, signs[k] * b, atol=1e-9)


def test_whitening_without_variance_and_of_nothing(spark):
    assert whiten(table_of(spark, [])).count() == 0
    assert whiten(table_of(spark, [(1, None, 1), (2, [], 1), (3, [float("inf")] * 4, 1)])).count() == 0
    alike = whiten(table_of(spark, [(1, [0.5] * 4, 1), (2, [0.5] * 4, 1), (None, [0.5] * 4, 1), (9, [1.0] * 5, 1)]), components=3).collect()
    assert sorted((r["id"] or 0, r["component"]) for r in alike) == [(i, c) for i in (0, 1, 2) for c in (1, 2, 3)]
    assert all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0 and r["identity_error"] == 0 for r in alike)
    line = whiten(table_of(spark, [(k, [float(k), 0.0, -float(k)], 1) for k in range(9)])).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line) and len(line) == 27
    assert abs(sum(r["whitened"] ** 2 for r in line if r["component"] == 1) / 9 - 1) < 1e-12


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(1, [1e9, 0.0], 1), (2, [-1e9, 0.0], 1), (3, [0.0, 1.0], 1), (4, [0.0, -1.0], 1)]
    found = {r["id"]: r["deviation"] for r in whiten(table_of(spark, rows)).collect()}
    assert found[1] is None and found[2] is None and found[3] == found[4] + 0 == 256 * 256


def test_packed_vectors_come_back():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-(2**b), 2**b, (20, 5)) for b in (3, 7, 8, 15, 16, 31, 32, 40)])
    keys = pack(x)
    assert {len(k) // 5 for k in keys} == {1, 2, 4, 8}
    assert (unpack(keys, 5) == x).all()
    assert len(set(keys)) == len({tuple(row) for row in x.tolist()})
