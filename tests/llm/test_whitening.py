"""Whitening against numpy."""

import numpy as np
import pytest

from tillstream.llm import queries, rows, whitening

SF = "/root/testdata/sf0.01"


def by_hand(vectors, components, weights):
    """(n, deviations, |whitened|, explained) of the rows of one length."""
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    w = counts if weights == "counts" else np.ones(len(distinct), int)
    n, s = int(w.sum()), (distinct * w[:, None]).sum(axis=0)
    centred = distinct - s / n
    covariance = (centred * w[:, None]).T @ centred / n
    values, own = np.linalg.eigh(covariance)
    values, own = values[::-1][:components], own[:, ::-1][:, :components]
    return n, ((n * x - s) ** 2).sum(axis=1), np.abs((x - s / n) @ own) / np.sqrt(values), values / np.trace(covariance)


def check(found, ids, vectors, components=4, weights="one"):
    n, deviations, white, explained = by_hand(vectors, components, weights)
    got = {(r["id"], r["component"]): r for r in found}
    assert len(got) == len(found) == len(ids) * components
    for k, i in enumerate(ids):
        for c in range(components):
            r = got[i, c + 1]
            assert (r["n"], int(r["deviation"])) == (n, int(deviations[k]))
            assert abs(r["whitened"]) == pytest.approx(white[k, c], abs=1e-8)
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
            assert r["identity_error"] < 1e-9


def one_sign(found, other):
    """The two results agree up to one sign for each component."""
    ratio = {}
    for a, b in zip(found, other):
        if abs(b["whitened"]) > 1e-6:
            ratio.setdefault(a["component"], set()).add(a["whitened"] * b["whitened"] > 0)
    return all(len(s) == 1 for s in ratio.values())


@pytest.mark.parametrize("weights", ["one", "counts"])
@pytest.mark.parametrize("hot", [10_000, 3])
def test_like_numpy(spark, monkeypatch, weights, hot):
    """A third of the rows are equal; with few hot keys the others are joined by shuffle."""
    monkeypatch.setattr(rows, "HOT_KEYS", hot)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(150, 6)) @ rng.normal(size=(6, 6)) / 5).round(3).tolist()
    vectors += [vectors[0]] * 70 + [[v + 1e-7 for v in vectors[3]]] * 5
    table = spark.createDataFrame([(i, v, "x", 1.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, id string, x double")
    found = whitening.whiten(table, weights=weights).orderBy("id", "component").collect()
    check(found, range(len(vectors)), vectors, weights=weights)
    assert {(r["component"], r["whitened"]) for r in found if r["id"] in (0, 160)} == {(r["component"], r["whitened"]) for r in found if r["id"] == 0}


def test_odd_vectors(spark):
    data = [
        (1, None), (2, [1.0, None, 2.0]), (3, [1.0, float("nan"), 0.0]), (4, [float("inf"), 0.0, 0.0]), (5, []),
        (6, [0.0, 0.0, 0.0]), (None, [1.0, 2.0, 0.0]), (8, [-1.0, 0.5, 0.25]), (8, [0.3, -0.7, 4.0]), (9, [0.5, 0.5]),
    ]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = whitening.whiten(table).collect()
    assert sorted((r["id"], r["component"]) for r in found if r["id"] in (8, 9)) == [(8, 1), (8, 1), (8, 2), (8, 2), (8, 3), (8, 3), (9, 1), (9, 2)]
    assert {r["id"] for r in found} == {6, None, 8, 9}
    alone = [r for r in found if r["id"] == 9]
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in alone)
    three = [v for _, v in data if v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v)]
    n, deviations, white, _ = by_hand(three, 3, "one")
    assert sorted(int(r["deviation"]) for r in found if r["id"] != 9 and r["component"] == 1) == sorted(deviations.tolist())
    first = sorted(abs(r["whitened"]) for r in found if r["id"] != 9 and r["component"] == 1)
    assert first == pytest.approx(sorted(white[:, 0]))


def test_whole_numbers_are_exact(spark):
    """Entries so large that 64 bits do not hold the squares."""
    vectors = [[1e7, -3.5e7], [2.5e7, 1e3], [0.0, 9e7]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    x = [[int(256 * c) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    expected = [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    found = whitening.whiten(table).where("component = 1").orderBy("id").collect()
    assert [int(r["deviation"]) for r in found] == expected


def test_no_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_query(spark):
    found = queries.op11_embedding_whitening(spark, SF).withColumnRenamed("vec_id", "id").collect()
    given = queries.table(spark, SF, "embeddings").collect()
    check(found, [r["vec_id"] for r in given], [r["embedding"] for r in given])
