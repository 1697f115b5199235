"""Whitening against a dense eigensolver; hard negatives against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from leafmill.llm import hard_negatives, whitening
from leafmill.llm.catalog import QUERIES
from leafmill.llm.vectors import integer_vectors
from leafmill.session import through_table

SF = "/root/testdata/sf0.001"


def dense(x):
    """Eigenpairs of the covariance of integer rows, in falling order."""
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / len(y))
    return y, values[::-1], vectors[:, ::-1]


def check(rows, x, ids, components=8):
    """Rows of the operator against a dense solver."""
    n, d = x.shape
    k = min(components, d)
    y, values, vectors = dense(x.astype(float))
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == n * k and set(by) == {(i, c) for i in ids for c in range(1, k + 1)}
    sums = x.sum(axis=0)
    for i, own in zip(ids, x):
        r = by[i, 1]
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(own, sums))
    for c in range(k):
        got = np.array([by[i, c + 1].whitened for i in ids], float)
        expected = y @ vectors[:, c] / math.sqrt(values[c])
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-7
        assert abs(by[ids[0], c + 1].explained / (values[c] / values.sum()) - 1) < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_whitened_embeddings(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in r.embedding] for r in rows])
    check(QUERIES["op13_whitening"](spark, sf).collect(), x, [r.vec_id for r in rows])


@pytest.mark.parametrize("d,guard,parts", [(60, 16, 2), (5, 32, 40), (9, 1, 3)])
def test_filter_finds_the_leading_space(spark, d, guard, parts):
    rng = np.random.default_rng(d + guard)
    vectors = rng.standard_normal((700, d)) * np.linspace(3, 0.2, d) + rng.standard_normal(d)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<double>")
    rows = through_table(integer_vectors(df.repartition(parts), df["v"], 1024, 100000, vec_id=df["vec_id"]), "vectors")
    found = whitening.fit(rows, 8, guard=guard)
    _, values, exact = dense(np.floor(1024 * vectors) + 100000)
    k = min(8, d)
    assert np.allclose(found.values, values[:k], rtol=1e-12)
    assert np.abs(np.abs((found.vectors * exact[:, :k]).sum(axis=0)) - 1).max() < 1e-12
    assert found.residual <= whitening.ROUNDING
    if d < 10:
        assert whitening.fit(rows, 8, guard=guard).vectors.tobytes() == found.vectors.tobytes()


def test_odd_vectors(spark):
    schema = "vec_id long, embedding array<double>, x int, component string"
    good = [(i, [float(i % 3), float(i % 5), 1.0], 0, "a") for i in range(30)]
    odd = [(90, None, 1, None), (91, [1.0, None, 2.0], 1, "b"), (92, [1.0, float("nan"), 2.0], 1, "b"), (93, [1.0, float("inf"), 0.0], 1, ""),
           (94, [], 1, "c"), (95, [1.0, 2.0], 1, "c"), (96, [1e300, 0.0, 0.0], 1, "c")]
    df = spark.createDataFrame(good + odd + [good[0], (None, [1.0, 1.0, 1.0], 0, "d")], schema)
    got = whitening.whiten(df, df["vec_id"], df["embedding"]).collect()
    assert len(got) == 32 * 3 and {r.vec_id for r in got} == {*range(30), None}
    assert all((r.whitened is None) == (r.component == 3) for r in got)  # the third direction has no variance
    assert got[0].identity_error < 1e-9
    assert whitening.whiten(df.limit(0), df["vec_id"], df["embedding"]).count() == 0
    same = spark.createDataFrame([(i, [0.5] * 12, 0, "") for i in range(9)], schema)
    flat = whitening.whiten(same, same["vec_id"], same["embedding"]).collect()
    assert len(flat) == 72 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 for r in flat)


def test_long_vectors_and_large_deviations(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((40, 3000)) * 1e9
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<double>")
    got = whitening.whiten(df, df["vec_id"], df["v"]).collect()
    assert len(got) == 320 and all(r.deviation is None for r in got) and got[0].identity_error < 1e-4


def brute_negatives(rows, anchor):
    """(id, label, x) rows to all result rows, by all pairs."""
    seen, out = {}, []
    for i, label, x in rows:
        if anchor(i):
            seen[i] = min(seen.get(i, (label, x)), (label, x))
    for a, (label, x) in seen.items():
        scored = [(-sum(p * q for p, q in zip(x, y)), i, other == label) for i, other, y in rows if i != a]
        for s, i, _ in sorted(r for r in scored if r[2])[:5]:
            fits = sorted(r for r in scored if not r[2] and 30 * -s <= 100 * -r[0] <= 90 * -s)[:10]
            out += [(a, i, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("block,batch", [(3, 5), (8, 1 << 14)])
def test_negatives_of_clustered_vectors_with_ties(spark, block, batch):
    rng = np.random.default_rng(block)
    centres = rng.standard_normal((6, 8))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 6] + 0.05 * rng.integers(0, 3, 8)).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, label int, v array<double>").repartition(5)
    got = hard_negatives.mine(df, df["vec_id"], df["label"], df["v"], df["vec_id"] % 20 == 0, scale=16, block=block, batch=batch)
    exact = [(i, label, [math.floor(16 * c) for c in v]) for i, label, v in rows]
    assert got.columns == hard_negatives.RESULT
    assert sorted(map(tuple, got.collect())) == brute_negatives(exact, lambda i: i % 20 == 0)


def test_negatives_agree_with_the_sql(spark):
    from leafmill.llm.catalog import ORACLE
    from oracle import compare, connect

    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), "op12_hard_negatives", QUERIES["op12_hard_negatives"], ORACLE["op12_hard_negatives"], sf) == []


def test_bounds_spare_most_scores():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 32)) * 200
    x = np.floor(np.repeat(centres, 200, axis=0) + rng.standard_normal((4000, 32))).astype(np.int64)
    labels, ids = rng.integers(0, 2, 4000), np.arange(4000)
    at = np.flatnonzero(labels == 1)[::10]
    order, parent, edge = hard_negatives.spanning_tree(x[at])
    none = [np.zeros(0, np.int64)] * len(at)
    tree = hard_negatives.Block(ids[at][order], labels[at][order], x[at][order], parent, edge, none, none)
    wanted = [hard_negatives.Wanted(tree, k, 5, 10, 30, 90, False) for k in range(len(at))]
    for k, own in enumerate(wanted):
        own.learn(hard_negatives.products(tree.x, tree.x)[k], tree.ids, tree.labels)
    scored = hard_negatives.walk(tree, wanted, ids, labels, x)
    assert scored < 0.15 * len(at) * (labels == 1).sum()
    for k, own in enumerate(wanted):
        use = (labels == tree.labels[k]) & (ids != tree.ids[k])
        scores = hard_negatives.products(x, tree.x[k : k + 1])[:, 0]
        expected = sorted((-s, i) for s, i in zip(scores[use], ids[use]))[:5]
        assert [(-s, i) for s, i in zip(own.best[0].scores, own.best[0].ids)] == expected


def test_odd_rows_for_negatives(spark):
    schema = "vec_id long, label int, v array<double>, score int, block string"
    rows = [(0, 1, [1.0, 0.0], 0, "a"), (0, 1, [1.0, 0.5], 0, "a"), (1, 1, [1.0, 0.0], 0, ""), (1, 1, [1.0, 0.0], 0, ""), (2, 2, [0.5, 0.0], 0, None),
            (2, 2, [0.5, 0.0], 1, None), (3, None, [0.5, 0.0], 1, None), (None, 2, [0.5, 0.0], 1, None), (4, 2, None, 1, None),
            (5, 2, [None, 1.0], 1, None), (6, 2, [float("nan"), 1.0], 1, None), (7, 2, [0.5], 1, None), (8, 3, [0.3, 1.0], 1, None), (100, 9, [1.0, 1.0], 0, "")]
    df = spark.createDataFrame(rows, schema)
    anchor = lambda d: F.coalesce(d["vec_id"] % 100 == 0, F.lit(False))
    got = hard_negatives.mine(df, df["vec_id"], df["label"], df["v"], anchor(df))
    clean = [(r[0], r[1], [math.floor(256 * c) for c in r[2]]) for r in rows if r[0] in (0, 1, 2, 8, 100)]
    assert sorted(map(tuple, got.collect())) == brute_negatives(clean, lambda i: i % 100 == 0)
    none = df.limit(0)
    assert hard_negatives.mine(none, none["vec_id"], none["label"], none["v"], anchor(none)).count() == 0


def test_scores_beyond_doubles_are_exact():
    x = np.array([[(1 << 30) + 1, 3], [5, 1 << 29]])
    assert hard_negatives.products(x, x).tolist() == [[sum(a * b for a, b in zip(p, q)) for q in x.tolist()] for p in x.tolist()]
    big = np.array([[1 << 40, 1]])
    with pytest.raises(OverflowError):
        hard_negatives.products(big, big)
