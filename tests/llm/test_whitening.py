"""Whitening against numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from cdcflow.llm import whitening

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, row INT, x STRING, c INT, away INT, w INT, task INT"


def frame(spark, vectors, ids=None):
    rows = [(i, v, 1, "x", 1, 1, 1, 1) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def expected(vectors, most):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    away = n * x - total
    centred = away / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return (away**2).sum(1), centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def data(n, size, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) * np.arange(1, size + 1) @ rng.normal(size=(size, size)) / 20).astype(np.float32)


@pytest.mark.parametrize("n, size, block", [(300, 12, 2048), (300, 12, 7), (50, 3, 16)])
def test_against_numpy(spark, monkeypatch, n, size, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    vectors = data(n, size)
    rows = whitening.whitened(frame(spark, vectors.tolist())).collect()
    deviation, white, explained = expected(vectors, 8)
    k = min(8, size)
    assert len(rows) == n * k
    own = np.zeros((n, k))
    for r in rows:
        own[r.vec_id, r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        assert r.identity_error < 1e-9
    signs = np.sign((own * white).sum(0))
    assert np.allclose(own, white * signs, atol=1e-8)


def test_unusable_and_repeated_rows(spark):
    good = data(20, 4, 1).tolist()
    bad = [None, [1.0, None, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0]]
    ids = [*range(19), None, 90, 91, 92, 93, 3]
    rows = whitening.whitened(frame(spark, [*good, *bad, good[3]], ids)).collect()
    assert {r.vec_id for r in rows} == {*range(19), None} and {r.n for r in rows} == {21}
    assert sorted(r.component for r in rows if r.vec_id == 3) == [1, 1, 2, 2, 3, 3, 4, 4]
    deviation, _, _ = expected([*good, good[3]], 4)
    assert {r.deviation for r in rows if r.vec_id == 3} == {deviation[3]}


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, vectors):
    out = whitening.whitened(frame(spark, vectors))
    assert out.collect() == []
    assert [f.simpleString() for f in out.schema] == [f"{c.split()[0]}:{c.split()[1].lower()}" for c in whitening.RESULT.split(", ")]


def test_no_variance_along_a_component(spark):
    rows = whitening.whitened(frame(spark, [[float(i), 2.0 * i, 5.0] for i in range(10)])).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 10


def test_unequal_lengths(spark):
    with pytest.raises(ValueError, match="length"):
        whitening.whitened(frame(spark, [[1.0], [1.0, 2.0]]))


def test_query_on_given_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = whitening.op11_embedding_whitening(spark, sf_dir).collect()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    deviation, white, explained = expected([r.embedding for r in given], 8)
    at = {r.vec_id: i for i, r in enumerate(given)}
    own = np.zeros_like(white)
    for r in rows:
        own[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]] and math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
    assert len(rows) == own.size and np.allclose(own, white * np.sign((own * white).sum(0)), atol=1e-6)
    assert rows[0].identity_error < 1e-9
