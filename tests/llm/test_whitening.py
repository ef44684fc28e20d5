"""Whitening against eigenvectors of a dense solver, and the factor and rotation by themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import queries, whitening
from claimlake.llm.whitening import WhiteningParams

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, components=4, scale=256.0):
    """The contract by dense linear algebra: {(row number, component): (n, deviation, whitened, explained)}."""
    xs = {}
    for at, (_, vector) in enumerate(rows):
        if vector and all(c is not None and math.isfinite(c) for c in vector):
            xs[at] = tuple(math.floor(scale * float(np.float32(c))) for c in vector)
    fit = sorted(set(xs.values()))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = np.asarray([[x - s / n for x, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = {}
    for at, x in xs.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k, i in enumerate(order, 1):
            white = sum((a - s / n) * c for a, s, c in zip(x, sums, vectors[:, i])) / math.sqrt(values[i])
            out[at, k] = (n, deviation, white, values[i] / values.sum())
    return out


def check(spark, rows, components=4):
    frame = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(rows)], SCHEMA)
    got = whitening.whiten(frame, WhiteningParams(components=components)).collect()
    want = plain(rows, components)
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, deviation, white, explained = want[r.vec_id, r.component]
        sign = signs.setdefault(r.component, math.copysign(1, r.whitened * white))
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened == pytest.approx(sign * white, abs=1e-9)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9
    return got


def test_against_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.2]) @ rng.normal(size=(6, 6)) + 40
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(spread)]
    rows += rows[:50] * 3  # repeated vectors are fitted once
    rows += [(900, None), (901, []), (902, [None] * 6), (903, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (904, [float("inf")] * 6)]
    check(spark, rows)


def test_far_from_the_origin(spark):
    """Offsets of 2**40 leave as much precision as none: x is exact and centred before it is multiplied."""
    base = 2.0**32
    rows = [(i, [base + 512.0 * (i % 7), -base + 512.0 * (i % 5), 512.0 * (i % 3)]) for i in range(105)]
    check(spark, rows, components=3)


def test_given_table(spark, sf_dir):
    table = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, signs = plain(table), {}
    got = queries.op12_embedding_whitening(spark, sf_dir).collect()
    at = {key: i for i, (key, _) in enumerate(table)}
    assert len(got) == len(want)
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, deviation, white, explained = want[at[r.vec_id], r.component]
        sign = signs.setdefault(r.component, math.copysign(1, r.whitened * white))
        assert (r.n, r.deviation) == (n, deviation) and r.whitened == pytest.approx(sign * white, abs=1e-8)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_low_rank_gives_the_components_there_are(spark):
    rows = [(i, [float(i % 9), 2.0 * (i % 9), 0.0, 1.0]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and len(got) == 40
    assert all(r.explained == pytest.approx(1.0) for r in got)


def test_lengths_null_ids_and_clashing_names(spark):
    rows = [(None if i == 3 else i, [float(i), float(i * i % 11)]) for i in range(20)] + [(50, [1.0]), (51, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    clash = frame.select("*", *[F.lit("c").alias(c) for c in ("x", "n", "id", "dimension", "component", "deviation")])
    got = whitening.whiten(clash).collect()
    assert len(got) == 40 and sorted({r.vec_id for r in got}, key=str) == sorted([None, *range(3), *range(4, 20)], key=str)


def test_huge_entries(spark):
    rows = [(i, [3e38 if i % 2 else -3e38, float(i)]) for i in range(8)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    # beside such entries the variance of the others is beneath rounding
    assert len(got) == 8 and all(r.component == 1 and r.deviation is None for r in got)


def test_factor_and_rotation():
    rng = np.random.default_rng(5)
    for rank, size in ((1, 1), (3, 7), (12, 12), (31, 33)):
        half = rng.normal(size=(size, rank)) * np.geomspace(1, 1e-4, rank)
        matrix = half @ half.T
        factor = whitening.pivoted_cholesky(matrix, 1e-13)
        assert factor.shape == (size, rank) and np.allclose(factor @ factor.T, matrix, atol=1e-12)
        values, vectors = whitening.one_sided_jacobi(factor, 60)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-8)
        assert np.allclose(vectors @ vectors.T, np.eye(rank), atol=1e-12)
        assert np.allclose((vectors.T * values) @ vectors, matrix, atol=1e-12)
