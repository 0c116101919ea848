"""Embedding whitening against integers of Python and a covariance by hand."""

import math
from fractions import Fraction

import numpy as np
import pytest

from brassledger.llm import queries, whitening
from brassledger.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def scatter_by_hand(x):
    rows = [[int(v) for v in r] for r in x]
    d = len(rows[0])
    return [sum(r[i] for r in rows) for i in range(d)], [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize(("rows", "low", "high"), [(1, 0, 5), (63, -9, 9), (64, 0, 1), (65, 99_000, 101_000), (200, -(2**40), 2**40), (5, 7, 8)])
def test_bit_slices_give_exact_products(rows, low, high):
    x = np.random.default_rng(rows).integers(low, high, (rows, 5))
    sums, products = whitening.scatter(x)
    assert ([int(s) for s in sums], [[int(v) for v in r] for r in products]) == scatter_by_hand(x)


def test_tiles_do_not_change_counts(monkeypatch):
    x = np.random.default_rng(0).integers(0, 4000, (300, 9))
    whole = whitening.scatter(x)[1]
    monkeypatch.setattr(whitening, "TILE_BYTES", 1)
    assert (whitening.scatter(x)[1] == whole).all()


def check(rows, given):
    """Rows of the operator against a second computation over `given` ((vec_id, vector) pairs of one length)."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in given]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    far = sorted((i, sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True))) for (i, _), r in zip(given, x, strict=True))
    assert sorted((r["vec_id"], r["deviation"]) for r in rows if r["component"] == 1) == far
    centred = [[float(Fraction(n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j], n * n)) for j in range(d)] for i in range(d)]
    values, vectors = np.linalg.eigh(np.array(centred))
    k = max(r["component"] for r in rows)
    mean = np.array([s / n for s in sums])
    by_hand = (np.array(x) - mean) @ vectors[:, ::-1][:, :k] / np.sqrt(values[::-1][:k])
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * k
    for c in range(1, k + 1):
        mine = np.array([got[i, c]["whitened"] for i, _ in given])
        assert np.allclose(np.abs(mine @ by_hand[:, c - 1]) / n, 1, atol=1e-6)
        assert np.allclose(mine, by_hand[:, c - 1], atol=1e-6) or np.allclose(mine, -by_hand[:, c - 1], atol=1e-6)
        assert got[given[0][0], c]["explained"] == pytest.approx(values[::-1][c - 1] / np.trace(np.array(centred)), rel=1e-9)
    assert {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-4


def test_query_by_hand(spark, small_dir):
    rows = queries.queries()["op13_whitening"](spark, small_dir).collect()
    given = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    assert max(r["component"] for r in rows) == 8
    check(rows, given)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.normal(0, 1, 10)]) for i in range(80)]
    bad = [(100, None), (101, [1.0] * 9 + [None]), (102, [float("nan")] * 10), (103, [float("inf")] * 10), (104, [])]
    rows = [(i, v, "x", 1) for i, v in good + bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, n int").repartition(3)
    got = whitening.whiten(df).collect()
    f32 = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    check(got, f32)


def test_other_lengths_ties_and_flat_tables(spark):
    two = [(i, [float(i % 3), float(i % 2)]) for i in range(12)]
    three = [(None, [float(i), 0.0, 0.0]) for i in range(4)]
    df = spark.createDataFrame(two + three, "vec_id long, embedding array<float>")
    got = whitening.whiten(df).collect()
    check([r for r in got if r["n"] == 12], two)
    flat = [r for r in got if r["n"] == 4]
    assert len(flat) == 4 and {r["component"] for r in flat} == {1} and {r["vec_id"] for r in flat} == {None}
    same = spark.createDataFrame([(1, [2.0, 2.0])] * 5, "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(same.limit(0)).collect() == []
