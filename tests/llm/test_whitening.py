from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm.queries import op12_embedding_whitening
from reviewlens.llm.whitening import eigen, fit, whiten

VECTORS = "vec_id long, vector array<long>"


def spectrum(kind, dim=48):
    return {
        "spread": np.random.default_rng(1).random(dim) * 50,
        "equal": np.r_[np.full(10, 3.0), np.full(20, 1.0), np.random.default_rng(2).random(dim - 30)],
        "near": np.r_[1 + 1e-9 * np.arange(8), np.random.default_rng(3).random(dim - 8) / 2],
        "very near": np.r_[1 + 1e-12 * np.arange(8), np.random.default_rng(3).random(dim - 8) / 2],
        "falling": 10.0 ** -np.linspace(0, 12, dim),
        "rank one": np.r_[5.0, np.zeros(dim - 1)],
        "one": np.full(dim, 2.0),
        "large": 1e30 * np.random.default_rng(4).random(dim),
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "equal", "near", "very near", "falling", "rank one", "one", "large"])
def test_refined_eigenvectors_are_exact_to_double_precision(kind):
    values = spectrum(kind)
    turn, _ = np.linalg.qr(np.random.default_rng(5).normal(size=(48, 48)))
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = eigen(matrix)
    size = np.abs(values).max()
    assert np.abs(vectors.T @ vectors - np.eye(48)).max() < 4e-15
    assert np.abs(matrix @ vectors - vectors * found).max() < 4e-15 * size
    assert np.abs(found - np.sort(np.linalg.eigvalsh(matrix))[::-1]).max() < 1e-14 * size
    assert (np.diff(found) <= 0).all()


def test_single_precision_alone_would_not_do():
    values = spectrum("near")
    turn, _ = np.linalg.qr(np.random.default_rng(5).normal(size=(48, 48)))
    matrix = (turn * values) @ turn.T
    _, rough = np.linalg.eigh(matrix.astype(np.float32))
    assert np.abs(rough.astype(float).T @ rough.astype(float) - np.eye(48)).max() > 1e-8


def plain(points, components=16):
    """Covariance, eigenvectors and exact deviations with numpy and whole numbers."""
    listed = [list(v) for v in sorted({tuple(v) for _, v in points})]
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    mean = np.array([s / n for s in sums])
    centred = np.array(listed, float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = values > len(values) * np.finfo(float).eps * values[0]
    scaled = (vectors[:, keep] / np.sqrt(values[keep]))[:, :components]
    far = {i: sum((n * x - s) ** 2 for x, s in zip(v, sums)) for i, v in points}
    return {i: (np.array(v, float) - mean) @ scaled for i, v in points}, far, values / values.sum()


def cases():
    rng = np.random.default_rng(9)
    normal = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) * 30
    few = rng.normal(size=(5, 20)) * 30
    flat = np.c_[rng.normal(size=(100, 3)) * 30, np.full(100, 7.0)]
    for matrix in (normal, few, flat):
        points = [(i, (np.floor(v).astype(int) + 1_000_000).tolist()) for i, v in enumerate(matrix)]
        yield points + [(1000 + i, v) for i, v in points[:3]] * 2


@pytest.mark.parametrize("points", list(cases()), ids=["full rank", "fewer vectors than dimensions", "constant dimension"])
def test_same_as_numpy(spark, points):
    rows, model, error = whiten(spark.createDataFrame(points, VECTORS).repartition(5))
    white, far, shares = plain(points)
    got = rows.collect()
    assert len(got) == len(points)
    for row in got:
        want = white[row["vec_id"]]
        assert row["deviation"] == far[row["vec_id"]]
        assert np.allclose(np.abs(row["whitened"]), np.abs(want), atol=1e-7)
    assert np.allclose(model.eigenvalues / model.trace, shares[: len(model.eigenvalues)], rtol=1e-9)
    assert error < 1e-9


def test_edges(spark):
    rows = [(1, [1, 2]), (2, None), (3, []), (4, [None, 2]), (5, [1, 2, 3]), (None, [3, 9]), (7, [5, 1]), (7, [5, 1])]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("whitened", "i", "j", "v", "d", "deviation")})
    got, model, error = whiten(frame)
    assert model.n == 3 and error < 1e-12
    assert sorted((r["vec_id"] or 0) for r in got.collect()) == [0, 1, 7, 7]
    got, model, error = whiten(spark.createDataFrame([], VECTORS))
    assert got.count() == 0 and model.n == 0 and error == 0.0
    got, _, _ = whiten(spark.createDataFrame([(1, [4, 4]), (2, [4, 4])], VECTORS))
    assert [tuple(r) for r in got.select("deviation", F.size("whitened")).distinct().collect()] == [(0, 0)]
    odd = spark.createDataFrame([(1, [float("nan"), 1.0]), (2, [float("inf"), 1.0]), (3, [0.5, 1.0]), (4, [1.5, 2.0])], "vec_id long, vector array<double>")
    assert sorted(r["vec_id"] for r in whiten(odd)[0].collect()) == [3, 4]


def test_huge_entries_stay_exact(spark):
    big = 2**62
    got, model, _ = whiten(spark.createDataFrame([(1, [big, 0]), (2, [-big, 1]), (3, [5, 7])], VECTORS))
    assert model.sums == [5, 8] and model.n == 3
    assert [r["deviation"] for r in got.orderBy("vec_id").collect()] == [None, None, (15 - 5) ** 2 + (21 - 8) ** 2]


def test_sums_add_up_over_partitions(spark):
    points = [(i, [i % 97, i * i % 89, i % 7]) for i in range(2000)]
    frame = spark.createDataFrame(points, VECTORS)
    one, many = (fit(frame.repartition(k).select("vector"))[0] for k in (1, 13))
    assert one.n == many.n and one.sums == many.sums
    assert np.allclose(one.eigenvalues, many.eigenvalues, rtol=1e-12)


def test_query_by_its_contract(spark, sf):
    """Against numpy over the whole table, with whole-number deviations in decimals."""
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    points = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in table]
    white, far, shares = plain(points)
    rows = op12_embedding_whitening(spark, sf).collect()
    assert len(rows) == 16 * len(points)
    fitted = {tuple(v) for _, v in points}
    for r in rows:
        k = r["component"] - 1
        assert r["n"] == len(fitted) and Decimal(r["deviation"]) == Decimal(far[r["vec_id"]])
        assert abs(abs(r["whitened"]) - abs(white[r["vec_id"]][k])) < 1e-6
        assert abs(r["explained"] - shares[k]) < 1e-10 and r["identity_error"] < 1e-10
