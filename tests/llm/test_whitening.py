import math

import numpy as np
import pytest

from lakemill.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, components=8):
    """Everything by whole matrices and plain integers."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array(x, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviation, values, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(found, ids, rows, components=8):
    n, deviation, values, whitened, explained = exact(rows, components)
    assert len(found) == len(rows) * min(components, len(rows[0]))
    at = {i: k for k, i in enumerate(ids)}
    sign = {}
    for r in found:
        j, k = r.component - 1, at[r.vec_id]
        assert r.n == n and int(r.deviation) == deviation[k]
        assert abs(r.explained / explained[j] - 1) < 1e-10 and r.identity_error < 1e-9
        s = sign.setdefault(j, math.copysign(1, r.whitened * whitened[k, j]) if abs(whitened[k, j]) > 1e-3 else None) or 1
        assert abs(s * r.whitened - whitened[k, j]) < 1e-7 or sign[j] is None


@pytest.mark.parametrize("d, wanted, values", [
    (64, 8, None), (64, 8, [9, 9 - 1e-6, 8, 8 - 1e-9, 7, 6, 5, 4, 4 - 1e-7]), (200, 8, None), (5, 8, None), (1, 3, None),
    (40, 6, [3] * 10), (50, 4, [1e8, 1, 1e-3, 1e-4]), (30, 8, [5, 4])])
def test_leading_components(d, wanted, values):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    if values is None:
        e = np.sort(rng.random(d) * 10)[::-1]
    else:
        e = np.zeros(d) if len(values) == 2 else np.linspace(min(values) * 0.9, 0, d)
        e[:len(values)] = values
    v = (q * e) @ q.T
    passes = []

    def product(block):
        passes.append(block.shape[1])
        return v @ block

    got, vectors = whitening.leading(product, d, wanted)
    assert np.allclose(got, e[:wanted], rtol=1e-12, atol=1e-13 * e[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-13)
    assert np.abs(v @ vectors - vectors * got).max() <= 16 * 2.3e-16 * math.sqrt(d) * e[0]
    assert len(passes) < 130


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    a = (q * np.r_[np.linspace(-3, -1, 10), np.linspace(1, 4, 20)]) @ q.T
    b = rng.standard_normal((30, 4))
    b[:, 2] = 0
    assert np.allclose(whitening.minres(lambda y: a @ y, b, 1e-13, 60), np.linalg.solve(a, b), atol=1e-9)


def test_query_equals_whole_matrices(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    found = queries.registry()["op13_embedding_whitening"](spark, small).collect()
    check(found, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [[float(v) for v in r] for r in rng.standard_normal((40, 3)).astype(np.float32)]
    good[5] = good[4]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(good)] + [(100 + i, v, None) for i, v in enumerate(bad)]
    embeddings = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "whitened")
    check(whitening.whitened(spark, embeddings).collect(), range(40), good)
    for none in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]):
        assert whitening.whitened(spark, spark.createDataFrame(none, SCHEMA)).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 0.0, 1.0], 1) for i in range(6)], SCHEMA)
    assert {r.component for r in whitening.whitened(spark, flat).collect()} == {1}
    with pytest.raises(ValueError):
        whitening.whitened(spark, spark.createDataFrame([(1, [1.0], 1), (2, [1.0, 2.0], 1)], SCHEMA))
    same_id = spark.createDataFrame([(None, v, 1) for v in good], SCHEMA)
    assert whitening.whitened(spark, same_id).count() == 120


def test_deviations_past_64_bits():
    x = np.array([[100_000, 3], [99_000, 4]])
    n, sums = 10**12, np.array([10**17, 3 * 10**12])
    assert [int(v) for v in whitening._deviations(x, n, sums).to_pylist()] == [0, (99_000 * n - 10**17) ** 2 + n * n]
