import math
import random
from fractions import Fraction

import numpy as np
import pytest

from platewise.llm import op12_whitening as op
from tests.llm.conftest import FOLDER

SCHEMA = "vec_id long, embedding array<float>, n string"


def plain(rows, components=4):
    """n, deviations by vec_id and the covariance, in whole numbers and fractions."""
    usable = {}
    for vec_id, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            usable.setdefault(vec_id, []).append(tuple(math.floor(256 * c) for c in v))
    distinct = sorted({x for xs in usable.values() for x in xs})
    n, dims = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(dims)]
    deviation = {k: sorted(sum((n * x[j] - sums[j]) ** 2 for j in range(dims)) for x in xs) for k, xs in usable.items()}
    cov = [
        [float(Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in distinct), n**3)) for j in range(dims)] for i in range(dims)
    ]
    return n, sums, deviation, np.array(cov), distinct


def check(rows, result, components=4):
    n, sums, deviation, cov, distinct = plain(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    found = {}
    for r in result:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        found.setdefault(r["vec_id"], []).append(r)
    assert {v: sorted({r["deviation"] for r in rs}) for v, rs in found.items()} == {v: sorted(set(d)) for v, d in deviation.items()}
    assert all(len(rs) == k * len(deviation[v]) for v, rs in found.items())
    white = np.array([[r["whitened"] for r in sorted(rs, key=lambda r: r["component"])] for v, rs in sorted(found.items()) if len(rs) == k])
    x = np.array([next(x for x in distinct if sum((n * a - s) ** 2 for a, s in zip(x, sums)) == deviation[v][0]) for v, rs in sorted(found.items()) if len(rs) == k])
    # cov @ (whitened covariance with x) returns the eigenvalue times itself
    centred = x - np.array(sums) / n
    directions, *_ = np.linalg.lstsq(centred, white, rcond=None)
    for c in range(k):
        u = directions[:, c] * np.sqrt(values[c])
        if np.linalg.matrix_rank(centred) == cov.shape[0]:
            assert np.linalg.norm(u) == pytest.approx(1, abs=1e-6)
            assert cov @ u == pytest.approx(values[c] * u, abs=1e-6 * values[0])


def test_cross_products_equal_plain_ones():
    rng = np.random.default_rng(1)
    for low, high, n in ((-5, 9, 1), (-300, 500, 200), (0, 1, 64), (-(2**62), 2**62, 90)):
        x = rng.integers(low, high, (n, 5))
        x[:, 2] = 7
        least = x.min(axis=0)
        bits = [(int(a) - int(b)).bit_length() for a, b in zip(x.max(axis=0), least)]
        got = op.cross_products(x, least, bits)
        y = np.column_stack([x.astype(object) - least.astype(object), np.ones(n, object)])
        want = y.T @ y
        assert [int(got[i, j]) for i in range(6) for j in range(i, 6)] == [int(want[i, j]) for i in range(6) for j in range(i, 6)]


def test_query_equals_plain_version(spark):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    check(rows, op.whiten(frame).collect())


def test_odd_rows_and_repeated_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (j + 1) for j in range(6)]) for i in range(60)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(5, rows[7][1])]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [1.0] * 5)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], SCHEMA).repartition(5)
    got = op.whiten(frame).collect()
    assert {r["vec_id"] for r in got} == {i for i, _ in rows}
    check(rows, got)


def test_negative_zero_and_borders():
    import pyarrow as pa

    x, good = op.integers(pa.array([[-0.0, 0.999, -0.001], [1e300, -1e300, 0.0], [], None], pa.list_(pa.float64())))
    assert np.frombuffer(x[0], np.int64).tolist() == [0, 255, -1]
    assert np.frombuffer(x[1], np.int64).tolist() == [2**63 - 1, -(2**63), 0]
    assert good.tolist() == [True, True, False, False]


def test_without_variance_there_are_no_rows(spark):
    assert op.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "b")], SCHEMA)
    assert op.whiten(same).collect() == []
    assert op.whiten(same).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_dimensions_than_components(spark):
    rows = [(i, [float(i), float(i * i % 7), 3.0], "a") for i in range(20)]
    got = op.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2}
    check([r[:2] for r in rows], got)
