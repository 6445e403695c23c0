"""Whitening against exact arithmetic and the library's eigenvectors."""

from fractions import Fraction

import numpy as np
import pytest

from tests.llm.test_join_archive_pipeline import SF_DIR
from tidelog.llm import whitening
from tidelog.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, component string"


def by_hand(rows, k=8):
    """n, exact deviation of each row, covariance, eigenpairs and whitened values up to sign."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(((n * row - sums) ** 2).sum()) for row in x]
    z = (n * x - sums).astype(object)
    cov = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in z.T @ z])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, deviation, np.trace(cov), values, (z / n).astype(float) @ vectors / np.sqrt(values)


def spectra():
    rng = np.random.default_rng(3)
    yield rng.random(40) ** 3 * 1e5
    yield np.repeat([900.0, 900.0, 30.0, 5.0, 5.0, 5.0, 1.0, 0.0], 3)
    yield np.array([1.0, 1 - 1e-9, 1 - 3e-12, 0.5, 0.0, 0.0])
    yield np.array([7.0])


@pytest.mark.parametrize("spectrum", list(spectra()))
def test_eigenpairs_of_known_spectra(spectrum):
    n = len(spectrum)
    q = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))[0]
    v = q * spectrum @ q.T
    v = (v + v.T) / 2
    want = np.sort(spectrum)[::-1]
    values, vectors = whitening.leading_eigenpairs(v, 8)
    assert np.abs(values - want[:8]).max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * want[0]
    for s in (want[:-1] + want[1:]) / 2:
        if np.abs(want - s).min() > 1e-10 * want[0]:
            assert whitening.count_above(v, s) == (want > s).sum()


def test_inertia_needs_pivots_of_two_rows():
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0, 1)
    assert whitening.inertia(np.zeros((3, 3))) == (0, 3, 0)
    assert whitening.inertia(np.zeros((0, 0))) == (0, 0, 0)


def test_op12_over_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    n, deviation, trace, values, whitened = by_hand(rows)
    got = {(r.vec_id, r.component): r for r in QUERIES["op12_whitening"](spark, SF_DIR).collect()}
    assert len(got) == 8 * n
    for c in range(8):
        own = np.array([got[i, c + 1].whitened for i, _ in rows])
        sign = np.sign(own @ whitened[:, c])
        assert np.abs(own * sign - whitened[:, c]).max() < 1e-9
        assert abs(got[rows[0][0], c + 1].explained / (values[c] / trace) - 1) < 1e-12
    for (i, _), d in zip(rows, deviation, strict=True):
        assert got[i, 1].deviation == d and got[i, 1].n == n and 0 <= got[i, 1].identity_error < 1e-9


def test_nulls_ties_repeats_short_and_huge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, -1.0], "a"), (1, [1.0, 2.0, -1.0], "b"), (None, [0.5, -2.0, 3.0], None),
        (3, None, None), (4, [1.0, None, 2.0], None), (5, [nan, 0.0, 0.0], None), (6, [inf, 0.0, 0.0], None),
        (7, [], None), (8, [4.0], None), (9, [1e300, 0.0, 1.0], None), (10, [-1e300, 0.0, 1.0], None),
    ]
    data = spark.createDataFrame(rows, SCHEMA)
    out = whitening.whiten(data).collect()
    assert len(out) == 7 * 3 and {r.vec_id for r in out} == {1, None, 7, 8, 9, 10}
    assert all(r.identity_error < 1e-4 for r in out) and all(r.n == 7 for r in out)
    small = spark.createDataFrame([r for r in rows if r[0] not in (9, 10)], SCHEMA)
    used = [(r[0], (r[1] + [0.0] * 3)[:3]) for r in rows if r[0] in (1, None, 7, 8)]
    n, deviation, _, _, _ = by_hand(used, 3)
    assert sorted(int(r.deviation) for r in whitening.whiten(small).where("component = 1").collect()) == sorted(deviation)


def test_whole_numbers_are_exact_whatever_their_size(spark):
    rows = [(i, [float(2**40 - i), float(i * i), 2.0**-10 * i]) for i in range(300)]
    model = whitening.fit(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    n, deviation, trace, values, _ = by_hand(rows, 3)
    assert model.n == n and np.allclose(model.eigenvalues[:2], values[:2], rtol=0, atol=1e-14 * values[0]) and np.isclose(model.trace, trace, rtol=1e-15)
    got = whitening.transform(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), model).collect()
    assert [int(r.deviation) for r in got] == deviation


def test_without_variance_and_without_rows(spark):
    same = spark.createDataFrame([(i, [0.5, 0.5], "x") for i in range(4)], SCHEMA)
    rows = whitening.whiten(same).collect()
    assert len(rows) == 8 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in rows)
    assert whitening.whiten(same.limit(0)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [], "x")], SCHEMA)).collect() == []
    line = spark.createDataFrame([(i, [float(i), float(2 * i)], "x") for i in range(4)], SCHEMA)
    rows = whitening.whiten(line).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in rows)
