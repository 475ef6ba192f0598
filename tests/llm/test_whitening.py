import math

import numpy as np
import pytest
from numpy.testing import assert_allclose

from strataform.llm import charpoly, whitening

SCHEMA = "vec_id bigint, embedding array<float>, x int, i int, j int, n string, c int, place int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, None, "n", 4, 5) for i, v in rows], SCHEMA)


def plain(rows, components):
    """By numpy: n, deviations, whitened (signs open) and shares, of the good rows."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}))
    n, sums = len(fit), fit.sum(axis=0)
    e, v = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    x = np.array([x for _, x in good])
    far = ((n * x - sums) ** 2).sum(axis=1)
    return [i for i, _ in good], n, far, (x - sums / n) @ v / np.sqrt(e), e / np.trace(
        np.cov(fit.T, bias=True))


def test_matches_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) * np.linspace(1, 2, 10)).tolist()) for i in range(400)]
    rows += [(i, rows[5][1]) for i in range(400, 700)]  # one hot vector
    rows += [(None, rows[7][1]), (5, rows[5][1])]
    rows += [(800, None), (801, [1.0, None, *[0.0] * 8]), (802, [math.nan] * 10),
             (803, [math.inf] * 10), (804, [])]
    found = whitening.whiten(frame(spark, rows).repartition(5), components=4)
    got = {}
    for r in found.collect():
        got.setdefault(r.vec_id, []).append(r)
    ids, n, far, white, share = plain(rows, 4)
    assert sum(map(len, got.values())) == len(ids)
    signs = np.sign(np.array(got[1][0].whitened)) * np.sign(white[1])
    for i, d, w in zip(ids, far, white, strict=True):
        r = got[i][0]
        assert (r.n, int(r.deviation)) == (n, d)
        assert_allclose(np.array(r.whitened) * signs, w, atol=1e-9)
        assert_allclose(r.explained, share, rtol=1e-12)
        assert r.identity_error < 1e-9
    flat = whitening.by_component(found).where("vec_id = 1").orderBy("component").collect()
    assert [r.component for r in flat] == [1, 2, 3, 4]
    assert [r.whitened for r in flat] == list(got[1][0].whitened)
    assert flat[0].deviation == int(got[1][0].deviation)


def test_equal_eigenvalues_and_large_entries(spark):
    # A cross: both components have one eigenvalue; entries beyond 32 bits.
    rows = [(1, [2.0 ** 40, 0.0, 0.0]), (2, [-2.0 ** 40, 0.0, 0.0]), (3, [0.0, 2.0 ** 40, 0.0]),
            (4, [0.0, -2.0 ** 40, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    white = np.array([r.whitened for r in got])
    assert white.shape == (4, 2)  # the third has eigenvalue zero
    assert_allclose(white.T @ white / 4, np.eye(2), atol=1e-12)
    assert {int(r.deviation) for r in got} == {16 * 2 ** 92}
    assert {r.deviation for r in whitening.by_component(
        whitening.whiten(frame(spark, rows))).collect()} == {None}


def test_nothing_to_whiten(spark):
    docs = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)])
    assert whitening.whiten(docs).count() == 0
    assert whitening.whiten(docs.where("false")).count() == 0
    assert whitening.by_component(whitening.whiten(docs.where("vec_id = 3"))).count() == 0


def test_different_lengths_are_an_error(spark):
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0])]))


def test_polynomial_of_known_roots(spark):
    # An orthogonal change of basis of diag(9, 4, 4, 0), scaled to integers.
    h = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])
    matrix = (h @ np.diag([9, 4, 4, 0]) @ h).tolist()
    poly = whitening.characteristic_polynomial(spark, matrix)
    assert poly == [int(c) for c in np.round(np.poly([36, 16, 16, 0]))][::-1]
    assert [charpoly.roots_above(poly, c, 0) for c in (-1, 0, 15, 16, 36)] == [4, 3, 3, 1, 0]
    found = whitening.principal_components(spark, matrix, 4)
    assert [round(float(e), 12) for e, _ in found] == [36, 16, 16]
    vectors = np.stack([v for _, v in found])
    assert_allclose(vectors @ vectors.T, np.eye(3), atol=1e-12)
    assert_allclose(np.array(matrix) @ vectors.T, vectors.T * [36, 16, 16], atol=1e-9)
