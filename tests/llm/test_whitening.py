"""Whitening against numpy's eigenvectors, and the inertia counts."""

import math

import numpy as np
import pytest

from hourglass.llm.whitening import inertia, leading, whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, component string"


def plain(rows, most=4):
    """{(vec_id, place in the input, component)}: what the contract asks for, in plain Python and numpy."""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array(sums) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    out = []
    for i, x in good:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        w = (np.array(x) - np.array(sums) / n) @ axes / np.sqrt(values)
        out += [(i, k + 1, n, dev, w[k], values[k] / np.trace(v)) for k in range(len(values))]
    return out


def compare(got, want):
    assert len(got) == len(want)
    got = sorted(got, key=lambda r: (r.vec_id is not None, r.vec_id or 0, r.component, r.deviation))
    want = sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3]))
    signs = {}
    for g, w in zip(got, want, strict=True):
        assert (g.vec_id, g.component, g.n, g.deviation) == w[:4]
        assert g.explained == pytest.approx(w[5], rel=1e-9) and g.identity_error < 1e-9
        signs.setdefault(g.component, set())
        if abs(w[4]) > 1e-6:
            signs[g.component].add(np.sign(g.whitened * w[4]))
            assert abs(g.whitened) == pytest.approx(abs(w[4]), rel=1e-8)
    assert all(len(s) <= 1 for s in signs.values())


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    compare(whiten(rows).collect(), plain([(r.vec_id, r.embedding) for r in rows.collect()]))


def test_hard_rows(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((40, 6)) * [4, 3, 2, 1, 0.5, 0.25] + 7).astype(np.float32).tolist()
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    rows = [*enumerate(vectors), *[(100 + i, v) for i, v in enumerate(odd)], (None, vectors[3]), (7, vectors[7]), (8, vectors[9])]
    # A vector that holds a third of all rows counts once.
    rows += [(500 + i, vectors[0]) for i in range(30)]
    frame = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    compare(whiten(frame).collect(), plain([r for r in rows if r[1] is None or len(r[1]) == 6]))


def test_no_variance_and_no_rows(spark):
    frame = spark.createDataFrame([(i, [1.0, 2.0], 0, "x", "y") for i in range(3)], SCHEMA)
    assert whiten(frame).collect() == [] and whiten(frame.limit(0)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 0, "x", "y") for i in range(5)], SCHEMA)
    got = whiten(line).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1.0)


@pytest.mark.parametrize("seed", range(5))
def test_inertia_counts(seed):
    rng = np.random.default_rng(seed)
    for d in (1, 2, 5, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        if seed % 2:
            np.fill_diagonal(a, 0)  # needs pivots of order 2
        values = np.linalg.eigvalsh(a)
        assert inertia(a) == ((values > 0).sum(), (values < 0).sum(), 0) or d == 1


def test_leading_with_clusters():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    for values in ([9, 9, 9, 5, 1], [5, 5 - 1e-9, 5 - 2e-9, 1], [1e6, 1e-3, 1e-4], [3.0]):
        full = np.zeros(30)
        full[: len(values)] = values
        v = q @ np.diag(full) @ q.T
        found = leading((v + v.T) / 2, 4)
        assert len(found) == min(4, len(values)) and all(c.certified for c in found)
        basis = np.array([c.vector for c in found])
        assert np.abs(basis @ basis.T - np.eye(len(found))).max() < 1e-9
        assert [c.value for c in found] == pytest.approx(sorted(values, reverse=True)[:4], abs=1e-11 * max(values))
