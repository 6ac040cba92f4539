"""Whitening against plain arithmetic with fractions, and eigenvectors against known ones."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from corpus_ledger.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, deviation string"


def rotation(d, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]


@pytest.mark.parametrize("values", [
    [8, 4, 2, 1, 0.5, 0.25],
    [1 + 1e-9 * k for k in range(8)] + [3, 3 + 1e-11, 1e-6, 2e-6],
    [5] * 6 + [1] * 4,
    [1e6, 1, 1 + 1e-13, 1 + 3e-13, 1e-3, 0],
    [0] * 5,
])
def test_refined_eigenvectors(values):
    """Residuals and orthogonality reach double precision, also where eigenvalues are close or equal."""
    d = len(values)
    q = rotation(d, 3).astype(whitening.WIDE)
    q = q + q @ (np.eye(d) - q.T @ q) / 2
    q = q + q @ (np.eye(d) - q.T @ q) / 2
    a = (q * np.array(values, whitening.WIDE)) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined(a, whitening.float32_start(a))
    size = max(max(values), 1e-300)
    assert np.abs(got - np.sort(np.array(values, whitening.WIDE))[::-1]).max() <= 1e-16 * size
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-16
    assert np.abs(a @ x - x * got).max() <= 1e-16 * size


def test_single_precision_alone_is_not_enough():
    a = (rotation(30, 1) * np.linspace(1, 2, 30)) @ rotation(30, 1).T
    rough = whitening.float32_start(a)
    _, fine = whitening.refined(a.astype(whitening.WIDE), rough)
    exact = np.linalg.eigh(a)[1][:, ::-1]
    error = lambda x: max(min(np.abs(x[:, k] - exact[:, k]).max(), np.abs(x[:, k] + exact[:, k]).max()) for k in range(30))
    assert error(rough) > 1e-7 and error(fine) < 1e-12


def usable(rows):
    good = [(i, [float(c) for c in v]) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s), default=0)
    return [(i, [min(max(math.floor(64 * c) + 1_000_000, -(2**52)), 2**52) for c in v]) for i, v in good if len(v) == d]


def check(rows, got):
    """Everything but the eigenvectors by fractions; these by what they have to fulfil, and by numpy where they are unique."""
    x = usable(rows)
    n, d = len(x), len(x[0][1]) if x else 0
    kept = min(32, d)
    assert len(got) == n * kept
    if not n:
        return
    sums = [sum(v[k] for _, v in x) for k in range(d)]
    wanted = sorted((str(i), str(sum((n * c - s) ** 2 for c, s in zip(v, sums)))) for i, v in x)
    assert sorted((str(r["vec_id"]), r["deviation_exact"]) for r in got if r["component"] == 1) == wanted
    assert all(str(r["deviation"]) == r["deviation_exact"] for r in got if int(r["deviation_exact"]) < 2**63)
    assert all(r["deviation"] is None for r in got if int(r["deviation_exact"]) >= 2**63)
    assert {r["n"] for r in got} == {n}
    cov = np.array([[float(sum(Fraction(n * v[i] - sums[i]) * (n * v[j] - sums[j]) for _, v in x) / n**3) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    centred = {str(i): np.array([float(Fraction(n * c - s, n)) for c, s in zip(v, sums)]) for i, v in x}
    scale = max(values[0], 1e-12)
    for k in range(kept):
        mine = [r for r in got if r["component"] == k + 1]
        assert len({r["explained"] for r in mine}) == 1
        if values[k] < 1e-9 * scale:
            assert all(r["whitened"] is None for r in mine)
            continue
        assert abs(mine[0]["explained"] * values.sum() / values[k] - 1) < 1e-9
        near = min([abs(values[k] - v) for j, v in enumerate(values) if j != k], default=1)
        if near > 1e-4 * scale:
            plain = np.array([centred[str(r["vec_id"])] @ axes[:, k] / math.sqrt(values[k]) for r in mine])
            seen = np.array([r["whitened"] for r in mine])
            assert min(np.abs(plain - seen).max(), np.abs(plain + seen).max()) < 1e-9
    assert all(r["identity_error"] is None or r["identity_error"] < 1e-9 for r in got)


def report(spark, rows):
    return whitening.whitening_report(spark.createDataFrame(rows, SCHEMA)).collect()


def test_against_fractions(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(k, 1 + k) for k in range(6)], "x") for i in range(60)]
    rows += [(60, None, "x"), (61, [], "x"), (62, [1.0, None, 2.0, 3.0, 4.0, 5.0], "x"), (63, [float("nan")] * 6, "x")]
    rows += [(64, [float("inf")] + [0.0] * 5, "x"), (65, [1.0, 2.0], "x"), (7, rows[7][1], "x"), (None, rows[8][1], None)]
    check(rows, report(spark, rows))


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, "x"), (2, [], "x"), (3, [None], "x")],
    [(1, [1.0, 2.0, 3.0], "x")],
    [(1, [1.0, 2.0], "x"), (1, [1.0, 2.0], "x"), (2, [1.0, 2.0], "x")],
    [(i, [float(i % 3), 5.0, float(i % 3)], "x") for i in range(9)],
    [(1, [0.5], "x"), (2, [0.25], "x"), (3, [7.0], "x")],
    [(1, [3e38, 1.0], "x"), (2, [-3e38, 2.0], "x"), (3, [1.0, 4.0], "x")],
    [(1, [1e9, 1.0], "x"), (2, [-3e9, 2.0], "x"), (3, [1.0, 4.0], "x")],
], ids=["no rows", "no vectors", "one row", "equal rows", "two constant directions", "one dimension", "huge", "large"])
def test_awkward_tables(spark, rows):
    check(rows, report(spark, rows))


def test_sums_do_not_round():
    y = np.array([[(1 << 51) + 1, -3], [5, 1 << 40]], np.int64)
    exact = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(2)] for i in range(2)]
    assert whitening.gram(y).tolist() == exact
    flat = [v for row in exact for v in row] + [-1, 0, -(1 << 80)]
    assert [whitening.whole(*parts) for parts in zip(*whitening.limbs(np.array(flat, object)))] == flat
    small = np.random.default_rng(1).integers(-(1 << 20), 1 << 20, (500, 3))
    assert whitening.gram(small).tolist() == (small.astype(object).T @ small.astype(object)).tolist()
    assert whitening.deviations(y, 10**9, [4, -7]) == [sum((10**9 * int(c) - r) ** 2 for c, r in zip(row, [4, -7])) for row in y]


def test_query_over_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) + ("x",) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, queries.op13_embedding_whitening(spark, sf).collect())
