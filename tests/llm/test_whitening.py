import math
from fractions import Fraction

import numpy as np
import pytest

from gridscout.llm import whitening as H
from gridscout.llm.queries import op13_embedding_whitening

SF_DIR = "/root/testdata/sf0.001"


def vectors(spark, rows, kind: str = "array<float>"):
    full = [(i, v, 1, 2, None, "x") for i, v in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding {kind}, _id int, component int, n int, z string").repartition(3)


def brute(rows, components: int = 8):
    """(n, deviations by row, eigenvalues, vectors, centred rows) in exact whole numbers as far as they go."""
    x = [[math.floor(Fraction(c) * 1024) + 100_000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    exact = [[n * a - b for a, b in zip(v, s)] for v in x]
    deviation = [sum(a * a for a in v) for v in exact]
    centred = np.array([[a / n for a in v] for v in exact])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, values[::-1][:components], axes[:, ::-1][:, :components], centred


def compare(out, rows, components: int = 8, distinct: bool = True):
    n, deviation, values, axes, centred = brute(rows, components)
    found = {}
    for r in out:
        found.setdefault((r.vec_id, r.component), []).append(r)
    k = max(c for _, c in found)
    assert k == min(components, len(rows[0][1])) and sum(map(len, found.values())) == n * k
    total = np.trace(centred.T @ centred / n)
    for c in range(1, k + 1):
        expected = centred @ axes[:, c - 1] / math.sqrt(values[c - 1])
        own = np.array([found[i, c][0].whitened for i, _ in rows])
        if distinct:
            assert np.abs(own * np.sign(own @ expected) - expected).max() < 1e-9
        for (i, _), e in zip(rows, deviation):
            r, e = found[i, c][0], e if e < 2**63 else None
            assert (r.n, r.deviation) == (n, e) and abs(r.explained / (values[c - 1] / total) - 1) < 1e-9 and r.identity_error < 1e-10 and r.residual < 1e-12
    white = np.array([[found[i, c][0].whitened for c in range(1, k + 1)] for i, _ in rows])
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-10


def floats(rng, n, d, spread=1.0):
    return [(i, [float(np.float32(c)) for c in rng.standard_normal(d) * np.linspace(1, 2, d) * spread]) for i in range(n)]


def test_by_exact_arithmetic(spark):
    rng = np.random.default_rng(1)
    rows = floats(rng, 300, 20)
    compare(H.whiten(vectors(spark, rows)).collect(), rows)
    rows = floats(rng, 60, 3, 1000.0)  # fewer dimensions than components; more than 16 bits
    compare(H.whiten(vectors(spark, rows, "array<double>")).collect(), rows)
    rows = floats(rng, 200, 6, 1e8)  # more than 32 bits
    compare(H.whiten(vectors(spark, rows, "array<double>"), components=4).collect(), rows, 4)


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    rows = floats(rng, 40, 4)
    kept = [*rows, (0, rows[0][1]), (7, rows[3][1]), (None, rows[5][1])]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [nan, 1.0, 1.0, 1.0]), (103, [1.0, inf, 1.0, 1.0]), (104, [-inf] * 4), (105, []), (106, [1.0, 2.0]), (107, [1e20, 1.0, 1.0, 1.0])]
    out = H.whiten(vectors(spark, kept + bad, "array<double>")).collect()
    assert len(out) == 43 * 4 and {r.n for r in out} == {43}
    assert sum(r.vec_id == 0 for r in out) == 8 and sum(r.vec_id is None for r in out) == 4
    assert not {r.vec_id for r in out} & set(range(100, 108))
    n, deviation, values, axes, centred = brute(kept)
    assert sorted(r.deviation for r in out if r.component == 1) == sorted(deviation)
    assert abs(sum(r.explained for r in out) / 43 - 1) < 1e-12


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        assert H.whiten(vectors(spark, rows)).collect() == []
    out = H.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])).collect()  # one direction only
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12


def test_equal_values(spark):
    rows = [(i, [float(8 * s if j == k else 0) for j in range(10)]) for i, (k, s) in enumerate((k, s) for k in range(10) for s in (1, -1))]
    compare(H.whiten(vectors(spark, rows)).collect(), rows, distinct=False)


def test_a_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float((-1) ** i * 4e9), float(i)]) for i in range(20)]
    out = H.whiten(vectors(spark, rows, "array<double>")).collect()
    assert {r.deviation for r in out} == {None} and all(r.identity_error < 1e-9 for r in out)


@pytest.mark.parametrize("kind", ["random", "close", "pairs", "steep", "indefinite"])
def test_jacobi_davidson(kind):
    rng = np.random.default_rng(5)
    d = 96
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {
        "random": rng.random(d) * 5,
        "close": np.concatenate([1 + 1e-6 * np.arange(12), rng.random(d - 12) * 0.9]),
        "pairs": np.repeat(np.arange(d // 2), 2) + 1.0,
        "steep": 10.0 ** -np.linspace(0, 14, d),
        "indefinite": np.linspace(-50, 3, d),
    }[kind]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    passes = []
    found, axes, residuals = H.jacobi_davidson(lambda w: (passes.append(w.shape[1]), matrix @ w)[1], d, 8)
    scale = np.abs(values).max()
    assert np.abs(found - np.sort(values)[::-1][:8]).max() < 1e-12 * scale
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-12 and residuals.max() < 1e-12 * scale
    assert np.abs(matrix @ axes - axes * found).max() < 1e-12 * scale and len(passes) < 200


def test_minres_solves_projected_equations():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    q = np.linalg.qr(rng.standard_normal((30, 3)))[0]
    project = lambda t: t - q @ (q.T @ t)
    right, shift = project(rng.standard_normal((30, 4))), np.array([0.5, -3.0, 7.0, 100.0])
    x = H.minres(lambda w: a @ w, shift, right, project, 200, 1e-13)
    assert np.abs(project(a @ x - x * shift) - right).max() < 1e-8 and np.abs(q.T @ x).max() < 1e-10


def test_query(spark):
    out = op13_embedding_whitening(spark, SF_DIR)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    compare(out.collect(), rows)
