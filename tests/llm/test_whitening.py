"""Whitening against exact rational arithmetic and numpy's eigenvalues."""

from fractions import Fraction

import numpy as np
import pytest

from sheaf.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, component string, x int"


def model_of(rows, k=16):
    """Plain model: ids, x vectors, their deviation, n, eigenvalues, V."""
    x = [(i, tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({v for _, v in x})
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    cov = np.array([[float(sum((n * v[a] - s[a]) * (n * v[b] - s[b]) for v in fit) / Fraction(n) ** 3) for b in range(d)] for a in range(d)])
    return x, n, s, cov, {v: sum((n * v[j] - s[j]) ** 2 for j in range(d)) for _, v in x}


def test_against_exact_arithmetic(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 9)) @ np.diag([30, 10, 5, 3, 1, 0.5, 0.2, 0.1, 0.05])
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(100 + i, rows[0][1]) for i in range(70)]  # one vector holds over half of all rows
    rows += [(None, rows[1][1]), (7, rows[2][1])]
    bad = [(900, None), (901, []), (902, [1.0] * 8 + [None]), (903, [1.0] * 8 + [float("nan")]), (904, [float("inf")] * 9), (905, [1.0] * 5), (906, [3e38] * 9)]
    df = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows + bad], SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    x, n, s, cov, deviation = model_of(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1].T
    assert len(got) == 9 * len(rows) and {r.n for r in got} == {n}
    assert {r.vec_id for r in got} == {i for i, _ in rows}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, set()).add((r.deviation, r.whitened, r.explained))
    sign = {}
    for i, v in x:
        for k in range(9):
            want = float(sum((Fraction(v[j]) - Fraction(s[j], n)) * Fraction(float(vectors[k][j])) for j in range(9))) / np.sqrt(values[k])
            match = [w for d, w, e in by_id[i][k + 1] if d == deviation[v] and abs(abs(w) - abs(want)) < 1e-6]
            assert match
            if abs(want) > 0.1:
                sign.setdefault(k, set()).add(np.sign(want * match[0]))
    assert all(len(v) == 1 for v in sign.values())
    explained = {r.component: r.explained for r in got}
    assert np.allclose([explained[k + 1] for k in range(9)], values / values.sum(), rtol=1e-10)


def test_small_eigenvalues_keep_their_digits():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    scale = np.diag(10.0 ** -np.arange(12))
    v = scale @ (q @ np.diag(np.linspace(1, 2, 12)) @ q.T) @ scale  # graded: condition 1e22
    values, vectors = whitening.solve(v)
    f = whitening.pivoted_cholesky(v)
    assert len(values) >= 8 and np.all(np.diff(values) <= 0)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(np.linalg.svd(f, compute_uv=False) ** 2, values, rtol=1e-9)


def test_rank_ties_and_width(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]  # one direction only
    got = whitening.whiten(spark.createDataFrame(line, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
    square = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, -1.0])]  # two equal eigenvalues
    got = whitening.whiten(spark.createDataFrame(square, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 8 and got[0].identity_error < 1e-12
    large = [(i, [1e9 * i, -3e9 * (i % 2)]) for i in range(4)]  # products leave 64 bits
    x, n, s, cov, deviation = [[(i, tuple(int(64 * c) + 1_000_000 for c in v)) for i, v in large], 4, None, None, None]
    s = [sum(v[j] for _, v in x) for j in range(2)]
    got = whitening.whiten(spark.createDataFrame(large, "vec_id long, embedding array<double>")).collect()
    for r in got:
        v = dict(x)[r.vec_id]
        want = sum((n * v[j] - s[j]) ** 2 for j in range(2))
        assert r.deviation_digits == str(want) and r.deviation == (want if want < 1 << 63 else None)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_fit(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_query_on_the_table(spark):
    out = queries.QUERIES["op11_embedding_whitening"](spark, SF)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert out.count() == 16 * n
