import math

import numpy as np
import pytest
from pyspark.sql import Row

from oreline.llm import whitening as W
from oreline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n string, component string, x string, vec string, id_ string, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], *[None] * 6) for i, v in rows], SCHEMA)


def check(rows, got, k=16):
    """``got`` against numpy's symmetric solver and exact sums."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    assert len(got) == sum(min(k, rank(kept, len(x))) for _, x in kept)
    for dim in {len(x) for _, x in kept} - {0}:
        fit = np.array(sorted({tuple(x) for _, x in kept if len(x) == dim}), dtype=object).reshape(-1, dim)
        n, sums = len(fit), fit.sum(axis=0)
        centred = (fit - sums / n).astype(float)
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        signs = {}
        for i, x in kept:
            if len(x) != dim:
                continue
            found = sorted((r for r in got if r.vec_id == i and r.n == n and r.deviation == sum(int(n * a - s) ** 2 for a, s in zip(x, sums))), key=lambda r: r.component)
            for r in found:
                c = r.component - 1
                want = float((np.array(x, float) - (sums / n).astype(float)) @ vectors[:, c]) / math.sqrt(values[c])
                if abs(want) > 1e-6:
                    sign = signs.setdefault(c, 1 if r.whitened * want > 0 else -1)
                    assert abs(r.whitened - sign * want) < 1e-7 * max(1, abs(want)), (i, c)
                else:
                    assert abs(r.whitened) < 2e-6
                assert abs(r.explained - values[c] / values.sum()) <= 1e-10 and r.identity_error < 1e-9


def rank(kept, dim):
    if not dim:
        return 0
    fit = np.array(sorted({tuple(x) for _, x in kept if len(x) == dim}), float).reshape(-1, dim)
    return int(np.linalg.matrix_rank(fit - fit.mean(axis=0), tol=1e-6))


def spread(seed, n, dim):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dim)) * np.geomspace(3, 0.3, dim)).round(3).tolist()


@pytest.mark.parametrize("n, dim", [(300, 24), (40, 3), (9, 20)])
def test_equals_the_symmetric_solver(spark, monkeypatch, n, dim):
    monkeypatch.setattr(W, "ROWS", 7)
    rows = list(enumerate(spread(n, n, dim)))
    check(rows, W.whitened(table(spark, rows)).collect())


def test_edge_rows(spark):
    rows = [*enumerate(spread(1, 30, 4)), (None, [1, 2, 3, 4]), (5, [1, 2, 3, 4]), (70, None), (71, [1, None, 0, 0]), (72, [math.nan, 0, 0, 0]), (73, [math.inf, 0, 0, 0]),
            (74, []), (75, [0.5, 0.5]), (76, [0.7, 0.2]), (77, [9, 9, 9])]
    got = W.whitened(table(spark, rows)).collect()
    check([(-1 if i is None else i, v) for i, v in rows], [Row(**{**r.asDict(), "vec_id": -1 if r.vec_id is None else r.vec_id}) for r in got])
    assert not any(r.vec_id in (70, 71, 72, 73, 74, 77) for r in got)
    assert {r.component for r in got if r.vec_id == 75} == {1}
    assert W.whitened(table(spark, [])).collect() == []


def test_far_entries_stay_exact_or_null(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.25, 2.0])]
    got = W.whitened(table(spark, rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.n == 3 for r in got)
    assert [r.deviation for r in got if r.vec_id == 1] == [None] * len([r for r in got if r.vec_id == 1])
    big = W.Whitening(3, [3 * 10 ** 15 + 1, -5], np.ones(2), np.eye(2), 2.0)
    assert big.squares(np.array([[10 ** 15 + 40, 7]])) == [(3 * (10 ** 15 + 40) - (3 * 10 ** 15 + 1)) ** 2 + 26 ** 2]


def test_pivots_and_rotations():
    rng = np.random.default_rng(2)
    for dim, rank_ in ((1, 1), (2, 2), (7, 4), (30, 30)):
        a = rng.standard_normal((dim, rank_)) * np.geomspace(1, 1e-3, rank_)
        factor = W.pivoted_cholesky(a @ a.T)
        assert factor.shape == (dim, rank_) and np.allclose(factor @ factor.T, a @ a.T)
        order = np.argsort(-np.abs(factor), axis=0)[0]
        assert factor[order[0], 0] ** 2 == pytest.approx((a @ a.T).diagonal().max())
        values, vectors = W.one_sided_jacobi(factor)
        assert np.allclose(values, np.linalg.eigvalsh(a @ a.T)[::-1][:rank_], rtol=1e-9) and np.allclose(vectors.T @ vectors, np.eye(rank_), atol=1e-12)
    assert W.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    for n in (0, 1, 2, 5, 8):
        seen = [(min(a, b), max(a, b)) for p, q in W.rounds_of_pairs(n) for a, b in zip(p.tolist(), q.tolist())]
        assert sorted(seen) == [(a, b) for a in range(n) for b in range(a + 1, n)]


def test_registered_query_equals_the_symmetric_solver(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(rows, QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001").collect())
