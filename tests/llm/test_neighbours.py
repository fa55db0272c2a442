import numpy as np
from pyspark.sql import functions as F

from oreline.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, label int, id long, cell long, hi string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0, 0, "") for i, v in rows], SCHEMA)


def brute(rows, asked, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, a in {(i, tuple(v)) for i, v in good if asked(i)}:
        a = np.array(a)
        found = {(-round(float((a * v).sum() / (np.sqrt((a * a).sum()) * np.sqrt((v * v).sum()))), 10), i) for i, v in good if i != q and len(v) == len(a)}
        out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def result(df, asked, k=5, sure=0.98):
    out = {}
    for r in sorted(neighbours.nearest(df, asked, k, sure=sure).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 10)))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_quantiles():
    assert abs(neighbours.chi_square_quantile(0.95, 2) - 5.9915) < 1e-3
    assert abs(neighbours.chi_square_quantile(0.98, 12) - 24.054) < 1e-2


def test_recall_over_many_cells(spark, monkeypatch):
    for name, value in (("BLOCK", 128), ("QUERIES", 16), ("LEAF", 16), ("SAMPLE", 600)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 24))
    rows = [(i, (centres[rng.integers(20)] + 0.4 * rng.standard_normal(24)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(600)]  # a very common vector
    want, got = brute(rows, lambda i: i % 50 == 0, 5), result(frame(spark, rows), F.col("id") % 50 == 0)
    assert want.keys() == got.keys() and all(len(v) == 5 for v in got.values())
    exact = {q: dict(v) for q, v in brute(rows, lambda i: i % 50 == 0, 3000).items()}
    assert all(abs(exact[q][i] - s) < 1e-9 for q, v in got.items() for i, s in v)
    hit = sum(s >= want[q][-1][1] - 1e-9 for q, v in got.items() for _, s in v)
    assert hit / sum(map(len, want.values())) >= 0.95


def test_odd_rows_and_ties(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1, 0]), (0, [1, 0]), (1, [2, 0]), (2, [1, 0]), (3, [0, 1]), (4, [-1, 0]), (5, [0, 0]), (6, None), (7, [1, None]), (8, [nan, 1]),
            (9, [1, inf]), (None, [1, 0]), (10, []), (50, [1, 0, 0]), (51, [1, 1, 0]), (100, [1e200, 1e200]), (101, [1e-200, 0]), (150, [1, 2, 3, 4])]
    df = frame(spark, rows)
    got = result(df, F.col("id") % 50 == 0, sure=0.999999)
    assert [i for i, _ in got[0]] == [1, 2, 101, 100, 3]
    assert got[50] == [(51, round(1 / 2 ** 0.5, 10))]
    assert sorted(i for i, _ in got[100]) == [0, 1, 2, 3, 101] and 150 not in got  # equal but for the last digit
    assert result(frame(spark, []), F.col("id") % 50 == 0) == {}
    assert result(frame(spark, [(0, [1, 2])]), F.col("id") % 50 == 0) == {}


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want, got = brute(rows, lambda i: i % 50 == 0, 5), result(df, F.col("id") % 50 == 0)
    assert sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want) / (5 * len(want)) >= 0.9
