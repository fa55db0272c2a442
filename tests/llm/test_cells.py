import math

import numpy as np
import pytest

from oreline.llm import cells

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vec string, node long, n long, cell int, `group` string, least double, good int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, *[None] * 8) for i, v, lab in rows], SCHEMA)


def brute(rows, least):
    """Links of all pairs, components by merging until nothing changes."""
    def cosine(a, b):
        a, b = (np.array(v, float) for v in (a, b))
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return (a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum()))

    fine = [v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) and lab is not None for _, v, lab in rows]
    links = [[j for j in range(len(rows)) if j != i and fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
              and cosine(rows[i][1], rows[j][1]) >= least] for i in range(len(rows))]
    out = []
    for i, (id_, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        name = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((id_, len(links[i]), name, id_ == name))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def groups(seed, labels=2, n=150, dim=12):
    """Random vectors, groups of near copies around some, chains of links, and exact copies."""
    rng, rows = np.random.default_rng(seed), []
    for lab in range(labels):
        base = rng.standard_normal((n, dim))
        near = [base[i % 7] + rng.standard_normal(dim) * 0.1 * np.linalg.norm(base[i % 7]) / math.sqrt(dim) for i in range(n)]
        chain = [np.r_[math.cos(0.15 * i), math.sin(0.15 * i), np.zeros(dim - 2)] for i in range(12)]
        rows += [(None, v, lab) for v in [*base, *near, *chain, *base[:9], *(base[:9] * 3)]]
    return [(i, v.tolist(), lab) for i, (_, v, lab) in zip(rng.permutation(len(rows)).tolist(), rows)]


@pytest.mark.parametrize("cell, block", [(4096, 4096), (24, 64), (24, 16)])
def test_equals_all_pairs_with_cells_and_blocks_of_any_size(spark, monkeypatch, cell, block):
    monkeypatch.setattr(cells, "CELL", cell)
    monkeypatch.setattr(cells, "PER_CELL", 4)
    monkeypatch.setattr(cells, "BLOCK", block)
    rows = groups(cell + block)
    assert got(cells.near_vectors(table(spark, rows), 0.98)) == brute(rows, 0.98)


def test_edge_rows(spark):
    rows = [(1, [1, 0], 0), (2, [2, 0], 0), (2, [2, 0], 0), (None, [1, 0.01], 0), (3, [1, 0], None), (4, [1, 0], 1), (5, None, 0), (6, [], 0), (7, [0, 0], 0),
            (8, [1, None], 0), (9, [float("nan"), 1], 0), (10, [float("inf"), 1], 0), (11, [1, 0, 0], 0), (12, [-1, 0], 0), (13, [1e300, 1e298], 0), (14, [1e-300, 0], 0),
            (None, [0, 1], 2), (None, [0, 2], 2)]
    assert got(cells.near_vectors(table(spark, rows))) == brute(rows, 0.98)
    assert got(cells.near_vectors(table(spark, []))) == []


def test_visits_lose_no_pair_at_a_border():
    rng = np.random.default_rng(4)
    for dim, k in ((2, 6), (3, 9), (8, 20)):
        points = cells.units(rng.standard_normal((400, dim)))
        home, visited = cells.places(points, cells.k_means(points, k), math.sqrt(2 - 2 * 0.98))
        close = np.argwhere(np.triu(points @ points.T >= 0.98, 1))
        for i, j in close:
            assert home[i] == home[j] or (visited[i, home[j]] if home[j] < home[i] else visited[j, home[i]])
        assert visited.sum() < 400 * (k - 1)


def test_few_visits_keep_cells_and_many_drop_them():
    rng = np.random.default_rng(5)
    tight = cells.units(np.repeat(np.eye(16), 100, axis=0) + rng.standard_normal((1600, 16)) * 0.01)
    loose = cells.units(rng.standard_normal((3000, 64)))
    assert len(cells.fit_cells(tight, 64_000, 0.2)) == 63
    assert len(cells.fit_cells(loose, 300_000, 0.2)) < 60


def test_centroids_are_unit_and_cells_follow_them():
    rng = np.random.default_rng(6)
    points = cells.units(np.repeat(np.eye(5), 40, axis=0) + rng.standard_normal((200, 5)) * 0.05)
    centres = cells.k_means(points, 5)
    home, _ = cells.places(points, centres, 0.0)
    assert np.allclose((centres ** 2).sum(axis=1), 1) and sorted(np.bincount(home)) == [40] * 5
