import random

import numpy as np

from oreline.llm import minhash

from .helpers import LONG, documents


def brute(rows, k, percent):
    sets = [(i, minhash.shingle_set((t or "").encode(), k)) for i, t in rows]
    label = list(range(len(sets)))

    def root(a):
        while label[a] != a:
            a = label[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            if minhash.similar(sets[a][1], sets[b][1], percent):
                label[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[root(a)] = min([x for x in (least.get(root(a)), i) if x is not None], default=None)
    return sorted(((i, len(s), least[root(a)] if s else i) for a, (i, s) in enumerate(sets)), key=repr)


def result(df, k, percent):
    got = minhash.near_duplicates(df, k, percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)


def test_words():
    assert minhash.words_of("ÀB\tc\x0bD\x1ce\xa0F g\n".encode()) == ["Àb".encode(), b"c", "d\x1ce\xa0f".encode(), b"g"]
    assert minhash.shingle_set(b"one", 2) == {(b"one",)} and minhash.shingle_set(b" \n", 2) == set()


def test_threshold_is_exact():
    a, b = set(range(100)), set(range(11, 111))
    assert minhash.similar(a, b, 80) == (100 * 89 >= 80 * 111)
    assert minhash.similar(set(range(8)), set(range(10)), 80) and not minhash.similar(set(), set(), 80)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 2000).astype(np.uint64)
    other = np.concatenate([base[:1600], rng.integers(0, 2**63, 400).astype(np.uint64)])
    same = (minhash.signature(base) == minhash.signature(other)).mean()
    assert abs(same - 1600 / 2400) < 0.12


def test_groups_against_all_pairs(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([3, 40, 120]))
        for _ in range(rng.choice([1, 4, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((i := i + 1, " ".join(text)))
    chain = rng.choices(words, k=200)
    for step in range(6):  # neighbours are similar, the ends are not
        chain[step * 12:step * 12 + 9] = [f"c{step}-{j}" for j in range(9)]
        rows.append((1000 - step, " ".join(chain)))
    rng.shuffle(rows)
    for k in (2, 5):
        assert result(documents(spark, rows), k, 80) == brute(rows, k, 80)


def test_edge_rows(spark):
    rows = [(5, "a b c"), (3, "A  b\nC"), (3, "A  b\nC"), (None, "a b c"), (8, None), (9, ""), (2, " \t"), (4, LONG), (6, LONG + " "), (None, None), (7, "solo")]
    assert result(documents(spark, rows), 2, 80) == brute(rows, 2, 80)
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    assert result(documents(spark, [(1, None), (2, "")]), 2, 80) == [(1, 0, 1), (2, 0, 2)]
