import hashlib
import math
from collections import Counter

import numpy as np

from oreline.llm import imatch

from .helpers import LONG, documents


def test_counts_and_band(spark):
    rows = [(i, f"common word{i % 10} single{i}") for i in range(200)] + [(300, None), (301, "")]
    df = documents(spark, rows)
    counts = imatch.cell_counts(df, "text")
    want = Counter(t for _, text in rows for t in imatch.terms_of(text or ""))
    import xxhash
    cells = Counter()
    for t, n in want.items():
        cells[xxhash.xxh3_64_intdigest(t) % imatch.CELLS] += n
    assert {i: int(counts[i]) for i in np.flatnonzero(counts)} == dict(cells)
    inside = np.unpackbits(np.frombuffer(imatch.band(counts, len(rows), 0.3, 0.95), np.uint8))
    for t, n in want.items():
        assert bool(inside[xxhash.xxh3_64_intdigest(t) % imatch.CELLS]) == (0.3 <= math.log(len(rows) / n) / math.log(len(rows)) <= 0.95)


def test_fingerprint_ignores_order_repeats_and_terms_outside(spark):
    rows = [(i, f"the word{i % 40} item{i % 30} unique{i}") for i in range(400)]
    own = imatch.Fingerprints(imatch.lexicon(documents(spark, rows)))
    a, b = "the word1 item2 word3 item4", "item4 word3 the the word1 item2 neverseen"
    assert own.of(a) == own.of(b) != own.of("the word1 item2 word3 item5")
    assert own.of("") == own.of(" \n") and imatch.likeness(own.of(""), own.of(a)) == 0.0
    assert own.of("nothing known") != own.of("nothing else") and imatch.likeness(own.of(a), own.of(a)) == 1.0


def test_survives_small_edits(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choice(words, 150))) for i in range(300)]
    own = imatch.Fingerprints(imatch.lexicon(documents(spark, rows)))
    near, far = [], []
    for (_, t), (_, other) in zip(rows, rows[1:]):
        edited = " ".join(t.split()[:140] + other.split()[:10])
        near.append(imatch.likeness(own.of(t), own.of(edited)))
        far.append(imatch.likeness(own.of(t), own.of(other)))
    assert np.mean(near) > 0.7 and np.mean(far) < 0.1


def test_edit_probe_over_ranges(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), " ".join(rng.choice(["aé", "b🙂", "cc", "d\n"], rng.integers(0, 30)))) for i in rng.permutation(500)]
    rows[7] = (rows[7][0], None)
    rows[8] = (rows[8][0], LONG)
    df = documents(spark, rows)
    packed = imatch.lexicon(df)
    got = {r.doc_id: r for r in imatch.edit_probe(df.repartition(7), packed).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    own = imatch.Fingerprints(packed)
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own.of(text), own.of(edited))
        assert (r.near_edited, r.near_next) == (imatch.likeness(own.of(text), own.of(edited)), imatch.likeness(own.of(text), own.of(following)))


def test_odd_tables(spark):
    empty = documents(spark, [])
    assert imatch.edit_probe(empty, imatch.lexicon(empty)).collect() == [] and imatch.fingerprints(empty, imatch.lexicon(empty)).collect() == []
    one = documents(spark, [(5, "only one here")])
    r = imatch.edit_probe(one, imatch.lexicon(one)).first()
    assert (r.near_next, r.n_chars, r.edited_sha256) == (1.0, 13, hashlib.sha256(b"only one " + b"only").hexdigest())
    odd = documents(spark, [(1, "a b"), (1, "a b"), (1, "c d"), (None, "e f"), (None, "e f"), (2, None)])
    assert Counter(r.doc_id for r in imatch.edit_probe(odd, imatch.lexicon(odd)).collect()) == {1: 3, None: 2, 2: 1}
    nulls = documents(spark, [(None, "x y z"), (None, "p q")])
    assert len(imatch.edit_probe(nulls, imatch.lexicon(nulls)).collect()) == 2
    prints = imatch.fingerprints(odd, imatch.lexicon(odd)).collect()
    assert len({r.fingerprint for r in prints if r.doc_id is None}) == 1 and len(prints) == 6


def test_band_is_decided_per_term(spark):
    import xxhash
    cell = xxhash.xxh3_64_intdigest(b"word1") % imatch.CELLS
    rare = next(t for i in range(100_000_000) if xxhash.xxh3_64_intdigest(t := b"rare%d" % i) % imatch.CELLS == cell)
    long = "L" * 500
    rows = [(i, f"common word{i % 10} single{i}" + (f" {long}" if i % 10 == 3 else "")) for i in range(200)] + [(200, rare.decode())]
    own = imatch.Fingerprints(imatch.lexicon(documents(spark, rows)))
    want = Counter(t for _, text in rows for t in imatch.terms_of(text))
    assert {t for t in want if own.inside(imatch.key_of(t))} == {t for t, n in want.items() if 0.3 <= math.log(201 / n) / math.log(201) <= 0.95}
    assert own.inside(b"word1") and own.inside(imatch.key_of(long.lower().encode())) and not own.inside(rare)


def test_filter_of_many_terms(spark):
    import xxhash
    digests = spark.range(100_000).selectExpr("xxhash64(cast(concat('in', id) AS binary)) AS digest")
    packed = imatch.packed_terms(digests)
    own = imatch.Fingerprints(packed)
    assert own.blocks > 20 and len(packed) * 8 < 1.1 * 100_000 * imatch.BITS
    assert all(own.inside(b"in%d" % i) for i in range(0, 100_000, 7))
    assert sum(own.inside(b"out%d" % i) for i in range(100_000)) < 100
    assert xxhash.xxh64_intdigest(b"in5", seed=42) == spark.sql("SELECT xxhash64(cast('in5' AS binary)) AS d").first().d % 2 ** 64
