import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from oreline.llm import packing

from .helpers import LONG, documents

PATH = P.path("byte_bpe_50k.json")


def optimum(lengths, size):
    """Fewest sequences by trying all ways."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for at in range(len(rooms)):
            if rooms[at] >= lengths[i] and rooms[at] not in rooms[:at]:
                place(i + 1, [r - lengths[i] * (j == at) for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    return best[0]


def test_bound_never_passes_the_optimum_and_fit_is_valid():
    rng = random.Random(5)
    for _ in range(150):
        size = rng.choice([10, 16, 30])
        lengths = np.array(sorted((rng.randint(1, size - 1) for _ in range(rng.randint(1, 9))), reverse=True))
        bins, offsets, count = packing.best_fit(lengths, size)
        bound = packing.lower_bound(np.bincount(lengths, minlength=size + 1), size)
        assert bound <= optimum(lengths.tolist(), size) <= count
        for b in range(count):
            at = 0
            for o, n in sorted(zip(offsets[bins == b], lengths[bins == b])):
                assert o == at
                at += n
            assert at <= size


def test_bound_knows_halves():
    assert packing.lower_bound(np.bincount([6] * 7, minlength=11), 10) == 7


def check(rows, got, size, tokenizer):
    left = sorted((tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows), key=repr)
    pieces = sorted(got, key=lambda r: (repr(r.doc_id), r.piece))
    places = {}
    for r in pieces:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert 0 < r.length <= size
    for used in places.values():
        at = 0
        for o, n in sorted(used):
            assert o == at
            at += n
        assert at <= size
    want = []
    for ids in left:
        first = packing.first_length(len(ids), size)
        cuts = [0, *range(first, len(ids) + 1, size)]
        want += [(p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    return len(places)


def test_rows(spark):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rows = [(1, "Hello"), (1, "Hello"), (None, "a b c"), (None, "a  b\n c"), (2, None), (3, ""), (4, LONG), (5, "x " * 40), (6, "<|endoftext|> is text")]
    got = packing.pack_documents(documents(spark, rows), PATH, size=64).collect()
    check(rows, got, 64, tokenizer)
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


@pytest.mark.parametrize("group_items", [40, 10_000])
def test_groups_exchange_and_certify(spark, group_items):
    rng = random.Random(3)
    items = [(i, rng.randint(1, 99)) for i in range(400)]
    df = spark.createDataFrame(items, "row long, rest long")
    got = packing.pack_lengths(df, 100, group_items, 4).collect()
    assert sorted(r.row for r in got) == list(range(400))
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, dict(items)[r.row]))
    for used in held.values():
        assert sum(n for _, n in used) <= 100
        assert all(o == sum(n for p, n in used if p < o) for o, _ in used)
    bound = packing.lower_bound(np.bincount([n for _, n in items], minlength=101), 100)
    assert bound <= len(held) <= bound * 1.1 + 400 // group_items + 1
    one = packing.pack_lengths(df, 100, 10_000).select("certified").distinct().collect()
    assert len(one) == 1


def test_exact_fit_is_one_full_piece(spark):
    tokenizer = Tokenizer.from_file(PATH)
    n = len(tokenizer.encode("a b c d e", add_special_tokens=False).ids) + 1
    got = packing.pack_documents(documents(spark, [(7, "a b c d e")]), PATH, size=n).collect()
    assert [(r.piece, r.start, r.length, r.offset, r.certified) for r in got] == [(0, 0, n, 0, True)]


def test_all_pairs_of_lengths():
    for a, b in itertools.product(range(1, 10), repeat=2):
        assert packing.best_fit(np.array([a, b]), 10)[2] == (1 if a + b <= 10 else 2)


def test_spaced_words_equal_the_tokenizer(monkeypatch):
    rng, encoder = random.Random(9), packing.SpacedEncoder(PATH)
    parts = [" ", "\n", "a", "B", ",", "é", ".", "12", "  ", "'s", "\r", "ª", "×", "🙂", "word", "-", "\u00a0", "\u0301", "ß", "字", "<|endoftext|>"]
    texts = ["", " ", "  ", "a  b", " a", "a ", "\n", "a \n b"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    for chars in (packing.MEMO_CHARS, 500):  # with a memory that is full again and again
        monkeypatch.setattr(packing, "MEMO_CHARS", chars)
        for at in range(0, len(texts), 700):
            assert encoder.batch(pa.array(texts[at:at + 700])) == encoder.raw(texts[at:at + 700])


def test_fast_merges_give_the_tokenizers_ids():
    encoder = packing.SpacedEncoder(PATH)
    assert encoder.fast is not None
    rng = random.Random(12)
    words = ["".join(chr(rng.choice([rng.randrange(97, 123), rng.randrange(33, 0x250), rng.randrange(0x250, 0xD000)])) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    words = [w for w in words if not any(c.isspace() for c in w)]
    quick = encoder.spaced(words)
    encoder.fast = None
    assert quick == encoder.raw([" " + w for w in words]) == encoder.spaced(words)
    other = Tokenizer.from_file(P.path("word_bpe_49k.json"))  # another kind of file: no short cut
    assert packing.same_merges(other) is None


def test_slices_hold_every_text_once():
    texts = pa.array(["a" * n for n in (5, 0, 30, 1, 1, 1, 9)])
    got = [t.to_pylist() for t in packing.by_size(texts, 10)]
    assert [t for part in got for t in part] == texts.to_pylist() and [len(p) for p in got] == [2, 1, 3, 1]
    assert list(packing.by_size(pa.array([], pa.string()))) == []
