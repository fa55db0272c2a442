from functools import lru_cache

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from oreline.llm import bpe

from .helpers import LONG, documents

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@lru_cache
def merge_rule():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture
def oracle():
    return merge_rule()


def ids(text):
    import numpy as np
    return np.frombuffer(bpe.text_bpe(PATH, PATTERN).encode(text), "<i4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab ,.'s\n\té́世🙂", max_size=80), st.lists(st.sampled_from(
    ["the", " ", "  ", "\n", "don't", "aaaaaaaa", "ééé", " 12", "<|endoftext|>", "\x1c", "\xa0", "==="]), max_size=25).map("".join)))
def test_same_ids_as_the_merge_rule(text):
    assert ids(text) == merge_rule().encode_ordinary(text)


def test_long_runs_and_small_memory(oracle, monkeypatch):
    for text in ("a" * 5000, " " * 3000 + "x", "ab" * 4000, "=" * 700, "é" * 900, LONG):
        assert ids(text) == oracle.encode_ordinary(text)
    monkeypatch.setattr(bpe, "MEMO_CHARS", 200)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 10)
    assert ids(LONG + " anders geschrieben") == oracle.encode_ordinary(LONG + " anders geschrieben")


def test_rows(spark, oracle):
    rows = [(1, "Hello, world"), (1, "Hello, world"), (None, "été  \n x"), (2, None), (3, ""), (4, LONG)]
    got = bpe.encode_texts(documents(spark, rows), PATH, PATTERN).collect()
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=repr) == \
        sorted(((i, oracle.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=repr)
    assert bpe.encode_texts(documents(spark, []), PATH, PATTERN).collect() == []


def test_decode_of_null(spark):
    df = spark.createDataFrame([(None,), ([],), ([464, 995],)], "ids array<int>")
    assert [r[0] if r[0] is None else bytes(r[0]) for r in df.select(bpe.decode(df.ids, PATH, PATTERN)).collect()] == [None, b"", b"The world"]
