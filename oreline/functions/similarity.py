"""Jaro-Winkler similarity over whole Arrow batches."""

from __future__ import annotations

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_CELLS = 1 << 21  # characters of a dense block, bounds the working memory of one task


def _codes(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    padded = np.zeros((len(texts), int(sizes.max(initial=1))), dtype=np.uint32)
    for row, text in enumerate(texts):
        padded[row, : len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return padded, sizes


def _block(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    a, na = _codes(left)
    b, nb = _codes(right)
    n, reach = len(left), np.maximum(np.maximum(na, nb) // 2 - 1, 0)
    hit_a = np.zeros(a.shape, dtype=bool)
    hit_b = np.zeros(b.shape, dtype=bool)
    rows = np.arange(n)
    columns = np.arange(b.shape[1])
    for i in range(a.shape[1]):
        near = (np.abs(columns[None, :] - i) <= reach[:, None]) & (columns[None, :] < nb[:, None])
        free = near & ~hit_b & (b == a[:, i][:, None]) & (i < na)[:, None]
        found = free.any(axis=1)
        hit_b[rows[found], free.argmax(axis=1)[found]] = True
        hit_a[found, i] = True
    matched = hit_a.sum(axis=1)
    # k-th matched character of either side, compared position by position
    order_a = np.argsort(~hit_a, axis=1, kind="stable")
    order_b = np.argsort(~hit_b, axis=1, kind="stable")
    width = min(a.shape[1], b.shape[1])
    seq_a = np.take_along_axis(a, order_a, axis=1)[:, :width]
    seq_b = np.take_along_axis(b, order_b, axis=1)[:, :width]
    swapped = ((seq_a != seq_b) & (np.arange(width)[None, :] < matched[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matched / na + matched / nb + (matched - swapped) / matched) / 3.0
    jaro = np.where(matched > 0, jaro, 0.0)
    head = min(4, width)
    same = (a[:, :head] == b[:, :head]) & (np.arange(head)[None, :] < np.minimum(na, nb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1.0 - jaro), jaro)


def jaro_winkler_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    a = left.fillna("").to_numpy(dtype=object)
    b = right.fillna("").to_numpy(dtype=object)
    # in a large group the same two names meet over and over: each two are compared once a batch
    at_a, at_b = pd.factorize(a)[0], pd.factorize(b)[0]
    _, first, place = np.unique(at_a * np.int64(len(b) + 1) + at_b, return_index=True, return_inverse=True)
    return pd.Series(_compared(a[first], b[first])[place])


def _compared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), dtype=np.float64)
    usable = np.flatnonzero([bool(x) and bool(y) for x, y in zip(a, b)])
    # only similar lengths share a block: a long name widens no other and a block costs what its own names cost
    size = np.fromiter((max(len(a[i]), len(b[i])) for i in usable), dtype=np.int64, count=len(usable))
    order = np.argsort(size, kind="stable")
    usable, size = usable[order], size[order]
    start = 0
    while start < len(usable):
        widest = max(16, int(size[start]) * 5 // 4)
        stop = int(np.searchsorted(size, widest, side="right"))
        stop = min(stop, start + max(1, _CELLS // widest))
        part = usable[start:stop]
        out[part] = _block(a[part], b[part])
        start = stop
    return out


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_batch(left, right)


def jaro_winkler(a: Column, b: Column) -> Column:
    """0.0 when either side is NULL or empty; equal names skip Python."""
    usable = (F.length(a) > 0) & (F.length(b) > 0)
    differ = usable & (a != b)
    asked = _jaro_winkler(F.when(differ, a), F.when(differ, b))
    return F.when(usable & (a == b), F.lit(1.0)).when(differ, asked).otherwise(F.lit(0.0))


# Keys that similar names share. With m characters matched, Jaro similarity is at most (m / n + m / l + 1) / 3 for lengths n and l, and a
# common beginning of p characters adds p tenths of what is missing. So a similarity and a beginning ask for a number of shared
# characters, and sorting characters by rarity, the first few of both names must share as many as one cares to ask for.

#: Below this the prefix bonus does not apply and too few shared characters follow.
PREFIX_FROM = 0.7
#: Shared characters a key is made of, and keys per name and length of the other name, at most.
SHARED, KEYS = 8, 60
_COMMON = " aeinorstlhdcumpgbykvfwzjxq"  # frequent characters of names first; any order is right


def least_jaro(similarity: float, begin: int) -> float:
    """The smallest Jaro similarity with which names that begin with so many equal characters (four count at most) reach a Jaro-Winkler
    similarity above ``PREFIX_FROM``."""
    return max(PREFIX_FROM, (similarity - begin / 10) / (1 - begin / 10))


def shared_needed(n: int, other: int, jaro: float) -> int:
    """Characters two names of these lengths must have in common; more than the shorter has if it can't be."""
    return max(1, math.ceil((3 * jaro - 1) * n * other / (n + other) - 1e-9))


def rare_first(name: str) -> list[str]:
    """Characters with their occurrence, rarest first: a multiset as a set."""
    seen: Counter = Counter()
    marked = []
    for c in name:
        seen[c] += 1
        marked.append((-_COMMON.find(c) if c in _COMMON else -len(_COMMON), -seen[c], c))
    return [f"{c}{-k}" for _, k, c in sorted(marked)]


def keys_of_name(name: str, similarity: float) -> list[str]:
    """Keys of a name: any other name that is similar enough shares one. Names without characters have none, they are similar to nothing."""
    n, out, rare = len(name), [], rare_first(name)
    for begin in range(min(4, n) + 1 if n else 0):
        jaro = least_jaro(similarity, begin)
        short = 3 * jaro - 2  # the other length over this one, at least
        for other in range(max(1, begin, math.ceil(short * n - 1e-9)), math.floor(n / short + 1e-9) + 1):
            needed = shared_needed(n, other, jaro)
            if needed > min(n, other):
                continue
            longer = max(n, other) - needed
            shared = max(k for k in range(1, min(needed, SHARED) + 1) if k == 1 or math.comb(longer + k, k) <= KEYS)
            head = f"{begin}{name[:begin]}:{min(n, other)}:{max(n, other)}:"
            out += [head + "|".join(c) for c in combinations(rare[:n - needed + shared], shared)]
    return out


def name_keys(name: Column, similarity: float) -> Column:
    """array<long>: hashes of ``keys_of_name``; none for a NULL name."""
    @F.pandas_udf("array<string>")
    def keys(names: pd.Series) -> pd.Series:
        return names.map(lambda name: keys_of_name(name, similarity) if name else [])

    return F.transform(keys(name), lambda key: F.xxhash64(key))
