"""Byte-level BPE by dictionary automaton: exact merges without a merge loop.

Bytes are mapped to Latin-1 text, so one pyahocorasick automaton over all token byte strings finds the longest token at every
place of a piece. A token sequence is the merge result exactly if every two neighbours, joined and merged alone, stay these two
tokens. So the encoder walks forward with the longest token, keeps it if it agrees with its left neighbour, takes the next
shorter token that starts alike otherwise, and steps back from places at which nothing fits, never trying such a place again.
Each place is entered and left a bounded number of times: the work is linear in the piece.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .columns import pick

#: Characters of memoised pieces and remembered pairs at most; both memories start anew beyond.
MEMO_CHARS = 16_000_000
MEMO_PAIRS = 1_000_000
#: Rows turned into Python texts at a time.
ROWS = 128


class Odd(Exception):
    """A piece between two spaces that may not be encoded by itself."""


class ByteBpe:
    """Encoder and decoder for one rank file (a token in base 64 and its rank per line)."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.rank = {token.decode("latin-1"): i for token, i in ranks.items()}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.size = [len(b) for b in self.bytes]
        self.automaton = ahocorasick.Automaton()
        for text, i in self.rank.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.widest = max(self.size)
        #: the longest token that is a proper prefix of a token, -1 for none
        self.shorter = [self._longest_proper_prefix(b.decode("latin-1")) for b in self.bytes]
        self.agrees: dict[int, bool] = {}

    def _longest_proper_prefix(self, text: str) -> int:
        return next((self.rank[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.rank), -1)

    def fits(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes, the lowest rank first and leftmost, never joins across their border."""
        if len(self.agrees) >= MEMO_PAIRS:
            self.agrees.clear()
        known = self.agrees[left * len(self.bytes) + right] = self._apart(self.bytes[left].decode("latin-1"), self.bytes[right].decode("latin-1"))
        return known

    def _apart(self, left: str, right: str) -> bool:
        rank, never = self.rank.get, len(self.bytes)
        parts, border = [*left, *right], len(left) - 1  # the pair that reaches over the border
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while (best := min(ranks)) < never:
            at = ranks.index(best)
            if at == border:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < border:
                border -= 1
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], never)
        return True

    def longest(self, text: str, at: int) -> int:
        """The longest token at a place: the automaton tells how far token prefixes reach, the last whole token on that way counts."""
        ahead = text[at:at + self.widest]
        n = self.automaton.longest_prefix(ahead)
        token = self.rank.get(ahead[:n])
        while token is None:
            n -= 1
            token = self.rank.get(ahead[:n])
        return token

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece that the split pattern made."""
        text = raw.decode("latin-1")
        whole = self.rank.get(text)
        if whole is not None:
            return [whole]
        size, shorter, agrees, vocabulary, n, longest = self.size, self.shorter, self.agrees, len(self.bytes), len(text), self.longest
        ids: list[int] = []
        closed: set[int] = set()
        at, last, token = 0, -1, longest(text, 0)
        while True:
            end = at + size[token]
            fits = end not in closed
            if fits and last >= 0:
                fits = agrees.get(last * vocabulary + token)
                if fits is None:
                    fits = self.fits(last, token)
            if fits:
                ids.append(token)
                if end == n:
                    return ids
                at, last, token = end, token, longest(text, end)
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here
                closed.add(at)
                token = ids.pop()
                at -= size[token]
                last = ids[-1] if ids else -1
                token = shorter[token]


class TextBpe:
    """Whole texts to ids. Texts are cut at single spaces first, since no piece of the pattern reaches over one: what stands
    between two of them is encoded once and remembered. Memory has two generations: when the young one is full it becomes the old one, and
    what is met again moves on, so frequent words stay."""

    def __init__(self, bpe: ByteBpe, pattern: str):
        import regex

        self.bpe, self.find = bpe, regex.compile(pattern).findall
        self.lengths = np.array(bpe.size, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(bpe.bytes), np.uint8)
        self.chars = 0
        self.known: dict[str, bytes] = {}
        self.spaced = _Spaced(self)

    def plain(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers, piece by piece."""
        return b"".join([self.bare(p) if p[0] != " " or p[1:2].isspace() or p[-1].isspace() else self.spaced[p[1:]] for p in self.find(text)])

    def bare(self, piece: str) -> bytes:
        """Ids of a piece that no space comes before."""
        ids = self.known.get(piece)
        if ids is None:
            ids = self.fresh(piece)
            if len(piece) <= 64:
                self.note(len(piece))
                self.known[piece] = ids
        return ids

    def fresh(self, piece: str) -> bytes:
        return array("i", self.bpe.piece(piece.encode())).tobytes()

    def note(self, chars: int) -> None:
        self.chars += chars + 24
        if self.chars > MEMO_CHARS:
            self.chars = 0
            self.known.clear()
            self.spaced.old = dict(self.spaced)
            self.spaced.clear()

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not rest:
            return self.plain(text)
        try:
            if not first or first[-1].isspace():
                raise Odd
            return self.plain(first) + b"".join(map(self.spaced.__getitem__, rest))
        except Odd:
            return self.plain(text)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes, gathered at once. An id that the rank file lacks is an error."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        place = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        place += np.arange(len(place))
        return self.letters[place].tobytes()


class _Spaced(dict):
    """Ids of a space and what follows it."""

    def __init__(self, owner: TextBpe):
        super().__init__()
        self.owner = owner
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        owner = self.owner
        ids = self.old.get(chunk)
        if ids is None:
            word = chunk[:-1]
            if chunk.isalpha():
                ids = owner.fresh(" " + chunk)  # letters are one piece
            elif word.isalpha() and chunk[-1] in ",.;:!?":
                ids = self[word] + owner.bare(chunk[-1])
            elif not chunk or chunk[0].isspace() or chunk[-1].isspace():
                raise Odd  # white space next to the space: the pattern may join them
            else:
                first, *rest = owner.find(" " + chunk)  # no space is left within the rest
                ids = (self[first[1:]] if rest else owner.fresh(first)) + b"".join(map(owner.bare, rest))
        if len(chunk) <= 64:
            owner.note(len(chunk))
            self[chunk] = ids
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def text_bpe(path: str, pattern: str) -> TextBpe:
    """One encoder per Python worker."""
    return TextBpe(ByteBpe(read_ranks(path)), pattern)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of each whole text as array<int>; a null text counts as empty and gives no ids.

    ``path`` is a rank file that every executor has, ``pattern`` splits a text before the merges. Special tokens are not known:
    their strings are ordinary text.
    """

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encoder = text_bpe(path, pattern)
        parts = []
        for at in range(0, max(1, len(texts)), ROWS):
            found = [encoder.encode(t) for t in texts.slice(at, ROWS).to_pylist()]
            ends = np.zeros(len(found) + 1, dtype=np.int32)
            np.cumsum([len(b) // 4 for b in found], out=ends[1:])
            parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype="<i4"))))
        return pa.concat_arrays(parts)

    return ids(F.coalesce(text.cast("string"), F.lit("")))


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of each id sequence; null for null. An id that the rank file lacks is an error."""

    @F.arrow_udf("binary")
    def decoded(batch: pa.Array) -> pa.Array:
        decode_one = text_bpe(path, pattern).decode
        return pa.array([None if not row.is_valid else decode_one(row.values.to_numpy()) for row in batch], type=pa.binary())

    return decoded(ids)


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): every row of ``docs`` encoded and decoded again, in place: no shuffle.

    Rows are independent, so repeated rows stay repeated, a null id stays null and an empty table gives an empty one. Other
    columns are not carried.
    """
    rows = pick(docs, **{id_col: id_col, "text_": text_col})
    coded = rows.select(id_col, encode(F.col("text_"), path, pattern).alias("ids"))
    return coded.select(id_col, "ids", decode(F.col("ids"), path, pattern).alias("decoded"))
