"""Best-fit packing of tokenised documents into sequences, certified by dual feasible functions.

Documents longer than a sequence are cut so that only their first piece is shorter than a sequence; full pieces are sequences
of their own. The short pieces (at most one per document) are dealt into groups of bounded size, each packed best-fit decreasing.
A dual feasible function maps piece lengths so that no sequence holds more than one unit; the sum over a group, rounded up, is a
lower bound of its number of sequences. A group that meets its bound is certified and done. The pieces of the other groups are
dealt anew among fewer groups and packed again, as long as this saves sequences.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from functools import lru_cache
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import keep_table
from .columns import field, pick

#: Pieces per group (memory of one task) and dealings at most.
GROUP_ITEMS = 131_072
ROUNDS = 3
#: Letters of every Unicode version, before an ASCII character that is none.
HEAD = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[\\x00-@[-`{-\\x7f])")
#: Words encoded at once, bytes of texts looked up at once, characters of remembered words.
ENCODED, SLICE, MEMO_CHARS = 4096, 1_500_000, 8_000_000
#: Bits of a sequence number that count sequences within a group.
WITHIN = 1 << 36


# fixed value: how a byte-level file splits a text before its merges
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def same_merges(tokenizer):
    """An encoder of the same ids over the vocabulary of a byte-level file, several times as fast; none unless the file's merges are in the
    order of their ids and nothing but the usual split comes before them."""
    import tiktoken

    held = json.loads(tokenizer.to_str())
    model, split = held["model"], held.get("pre_tokenizer") or {}
    plain = held.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [model["vocab"].get("".join(m)) for m in merges]
    if model.get("type") != "BPE" or not plain or None in ids or ids != sorted(ids) or model.get("ignore_merges"):
        return None
    # printable bytes stand for themselves, the others for the characters from 256 on
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    special = {t["content"] for t in held.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    single = [ranks.get(bytes([b])) for b in range(256)]
    if None in single or max(single) > min(ids, default=1 << 31):
        return None
    return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class SpacedEncoder:
    """ids by a tokenizers file; what stands between two single spaces is encoded once and remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.met: set[str] = set()
        self.chars = 0
        vocab = self.tokenizer.get_vocab()
        space = np.frombuffer(self.raw([" "])[0], "<u4")
        mark = self.tokenizer.id_to_token(int(space[0])) if len(space) == 1 else None
        self.begins = np.zeros(max(vocab.values()) + 1, bool)  # tokens that begin with a space
        self.begins[[i for t, i in vocab.items() if mark and t.startswith(mark)]] = True
        self.fast = same_merges(self.tokenizer)

    def forget(self) -> None:
        """Keep only words that were met again: the next task may be of another stage, but if it is of this one, it meets them too."""
        known, old = self.known, self.old
        self.old = {w: ids for w in self.met if (ids := known.get(w) or old.get(w))}
        self.known, self.tails, self.met, self.chars = {}, {}, set(), 0

    def raw(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in coded]

    def spaced(self, words: list[str]) -> list[bytes]:
        """Ids of a space and each word, encoded as one text: no other space is in it, so each token that begins with one begins a word."""
        if not words:
            return []
        if len(words) > ENCODED:  # an encoding takes far more memory than its ids
            return [ids for at in range(0, len(words), ENCODED) for ids in self.spaced(words[at:at + ENCODED])]
        text = " " + " ".join(words)
        flat = self.raw([text])[0] if self.fast is None else np.asarray(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        cuts = (4 * np.flatnonzero(self.begins[np.frombuffer(flat, "<u4")])).tolist()
        if len(cuts) != len(words):
            return self.raw([" " + w for w in words])
        return [flat[a:b] for a, b in zip(cuts, [*cuts[1:], len(flat)])]

    def runs(self, words: list[str]) -> list[bytes | None]:
        """Ids of a space and each of distinct words; none where white space stands next to the space, as the pattern may join them.

        A word is split behind its first letters, where the pattern splits it anyway: both parts are known more often.
        """
        if self.chars > MEMO_CHARS:  # the full memory stays as the old one: what is met again moves on
            self.old, self.known, self.tails, self.met, self.chars = self.known, {}, {}, set(), 0
        known, old, tails = self.known, self.old, self.tails
        found = list(map(known.get, words))
        self.met.update(compress(words, found))
        need, split, more = [], [], set()
        for w in [w for w, ids in zip(words, found) if ids is None]:
            if w in old:
                known[w] = old[w]
                self.met.add(w)
            elif w.isalpha():
                need.append(w)
            elif w and not w[0].isspace() and not w[-1].isspace():
                head = HEAD.match(w)
                if head:
                    split.append((w, head[0], w[head.end():]))
                else:
                    need.append(w)
        new = set(need)
        for _, head, tail in split:
            if head not in known and head not in new:
                new.add(head)
                need.append(head)
            if tail not in tails:
                more.add(tail)
        known.update(zip(need, self.spaced(need)))
        more = list(more)
        tails.update(zip(more, self.raw(more) if more else ()))
        known.update([(w, known[head] + tails[tail]) for w, head, tail in split])
        self.chars += sum(map(len, need)) + sum(map(len, more)) + sum([len(w) for w, _, _ in split]) + 24 * (len(need) + len(more) + len(split))
        return [known.get(w) if ids is None else ids for w, ids in zip(words, found)]

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers. Distinct words are looked up; their ids are gathered by place."""
        parts = pc.split_pattern(texts, " ")
        begin = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        firsts = [coded.dictionary[i].as_py() for i in at[begin]]
        runs = self.runs(coded.dictionary.to_pylist())
        at[begin] = len(runs) + np.arange(len(firsts))
        odd = np.array([r is None for r in runs] + [False] * len(firsts))[at]
        sizes = np.diff(np.append(begin, len(at)))
        strange = np.add.reduceat(odd, begin) > 0
        strange |= (sizes > 1) & np.array([not f or f[-1].isspace() for f in firsts])
        runs = [r or b"" for r in runs] + self.raw(firsts)
        length = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        start = np.cumsum(length) - length
        each = length[at]
        ends = np.cumsum(each)
        place = np.repeat(start[at] - (ends - each), each)
        place += np.arange(len(place))
        ids = memoryview(np.frombuffer(b"".join(runs), "<u4")[place]).cast("B")
        cuts = [0, *(4 * ends[begin + sizes - 1]).tolist()]
        whole = texts.filter(pa.array(strange)).to_pylist()
        again = iter(self.raw(whole)) if whole else iter(())
        return [next(again) if s else bytes(ids[a:b]) for s, a, b in zip(strange.tolist(), cuts, cuts[1:])]


@lru_cache(maxsize=2)
def spaced_encoder(path: str) -> SpacedEncoder:
    """One encoder per Python worker."""
    return SpacedEncoder(path)


def by_size(texts: pa.Array, most: int = SLICE):
    """Slices of a batch with about ``most`` bytes each, so that long texts do not add up in memory."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(at, to - at)
        at = to


def token_lengths(docs: DataFrame, path: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, crcs, full): ids of each document with the closing id, CRC-32 of each piece's little-endian 32-bit ids, and the
    number of its first full piece (below zero, counted down within the partition, so that no two full pieces share one)."""
    rows = pick(docs, **{id_col: id_col, "text_": text_col}).withColumn("text_", F.coalesce(F.col("text_").cast("string"), F.lit("")))
    close = int(end_id).to_bytes(4, "little")

    def lengths(batches):
        gc.disable()  # nothing here is cyclic, and each collection would walk all remembered words
        try:
            yield from encoded(batches)
        finally:
            gc.enable()
            spaced_encoder(path).forget()  # the worker's next task may be of another stage

    def encoded(batches):
        encoder = spaced_encoder(path)
        full = -1 - (TaskContext.get().partitionId() << 40)
        for batch in batches:
            n, crcs, fulls = [], [], []
            for texts in by_size(batch.column(1)):
                for ids in encoder.batch(texts):
                    ids = memoryview(ids + close)
                    total = len(ids) // 4
                    first = first_length(total, size)
                    cuts = [0, *range(first, total + 1, size)]
                    n.append(total)
                    crcs.append([zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(cuts, cuts[1:])])
                    fulls.append(full)
                    full -= total // size
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(fulls, pa.int64())],
                names=[id_col, "n", "crcs", "full"])

    schema = T.StructType([field(rows, id_col), T.StructField("n", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType())),
                           T.StructField("full", T.LongType())])
    return rows.mapInArrow(lengths, schema)


def first_length(n: int, size: int) -> int:
    """Length of the first piece: what full pieces leave over."""
    return n if n <= size else n % size or size


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: (bin, offset) per piece and the number of bins.

    Rooms left are whole numbers, so open bins are kept by room and a bit set tells the smallest room that suffices.
    """
    rooms: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets, count, free = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = free >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                free &= ~(1 << room)
        else:
            room, at, count = size, count, count + 1
        bins[i], offsets[i] = at, size - room
        if room > n:
            rooms[room - n].append(at)
            free |= 1 << (room - n)
    return bins, offsets, count


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Sequences that pieces need at least; ``counts[n]`` pieces have length n.

    Two families of dual feasible functions: one counts a piece over ``size - k`` as a whole sequence and drops pieces under k,
    the other rounds a piece's share down to multiples of 1/k; their compositions are dual feasible too.
    """
    n = np.arange(size + 1)
    best = 0
    for k in range(size // 2 + 1):
        cut = np.where(n > size - k, size, np.where(n < k, 0, n))
        best = max(best, -(-int((counts * cut).sum()) // size))
    for k in range(1, 21):
        whole = (n * (k + 1)) % size == 0
        share = np.where(whole, n * k, (n * (k + 1)) // size * size)  # in units of size * k
        best = max(best, -(-int((counts * share).sum()) // (size * k)))
    return best


def pack_lengths(items: DataFrame, size: int, group_items: int = GROUP_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """(row, sequence_id, offset, certified) for items (row long, rest long) with 0 < rest < size.

    ``row`` numbers are distinct. Groups are dealt by a hash of the row number, so no group grows with a hot source or many
    equal documents. ``certified`` tells that the item's group met its lower bound.
    """
    def packed(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["rest"].to_numpy(np.int64)
        bins, offsets, count = best_fit(lengths, size)
        bound = lower_bound(np.bincount(lengths, minlength=size + 1), size)
        return pd.DataFrame({"row": group["row"], "rest": lengths, "sequence_id": group["group"].to_numpy(np.int64) * WITHIN + bins,
                             "offset": offsets, "bins": count, "gap": count - bound, "group": group["group"]})

    spark = items.sparkSession
    schema = "row long, rest long, sequence_id long, offset long, bins long, gap long, group long"
    done, left, base, before = [], items, 0, None
    for turn in range(rounds):
        n = left.count()
        if not n:
            break
        groups = -(-n // group_items)
        dealt = left.select("row", "rest", (F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)) + base).alias("group"))
        tried = keep_table(dealt.groupBy("group").applyInPandas(packed, schema), "packed")
        per_group = tried.groupBy("group").agg(F.max("bins").alias("bins"), F.max("gap").alias("gap"))
        bins, loose, open_bins = per_group.agg(F.sum("bins"), F.sum(F.when(F.col("gap") > 0, F.col("bins"))), F.count_if(F.col("gap") > 0)).first()
        if before is not None and bins >= before[1]:
            break  # dealing anew saved nothing: the earlier packing stays
        if before is not None:
            done.append(before[0].where("gap = 0"))
        before, left, base = (tried, loose or 0), tried.where("gap > 0").select("row", "rest"), base + groups
        if not open_bins or groups == 1:
            break
    if before is None:
        return spark.createDataFrame([], "row long, sequence_id long, offset long, certified boolean")
    done.append(before[0])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row", "sequence_id", "offset", (F.col("gap") == 0).alias("certified"))


def pack_documents(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                   group_items: int = GROUP_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """Every document's pieces and their places: (id, piece, start, length, ids_crc32, sequence_id, offset, certified).

    A document is its ids and then ``end_id``; null text counts as empty, so every document has a piece. Repeated rows are
    packed each for itself and a null id stays null. Texts are read once and never shuffled: token counts and checksums are kept
    in the shared folder, and only lengths are packed. Sequences of full pieces are numbered below zero.
    """
    found = keep_table(token_lengths(docs, path, end_id, size, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "lengths")
    items = found.select("row", F.pmod("n", F.lit(size)).alias("rest")).where("rest > 0")
    placed = pack_lengths(items, size, group_items, rounds)
    first = F.when(F.col("rest") > 0, F.col("rest")).otherwise(size)
    pieces = (
        found.withColumn("rest", F.pmod("n", F.lit(size))).join(placed, "row", "left")
        .select(id_col, "full", "rest", "sequence_id", "offset", "certified", F.posexplode("crcs").alias("piece", "ids_crc32"))
    )
    short = (F.col("piece") == 0) & (F.col("rest") > 0)
    return pieces.select(
        id_col, F.col("piece").cast("int").alias("piece"),
        F.when(F.col("piece") == 0, F.lit(0).cast("long")).otherwise(first + (F.col("piece") - 1) * size).alias("start"),
        F.when(short, F.col("rest")).otherwise(F.lit(size).cast("long")).alias("length"),
        "ids_crc32",
        F.when(short, F.col("sequence_id")).otherwise(F.col("full") - F.col("piece") + (F.col("rest") > 0).cast("int")).alias("sequence_id"),
        F.when(short, F.col("offset")).otherwise(F.lit(0).cast("long")).alias("offset"),
        F.coalesce(F.when(short, F.col("certified")), F.lit(True)).alias("certified"),
    )
