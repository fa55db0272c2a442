"""Near copies by circulant MinHash, banding and exact Jaccard similarity.

Two permutations serve a whole signature: every shingle is placed by the first, and coordinate k is the smallest value the second,
shifted by k places around the circle, gives to any of them. Bands of coordinates make candidates; set sizes, a
sketch of one bit per coordinate and a parity table drop most false ones inside the join; the full shingle sets decide.

Texts with equal sets are one class, so copies are never paired. Classes of a bucket are not paired all with all either: each is
compared with the bucket's hub (eight orders choose hubs, so a class meets several), components are formed, and then only pairs
whose classes are still in different components are compared, every one of them. Links inside a component that is already joined
cannot change the result, so components equal those of all candidate pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.components import star_forest
from ..session import keep_table
from .columns import field, pick

COORDINATES = 192
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 32 = 3e-6.
BANDS, ROWS = 32, 5
ORDERS = 8
#: Cells of the parity table.
CELLS = 1024
LONGS = (COORDINATES + CELLS) // 64
_PLACE, _VALUE = np.uint32(0x9E3779B1), (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(raw: bytes) -> list[bytes]:
    """Words between space and the control characters 9 to 13 of a UTF-8 text, A to Z lower-cased."""
    return raw.lower().split()


def shingle_set(raw: bytes, k: int) -> set:
    """Distinct runs of k words; with fewer words the whole sequence is the only one; none without words."""
    words = words_of(raw)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(k)]))


def similar(a: set, b: set, percent: int) -> bool:
    if not a or not b:
        return False
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)


class WordHashes(dict):
    """64-bit hash per word, remembered up to a bound."""

    def __init__(self):
        import xxhash

        super().__init__()
        self.of = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        found = self.of(word)
        if len(word) <= 48:
            if len(self) > 500_000:
                self.clear()
            self[word] = found
        return found


def shingle_hashes(raw: bytes, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = words_of(raw)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ (out >> np.uint64(29))) * _STEP + h[i:len(words) - k + 1 + i]
    out = (out ^ (out >> np.uint64(32))) * _STEP
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Circulant MinHash over the circle of 2 ** 32 places."""
    place = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    place ^= place >> np.uint32(15)
    place *= _PLACE  # the first permutation
    shift = np.arange(COORDINATES, dtype=np.uint32)[:, None]
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(place), 1024):
        x = place[None, at:at + 1024] - shift
        t = x >> np.uint32(16)
        x ^= t
        x *= _VALUE[0]
        np.right_shift(x, np.uint32(13), out=t)
        x ^= t
        x *= _VALUE[1]  # the second permutation
        np.right_shift(x, np.uint32(16), out=t)
        x ^= t
        np.minimum(out, x.min(axis=1), out=out)
    return out


def bands_of(sig: np.ndarray) -> np.ndarray:
    parts = sig[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = (key ^ (key >> np.uint64(31))) * _STEP + parts[:, i]
    key = (key ^ (key >> np.uint64(32))) * _STEP
    return (key ^ (key >> np.uint64(29))).view(np.int64)


def sketch_of(sig: np.ndarray) -> np.ndarray:
    """The last bit of every coordinate."""
    return np.packbits((sig & np.uint32(1)).astype(np.uint8)).view(np.int64)


def parity_of(hashes: np.ndarray) -> np.ndarray:
    """One bit per cell: whether an odd number of shingles fall there. Common shingles cancel out between two sets, so the
    bits in which two sets differ are never more than the shingles in which they do."""
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_different_bits(percent: int) -> int:
    """Bits in which sketches of a pair at the threshold differ at most: mean and five deviations."""
    p = (1 - percent / 100) / 2
    return math.ceil(COORDINATES * p + 5 * math.sqrt(COORDINATES * p * (1 - p)))


def sets_by_row(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, cls, n_shingles, bands, sketch) per row; no class, bands and sketch for an empty set."""
    rows = pick(docs, **{id_col: id_col, "text_": text_col}).withColumn("text_", F.coalesce(F.col("text_").cast("string"), F.lit("")).cast("binary"))

    def sketched(batches):
        hashes = WordHashes()
        for batch in batches:
            out = {"text_key": [], "cls": [], "n_shingles": [], "bands": [], "sketch": []}
            for raw in batch.column(1):
                raw = raw.as_py()
                found = shingle_hashes(raw, k, hashes)
                sig = signature(found) if len(found) else None
                out["text_key"].append(hashlib.md5(raw).hexdigest())
                out["cls"].append(None if sig is None else hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                out["n_shingles"].append(len(found))
                out["bands"].append(None if sig is None else bands_of(sig))
                out["sketch"].append(None if sig is None else np.concatenate([sketch_of(sig), parity_of(found)]))
            types = (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(out.values(), types)]], names=[id_col, *out])

    longs = T.ArrayType(T.LongType())
    return rows.mapInArrow(sketched, T.StructType([
        field(rows, id_col), T.StructField("text_key", T.StringType()), T.StructField("cls", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("bands", longs), T.StructField("sketch", longs)]))


def may_link(a: str, b: str, percent: int) -> Column:
    """What a pair must meet, without its sets: a size bound and a bound on the parity bits that differ (both certain), and one on
    the signature bits that differ (five deviations)."""
    bits = [F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(LONGS)]
    signs, odd = bits[:COORDINATES // 64], bits[COORDINATES // 64:]
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return (100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")) \
        & (sum(signs[1:], signs[0]) <= most_different_bits(percent)) & ((100 + percent) * sum(odd[1:], odd[0]) <= (100 - percent) * both)


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full shingle sets are similar enough; ``texts`` has one text per node."""
    both = pairs.join(texts.select(F.col("node").alias("src"), F.col("raw").alias("left_raw")), "src") \
        .join(texts.select(F.col("node").alias("dst"), F.col("raw").alias("right_raw")), "dst") \
        .select("src", "dst", "left_raw", "right_raw")

    def check(batches):
        for batch in batches:
            left_of = right_of = None
            keep = []
            for s, d, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if s != left_of:
                    left_of, left = s, shingle_set(a.as_py(), k)
                if d != right_of:
                    right_of, right = d, shingle_set(b.as_py(), k)
                keep.append(similar(left, right, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "src long, dst long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of ``docs``.

    Two texts are linked if ``100 * common >= percent * union`` for their sets of k-word shingles; the component id is the smallest
    id reachable. Null, empty and wordless texts have an empty set and are linked with nothing (their component is their own id).
    Texts with equal sets are one class, so ties and repeated rows share a component; a row whose id is null can be a member
    but never names a component unless all members lack an id. Other columns of ``docs`` are ignored.
    """
    return grouped(docs, k, percent, id_col, text_col).select(id_col, "n_shingles", "component_id") \
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def grouped(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, component_id, text_key, component) per row: what ``near_duplicates`` gives, the MD5 of the text, and a name of the
    component that no other one has, whatever ids repeat."""
    rows = keep_table(sets_by_row(docs, k, id_col, text_col), "shingles")
    classes = keep_table(
        rows.where("cls is not null").groupBy("cls").agg(
            F.min(id_col).alias("least"), F.first("text_key").alias("text_key"), F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("node", F.posexplode("bands").alias("band", "key")).withColumn("turn", F.xxhash64("node", F.col("band") % ORDERS)).drop("band")
    shared = buckets.groupBy("key").agg(F.min("turn").alias("first_turn"), F.count("*").alias("size")).where("size > 1").drop("size")
    members = keep_table(buckets.join(shared, "key").join(classes.select("node", "n", "sketch"), "node"), "buckets")

    m, h = members.alias("m"), members.where("turn = first_turn").alias("h")
    first = keep_table(m.join(h, (F.col("m.key") == F.col("h.key")) & (F.col("m.node") != F.col("h.node")) & may_link("m", "h", percent))
                       .select(F.least("m.node", "h.node").alias("src"), F.greatest("m.node", "h.node").alias("dst")).distinct(), "pairs")
    wanted = members.select("node").distinct().join(classes.select("node", "text_key"), "node")
    raws = pick(docs, text_=text_col).select(F.coalesce(F.col("text_").cast("string"), F.lit("")).cast("binary").alias("raw"))
    texts = keep_table(raws.withColumn("text_key", F.md5("raw")).join(wanted, "text_key").groupBy("node").agg(F.first("raw").alias("raw")), "texts")
    links = keep_table(confirmed(first, texts, k, percent), "links")

    forest = star_forest(links)
    label = F.coalesce("dst", "node").alias("label")
    labelled = members.join(forest.withColumnRenamed("src", "node"), "node", "left") \
        .select("key", "node", "n", "sketch", label)
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    open_members = keep_table(labelled.join(mixed, "key"), "open")
    a, b = open_members.alias("a"), open_members.alias("b")
    rest = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label")) & may_link("a", "b", percent)) \
        .select(F.col("a.node").alias("src"), F.col("b.node").alias("dst")).distinct().join(first, ["src", "dst"], "left_anti")
    more = keep_table(confirmed(rest, texts, k, percent), "links")
    if not more.isEmpty():
        forest = star_forest(forest.select("src", "dst").unionByName(more))

    root = classes.select("cls", "least", "node").join(forest.withColumnRenamed("src", "node"), "node", "left").select("cls", "least", label)
    named = root.groupBy("label").agg(F.min("least").alias("component_id"))
    per_class = root.join(named, "label").select("cls", "component_id", "label")
    out = rows.select(id_col, "n_shingles", "text_key", "cls").join(per_class, "cls", "left")
    alone = F.col("cls").isNull()
    own = F.concat_ws(":", F.col(id_col).cast("string"), "text_key")
    return out.select(id_col, "n_shingles", F.when(alone, F.col(id_col)).otherwise(F.col("component_id")).alias("component_id"), "text_key",
                      F.when(alone, own).otherwise(F.col("label").cast("string")).alias("component"))
