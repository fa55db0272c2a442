"""I-Match fingerprints over randomised lexicons.

The lexicon is the band of terms that are neither too common nor too rare in the corpus, by inverse document frequency. A text keeps its
distinct terms of that band, sorted; each randomised lexicon keeps a part of them, and their hash is one part of the fingerprint.
The lexicons keep 1/2, 1/4, 1/8 ... of the band, several of each size, so that short and long texts both have parts that survive an
edit. Likeness is the share of equal parts at the size where it is largest.

Document frequencies are counted per term over the whole corpus. What every task needs to know of the band is a blocked Bloom filter
sized from the counted vocabulary, ``BITS`` bits for each term of the band: all terms of the band are in it, and of the others fewer than
one in a thousand, whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import keep_table

#: Cells of the frequency table; sizes of randomised lexicons (halves of halves) and lexicons of each size (32 bits of a draw each).
CELLS, SIZES, EACH = 1 << 20, 12, 4
#: The filter: bits for each term, bits set for each term, bits of a block. Wrongly inside: (1 - exp(-PROBES / BITS)) ** PROBES = 0.0006.
BITS, PROBES, BLOCK = 16, 8, 1 << 16
#: Distinct terms counted in a Python worker before they are handed on; longer terms are counted by a digest of 256 bits.
FLUSH_TERMS, LONG_TERM = 400_000, 64
#: The band: normalised inverse document frequency, log(N / df) / log(N), between these.
LOW, HIGH = 0.3, 0.95
EMPTY = "0" * 8


def terms_of(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").split())


def key_of(term: bytes) -> bytes:
    return term if len(term) <= LONG_TERM else hashlib.blake2b(term, digest_size=32).digest()


def term_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(key, n): how many rows hold each term, counted within tasks first."""
    def counted(batches):
        held: Counter = Counter()

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["key", "n"])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    held.update({t if len(t) <= LONG_TERM else key_of(t) for t in terms_of(text)})
                    if len(held) > FLUSH_TERMS:
                        yield flushed()
                        held.clear()
        yield flushed()

    return texts.select(texts[f"`{text_col}`"].cast("string")).mapInArrow(counted, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def places(digests: np.ndarray) -> np.ndarray:
    """Bits of a block that each 64-bit digest sets, one row a digest."""
    d = digests.astype(np.int64).view(np.uint64)
    first, step = d >> np.uint64(48), d >> np.uint64(32) & np.uint64(0xFFFF) | np.uint64(1)
    return (first[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None] & np.uint64(BLOCK - 1)).astype(np.int64)


def packed_terms(digests: DataFrame, bits_each: int = BITS) -> bytes:
    """The filter of a stored column of digests: blocks are filled in tasks, their bytes collected."""
    blocks = max(1, -(-digests.count() * bits_each // BLOCK))

    @F.arrow_udf("binary")
    def filled(lists: pa.Array) -> pa.Array:
        out = []
        for held in lists:
            bits = np.zeros(BLOCK, np.uint8)
            bits[places(held.values.to_numpy()).ravel()] = 1
            out.append(np.packbits(bits).tobytes())
        return pa.array(out, pa.binary())

    grouped = digests.groupBy(F.pmod("digest", F.lit(blocks)).alias("block")).agg(F.collect_list("digest").alias("digests"))
    found = {r.block: r.bits for r in grouped.select("block", filled("digests").alias("bits")).collect()}
    return b"".join([found.get(b, bytes(BLOCK // 8)) for b in range(blocks)])


def cell_counts(texts: DataFrame, text_col: str) -> np.ndarray:
    """Rows per cell of a table of fixed size: how many rows hold a term of the cell. A bounded overview; the lexicon counts terms."""
    def counted(batches):
        import xxhash
        known: dict[bytes, int] = {}
        held = np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    terms = terms_of(text)
                    if len(known) > 400_000:
                        known.clear()
                    for t in [t for t in terms if t not in known]:
                        known[t] = xxhash.xxh3_64_intdigest(t) % CELLS
                    cells = np.fromiter(map(known.__getitem__, terms), np.int64, len(terms))
                    held[np.unique(cells)] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["cell", "n"])

    found = texts.select(texts[f"`{text_col}`"].cast("string")).mapInArrow(counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def band(counts: np.ndarray, total: int, low: float = LOW, high: float = HIGH) -> bytes:
    """Packed bits: cells whose terms belong to the lexicon."""
    idf = np.log(max(total, 2) / np.maximum(counts, 1)) / np.log(max(total, 2))
    return np.packbits((counts > 0) & (idf >= low) & (idf <= high)).tobytes()


class TermFilter:
    """Looks keys up in what ``packed_terms`` made."""

    def __init__(self, packed: bytes):
        self.packed, self.blocks = packed, len(packed) * 8 // BLOCK

    def inside(self, key: bytes) -> bool:
        import xxhash
        digest = xxhash.xxh64_intdigest(key, seed=42)  # Spark's xxhash64, whose remainder is that of the signed number
        base = (digest - (digest >> 63 << 64)) % self.blocks * BLOCK
        first, step = digest >> 48, digest >> 32 & 0xFFFF | 1
        for probe in range(PROBES):
            at = base + (first + probe * step & BLOCK - 1)
            if not self.packed[at >> 3] >> (7 - (at & 7)) & 1:
                return False
        return True


class Fingerprints(TermFilter):
    """Fingerprints by one band; remembers what it knows of a term."""

    def __init__(self, packed: bytes):
        super().__init__(packed)
        self.known: dict[bytes, tuple[int, ...]] = {}

    def lexicons(self, term: bytes) -> tuple[int, ...]:
        """Numbers of the randomised lexicons that keep the term; none outside the band."""
        import xxhash
        if not self.inside(key_of(term)):
            return ()
        draw = xxhash.xxh3_128_intdigest(term, seed=7)
        out = []
        for copy in range(EACH):
            # the lexicon of share 2 ** -size keeps the terms whose draw ends in that many zero bits
            bits = draw >> 32 * copy & 0xFFFFFFFF
            zeros = (bits & -bits).bit_length() - 1 if bits else 32
            out += [EACH * size + copy for size in range(min(SIZES, zeros))]
        return tuple(out)

    def of(self, text: str) -> str:
        """Hash parts joined by dots, ``00000000`` where a lexicon keeps nothing of the text; a text without a term of the
        band is fingerprinted by all its terms, an empty one by none."""
        terms = terms_of(text)
        if len(self.known) > 400_000:
            self.known.clear()
        for t in [t for t in terms if t not in self.known]:
            self.known[t] = self.lexicons(t)
        kept: list[list[bytes]] = [[] for _ in range(SIZES * EACH)]
        known = self.known
        for t in sorted([t for t in terms if known[t]]):
            for k in known[t]:
                kept[k].append(t)
        if not any(kept):
            kept[0] = [b"\n", *sorted(terms)] if terms else []
        return ".".join([hashlib.blake2b(b"\n".join(part), digest_size=4).hexdigest() if part else EMPTY for part in kept])


@lru_cache(maxsize=2)
def by_band(packed: bytes) -> Fingerprints:
    """One per Python worker and band."""
    return Fingerprints(packed)


def likeness(a: str, b: str) -> float:
    """Over the sizes of lexicons, the largest share of equal parts among those filled in either text (two at least); 1 for
    equal fingerprints. Small lexicons survive edits of long texts, large ones tell short texts apart."""
    if a == b:
        return 1.0
    x, y, best = a.split("."), b.split("."), 0.0
    for at in range(0, SIZES * EACH, EACH):
        filled = [(p, q) for p, q in zip(x[at:at + EACH], y[at:at + EACH]) if p != EMPTY or q != EMPTY]
        if len(filled) >= 2:
            best = max(best, sum(p == q for p, q in filled) / len(filled))
    return best


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> bytes:
    """The band of a corpus, as a filter; null texts count as documents without terms."""
    total = max(docs.count(), 2)
    idf = F.log(F.lit(total) / F.col("n")) / math.log(total)
    kept = term_counts(docs, text_col).where((idf >= low) & (idf <= high)).select(F.xxhash64("key").alias("digest"))
    return packed_terms(keep_table(kept, "band"))


def fingerprints(docs: DataFrame, packed: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text, in place. A null text counts as empty; equal texts have equal fingerprints, repeated
    rows and null ids are kept as they are, other columns are not carried."""
    shared = docs.sparkSession.sparkContext.broadcast(packed)  # BITS bits for each term of the band

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        own = by_band(shared.value)
        return pa.array([own.of(t) for t in texts.to_pylist()], pa.string())

    return docs.select(docs[f"`{id_col}`"], made(F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))).alias("fingerprint"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, last, id, h, text) laid out so that each row's next document, by descending id, follows it in the same partition.

    Ids are cut into ranges by quantiles, one range a partition; the first document of a range is repeated (``last`` = 1) at the end of
    the range before, that of the first range at the end of the last one. Texts are shuffled once and ranges are streamed, so
    no order over all rows is ever built in one task. Rows with one id are ordered by a hash of the text; null ids come last.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    cuts = sorted(set(rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] or [])) if parts > 1 else []
    part = F.coalesce(F.size(F.filter(F.lit(cuts), lambda c: c > F.col("id"))) if cuts else F.lit(0), F.lit(len(cuts)))
    dealt = rows.withColumn("part", part.cast("int"))
    # one row a range
    firsts = sorted((r.part, r.id) for r in dealt.groupBy("part").agg(F.max("id").alias("id")).collect())
    before = [firsts[-1][0], *[p for p, _ in firsts[:-1]]] if firsts else []
    ends = spark.createDataFrame([(p, q) for (p, _), q in zip(firsts, before)], "part int, to int")
    wanted = [i for _, i in firsts if i is not None]
    of_none = F.col("id").isNull() if any(i is None for _, i in firsts) else F.lit(False)
    halo = dealt.where(F.col("id").isin(wanted) | of_none).groupBy("part").agg(F.max_by("text", F.xxhash64("text")).alias("text")) \
        .join(F.broadcast(ends), "part").select(F.col("to").alias("part"), F.lit(1).alias("last"), F.lit(None).alias("id"), "text")
    both = dealt.select("part", F.lit(0).alias("last"), "id", "text").unionByName(halo)
    return both.repartitionById(len(cuts) + 1, F.col("part")) \
        .sortWithinPartitions("part", "last", F.desc_nulls_last("id"), F.desc(F.xxhash64("text")))


def edit_probe(docs: DataFrame, packed: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How far fingerprints survive an edit: (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last third (rounded down) replaced by the first as many code points of the next document by descending
    id, that of the last document by those of the first. Null texts count as empty; a single document is its own next one.
    """
    laid = with_next(docs, id_col, text_col).select("part", "last", "id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(packed)  # BITS bits for each term of the band
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(id_col, laid.schema["id"].dataType), *[T.StructField(n, t) for n, t in zip(names[1:], kinds)]])

    def probed(batches):
        own = by_band(shared.value)
        held = None
        for batch in batches:
            out = []
            for last, i, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                text = text.as_py()
                mark = own.of(text)
                if held is not None:
                    held_id, held_text, held_mark = held
                    third = len(held_text) // 3
                    edited = held_text[:len(held_text) - third] + text[:third]
                    edited_mark = own.of(edited)
                    out.append((held_id, len(held_text), hashlib.sha256(edited.encode()).hexdigest(), held_mark, edited_mark,
                                likeness(held_mark, edited_mark), likeness(held_mark, mark)))
                held = None if last else (i, text, mark)
            columns = list(zip(*out)) if out else [[] for _ in names]
            arrow = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow)], names=names)

    return laid.mapInArrow(probed, schema)
