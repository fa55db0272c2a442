"""Personal data: patterns, and terms that reveal protected entities by how they occur together in the corpus.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Every distinct value found is a protected entity. A term of a
document that holds an entity reveals it as far as meeting the term tells that the entity is there: the pointwise mutual information
of both over all documents, as a share of the entity's own information content. Terms whose share reaches ``disclosure`` are generalised
(to their kind: a name, a number, a word) or removed wherever they stand, in any document, like the entities themselves.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import keep_table
from .columns import field, pick
from .imatch import TermFilter, packed_terms

KINDS = ("email", "ip", "card", "phone")
#: Share of an entity's information that a term must give; different texts a pair must be in.
DISCLOSURE, SUPPORT = 0.9, 2
#: Distinct terms counted in a Python worker before they are handed on.
FLUSH_TERMS = 200_000
#: Bits of the filter for each disclosing term: of other terms, common ones too, fewer than one in a million passes.
FILTER_BITS = 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a local part ends at the @ and is taken back from there: the same matches without a search from every letter
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts or ends within a run of digits, so runs are taken whole
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def emails(text: str):
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last


def ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str):
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


_FINDERS = (("email", "@", emails), ("ip", ".", ips), ("card", "", cards), ("phone", "+", phones))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start, in code points."""
    return [(kind, a, b) for kind, sign, find in _FINDERS if sign in text for a, b in find(text)]


def outside(spans: list[tuple[str, int, int]]):
    """Whether a place overlaps no span."""
    merged: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]

    def free(a: int, b: int) -> bool:
        at = bisect_left(starts, b)
        return at == 0 or merged[at - 1][1] <= a

    return free


def terms_in(text: str, spans: list[tuple[str, int, int]]):
    """(term, start, end) for every term of two characters or more that overlaps no span."""
    free = outside(spans)
    for m in _TERM.finditer(text):
        a, b = m.span()
        if b - a > 1 and free(a, b):
            yield m.group().lower(), a, b


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, base, entities, words) per row: h is the text's hash; base spans; distinct entities; distinct terms if there is an entity."""
    rows = hashed(docs, id_col, text_col)
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    base_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    strings = pa.list_(pa.string())

    def scanned(batches):
        for batch in batches:
            base, entities, words = [], [], []
            for text in batch.column(2):
                text = text.as_py()
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                entities.append(list({f"{k}:{text[a:b].lower()}" for k, a, b in spans}))
                words.append(list({t for t, _, _ in terms_in(text, spans)}) if spans else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(base, base_type), pa.array(entities, strings), pa.array(words, strings)],
                                             names=[id_col, "h", "base", "entities", "words"])

    listed = T.ArrayType(T.StringType())
    schema = T.StructType([field(rows, id_col), T.StructField("h", T.LongType()), T.StructField("base", span), T.StructField("entities", listed), T.StructField("words", listed)])
    return rows.mapInArrow(scanned, schema)


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text_) with null texts as empty ones."""
    rows = pick(docs, **{id_col: id_col, "text_": text_col}).withColumn("text_", F.coalesce(F.col("text_").cast("string"), F.lit("")))
    return rows.select(id_col, F.xxhash64("text_").alias("h"), "text_")


def term_documents(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, n): in how many rows each term occurs, counted within tasks first."""
    def counted(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    held.update(set(_TERM.findall(text.lower())))
                    if len(held) > FLUSH_TERMS:
                        yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], names=["term", "n"])
                        held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

    return docs.select(docs[f"`{text_col}`"].cast("string")).mapInArrow(counted, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing(found: DataFrame, docs: DataFrame, text_col: str, disclosure: float, support: int) -> DataFrame:
    """(entity, term) pairs whose mutual information reaches the share ``disclosure`` of the entity's information.

    Pairs are counted over whole documents and over different texts: copies of a text say no more than the text, so an entity and a
    term need ``support`` different texts that hold both. The term's own share is that of all rows, which is no smaller for
    copied text. Pairs are summed within tasks first and meet the entities' and terms' counts as counts, so an entity of very many
    documents is not one task's.
    """
    texts = keep_table(found.where(F.size("entities") > 0).groupBy("h").agg(F.first("entities").alias("entities"), F.first("words").alias("words")), "texts")
    held = texts.select("h", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.count("*").alias("alone")).where(F.col("alone") >= support)
    # ids of texts meet their entities, and only then, by text, the terms
    pairs = held.join(entities.select("entity"), "entity").join(texts.select("h", "words"), "h").select("entity", F.explode("words").alias("term")) \
        .groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= support)
    counted = pairs.join(entities, "entity").join(term_documents(docs, text_col).where(F.col("n") >= support), "term")
    total = found.agg(F.count("*").alias("total"), F.count_distinct("h").alias("texts"))
    shared = F.log(F.col("both") * F.col("total") / (F.col("alone") * F.col("n")))
    own = F.log(F.col("texts") / F.col("alone"))
    return counted.withColumn("one", F.lit(1)).join(F.broadcast(total.withColumn("one", F.lit(1))), "one") \
        .where((own > 0) & (shared >= disclosure * own)).select("entity", "term")


@lru_cache(maxsize=2)
def by_filter(packed: bytes) -> TermFilter:
    """One per Python worker and filter."""
    return TermFilter(packed)


def occurrences(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, start, end): every place of the stored ``terms`` in all texts, once a text, outside base spans. A filter sized from the
    terms lets few other places through, the join with the terms drops these."""
    shared = docs.sparkSession.sparkContext.broadcast(packed_terms(terms.select(F.xxhash64(F.col("term").cast("binary")).alias("digest")), FILTER_BITS))

    def placed(batches):
        own, known = by_filter(shared.value), {}
        for batch in batches:
            out = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if len(known) > 2 * FLUSH_TERMS:
                    known.clear()
                places = []
                for m in _TERM.finditer(text):
                    term = m.group().lower()
                    if (inside := known.get(term)) is None:
                        inside = known[term] = len(term) > 1 and own.inside(term.encode("utf-8", "surrogatepass"))
                    if inside:
                        places.append((term, *m.span()))
                if places:
                    free = outside(base_spans(text))
                    out += [(h, t, a, b) for t, a, b in places if b - a > 1 and free(a, b)]
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["h", "term", "start", "end"])

    found = hashed(docs, id_col, text_col).select("h", "text_").mapInArrow(placed, "h long, term string, start long, end long")
    return found.distinct().join(terms, "term", "left_semi").select("h", "start", "end")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(id, h, base, terms, elsewhere): per row its base spans and the spans of terms that reveal an entity, of this row or another, all by
    place: ``terms`` in a row that has base spans, ``elsewhere`` in a row that has none.

    Null and empty texts have no spans. Equal texts have equal spans, repeated rows stay repeated and a null id stays null; ``h`` is
    the hash of the text. Spans, entities and the distinct terms of rows that hold an entity are shuffled, never texts.
    """
    found = keep_table(scan(docs, id_col, text_col), "entities")
    known = keep_table(disclosing(found, docs, text_col, disclosure, support).select("term").distinct(), "terms")
    marked = occurrences(docs, known, id_col, text_col).groupBy("h").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("marked"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    marks, own = F.coalesce("marked", none), F.size("base") > 0
    return found.select(id_col, "h", "base").join(marked, "h", "left") \
        .select(id_col, "h", "base", F.when(own, marks).otherwise(none).alias("terms"), F.when(own, none).otherwise(marks).alias("elsewhere"))


def span_text(base: Column, terms: Column | None = None) -> Column:
    """kind:start:end, comma-joined: base spans by kind and start, then revealing terms by start."""
    shown = F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    if terms is not None:
        shown = F.concat(shown, F.transform(terms, lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string"))))
    return F.array_join(shown, ",")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove_terms: bool = False, **options) -> DataFrame:
    """(id, text, base, terms): texts with entities replaced by their kind and revealing terms generalised (to <name> if they start with a
    capital, <number> if they start with a digit, <word> else) or, with ``remove_terms``, removed."""
    spans = find(docs, id_col, text_col, **options).select("h", "base", F.concat("terms", "elsewhere").alias("terms")).dropDuplicates(["h"])
    held = hashed(docs, id_col, text_col).join(spans, "h")

    @F.arrow_udf("string")
    def rewritten(texts: pa.Array, base: pa.Array, terms: pa.Array) -> pa.Array:
        out = []
        for text, spans, words in zip(texts.to_pylist(), base.to_pylist(), terms.to_pylist()):
            cuts = [(s["start"], s["end"], f"<{s['kind']}>") for s in spans] + [(w["start"], w["end"], "") for w in words]
            at, parts = 0, []
            for start, end, sign in sorted(cuts):
                if start < at:  # spans of different kinds may overlap: the rest of the later one goes too
                    at = max(at, end)
                    continue
                first = text[start]
                general = "" if remove_terms else "<name>" if first.isupper() else "<number>" if first.isdigit() else "<word>"
                parts += [text[at:start], sign or general]
                at = end
            out.append("".join([*parts, text[at:]]))
        return pa.array(out, pa.string())

    return held.select(id_col, rewritten("text_", "base", "terms").alias(text_col), "base", "terms")
