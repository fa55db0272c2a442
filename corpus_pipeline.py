"""Documents to packed training sequences: language, near copies, secrets, packing.

Each stage works on all its predecessor kept and returns the columns of ``documents`` (the last one returns packed pieces). Null ids,
null texts and repeated rows are ordinary rows: a text without letters is rejected by the first stage, repeated rows are copies for
the second. Extra columns are carried along by the first three stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from oreline.llm import language, minhash, packing, secret_scan
from oreline.session import adopt, keep_table

#: A prediction below this is a rejection: with four languages, hardly more than a draw.
LEAST_SCORE = 0.3


def columns_of(docs: DataFrame, changed: dict[str, Column], held: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of ``row``, some of them changed."""
    return held.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a missing label is filled in."""
    adopt(spark)
    model = language.learn(docs, language.fold() != 2)
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), language.predicted(spark, docs["text"], model).alias("found"))
    kept = held.where((F.col("found.lang_pred") != language.UNKNOWN) & (F.col("found.score") >= LEAST_SCORE))
    return columns_of(docs, {"lang": F.coalesce("row.lang", "found.lang_pred")}, kept)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the one with the smallest id, null ids last,
    and among rows of one id the one with the smallest text key."""
    adopt(spark)
    rows = minhash.grouped(docs, 5, 80, "doc_id", "text")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key")).distinct()
    key = F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"))
    # the row in a struct of its own: other columns may have any name
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].alias("id_"), key.alias("key_"), F.xxhash64(docs["text"]).alias("hash_"))
    marked = held.join(kept, (F.col("key_") == F.col("kept_key")) & F.col("id_").eqNullSafe(F.col("kept_id")), "left_semi")
    return columns_of(docs, {}, marked.dropDuplicates(["id_", "hash_"]))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced in its text and its length counted anew."""
    adopt(spark)
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    return columns_of(docs, {"text": F.col("redacted"), "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType)}, found)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    adopt(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", identify_language), ("near_copies", drop_near_copies), ("secrets", redact_secrets), ("packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what a stage returns is stored and read again as the next one's documents."""
    docs = adopt(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
