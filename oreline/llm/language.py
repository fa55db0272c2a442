"""Language identification by string kernels: blended-spectrum presence, Nystroem landmarks, one-versus-rest kernel ridge regression.

A text is the set of its character n-grams of all lengths from 1 to ``ORDER`` (presence, not counts), hashed into ``CELLS`` cells.
The kernel of two texts is the number of shared cells over the root of the product of their sizes. Landmarks Z are a sample of
labelled texts; regression in the space they span solves (Kn'Kn + r Kz) a = Kn'Y, with Kn the kernel of training texts and
landmarks and Y one column per language (+1 or -1). A batch of texts X is scored by matrix products: K(X, Z) a = X (Z'a), each row
scaled by its size; Z'a is computed once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .columns import pick

#: Longest n-gram and number of cells.
ORDER, CELLS = 4, 1 << 16
#: Rows scored by one matrix product, and characters hashed at a time.
BATCH_ROWS, BATCH_CHARS = 64, 1 << 18
UNKNOWN = "und"
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B))


def presence(text: str, row: np.ndarray) -> None:
    """Set the cells of a text's n-grams to 1. Case, and the width and kind of what is not a letter, do not matter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    step = BATCH_CHARS
    for at in range(0, len(codes), step):
        part = codes[max(0, at - ORDER + 1):at + step].copy()
        part[part < 65] = 32  # digits, punctuation and white space
        h = np.zeros(len(part), np.uint32)
        for n in range(1, ORDER + 1):
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * _MIX[0] + part[n - 1:] + np.uint32(n)
            cell = h ^ (h >> np.uint32(15))
            cell *= _MIX[1]
            row[cell >> np.uint32(16)] = 1


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # CELLS x languages: Z'a


def fit(rows: list[tuple[str, np.ndarray]], landmarks: int, ridge: float) -> Model:
    """``rows`` are (language, packed cells). Landmarks are taken from all languages alike."""
    languages = sorted({lang for lang, _ in rows})
    by = {lang: [r for r in rows if r[0] == lang] for lang in languages}
    share = max(1, landmarks // max(1, len(languages)))
    chosen = [r for lang in languages for r in by[lang][:share]]
    if not chosen:
        return Model([], np.zeros((CELLS, 0), np.float32))

    def cells(part):
        x = np.unpackbits(np.stack([c for _, c in part]), axis=1).astype(np.float32)
        x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        return x

    z = cells(chosen)
    kz = z @ z.T
    normal, target = ridge * kz.astype(np.float64), np.zeros((len(chosen), len(languages)))
    for at in range(0, len(rows), BATCH_ROWS):  # few rows at a time: the driver holds the landmarks and little else
        part = rows[at:at + BATCH_ROWS]
        k = (cells(part) @ z.T).astype(np.float64)
        y = np.where(np.array([[lang == other for other in languages] for lang, _ in part]), 1.0, -1.0)
        normal += k.T @ k
        target += k.T @ y
    normal += 1e-6 * np.trace(normal) / len(chosen) * np.eye(len(chosen))
    return Model(languages, (z.T @ np.linalg.solve(normal, target)).astype(np.float32))


def training_sample(docs: DataFrame, allowed: Column, per_language: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, np.ndarray]]:
    """At most ``per_language`` labelled rows of each language (those with the smallest hash), as packed cells: what is brought to
    the driver is bounded by that number and not by the texts."""
    rows = pick(docs.where(allowed), id=id_col, text=text_col, lang=lang_col).where("lang is not null and text rlike '\\\\p{L}'")
    keyed = rows.select("lang", F.xxhash64("id", "text").alias("h"))
    best = keyed.distinct().withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("at") <= per_language).drop("at")
    # the sample has at most per_language rows a language: a side of known size
    texts = rows.withColumn("h", F.xxhash64("id", "text")).join(F.broadcast(best), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))

    def packed(batches):
        for batch in batches:
            out = []
            for text in batch.column(2):
                row = np.zeros(CELLS, np.uint8)
                presence(text.as_py(), row)
                out.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["lang", "h", "cells"])

    found = texts.mapInArrow(packed, "lang string, h long, cells binary").collect()
    return [(r.lang, np.frombuffer(r.cells, np.uint8)) for r in sorted(found, key=lambda r: (r.h, r.lang))]


def predicted(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct(lang_pred, score) of a text column.

    Every n-gram of the whole text counts. ``score`` is the share of the best language in the softmax of the regression values, 0
    to 1. A text that is null or has no letter is ``und`` with score 0, as is every text if the model knows no language. Ties go
    to the first language in alphabetical order.
    """
    shared = spark.sparkContext.broadcast(model)  # CELLS x languages numbers

    @F.arrow_udf("lang_pred string, score double")
    def scored(texts: pa.Array) -> pa.Array:
        import regex
        known = shared.value
        letter = regex.compile(r"\p{L}").search
        lang, score, places = [UNKNOWN] * len(texts), [0.0] * len(texts), []
        block = np.zeros((BATCH_ROWS, CELLS), np.float32)

        def flush():
            x = block[:len(places)]
            value = (x @ known.weights) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
            odds = np.exp(4 * (value - value.max(axis=1, keepdims=True)).astype(np.float64))
            for j, at in enumerate(places):
                best = int(odds[j].argmax())
                lang[at], score[at] = known.languages[best], float(odds[j, best] / odds[j].sum())
            x[:] = 0
            places.clear()

        for i, text in enumerate(texts):
            text = text.as_py()
            if text and known.languages and letter(text):
                presence(text, block[len(places)])
                places.append(i)
                if len(places) == BATCH_ROWS:
                    flush()
        if places:
            flush()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return scored.asNondeterministic()(text.cast("string"))  # so that a filter on it does not run it again


def learn(docs: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 1024, landmarks: int = 256, ridge: float = 0.1) -> Model:
    """A model from the labelled rows where ``allowed`` holds: a sample of at most ``per_language`` rows a language."""
    return fit(training_sample(docs, allowed, per_language, id_col, text_col, lang_col), landmarks, ridge)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row of ``docs``, in place; repeated rows and null ids stay as they are."""
    return docs.select(docs[f"`{id_col}`"], predicted(docs.sparkSession, docs[f"`{text_col}`"], model).alias("found")).select(id_col, "found.*")


def fold(id_col: str = "doc_id") -> Column:
    """Remainder that holds rows out: CRC-32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
