import importlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from oreline.session import keep_table

from .helpers import documents

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names and all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 14))
    assert set(importlib.import_module("oreline.llm.queries").SQL) <= set(names)


@pytest.mark.parametrize("name", ["op7_chat_format", "op8_minhash_dedup", "op11_prefix_trie", "op12_embedding_dedup"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from checks.compare import compare
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)[0] == "ok"


@pytest.mark.parametrize("name", ["op1_language_id", "op2_license_scan", "op3_best_fit_packing", "op4_nearest_neighbours", "op5_secret_scan", "op6_byte_bpe", "op9_imatch", "op10_pii"])
def test_queries_run_over_all_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    if name.startswith("op4"):
        assert df.select("query_id").distinct().count() == spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 50 = 0").count()
    else:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        assert df.select("doc_id").distinct().count() == docs.count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in pipeline.STAGES[:-1]:
        after = keep_table(stage(spark, seen, SF), name)
        assert after.columns == docs.columns and after.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        if name == "language":
            assert seen.join(after, "doc_id", "left_anti").where(F.col("text").rlike("\\p{L}{20}")).count() == 0
        if name == "near_copies":
            assert after.groupBy("text").count().where("count > 1").count() == 0 and after.count() < seen.count()
        if name == "secrets":
            assert after.where(F.col("text").rlike('token = "[0-9a-f]{40}"')).count() == 0 and after.count() == seen.count()
            assert after.where(F.length("text") != F.col("n_chars")).count() == 0
        seen = after
    packed = pipeline.STAGES[-1][1](spark, seen, SF)
    assert packed.select("doc_id").distinct().count() == seen.count()


def test_odd_documents(spark):
    words = "the of and with that this from shall house water people under never der die und nicht straße".split()
    rows = [(i, " ".join(words[(i * j) % len(words)] + str(i % 3) * (j % 2) for j in range(30)), "en" if i % 2 else "de", "s") for i in range(1, 30)]
    rows += [(1, rows[0][1], "en", "s"), (None, "the people of the house with water", None, None), (None, "the people of the house with water", None, None),
             (50, None), (51, ""), (52, "12 34")]
    seen = documents(spark, rows)
    columns = seen.columns
    for name, stage in pipeline.STAGES[:-1]:
        seen = keep_table(stage(spark, seen, SF), name)
        assert seen.columns == columns
    ids = [r.doc_id for r in seen.collect()]
    assert 50 not in ids and 51 not in ids and 52 not in ids and ids.count(1) == 1 and ids.count(None) == 1
    assert pipeline.pack_sequences(spark, seen, SF).select("doc_id").distinct().count() == len(ids)
    empty = documents(spark, [])
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_copies_under_one_id(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    rows = [(1, a), (1, a + " more"), (None, a + " less"), (None, b), (None, b + " more"), (2, b + " less"), (1, "quite another text of seven words")]
    got = pipeline.drop_near_copies(spark, documents(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text[:2]) for r in got) == [(1, "a0"), (1, "qu"), (2, "b0")]
