"""One registered query per operator, over whole tables and whole texts, with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import adopt
from . import bpe, cells, chat, imatch, language, licenses, minhash, neighbours, packing, pii, prefix_trie, secret_scan, whitening
from .columns import sha256_hex

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(adopt(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    found = language.identify(docs, language.learn(docs, language.fold() != 2))
    return found.select("doc_id", F.coalesce(language.fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op2_license_scan(spark, sf):
    found = licenses.scan(table(spark, sf, "documents"))
    shown = F.transform("licenses", lambda f: F.concat_ws(":", f["name"], f["start"].cast("string"), f["end"].cast("string")))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(shown, ",").alias("spans"),
        F.array_max(F.transform("licenses", lambda f: f["dice"])).alias("best_dice"),
    )


@query
def op3_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_nearest_neighbours(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("id") % 50 == 0)


@query
def op5_secret_scan(spark, sf):
    docs = table(spark, sf, "documents")
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    return found.select(
        "doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"),
        F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
        F.array_max(F.transform("secrets", lambda s: s["score"])).alias("score"), sha256_hex(F.col("redacted")).alias("redacted_sha256"),
    )


@query
def op6_byte_bpe(spark, sf):
    coded = bpe.encode_texts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op7_chat_format(spark, sf):
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    done = chat.format_conversations(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    read = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"),
        sha256_hex(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha256_hex(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL["op7_chat_format"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt,
    length(role || text) + 4 * length(regexp_replace(role || text, '[^&\\[\\]]', '', 'g')) + 3 * length(regexp_replace(role || text, '[^<]', '', 'g')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(string_agg(learnt, '' ORDER BY turn, role, text)) AS loss_chars,
  sha256(string_agg(learnt, '' ORDER BY turn, role, text)) AS loss_sha256,
  3 + sum(chars + 6)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op8_minhash_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), k=2, percent=80)


SQL["op8_minhash_dedup"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (SELECT x, y FROM common WHERE 100 * c >= 80 * (nx + ny - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x
)
SELECT s.doc_id, len(s.s) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""


@query
def op9_imatch(spark, sf):
    docs = table(spark, sf, "documents")
    return imatch.edit_probe(docs, imatch.lexicon(docs))


@query
def op10_pii(spark, sf):
    found = pii.find(table(spark, sf, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), sha256_hex(pii.span_text(F.col("base"))).alias("base_sha256"),
        pii.span_text(F.col("base"), F.concat("terms", "elsewhere")).alias("spans"),
    )


@query
def op11_prefix_trie(spark, sf):
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences(table(spark, sf, "conversations"))))


SQL["op11_prefix_trie"] = """
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda b: ascii(b)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM (SELECT DISTINCT c FROM own)
), turns AS (
  SELECT v.c, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.base AND o.pos <= v.h
  UNION ALL
  SELECT v.c, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h
), placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS depth, length(text) AS chars, sha256(length(role) || ':' || role || text) AS turn FROM turns
), prefixes AS (
  SELECT c, depth, chars, string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM convs
), last AS (SELECT c, max(depth) AS depth FROM prefixes GROUP BY 1),
nodes AS (
  SELECT p.path, any_value(p.depth) AS depth, min(p.c) AS conv_id, count(*) AS n_convs, any_value(p.chars) AS chars,
    sha256(coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (WHERE p.depth = l.depth), '')) AS ends_sha256
  FROM prefixes p JOIN last l USING (c) GROUP BY p.path
), linked AS (
  SELECT n.*, CASE WHEN depth > 0 THEN left(path, length(path) - 64) END AS up FROM nodes n
), kids AS (SELECT up, count(*) AS n_children FROM linked WHERE up IS NOT NULL GROUP BY 1),
sums AS (
  SELECT a.path, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.chars)::BIGINT AS saved_tokens
  FROM linked d JOIN prefixes a ON a.c = d.conv_id AND a.depth <= d.depth LEFT JOIN kids k ON k.up = d.path GROUP BY 1
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM linked n JOIN sums s USING (path) LEFT JOIN kids k ON k.up = n.path LEFT JOIN nodes u ON u.path = n.up
"""


@query
def op12_embedding_dedup(spark, sf):
    return cells.near_vectors(table(spark, sf, "embeddings"), 0.98)


SQL["op12_embedding_dedup"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98::DOUBLE
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
), named AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT n.vec_id, coalesce(c.n, 0) AS n_links, n.component_id, n.vec_id = n.component_id AS kept
FROM named n LEFT JOIN counted c ON c.x = n.vec_id
"""


@query
def op13_embedding_whitening(spark, sf):
    return whitening.whitened(table(spark, sf, "embeddings"), 16)
