"""Small inputs with columns whose names clash with the operators' own."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, ids string, score double, node long, cls string, "
          "lang_pred string, row string, h string, n string, text_ string, part int, text_hash_ string, id_ string, key_ string, hash_ string, kept_id string, kept_key string")


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else (None, None)), None if r[1] is None else len(r[1]), *[None] * 16) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = ("Na palavra longa não há nada 12345 " * 9000).strip()
