import zlib

import numpy as np

from oreline.llm import language

from .helpers import LONG, documents

SAY = {
    "en": "the of and with that this from shall house water people under never".split(),
    "de": "der die und nicht straße über können wasser haus menschen immer unter".split(),
    "fr": "le la les été maison être avec beaucoup eau toujours français sous".split(),
}


def corpus(n=60):
    rng = np.random.default_rng(2)
    return [(i, " ".join(rng.choice(SAY[lang], 30)), lang, "s") for i in range(n) for lang in [list(SAY)[i % 3]]]


def test_presence_does_not_depend_on_the_cut(monkeypatch):
    whole, cut = np.zeros(language.CELLS, np.uint8), np.zeros(language.CELLS, np.uint8)
    language.presence(LONG[:5000], whole)
    monkeypatch.setattr(language, "BATCH_CHARS", 64)
    language.presence(LONG[:5000], cut)
    assert (whole == cut).all()


def test_learns_and_handles_odd_rows(spark):
    rows = corpus() + [(100, None, "en", "s"), (101, "", "de", "s"), (102, "123 !? ...", "fr", "s"), (None, "und nicht über die straße", None, None),
                       (103, " ".join(SAY["fr"] * 4000), None, None), corpus()[0]]
    df = documents(spark, rows)
    model = language.learn(df, language.fold() != 2)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(df, model).collect()}
    assert {(i, lang) for i, _, lang, _ in corpus()} <= got
    assert {(100, "und"), (101, "und"), (102, "und"), (None, "de"), (103, "fr")} <= got
    scores = [r.score for r in language.identify(df, model).collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores)


def test_held_out_rows_are_not_learnt(spark):
    rows = corpus()
    poisoned = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    model = language.learn(documents(spark, poisoned), language.fold() != 2)
    assert model.languages == ["de", "en", "fr"]


def test_weights_equal_the_kernel_form(spark):
    rows = corpus(30)
    df = documents(spark, rows)
    sample = language.training_sample(df, language.fold() != 9, 1024, "doc_id", "text", "lang")
    model = language.fit(sample, 15, 0.1)

    def cells(packed):
        x = np.unpackbits(np.stack(packed), axis=1).astype(float)
        return x / np.sqrt(x.sum(axis=1, keepdims=True))

    chosen = [c for lang in model.languages for c in [c for other, c in sample if other == lang][:5]]
    z, x = cells(chosen), cells([c for _, c in sample])
    kn, kz = x @ z.T, z @ z.T
    y = np.array([[1.0 if lang == other else -1.0 for other in model.languages] for lang, _ in sample])
    normal = kn.T @ kn + 0.1 * kz
    a = np.linalg.solve(normal + 1e-6 * np.trace(normal) / len(z) * np.eye(len(z)), kn.T @ y)
    assert np.allclose(kn @ a, x @ model.weights, atol=1e-3)


def test_no_labels_and_no_rows(spark):
    df = documents(spark, [(1, "some words")])
    assert [(r.lang_pred, r.score) for r in language.identify(df, language.learn(df, language.fold() != 9)).collect()] == [("und", 0.0)]
    empty = documents(spark, [])
    assert language.identify(empty, language.learn(empty, language.fold() != 2)).collect() == []


def test_sample_is_bounded(spark):
    assert len(language.training_sample(documents(spark, corpus()), language.fold() != 9, 5, "doc_id", "text", "lang")) == 15


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.learn(docs, language.fold() != 2)).join(docs.select("doc_id", "lang"), "doc_id").where(language.fold() == 2)
    assert found.where("lang = lang_pred").count() / found.count() > 0.98
