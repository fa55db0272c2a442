import random
import re

import regex
from pyspark.sql import functions as F

from oreline.llm import secret_scan as S

from .helpers import documents

HEX = "0123456789abcdef0123456789abcdef01234567"


def labelled(spark, n=40):
    rows = []
    for i in range(n):
        key = f"{i * 7919 + 104729:08x}9f3ce1a07b5d42688ac91f03d7be5521"
        rows += [(3 * i, f'so the api_key = "{key}" is here', "en", "src/app"), (3 * i + 1, f"paid with 4{i:03d}123412341234 today commit {key}", "en", "tests/x"),
                 (3 * i + 2, f"see some-long-name-{i}-of-a-page and 123e4567-e89b-12d3-a456-4266141740{i:02d}", "en", "docs")]
    return documents(spark, rows)


def test_candidates_have_their_places(spark):
    text = f"é {HEX} x=ABCDEFGHIJKLMNOP1, abcdefghijklmnopqrstuvwxyz a1b2 🙂{'9' * 16}"
    got = documents(spark, [(1, text)]).select(S.candidates(F.col("text")).alias("c")).first().c
    assert [(c.start, c.candidate) for c in got] == [(m.start(), m.group()) for m in re.finditer(r"[A-Za-z0-9_+/=-]{16,}", text) if re.search("[0-9]", m.group())]
    assert got[0].before == "é " and got[1].before.endswith(" ") and got[-1].after == ""


def test_labels(spark):
    rows = {f'token = "{HEX}"': 1.0, f"password: '{HEX}'": 1.0, "GITHUB_TOKEN=ghp_" + "a1B2" * 9: None, f"commit {HEX}": 0.0, "4111111111111111": 0.0, f"hash of {HEX}": None}
    df = documents(spark, list(enumerate(rows)))
    got = {r.text: r.label for r in df.select("text", F.explode(S.candidates(F.col("text"))).alias("c")).select("text", S.rule_label(F.col("c")).alias("label")).collect()}
    assert got == rows


def test_forest_tells_secrets_from_others(spark):
    df = labelled(spark)
    forest = S.learn(df)
    assert len(forest.trees) == S.TREES
    new = documents(spark, [
        (1, f'secret_token = "{HEX}" and more', "en", "src/main"), (1, f'secret_token = "{HEX}" and more', "en", "src/main"),
        (2, f"digest {HEX} of it", "en", "tests/a"), (3, "card 4111111111111111 ok", None, None), (None, f'password="{HEX}"é', None, None),
        (4, None), (5, ""), (6, "word " * 60_000 + f'the access_key: "{HEX}" end', "en", "src")])
    got = S.scan(new, forest).collect()
    found = sorted(((r.doc_id, [(s.start, s.end) for s in r.secrets], r.redacted if r.redacted is None else len(r.redacted)) for r in got), key=repr)
    one = (1, [(16, 56)], 16 + 8 + 10)
    assert found == sorted([one, one, (2, [], 53), (3, [], 24), (None, [(10, 50)], 20), (4, [], None), (5, [], 0),
                            (6, [(300_017, 300_057)], 300_000 + 17 + 8 + 5)], key=repr)
    masked = next(r.redacted for r in got if r.doc_id == 1)
    assert masked == 'secret_token = "<secret>" and more' and got[0].row.doc_id in (1, 2, 3, 4, 5, 6, None)


def test_forest_expression_equals_the_trained_model(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    df = labelled(spark)
    words = S.dictionary(df, "text")
    findings = S.rule_findings(df, words).where("label is not null").cache()
    forest = S.train(findings, words)
    model = RandomForestClassifier(numTrees=S.TREES, maxDepth=S.DEPTH, seed=11, labelCol="label", featuresCol="vector") \
        .fit(VectorAssembler(inputCols=S.FEATURES, outputCol="vector").transform(findings))
    both = model.transform(VectorAssembler(inputCols=S.FEATURES, outputCol="vector").transform(findings)) \
        .withColumn("own", forest.score({n: F.col(n) for n in S.FEATURES}))
    assert both.where((F.col("own") > 0.5).cast("double") != F.col("prediction")).count() == 0


def test_given_findings_decide(spark):
    df = labelled(spark)
    words = S.dictionary(df, "text")
    none = S.rule_findings(df, words).selectExpr(*S.FEATURES, "0.0 AS label")
    assert all(not r.secrets for r in S.scan(df, S.learn(df, none)).collect())


def test_empty_table_and_one_class(spark):
    empty = documents(spark, [])
    assert S.scan(empty, S.learn(empty)).collect() == []
    plain = documents(spark, [(1, "4111111111111111")])
    assert S.learn(plain).trees == [0.0] and S.scan(plain, S.learn(plain)).first().secrets == []


def test_no_python_in_the_plan(spark):
    df = labelled(spark, 3)
    plan = S.scan(df, S.Forest([0.0], ["the"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_planted_tokens_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: [(s.start, s.end) for s in r.secrets] for r in S.scan(docs, S.learn(docs)).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == [m.span(1) for m in re.finditer('token = "([0-9a-f]{40})"', r.text)]


KEYS = ["AKIA" + "Q7ZX" * 4, "ghp_" + "a1B2" * 9, "glpat-" + "x9_Yz" * 4, "xoxb-" + "12345678901-" * 2 + "abcDEF", "xoxb-abcdefghij-klmnopqrst-uvwxyz",
        "sk_live_" + "abcd" * 6, "sk_live_" + "a1b2" * 6, "AIza" + "Sy1-_" * 7]


def test_values_are_taken_without_their_names(spark):
    wanted = {f"see {k} here": k for k in KEYS} | {f'x "{k}" y': k for k in KEYS} | {f"{n}={k}": k for k in KEYS for n in ("GITHUB_TOKEN", "x", "MY_NAME")} | {
        f"https://a.b/?q=1&api_key={HEX}&z": HEX, f"HASH={HEX} x": HEX, 'password = "hunter2!"': "hunter2!", "password: p@ss.word$1, then": "p@ss.word$1",
        "DB_PASSWORD=Tr0ub4dor&3": "Tr0ub4dor", "secret_key='correcthorsebattery'": "correcthorsebattery", f"plain {HEX}.": HEX, "auth_token=abcdefgh": "abcdefgh",
        "QUJDREVGR0hJSktMTU5P1234Ug==": "QUJDREVGR0hJSktMTU5P1234Ug=="}
    got = documents(spark, list(enumerate(wanted))).select("text", S.candidates(F.col("text"), S.VALUE).alias("c")).collect()
    assert {r.text: [(c.start, c.candidate) for c in r.c] for r in got} == {t: [(t.index(v), v)] for t, v in wanted.items()}


def test_published_keys_are_secrets_however_they_stand(spark):
    forest = S.learn(labelled(spark))
    texts = [f for k in KEYS for f in (f"see {k} here", f'x = "{k}" y', f"GITHUB_TOKEN={k}", f"u?api_key={k}&z")]
    found = S.scan(documents(spark, [(i, t, "en", "docs") for i, t in enumerate(texts)]), forest).collect()
    assert all(S.MASK in r.redacted and not any(k in r.redacted for k in KEYS) for r in found) and len(found) == len(texts)
    labels = documents(spark, list(enumerate(texts))).select(F.explode(S.candidates(F.col("text"), S.VALUE)).alias("c")).select(S.rule_label(F.col("c")).alias("l")).collect()
    assert {r.l for r in labels} == {1.0}


def test_short_and_open_passwords_are_found(spark):
    rows = [(i, f'{n} = "{v}"', "en", "src") for i, (n, v) in enumerate((n, f"{v}{j}") for j in range(20) for n in ("password", "api_key") for v in ("hunter2!", "p@ss.word$1", "Tr0ub4dor"))]
    rows += [(1000 + i, f"paid 4{i:03d}123412341234 commit {HEX} and some-long-name-{i}-of-a-page", "en", "src") for i in range(60)]
    df = documents(spark, rows)
    got = {r.doc_id: r.redacted for r in S.scan(df, S.learn(df)).collect()}
    assert all(got[i] == t.split('"')[0] + '"<secret>"' for i, t, *_ in rows[:120]) and all(S.MASK not in got[i] for i, *_ in rows[120:])


def test_only_secrets_labelled_and_few_among_many(spark, monkeypatch):
    df = documents(spark, [(1, f'token = "{HEX}"'), (2, f"see {HEX} there")])
    assert {r.doc_id: len(r.secrets) for r in S.scan(df, S.learn(df)).collect()} == {1: 1, 2: 0}
    monkeypatch.setattr(S, "FINDINGS", 40)
    rows = [(i, f"paid 4{i:04d}12341234123 today") for i in range(3000)] + [(9000 + i, f'token = "{HEX}"') for i in range(6)]
    df = documents(spark, rows)
    assert {r.doc_id for r in S.scan(df, S.learn(df)).collect() if r.secrets} == {9000 + i for i in range(6)}


def values_by_looking_back(text):
    """(start, value) by the definition, place by place: what stands before a place decides what may begin there."""
    named = r"(?i:token|secret|passwd|password|api.?key|access.?key|private.?key|credential|bearer|auth)[A-Za-z0-9_-]{0,16}"
    sign, run = r"[\"']?\s{0,4}[:=]{1,2}>?\s{0,4}", r"(?=[A-Za-z_+/=-]*[0-9])[A-Za-z0-9_+/=-]{16,}"
    key = rf"(?:{'|'.join(S.KEYS)})(?![A-Za-z0-9_-])"
    name = r"(?<![A-Za-z0-9_+/=-])[A-Za-z_][A-Za-z0-9_-]{0,63}="
    held, open_ = rf"(?![A-Za-z0-9_-]*{named}(?:=[^=\s]|{sign}[\"'`]?(?![=:>])[^\s\"'`,;&<>(){{}}\[\]]))", r"[^\s\"'`,;&<>(){}\[\]]"
    named_run, no_secret, signed = regex.compile(run), regex.compile(held), regex.compile(named + "[\"']?\\s{1,4}$")
    after = [
        (regex.compile(named + sign + "[\"'`]$"), regex.compile("[^\\s\"'`]++(?=[\"'`])")),
        (regex.compile(named + sign + "$"), regex.compile(rf"(?![=:>]){open_}*(?![.?:])(?!\s){open_}")),
        (regex.compile("(?<![A-Za-z0-9_-])$"), regex.compile(key)),
        (regex.compile(name + "$"), named_run),
        (regex.compile("(?<![A-Za-z0-9_+/=-])$"), regex.compile(rf"(?!{name[len('(?<![A-Za-z0-9_+/=-])'):]}(?:{key}|{run})){held}{run}")),
    ]
    found, at, done = [], 0, 0
    while at < len(text):
        if text[at] in "=:" and signed.search(text, max(done, at - 120), at):  # a sign is no part of a value
            at += 1
            continue
        for before, value in after:
            lead = before.search(text, max(done, at - 120), at)
            if lead and (not lead[0].endswith("=") or value is not named_run or no_secret.match(text, lead.start())) and (m := value.match(text, at)):
                found.append((at, m.group()))
                at = done = m.end()  # what belongs to a value is no name for the next
                break
        else:
            at += 1
    return found


PARTS = ["token", "my_secret_key", "API-KEY", "password", "author", "key", "name", "HASH", "commit", "x", " = ", "=", ": ", ":", " ", "\n", ' = "', '"', "'", "`", "==", " => ", ",", "; ", ".",
         HEX, "hunter2!", "a1b2c3d4e5f6a7b8", "correcthorsebattery", "some-long-name-of-a-page", "1234567890123456", "AKIA" + "Q7ZX" * 4, "ghp_" + "a1B2" * 9, "/", "é", "plain words here"]


def test_values_equal_those_found_by_looking_back(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: [(c.start, c.candidate) for c in r.c] for r in df.select("doc_id", S.candidates(F.col("text"), S.VALUE).alias("c")).collect()}
    wrong = [(t, got[i], values_by_looking_back(t)) for i, t in enumerate(texts) if got[i] != values_by_looking_back(t)]
    assert not wrong, (len(wrong), wrong[:5])
