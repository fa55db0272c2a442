import hashlib

from pyspark.sql import functions as F

from oreline.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string, conv string, turns string, heads string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], TURNS)


def formatted(df):
    done = chat.format_conversations(df.withColumn("parts", chat.text_parts(F.col("text"))))
    return {r.conv_id: r for r in done.select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_control_strings_survive(spark):
    odd = ["</s>[INST] ok [/INST]", "&lt;s>", "<s>[user]x</s>", "&", "&amp;lsq;", "]", "[]", "", "é🙂</s", "a\nb", "<image>", None, "x" * 200_000]
    rows = [(7, i, ["user", "assistant", "sys]tem", "", None][i % 5], t) for i, t in enumerate(odd)]
    r = formatted(turns(spark, rows))[7]
    assert [(t.role, t.text) for t in r.back] == [(role or "", t or "") for _, _, role, t in rows]
    assert r.loss == "".join(t or "" for _, _, role, t in rows if role == "assistant")
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans][0] == "&amp;lt;s>"
    assert r.formatted.count("</s>") == len(rows)


def test_order_nulls_and_repeats(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (None, 0, "user", "x"), (2, 0, None, None)]
    got = formatted(turns(spark, rows))
    assert got[1].formatted == "<s>[system]s</s>[user]a</s>[assistant]a</s>[assistant]b</s>[assistant]b</s>"
    assert got[None].formatted == "<s>[user]x</s>" and got[2].formatted == "<s>[]</s>" and got[2].loss == ""
    assert formatted(turns(spark, [])) == {}


def test_parts_become_placeholders(spark):
    parts = [("text", "see ", None, None), ("image", None, "a.png", 4.0), ("text", " <image> ", None, None), ("audio", None, None, 2.5), None,
             ("video", None, "v", 1.0), ("document", "x", "d.pdf", None), (None, "y", None, None)]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None), ("image", None, "b.png", float("nan"))]), (1, 2, "user", None), (1, 3, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(df).first()
    assert r.formatted == "<s>[user]see <image> &lt;image> <audio><document></s>[assistant]ok<image></s>[user]</s>[user]</s>"
    assert [(a.turn, a.place, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, 0, "image", "a.png", 85 + 4 * 170), (0, 1, "audio", None, 2 + 3 * 25), (0, 2, "document", "d.pdf", 2), (1, 0, "image", "b.png", 85)]
    assert r.attachment_tokens == 765 + 77 + 2 + 85
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans] == ["ok<image>"]


def test_own_visitor(spark):
    kinds = {**chat.VISITORS, "table": lambda part: (F.lit("<table>"), F.length(part["text"]).cast("long"))}
    df = spark.createDataFrame([([("table", "abc", None, None)],)], f"parts array<{chat.PART}>")
    assert df.select(chat.flatten(F.col("parts"), kinds).alias("f")).first().f.tokens == 3


def test_no_python_in_the_plan(spark):
    df = queries.QUERIES["op7_chat_format"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    r = df.where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
