"""Chat formatting of typed content parts.

A visitor (one function per part type) turns each part into a text piece, a token count and, for attachments, a reference. The
pieces of a turn are joined in order; a template marks turns:

    <s>[role]text</s>[role]text</s>

Inside roles and texts the characters that the template and the placeholders are made of are written as entities, so that no text
can imitate a mark, and reading back is exact: ``&`` ``<`` ``[`` ``]`` become ``&amp;`` ``&lt;`` ``&lsq;`` ``&rsq;``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .columns import pick

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[", "]"
#: Written in this order, read in the opposite one.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsq;"), ("]", "&rsq;"))
PART = "struct<type:string,text:string,ref:string,units:double>"


def escape(c: Column) -> Column:
    for char, entity in ENTITIES:
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def unescape(c: Column) -> Column:
    for char, entity in reversed(ENTITIES):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def text_part(part: Column) -> tuple[Column, Column]:
    """The escaped text; its tokens are counted by a tokenizer later, so it expands to none here."""
    return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0).cast("long")


def attachment(name: str, base: int, per_unit: int) -> Callable[[Column], tuple[Column, Column]]:
    """A placeholder that stands for ``base + per_unit * units`` tokens (units: image tiles, seconds, pages; missing ones count as 0)."""
    def visit(part: Column) -> tuple[Column, Column]:
        units = F.ceil(F.greatest(F.coalesce(F.nanvl(part["units"], F.lit(0.0)), F.lit(0.0)), F.lit(0.0)))
        return F.lit(f"<{name}>"), (F.lit(base) + F.lit(per_unit) * units).cast("long")
    return visit


VISITORS: dict[str, Callable[[Column], tuple[Column, Column]]] = {
    "text": text_part,
    "image": attachment("image", 85, 170),
    "audio": attachment("audio", 2, 25),
    "document": attachment("document", 2, 600),
}


def flatten(parts: Column, visitors: dict[str, Callable] = VISITORS) -> Column:
    """struct(text, attachments, tokens) of an array of parts (type, text, ref, units), in order.

    A null array is empty, a null part or a part of unknown type is dropped. Attachments keep their reference (null if they have
    none), their place among the placeholders and their expanded token count.
    """
    def visit(part: Column) -> Column:
        text = count = None
        for kind, visitor in visitors.items():
            piece, tokens = visitor(part)
            here = part["type"] == kind
            text = F.when(here, piece) if text is None else text.when(here, piece)
            count = F.when(here, tokens) if count is None else count.when(here, tokens)
        return F.struct(part["type"].alias("type"), text.alias("text"), part["ref"].alias("ref"), count.alias("tokens"))

    seen = F.filter(F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), visit), lambda p: p["text"].isNotNull())
    held = F.filter(seen, lambda p: p["type"] != "text")
    return F.struct(
        F.array_join(F.transform(seen, lambda p: p["text"]), "").alias("text"),
        F.transform(held, lambda p, i: F.struct(i.cast("int").alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(held, F.lit(0).cast("long"), lambda n, p: n + p["tokens"]).alias("tokens"),
    )


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units")))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts",
                         learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv, formatted, loss_spans, attachments, attachment_tokens): one row per conversation.

    Rows are ordered by turn (null first; ties by role, then text), so repeated rows are repeated turns. A null role is an empty
    one; a null conversation id is a conversation of its own. ``loss_spans`` are the (start, length) of the learnt roles' texts in
    ``formatted``, in characters from 0. One conversation's turns meet in one row, as its formatted text is one value;
    conversations are spread over all tasks. Other columns of ``turns`` are ignored.
    """
    rows = pick(turns, conv=conv_col, turn=turn_col, role=role_col, parts=parts_col)
    flat = rows.select("conv", "turn", F.coalesce("role", F.lit("")).alias("role"), flatten(F.col("parts")).alias("flat")) \
        .select("conv", F.struct("turn", "role", F.col("flat.text").alias("text"), F.col("flat.attachments").alias("attachments"), F.col("flat.tokens").alias("tokens")).alias("t"))
    held = flat.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    heads = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE)))
    held = held.withColumn("heads", heads)
    pieces = F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["text"], F.lit(END)))
    start = F.struct(F.lit(len(BEGIN)).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(turn["head"])
        size = F.length(turn["text"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(END)).alias("at"), F.when(turn["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    marked = F.zip_with("heads", "turns", lambda h, t: F.struct(h.alias("head"), t["text"].alias("text"), t["role"].isin(*learn).alias("learn")))
    return held.select(
        F.col("conv").alias(conv_col),
        F.concat(F.lit(BEGIN), F.array_join(pieces, "")).alias("formatted"),
        F.aggregate(marked, start, step, lambda s: s["spans"]).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(
            i.cast("int").alias("turn"), a["place"].alias("place"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct(role, text)> read back from a formatted conversation without attachments: the inverse of the template."""
    body = F.substr(formatted, F.lit(len(BEGIN) + 1))
    parts = F.slice(F.split(body, END), 1, F.size(F.split(body, END)) - 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(2)), CLOSE, 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, CLOSE) + 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
