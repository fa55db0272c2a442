"""Lenient parsing of raw text: bad text becomes NULL, never an error, with ANSI mode on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Accepted layouts.
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SECONDS = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"
US_DAY = "MM/dd/yyyy"
EU_DAY = "dd-MM-yyyy"

EVENT_LAYOUTS = (ISO_MILLIS_Z, SECONDS)
ORDER_LAYOUTS = (ISO_MILLIS_Z, SECONDS, DAY)
BIRTH_LAYOUTS = (DAY, US_DAY, EU_DAY)

def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _may_fit(text: Column, layout: str) -> Column:
    """False only where the layout cannot fit: a failing parse is an exception and slow."""
    if layout == ISO_MILLIS_Z:
        return F.contains(text, F.lit("T"))
    if layout == SECONDS:
        return F.contains(text, F.lit(" "))
    if layout == US_DAY:
        return F.contains(text, F.lit("/"))
    if layout == EU_DAY:
        return F.substring(text, 3, 1) == "-"
    # a year of more than four digits carries a sign
    return (F.substring(text, 5, 1) == "-") | F.substring(text, 1, 1).isin("+", "-")


def _attempt(text: Column, layout: str) -> Column:
    return F.when(_may_fit(text, layout), F.try_to_timestamp(text, F.lit(layout)))


def _plain(text: Column) -> Column:
    """True for the shapes ``yyyy-MM-dd`` and ``yyyy-MM-dd HH:mm:ss``."""
    def at(i: int, sign: str) -> Column:
        return F.substring(text, i, 1) == sign

    long = F.length(text)
    return at(5, "-") & at(8, "-") & ((long == 10) | ((long == 19) & at(11, " ") & at(14, ":") & at(17, ":")))


def parse_ts(c: Column | str, layouts: Sequence[str] = (), compat: bool = False) -> Column:
    """First layout that fits, then Spark's own ISO parsing (left out with ``compat``).

    Of plain days and seconds ISO parsing makes what their layouts make, without a formatter, which takes many times as long.
    """
    text = _column(c)
    attempts = [_attempt(text, layout) for layout in layouts]
    if compat and attempts:
        return F.coalesce(*attempts)
    iso = F.try_to_timestamp(text)
    return F.when(_plain(text), iso).otherwise(F.coalesce(*attempts, iso)) if attempts else iso


def parse_date(c: Column | str, layouts: Sequence[str] = BIRTH_LAYOUTS) -> Column:
    text = _column(c)
    return F.coalesce(*[_attempt(text, layout).cast("date") for layout in layouts])


def lenient_cast(c: Column | str, to: str | T.DataType) -> Column:
    return _column(c).try_cast(to)


def as_text(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The named columns as text; those the input lacks come back NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(name).cast("string") if name in present else F.lit(None).cast("string")).alias(name)
        for name in fields
    ])


CORRUPT = "_corrupt"


def decode_events(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parsed columns next to the rest; text that is no JSON object stays in the corrupt column.

    Text columns of the schema take nested values as their JSON text.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json(value, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    others = [c for c in df.columns if c != value]
    return df.withColumn("_event", parsed).select("_event.*", *others)


def flatten_nested(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps become JSON text so that the table at rest stays flat."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[
        F.to_json(F.col(f"`{field.name}`")).alias(field.name)
        if isinstance(field.dataType, nested) else F.col(f"`{field.name}`")
        for field in df.schema.fields
    ])
