"""Normal forms of enumerations and of the personal fields used to match customers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .parse import _column

# White space as text tools outside the JVM see it: Unicode spaces plus the four separators.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def norm_lower(c: Column | str) -> Column:
    return F.lower(F.trim(_column(c)))


def norm_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_column(c)))


def norm_token(c: Column | str) -> Column:
    """Spaces become underscores before the trim, so outer spaces stay as underscores."""
    return F.lower(F.trim(F.replace(_column(c), F.lit(" "), F.lit("_"))))


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def norm_email(c: Column | str) -> Column:
    """Lower case without outer space; dots and a ``+tag`` leave the local part of gmail addresses.

    The provider test is "contains", and a blank (not empty) address becomes "".
    """
    address = F.lower(F.regexp_replace(_filled(_column(c)), _EDGES, ""))
    at = F.instr(address, "@")
    local = F.substring_index(F.replace(F.substring_index(address, "@", 1), F.lit("."), F.lit("")), "+", 1)
    return F.when(F.contains(address, F.lit("@gmail.com")), F.concat(local, F.substring(address, at, F.length(address)))) \
        .otherwise(address)


def norm_phone(c: Column | str) -> Column:
    """The last ten digits."""
    return _filled(F.right(F.regexp_replace(_column(c), r"(?U)\D", ""), F.lit(10)))


@F.pandas_udf(T.StringType())
def _fold_accents(names: pd.Series) -> pd.Series:
    def fold(name):
        if name is None:
            return None
        split = unicodedata.normalize("NFKD", name)
        kept = "".join(ch for ch in split if not unicodedata.combining(ch))
        return " ".join(kept.lower().split())

    return names.map(fold, na_action="ignore")


def norm_name(c: Column | str) -> Column:
    """Accents stripped, lower case, single spaces.

    ASCII names stay in the JVM; only the others are handed to Python, in Arrow batches.
    """
    name = _filled(_column(c))
    ascii_only = F.octet_length(name) == F.char_length(name)
    native = F.trim(F.regexp_replace(F.lower(name), _SPACE, " "))
    return F.when(ascii_only, native).otherwise(_fold_accents(F.when(~ascii_only, name)))


def norm_postal(c: Column | str) -> Column:
    return F.regexp_replace(norm_upper(c), "[^A-Z0-9]", "")


def norm_city(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.trim(_column(c)), r"\s+", "_"))


def email_domain(c: Column | str) -> Column:
    return F.get(F.split(_column(c), "@"), F.lit(1))


def mask_email(c: Column | str) -> Column:
    return F.concat(F.lit("***@"), F.split_part(_column(c), F.lit("@"), F.lit(2)))


def with_block_keys(df: DataFrame) -> DataFrame:
    """Keys under which two profiles of one person should meet."""
    return df.withColumns({
        "block_key_1": F.concat(F.substring("last_name_norm", 1, 3), F.lit("_"), F.col("postal_code_norm")),
        "block_key_2": F.col("email_normalised"),
        "block_key_3": F.col("phone_normalised"),
        "email_domain": email_domain("email_normalised"),
        "last_name_soundex": F.soundex("last_name_norm"),
    })
