"""Parsing and normal forms on hand-written values."""

from datetime import date, datetime

import pandas as pd
from pyspark.sql import functions as F

from oreline.functions import calendar as cal, normalise as norm, parse
from oreline.functions.similarity import jaro_winkler, jaro_winkler_batch


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_timestamp_ladder(spark):
    texts = ["2024-01-02T03:04:05.000Z", "2024-01-02 03:04:05", "2024-01-02", "2024-01-02T03:04:05.123456+00:00", "bad", None]
    got = one(spark, texts, parse.parse_ts("c", parse.ORDER_LAYOUTS))
    full = datetime(2024, 1, 2, 3, 4, 5)
    assert got == [full, full, datetime(2024, 1, 2), full.replace(microsecond=123456), None, None]
    assert one(spark, texts, parse.parse_ts("c", parse.ORDER_LAYOUTS, compat=True))[3] is None


def test_event_ladder_without_day(spark):
    assert one(spark, ["2024-01-02"], parse.parse_ts("c", parse.EVENT_LAYOUTS, compat=True)) == [None]


def test_birth_ladder(spark):
    assert one(spark, ["1990-05-06", "05/06/1990", "06-05-1990", "1990", "", None], parse.parse_date("c")) \
        == [date(1990, 5, 6)] * 3 + [None] * 3


def test_lenient_casts(spark):
    assert one(spark, ["1.5", "n/a", "", None], parse.lenient_cast("c", "double")) == [1.5, None, None, None]
    assert one(spark, ["true", "maybe"], parse.lenient_cast("c", "boolean")) == [True, None]


def test_text_columns_of_any_type(spark):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert parse.as_text(df, ["a", "b", "missing"]).first() == ("1", "2.5", None)


def test_flatten_nested(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 2) AS s, array(1, 2) AS l")
    assert parse.flatten_nested(df).first() == (1, '{"x":2}', "[1,2]")


def test_email(spark):
    texts = [" Jo.Hn+x@Gmail.COM ", "a.b@x.org", "a.b+c@gmail.com.au", "", "   ", None, "no-at"]
    assert one(spark, texts, norm.norm_email("c")) == ["john@gmail.com", "a.b@x.org", "ab@gmail.com.au", None, "", None, "no-at"]


def test_phone(spark):
    assert one(spark, ["+1 (555) 123-4567 ", "12-34", "abc", "", None], norm.norm_phone("c")) \
        == ["5551234567", "1234", None, None, None]


def test_name(spark):
    names = ["José  MARÍA ", "  ann\tlee", "", None, "Ægir ﬁn", "   "]
    assert one(spark, names, norm.norm_name("c")) == ["jose maria", "ann lee", None, None, "ægir fin", ""]


def test_token_postal_city_domain_mask(spark):
    assert one(spark, ["Credit Card", " Card"], norm.norm_token("c")) == ["credit_card", "_card"]
    assert one(spark, [" ab-1 2"], norm.norm_postal("c")) == ["AB12"]
    assert one(spark, [" New  York "], norm.norm_city("c")) == ["new_york"]
    assert one(spark, ["a@b.c", "none", None], norm.email_domain("c")) == ["b.c", None, None]
    assert one(spark, ["a@b.c", None], norm.mask_email("c")) == ["***@b.c", None]


def test_block_keys_and_soundex(spark):
    df = spark.createDataFrame([("robert", "AB1", "r@x.y", None), (None, "AB1", None, "55")],
                               "last_name_norm string, postal_code_norm string, email_normalised string, phone_normalised string")
    got = norm.with_block_keys(df).select("block_key_1", "block_key_2", "block_key_3", "last_name_soundex").collect()
    assert [tuple(r) for r in got] == [("rob_AB1", "r@x.y", None, "R163"), (None, None, "55", None)]


def test_bands(spark):
    assert one(spark, [24, 25, 64, 65, None], cal.age_band("c"), "int") == ["18-24", "25-34", "55-64", "65+", "unknown"]
    assert one(spark, [29, 30, 364, 365, None], cal.tenure_band("c"), "int") \
        == ["new_30d", "new_90d", "established", "loyal", "loyal"]


def test_fiscal_calendar(spark):
    days = [date(2024, 1, 31), date(2024, 3, 31), date(2024, 4, 1), date(2024, 12, 31), None]
    assert one(spark, days, cal.fiscal_quarter_label("c"), "date") == ["Q4", "Q4", "Q1", "Q3", "Q4"]
    assert one(spark, days[:4], cal.fiscal_year("c"), "date") == [2023, 2023, 2024, 2024]


def test_age(spark):
    assert one(spark, [date(2000, 1, 1), None], cal.age_on("c", "2024-01-02"), "date") == [24, None]


def test_jaro_winkler_known_values():
    pairs = [("martha", "marhta", 0.9611), ("dixon", "dicksonx", 0.8133), ("abc", "xyz", 0.0), ("a", "a", 1.0),
             ("dwayne", "duane", 0.84), ("", "a", 0.0)]
    got = jaro_winkler_batch(pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs]))
    assert [round(v, 4) for v in got] == [p[2] for p in pairs]


def test_jaro_winkler_column(spark):
    df = spark.createDataFrame([("ann", "ann"), ("ann", None), ("", ""), ("martha", "marhta")], "a string, b string")
    got = [round(r[0], 4) for r in df.select(jaro_winkler(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 0.0, 0.9611]


def test_one_long_name_costs_only_itself():
    import time

    import numpy as np
    import pandas as pd

    from oreline.functions.similarity import jaro_winkler_batch
    rng = np.random.default_rng(0)
    names = ["".join(rng.choice(list("abcdefg"), rng.integers(3, 20))) for _ in range(1000)]
    other = names[::-1]
    plain = jaro_winkler_batch(pd.Series(names), pd.Series(other))
    start = time.perf_counter()
    got = jaro_winkler_batch(pd.Series([*names, "x" * 2000]), pd.Series([*other, "xy" * 1000]))
    assert time.perf_counter() - start < 2 and np.allclose(got[:1000], plain) and 0 < got[1000] < 1
