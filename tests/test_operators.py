"""Validation, dedup, merge, fraud signals, windows, quality, serving guards."""

import pytest
from pyspark.sql import functions as F

from oreline.operators import filters, fraud, merge, quality as Q, validate as V, windows
from oreline.operators.dedupe import latest_per_key
from oreline.plans import marts, serving, silver, views


@pytest.fixture
def flagged(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, "c"), (2, None)], "n int, s string")
    return df, {"negative": F.col("n") < 0, "bad_text": F.col("s") == "b"}


def test_unknown_policies(spark, flagged):
    df, rules = flagged
    def counts(policy):
        return tuple(V.validation_counts(V.validate(df, rules, policy)).first())
    # (raw, clean, quarantine, unknown); a row with a true flag is quarantined under every policy
    assert counts("pass") == (4, 2, 2, 0)
    assert counts("quarantine") == (4, 1, 3, 0)
    assert counts("drop") == (4, 1, 2, 1)
    with pytest.raises(ValueError):
        V.validate(df, rules, "other")


def test_rule_counts_and_mask(flagged, rows):
    df, rules = flagged
    assert rows(V.rule_counts(V.validate(df, rules))) == [("bad_text", 1), ("negative", 1)]
    assert [r[0] for r in df.select(V.error_mask(rules)).collect()] == [0, 2, 1, 0]


def test_clean_rows_observe(spark, flagged):
    from pyspark.sql import Observation

    df, rules = flagged
    seen = Observation()
    clean = V.clean_rows(V.validate(df, rules), seen)
    assert clean.columns == ["n", "s"] and clean.count() == 2
    assert seen.get["quarantine_count"] == 2


def test_latest_per_key_plan_and_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", None, 1), ("b", 0, 1), ("c", None, 7)], "k string, t int, v int")
    out = latest_per_key(df, ["k"], "t")
    assert rows(out) == [("a", 2, 1), ("b", 0, 1), ("c", None, 7)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a limit on each side of the shuffle
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_latest_per_key_tie_is_stable(spark):
    a = spark.createDataFrame([("k", 1, "x"), ("k", 1, "y")], "k string, t int, v string")
    b = spark.createDataFrame([("k", 1, "y"), ("k", 1, "x")], "k string, t int, v string")
    assert latest_per_key(a, ["k"], "t").collect() == latest_per_key(b, ["k"], "t").collect()


def test_upsert_is_idempotent_and_keeps(spark, rows):
    target = spark.createDataFrame([(1, "a", "e1"), (2, "b", None)], "id int, v string, e string")
    source = spark.createDataFrame([(2, "B", None), (3, "C", "new")], "id int, v string, e string")
    once = merge.upsert(target, source, ["id"])
    assert rows(once) == rows(merge.upsert(once, source, ["id"])) == [(1, "a", "e1"), (2, "B", None), (3, "C", "new")]
    again = spark.createDataFrame([(1, "A", None)], "id int, v string, e string")
    assert rows(merge.upsert(target, again, ["id"], keep=["e"])) == [(1, "A", "e1"), (2, "b", None)]


def test_update_columns_sets_null(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(1, None)], "id int, v string")
    assert rows(merge.update_columns(target, source, ["id"], ["v"])) == [(1, None), (2, "b")]


def test_insert_new_and_schema_evolution(spark, rows):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, "z", 9), (2, "b", 9)], "id int, v string, w int")
    assert rows(merge.insert_new(target, source, ["id"])) == [(2, "b", 9)]
    assert rows(merge.align_append_new(target, source)) == [(1, "a", None), (1, "z", 9), (2, "b", 9)]


def test_scd2(spark, rows):
    base = spark.createDataFrame([(1, "x"), (2, None)], "id int, seg string")
    first = merge.scd2_apply(None, base, "id", ["seg"], "2024-01-01")
    second = merge.scd2_apply(first, spark.createDataFrame([(1, "y"), (2, None), (3, "n")], "id int, seg string"),
                              "id", ["seg"], "2024-02-01")
    got = rows(second.select("id", "seg", F.to_date("valid_from").cast("string"), F.to_date("valid_to").cast("string"), "is_current"))
    assert got == [(1, "x", "2024-01-01", "2024-02-01", False), (1, "y", "2024-02-01", None, True),
                   (2, None, "2024-01-01", None, True), (3, "n", "2024-02-01", None, True)]
    same = merge.scd2_apply(second, spark.createDataFrame([(1, "y")], "id int, seg string"), "id", ["seg"], "2024-03-01")
    assert rows(same.drop("record_hash")) == rows(second.drop("record_hash"))


def test_empty_text_and_null_hash_apart(spark):
    df = spark.createDataFrame([("",), (None,)], "a string")
    assert len({r[0] for r in df.select(merge.record_hash(["a"])).collect()}) == 2


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1,), (5,)], "t int")
    assert merge.high_water_mark(df, "t", 0) == 5
    assert merge.high_water_mark(df.where("t > 9"), "t", 0) == merge.high_water_mark(None, "t", 0) == 0


def test_incremental_equals_full_and_delta_only_loses_history(spark, rows):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), ("a", 10)], "k string, v int")
    build = lambda df: df.groupBy("k").agg(F.sum("v").alias("s"))
    target, delta = build(facts.where("v < 10")), facts.where("v >= 10")
    assert rows(merge.incremental_replace(target, facts, delta, "k", build)) == rows(build(facts))
    assert rows(merge.incremental_replace_delta_only(target, delta, "k", build)) == [("a", 10), ("b", 5)]


def txns(spark, data):
    return spark.createDataFrame(data, "transaction_id string, customer_id string, ts string") \
        .select("transaction_id", "customer_id", F.to_timestamp("ts").alias("transaction_ts"))


def test_velocity_edges(spark, rows):
    df = txns(spark, [("1", "c", "2024-01-01 00:00:00"), ("2", "c", "2024-01-01 01:00:00.9"), ("3", "c", "2024-01-01 01:00:01"),
                      ("4", "d", "2024-01-01 00:30:00"), ("5", "c", "2024-01-01 01:00:00")])
    base = 1704067200
    assert rows(fraud.velocity_table(df)) == [("c", base, 1), ("c", base + 3600, 3), ("c", base + 3601, 3), ("d", base + 1800, 1)]


def test_velocity_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    events = [(str(i), rnd.choice("ab"), rnd.randrange(0, 40000)) for i in range(600)]
    df = spark.createDataFrame(events, "transaction_id string, customer_id string, s int") \
        .withColumn("transaction_ts", F.timestamp_seconds("s"))
    got = {(r.customer_id, r.second): r.txn_velocity_1h for r in fraud.velocity_table(df, hours=2).collect()}
    for _, c, s in events:
        assert got[(c, s)] == sum(1 for _, d, t in events if d == c and s - 7200 <= t <= s)


def test_baseline_is_bounded(spark):
    df = spark.createDataFrame([("c", 10.0, "2024-01-05"), ("c", 20.0, "2024-01-06"), ("c", 99.0, "2024-01-10"), ("c", 5.0, "2023-11-01")],
                               "customer_id string, amount double, d string").withColumn("transaction_ts", F.to_timestamp("d"))
    assert fraud.baseline(df, "2024-01-10").first().txn_count_30d == 2
    assert fraud.baseline(df, "2024-01-10", bounded=False).first().txn_count_30d == 3


def test_flags_with_unknowns(spark):
    df = spark.createDataFrame([(600.0, None, None, None, None, 1)],
                               "amount double, is_international boolean, avg_amount_30d double, stddev_amount_30d double, "
                               "txn_count_30d long, txn_velocity_1h long")
    now, old = fraud.with_risk(df).first(), fraud.with_risk(df, compat=True).first()
    assert (now.flag_new_customer_high_value, now.risk_score, now.risk_tier) == (True, 1, "LOW")
    assert (old.flag_new_customer_high_value, old.risk_score, old.risk_tier) == (None, None, "LOW")


def test_risk_tiers(spark):
    df = spark.createDataFrame([(6000.0, True, 10.0, 1.0, 9, 9), (6000.0, False, 10.0, None, 9, 1), (1500.0, True, 10.0, 0.0, 1, 1)],
                               "amount double, is_international boolean, avg_amount_30d double, stddev_amount_30d double, "
                               "txn_count_30d long, txn_velocity_1h long")
    assert [(r.risk_score, r.risk_tier) for r in fraud.with_risk(df).collect()] == [(10, "HIGH"), (2, "LOW"), (3, "MEDIUM")]


def test_null_checks_pass_by_default(spark):
    raw = spark.createDataFrame([("o", "c", None, "2024-01-01", "5", None)],
                                "order_id string, customer_id string, order_status string, order_ts string, gross_amount string, item_count string")
    assert silver.silver_orders(raw, "2024-02-01").count() == 1
    assert silver.silver_orders(raw, "2024-02-01", on_unknown="drop").count() == 0


def test_missing_birth_date_keeps_customer(spark):
    raw = spark.createDataFrame([("c", "a@b.co", None)], "customer_id string, email string, date_of_birth string")
    kept = silver.silver_customers(raw, "2024-02-01").first()
    assert kept.age_band == "unknown" and kept.resolved_entity_id is None


def test_rolling_and_lag(spark, rows):
    df = spark.createDataFrame([("x", i, float(i)) for i in range(10)], "p string, d int, v double")
    last = windows.rolling_avg(df, ["p"], "d", "v", 7, "m").orderBy(F.desc("d")).first()
    assert last.m == 6.0
    lagged = windows.lag_change(df, ["p"], ["d"], "v", 7, "prev", "chg").orderBy(F.desc("d")).first()
    assert (lagged.prev, lagged.chg) == (2.0, 7.0)


def test_quality_suite(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 500), (2, "z", None)], "id int, s string, n int")
    out = Q.run_suite({"t": df}, {"t": [Q.unique("id"), Q.not_null("s"), Q.accepted_values("s", ["a"]), Q.accepted_range("n", 0, 100)]})
    assert rows(out) == [("t", "id", "unique", 1, "fail"), ("t", "n", "accepted_range", 1, "fail"),
                         ("t", "s", "accepted_values", 1, "fail"), ("t", "s", "not_null", 1, "fail")]


@pytest.mark.parametrize("now,status", [("2024-01-02 00:00:00", "pass"), ("2024-01-02 02:00:00", "warn"), ("2024-01-04 00:00:00", "fail")])
def test_freshness(spark, now, status):
    df = spark.createDataFrame([("2024-01-01",)], "t string").select(F.to_timestamp("t").alias("t"))
    assert Q.freshness(df, "t", now).first().status == status
    assert Q.freshness(df.where("false"), "t", now).first().status == "fail"


@pytest.mark.parametrize("sql,ok", [
    ("SELECT mart_updated_at FROM m", True), ("with a as (select 1) select * from a;", True), ("SELECT 'drop it'", True),
    ("DELETE FROM m", False), ("SELECT 1; DROP TABLE m", False), ("with a as (select 1) insert into m select * from a", False), ("", False),
    (None, False)])
def test_sql_guard(sql, ok):
    assert serving.is_safe(sql) is ok


def test_sql_guard_compat():
    assert not serving.is_safe("SELECT mart_updated_at FROM m", compat=True)


def test_safe_sql_limits_and_iso(spark):
    t = spark.createDataFrame([(i,) for i in range(30)], "i int").withColumn("d", F.lit("2024-01-02").cast("date"))
    got = serving.safe_sql(spark, "SELECT i, d FROM guarded ORDER BY i", {"guarded": t}, 5).collect()
    assert len(got) == 5 and got[0].d == "2024-01-02"
    with pytest.raises(ValueError):
        serving.safe_sql(spark, "SELECT 1", {}, 1000)


def test_safe_sql_reads_nothing_else(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "other"))
    spark.range(1).createOrReplaceTempView("outsider")
    mine = spark.range(7)
    mine.createOrReplaceTempView("guarded")
    tables = {"guarded": spark.range(2)}
    for sql in (f"SELECT * FROM parquet.`{tmp_path}/other`", "SELECT reflect('java.lang.System', 'getProperty', 'user.name')",
                "SELECT `java_method`('java.lang.System', 'getProperty', 'user.name') FROM guarded", "SELECT * FROM range(5)",
                "SELECT * FROM outsider", "SELECT (SELECT max(id) FROM outsider) FROM guarded", "SELECT * FROM IDENTIFIER('outsider')",
                "WITH c AS (SELECT * FROM outsider) SELECT * FROM c", "SELECT * FROM guarded WHERE id IN (SELECT id FROM outsider)"):
        with pytest.raises(ValueError):
            serving.safe_sql(spark, sql, tables)
    assert serving.safe_sql(spark, "WITH c AS (SELECT id FROM guarded) SELECT 'reflect' AS r, id FROM c", tables).count() == 2
    assert spark.table("guarded").count() == 7
    assert serving.safe_sql(spark, "SELECT * FROM fresh", {"fresh": mine}).count() == 7
    assert not spark.catalog.tableExists("fresh")
    spark.catalog.dropTempView("guarded")
    spark.catalog.dropTempView("outsider")


def test_request_bounds(spark):
    df = spark.createDataFrame([], "order_date date")
    for bad in (0, 366):
        with pytest.raises(ValueError):
            serving.order_summary(df, "2024-01-01", days=bad)
    with pytest.raises(ValueError):
        filters.check_range("limit", 101, 1, 100)


def test_optional_filters(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    assert filters.filter_optional(df, k="a", v=None).count() == 1
    assert filters.filter_optional(df, k=None, v="").count() == 2


def test_churn_first_match_wins(spark):
    df = spark.createDataFrame([(0, 5, "2024-05-30", 3.0), (1, 1, "2024-05-30", 2.5), (0, 2, "2024-01-01", 9.0), (None, None, None, None),
                                (1, 9, "2024-05-30", 1.0)],
                               "orders_last_30d int, total_orders int, last string, orders_per_month double") \
        .withColumn("last_order_ts", F.to_timestamp("last"))
    got = [r[0] for r in df.select(marts.churn_status("2024-06-01")).collect()]
    assert got == ["at_risk", "loyal", "churned", "churned", "active"]


def test_run_audit_and_snapshot(spark):
    df = spark.range(1)
    assert set(marts.with_run_audit(df, "2024-01-01", "r1").columns) == {"id", "mart_created_at", "run_started_at", "run_id"}
    assert "snapshot_ts" in views.with_snapshot_ts(df, "2024-01-01").columns


@pytest.mark.parametrize("method,expected", [("max", "paypal"), ("latest", "crypto"), ("mode", "crypto")])
def test_representative_payment(spark, method, expected):
    data = [("o1", "paypal", "2024-01-01"), ("o2", "crypto", "2024-01-02"), ("o3", "crypto", "2024-01-03")]
    stg = spark.createDataFrame(data, "order_id string, payment_method string, d string").select(
        "order_id", F.lit("c").alias("customer_id"), "payment_method", F.lit("US").alias("shipping_country"),
        F.lit("delivered").alias("order_status"), F.lit(1).cast("decimal(18,2)").alias("net_amount"),
        F.lit(0).cast("decimal(18,2)").alias("discount_amount"), F.lit(0).cast("decimal(8,4)").alias("discount_pct"),
        F.lit(1).alias("item_count"), F.lit(False).alias("is_weekend"), F.to_timestamp("d").alias("order_ts"))
    for unique in (True, False):
        out = marts.customer_order_metrics(stg, "2024-02-01", method, unique).first()
        assert out.most_recent_payment_method == expected and out.total_orders == 3
