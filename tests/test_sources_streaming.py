"""Stored tables, publishing, manifest, streams and the daily run."""

import pytest
from pyspark.sql import functions as F

from oreline import catalog, schemas as S
from oreline.operators import fraud
from oreline.plans import graph, jobs, star
from oreline.sources import manifest, publish, tables as io
from oreline.streaming import landing, stateful


def test_mixed_raw_types_read_as_text(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("o1", 1.5)], "order_id string, gross_amount double").write.parquet(f"{path}/date=2024-01-01/hour=00")
    spark.createDataFrame([("o2", 2.5)], "order_id string, gross_amount double").write.parquet(f"{path}/date=2024-01-02/hour=00")
    got = io.read_bronze(spark, path, "2024-01-01", S.ORDER_FIELDS)
    assert got.columns == S.ORDER_FIELDS and got.collect()[0].gross_amount == "1.5" and got.count() == 1


def test_read_prefix_and_gate(spark, tmp_path):
    assert io.read_prefix(spark, str(tmp_path / "none"), "a int").count() == 0
    spark.range(3).write.parquet(str(tmp_path / "t" / "date=2024-01-01"))
    io.require_partitions(spark, [str(tmp_path / "t")], "2024-01-01")
    with pytest.raises(io.MissingData):
        io.require_partitions(spark, [str(tmp_path / "t")], "2024-01-02")


def test_malformed_json_is_kept_apart(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"customer_id":"c1"}\n{"customer_id":\n')
    good, bad = io.read_json_events(spark, str(tmp_path / "e.json"), S.text_schema(["customer_id"]))
    assert good.count() == 1 and bad.first()[0].startswith("{")


def test_event_array_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"session_id":"s1"},{"session_id":"s2"}]')
    assert io.read_event_file(spark, str(tmp_path / "a.json"), S.raw_schema("clickstream")).count() == 2


def test_upsert_table_moves_rows_between_folders(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    kind = "id int, v string, p int"
    io.upsert_table(spark, path, spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 2), (4, "d", 3)], kind), ["id"], ["p"])
    batch = spark.createDataFrame([(1, "A", 2), (2, "B", 2), (5, "E", 4)], kind)
    for _ in range(2):
        io.upsert_table(spark, path, batch, ["id"], ["p"])
        assert rows(io.read_table(spark, path), "id", "v", "p") == [(1, "A", 2), (2, "B", 2), (3, "c", 2), (4, "d", 3), (5, "E", 4)]


def test_unpartitioned_upsert_and_append(spark, tmp_path, rows):
    path = str(tmp_path / "u")
    for batch in ([(1, "a")], [(1, "b"), (2, "c")]):
        io.upsert_table(spark, path, spark.createDataFrame(batch, "id int, v string"), ["id"])
    assert rows(io.read_table(spark, path)) == [(1, "b"), (2, "c")]
    io.append_new(spark, path, spark.createDataFrame([(2, "z"), (3, "d")], "id int, v string"), ["id"])
    assert rows(io.read_table(spark, path)) == [(1, "b"), (2, "c"), (3, "d")]


COUNTRIES = "key string, country string"


def test_upsert_keeps_odd_folder_values(spark, tmp_path, rows):
    def run(name, stored, batch):
        path = str(tmp_path / name)
        io.upsert_table(spark, path, spark.createDataFrame(stored, COUNTRIES), ["key"], ["country"])
        io.upsert_table(spark, path, spark.createDataFrame(batch, COUNTRIES), ["key"], ["country"])
        return rows(io.read_table(spark, path), "key", "country")

    assert run("blank", [("a", None), ("b", "US"), ("c", None)], [("d", "")]) == [("a", None), ("b", "US"), ("c", None), ("d", "")]
    assert run("moved", [("a", "N/A"), ("b", "x=y/z")], [("a", "US")]) == [("a", "US"), ("b", "x=y/z")]
    assert run("digits", [("a", "007"), ("b", "012")], [("c", "012"), ("b", "012")]) == [("a", "007"), ("b", "012"), ("c", "012")]


def test_stopped_upsert_loses_nothing(spark, tmp_path, rows, monkeypatch):
    path, batch = str(tmp_path / "s"), spark.createDataFrame([("b", "DE")], COUNTRIES)
    io.upsert_table(spark, path, spark.createDataFrame([("a", "US"), ("b", "US")], COUNTRIES), ["key"])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(io.snapshots, "commit", stop)
        with pytest.raises(RuntimeError):
            io.upsert_table(spark, path, batch, ["key"])
    assert rows(io.read_table(spark, path)) == [("a", "US"), ("b", "US")]
    io.upsert_table(spark, path, batch, ["key"])
    assert rows(io.read_table(spark, path)) == [("a", "US"), ("b", "DE")]


def test_upsert_refuses_doubled_and_null_keys(spark, tmp_path):
    for batch in ([("a", "US"), ("a", "DE")], [(None, "US")]):
        with pytest.raises(ValueError, match="key"):
            io.upsert_table(spark, str(tmp_path / "d"), spark.createDataFrame(batch, COUNTRIES), ["key"])
    assert not io.table_exists(spark, str(tmp_path / "d"))


def test_versions_are_pruned_and_conflicts_found(spark, tmp_path, rows):
    path = str(tmp_path / "v")
    for i in range(6):
        io.upsert_table(spark, path, spark.createDataFrame([("a", str(i)), (f"k{i}", "x")], COUNTRIES), ["key"])
    assert len(list((tmp_path / "v" / "_snapshots").glob("*.json"))) == 3 and len(list((tmp_path / "v" / "_data").iterdir())) == 3
    assert len(rows(io.read_table(spark, path))) == 7
    with pytest.raises(io.snapshots.Conflict):
        io.snapshots.commit(spark, path, io.snapshots.latest(spark, path))


def test_load_is_once_and_a_date_replaces_itself(spark, tmp_path, monkeypatch):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    spark.range(3).write.parquet(src)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(publish.snapshots, "commit", stop)
        with pytest.raises(RuntimeError):
            publish.copy_into(spark, src, dst, spark.range(0).schema, "2024-01-01")
    assert publish.copy_into(spark, src, dst, spark.range(0).schema, "2024-01-01") == 3
    assert io.read_table(spark, dst).count() == 3
    marts, schemas = {"m": spark.range(2)}, {"m": spark.range(0).schema}
    for date in ("2024-01-01", "2024-01-01", "2024-01-02"):
        publish.sync_marts(spark, marts, schemas, str(tmp_path / "e"), str(tmp_path / "t"), date, date)
    assert io.read_part(spark, str(tmp_path / "t" / "m")).count() == 2 and io.read_table(spark, str(tmp_path / "t" / "m")).count() == 4


def test_cluster_write_narrows_files(spark, tmp_path):
    df = spark.range(4096).select((F.col("id") % 64).alias("x"), (F.col("id") / 64).cast("int").alias("y"))
    io.cluster_write(df, str(tmp_path / "z"), ["x", "y"], files=16)
    back = spark.read.parquet(str(tmp_path / "z"))
    spans = back.groupBy(F.input_file_name()).agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy")).collect()
    assert back.count() == 4096 and all(r.dx < 48 or r.dy < 48 for r in spans)


def test_clustered_files_are_skipped_at_any_size(spark, tmp_path):
    for n, files in ((4096, 16), (65536, 64)):
        df = spark.range(n).select((F.col("id") % 64).alias("x"), F.concat(F.lit("k"), F.lpad((F.col("id") / 64).cast("int").cast("string"), 5, "0")).alias("y"))
        io.cluster_write(df, str(tmp_path / f"z{n}"), ["x", "y"], files=files)
        spans = spark.read.parquet(str(tmp_path / f"z{n}")).groupBy(F.input_file_name().alias("f")).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"))
        touched = spans.where("x0 <= 5 AND x1 >= 3 AND y0 <= 'k00010'").count()
        assert spans.count() >= files // 2 and touched <= max(4, spans.count() // 4)
    hot = spark.range(20_000).select(F.lit(1).alias("x"), F.lit("a").alias("y"), "id")
    io.cluster_write(hot, str(tmp_path / "hot"), ["x", "y"], files=8)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "hot")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5000


def test_copy_into_loads_once_and_skips_bad_rows(spark, tmp_path):
    src, dst = (str(tmp_path / n) for n in ("src", "dst"))
    spark.createDataFrame([("1", "x"), ("bad", "y")], "ID string, Name string").write.parquet(src)
    schema = spark.createDataFrame([], "id int, name string, extra double").schema
    assert publish.copy_into(spark, src, dst, schema, "2024-01-01") == 1
    assert publish.copy_into(spark, src, dst, schema, "2024-01-01") == 0
    assert io.read_table(spark, dst).select("id", "name", "extra").collect() == [(1, "x", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish.copy_into(spark, src, str(tmp_path / "d2"), schema, "2024-01-01", on_error="abort")


def test_unload_caps_rows_and_replaces_day(spark, tmp_path):
    for n in (100, 50):
        out = publish.unload(spark.range(n).coalesce(1), str(tmp_path / "m"), "2024-01-01", max_file_mb=1, row_bytes=1024 * 1024 // 10)
        assert spark.read.parquet(out).count() == n
    assert len(list((tmp_path / "m" / "date=2024-01-01").glob("*.parquet"))) == 5


def test_sync_unknown_table(spark):
    with pytest.raises(ValueError):
        publish.sync_marts(spark, {}, {}, "x", "y", "2024-01-01", "2024-01-01", only=["nope"])


def test_snapshot_and_statistics(spark, tmp_path):
    publish.snapshot(spark.range(2), str(tmp_path / "s"), "2024-01-01")
    assert spark.read.parquet(str(tmp_path / "s")).columns == ["id", "snapshot_ts"]
    spark.sql(f"CREATE TABLE stats_probe (a INT) USING parquet LOCATION '{tmp_path}/probe'")
    io.analyze(spark, "stats_probe")
    spark.sql("DROP TABLE stats_probe")


def test_manifest_from_real_files(spark, tmp_path):
    base = tmp_path / "bronze/ecommerce/orders/date=2024-01-01/hour=05"
    base.mkdir(parents=True)
    (base / "a.parquet").write_bytes(b"x" * 200)
    (base / "b.parquet").write_bytes(b"x")
    (base / "c.keep").write_bytes(b"x" * 200)
    got = {r.file_name: r for r in manifest.file_manifest(manifest.list_files(spark, str(tmp_path)), str(tmp_path)).collect()}
    assert (got["a.parquet"].domain, got["a.parquet"].execution_date, got["a.parquet"].hour, got["a.parquet"].status) == ("orders", "2024-01-01", "05", "ready")
    assert (got["b.parquet"].reason, got["c.keep"].reason) == ("too_small", "not_parquet")


def test_ledger_expires(spark):
    files = spark.createDataFrame([("bronze/ecommerce/orders/date=2024-01-01/a.parquet", 500), ("bronze/ecommerce/orders/date=2024-01-01/b.parquet", 500)],
                                  "path string, length long").withColumn("modificationTime", F.to_timestamp(F.lit("2024-01-01")))
    ready = manifest.file_manifest(files)
    first = manifest.new_work(ready, None, "2024-01-01")
    assert tuple(manifest.work_summary(first).first()) == (1, 1)
    ledger = manifest.ledger_entries(first, "2024-01-01")
    assert manifest.work_summary(manifest.new_work(ready, ledger, "2024-01-05")).first().processed == 0
    assert manifest.work_summary(manifest.new_work(ready, ledger, "2024-01-09")).first().processed == 1
    assert manifest.work_summary(manifest.new_work(ready, ledger, "2024-01-05", "file")).first().processed == 1


def test_routing_and_folders(spark):
    df = spark.createDataFrame([("order",), ("click",), ("other",)], "event_type string")
    assert [r[0] for r in df.select(landing.route_domain("event_type")).collect()] == ["orders", "clickstream", "unknown"]
    assert landing.folder_of("unknown") == catalog.UNKNOWN_FOLDER


def test_stream_velocity_equals_batch(spark, tmp_path, rows):
    data = [(f"t{i}", f"c{i % 3}", 1000 * i, i * 1.5) for i in range(60)] + [("t60", None, 40500, 1.0), ("t61", "c1", None, None), (None, "c1", 40500, 2.0)]
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, s int, amount double").withColumn("transaction_ts", F.timestamp_seconds("s")).drop("s")
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for low, high in ((0, 20000), (20000, 41000), (41000, 10**9)):
        part = df.where(F.coalesce(F.col("transaction_ts").cast("long"), F.lit(0)).between(low, high - 1))
        part.write.mode("append").parquet(source)
        stateful.velocity_stream(spark.readStream.schema(df.schema).parquet(source), out, checkpoint).awaitTermination()
    stateful.velocity_close(spark, out, checkpoint)
    got = stateful.velocity_rows(spark, out).select("transaction_id", "amount", "transaction_ts", "txn_velocity_1h")
    want = fraud.with_signals(df).select("transaction_id", "amount", "transaction_ts", "txn_velocity_1h")
    assert rows(got) == rows(want) and stateful.late_rows(spark, out).isEmpty()


def test_stream_velocity_out_of_order(spark, tmp_path, rows):
    times = [0, 1000, 5000, 2000, 3000, 4000, 9000, 1500]
    df = spark.createDataFrame([(f"t{i}", "c", t) for i, t in enumerate(times)], "transaction_id string, customer_id string, s int") \
        .withColumn("transaction_ts", F.timestamp_seconds("s")).drop("s")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    for part in (["t0", "t1", "t2"], ["t3", "t4", "t5"], ["t6"], ["t7"]):
        df.where(F.col("transaction_id").isin(part)).write.mode("append").parquet(str(tmp_path / "in"))
        stateful.velocity_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), out, checkpoint, delay_seconds=5000).awaitTermination()
    for _ in range(2):
        stateful.velocity_close(spark, out, checkpoint)
    got = stateful.velocity_rows(spark, out).select("transaction_id", "txn_velocity_1h")
    want = fraud.with_signals(df.where("transaction_id <> 't7'")).select("transaction_id", "txn_velocity_1h")
    assert rows(got) == rows(want)
    assert rows(stateful.late_rows(spark, out), "transaction_id") == [("t7",)]


def test_stream_velocity_state_follows_the_watermark(spark, tmp_path):
    """A customer who never stops: state holds the slots the watermark has not left, not the whole past."""
    df = spark.range(4000).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("hot").alias("customer_id"), F.timestamp_seconds(F.col("id") * 60).alias("transaction_ts"))
    out, checkpoint, held = str(tmp_path / "out"), str(tmp_path / "ck"), []
    for low in range(0, 4000, 1000):
        df.where(F.col("transaction_ts").cast("long").between(low * 60, (low + 1000) * 60 - 1)).write.mode("append").parquet(str(tmp_path / "in"))
        stateful.velocity_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), out, checkpoint, delay_seconds=600).awaitTermination()
        counts, waiting = (spark.read.format("statestore").option("stateVarName", n).load(checkpoint) for n in ("counts", "waiting"))
        held.append((counts.agg(F.sum(F.size("value.seconds"))).first()[0], waiting.count()))
    assert all(seconds <= 3 * 60 and left <= 11 for seconds, left in held)
    stateful.velocity_close(spark, out, checkpoint)
    got = {r.transaction_id: r.txn_velocity_1h for r in stateful.velocity_rows(spark, out).collect()}
    assert got == {f"t{i}": min(i, 60) + 1 for i in range(4000)}


def test_dimension_lookup_by_time(spark, rows):
    dim = spark.createDataFrame([("m", "2024-01-01", "2024-02-01", "k1"), ("m", "2024-02-01", None, "k2")], "merchant_id string, f string, t string, merchant_sk string") \
        .select("merchant_id", F.to_timestamp("f").alias("valid_from"), F.to_timestamp("t").alias("valid_to"), "merchant_sk")
    fact = spark.createDataFrame([(1, "m", "2023-12-31"), (2, "m", "2024-01-31"), (3, "m", "2024-02-01"), (4, "x", "2024-02-01")], "i int, merchant_id string, d string") \
        .withColumn("ts", F.to_timestamp("d"))
    assert rows(star.lookup_sk(fact, dim, "merchant_id", "ts", "merchant_sk"), "i", "merchant_sk") == [(1, "-1"), (2, "k1"), (3, "k2"), (4, "-1")]
    assert rows(star.lookup_sk(fact, dim, "merchant_id", "ts", "merchant_sk", True), "i", "merchant_sk")[0] == (1, "k1")


def test_date_dimension(spark):
    d = star.dim_date(spark)
    assert d.count() == 3653
    row = d.where("date_sk = 20240331").first()
    assert (row.day_of_week, row.day_name, row.is_weekend, row.fiscal_year, row.fiscal_quarter, row.week_of_year) == (1, "Sunday", True, 2023, 4, 13)
    assert star.dim_payment_method(spark).count() == 10


def land(spark, lake, domain, date, rows_):
    spark.createDataFrame([tuple(r.get(f) for f in S.RAW_FIELDS[domain]) for r in rows_], S.raw_schema(domain)) \
        .write.mode("append").parquet(f"{lake.bronze(domain)}/date={date}/hour=00")


def test_two_days(spark, tmp_path):
    lake = catalog.Lake(str(tmp_path))
    with pytest.raises(io.MissingData):
        jobs.gate(spark, lake, "2024-01-01")
    assert jobs.run_orders(spark, lake, "2024-01-01", "2024-01-02") == jobs.NO_DATA
    order = dict(order_id="o1", customer_id="c1", merchant_id="m1", order_status="pending", order_ts="2024-01-01 10:00:00",
                 updated_ts="2024-01-01 10:00:00", currency="USD", gross_amount="20", item_count="1", payment_method="PayPal", shipping_country="us")
    txn = dict(transaction_id="t1", customer_id="c1", merchant_id="m1", transaction_ts="2024-01-01 10:00:00", amount="20", currency="USD",
               transaction_type="purchase", status="completed", is_international="false")
    person = dict(customer_id="c1", source_system="app", first_name="Ann", last_name="Lee", email="ann@x.org", phone="5551234567",
                  country="us", postal_code="A1", segment="new", registration_ts="2023-12-01 00:00:00", is_active="true")
    land(spark, lake, "orders", "2024-01-01", [order, {**order, "order_id": "o2", "order_status": "lost"}, {**order, "updated_ts": "2024-01-01 11:00:00"}])
    land(spark, lake, "transactions", "2024-01-01", [txn])
    land(spark, lake, "customers", "2024-01-01", [person, {**person, "customer_id": "p1", "source_system": "pay"}, {**person, "customer_id": "x", "email": "bad"}])
    assert jobs.run_orders(spark, lake, "2024-01-01", "2024-01-02", dry_run=True).count() == 1
    assert not (tmp_path / "silver").exists()
    first = jobs.run_day(spark, lake, "2024-01-01", "2024-01-02")
    assert {k: first["orders"][k] for k in ("raw_count", "clean_count", "quarantine_count", "silver_count", "dupes_removed")} \
        == {"raw_count": 3, "clean_count": 2, "quarantine_count": 1, "silver_count": 1, "dupes_removed": 1}
    assert first["entities"]["multi_member_clusters"] == 1 and first["entities"]["matched_pairs"] == 1
    assert first["quality"].where("status = 'fail'").count() == 0
    assert {r.table: r.rows_loaded for r in first["sync"].collect()} == {"customer_360": 2, "daily_order_summary": 1, "fraud_summary": 1}
    assert spark.read.parquet(lake.quarantine("customers")).count() == 1

    land(spark, lake, "orders", "2024-02-02", [{**order, "order_status": "delivered", "order_ts": "2024-02-01 10:00:00", "updated_ts": "2024-02-02 10:00:00"}])
    land(spark, lake, "transactions", "2024-02-02", [txn, {**txn, "transaction_id": "t2", "transaction_ts": "2024-02-02 09:00:00", "amount": "600"}])
    land(spark, lake, "customers", "2024-02-02", [{**person, "segment": "vip"}])
    second = jobs.run_day(spark, lake, "2024-02-02", "2024-02-03")
    orders = io.read_table(spark, lake.silver("orders")).collect()
    assert [(r.order_id, r.order_status, r.order_month) for r in orders] == [("o1", "delivered", 2)]
    assert io.read_table(spark, lake.silver("transactions")).count() == 2
    kept = io.read_table(spark, lake.silver("customers")).where("customer_id = 'c1'").first()
    assert (kept.segment, kept.resolved_entity_id) == ("vip", "ent_c1")
    assert second["transactions"]["flagged_count"] == 1
    assert {r.part: r.n for r in second["graph"].collect()} == {r.part: r.n for r in graph.load_counts(jobs.read_graph(spark, lake)).collect()}
    assert {r.table: r.n for r in second["star"].collect()} == {"dim_customer": 3, "dim_merchant": 1, "fact_orders": 1, "fact_transactions": 2}
    daily = {name: df.drop("mart_updated_at").collect() for name, df in jobs.build_marts(spark, lake, "2024-02-02", "2024-06-03").items()}
    full = {name: df.drop("mart_updated_at").collect() for name, df in jobs.build_marts(spark, lake, "2024-02-02", "2024-06-03", full_refresh=True).items()}
    assert {n: sorted(r, key=repr) for n, r in daily.items()} == {n: sorted(r, key=repr) for n, r in full.items()}
    assert second["orders"]["silver_count"] == 1 and {r.order_id for r in io.read_table(spark, lake.silver("orders")).collect()} == {"o1"}
