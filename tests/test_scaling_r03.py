"""Work and state that must not outgrow the input."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from oreline.functions import parse
from oreline.operators.components import unplaced_links
from oreline.operators import fraud, pagerank as P
from oreline.operators.dedupe import latest_per_key
from oreline.plans import graph as G
from oreline.session import adopt, shuffles_for, spread
from oreline.streaming import stateful


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_velocity_state_is_kept_by_bucket_not_by_customer(spark, tmp_path):
    df = spark.range(300).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.concat(F.lit("c"), F.col("id") % 100).alias("customer_id"),
                                 F.timestamp_seconds(F.col("id") + 40).alias("transaction_ts"))
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    df.write.parquet(source)
    stateful.velocity_stream(spark.readStream.schema(df.schema).parquet(source), out, checkpoint, delay_seconds=100, buckets=2).awaitTermination()
    counts = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
    assert counts.count() <= 2 * 2
    stateful.velocity_close(spark, out, checkpoint)
    got = {r.transaction_id: r.txn_velocity_1h for r in stateful.velocity_rows(spark, out).collect()}
    assert got == {f"t{i}": i // 100 + 1 for i in range(300)}


def test_unplaced_links_need_no_nested_loop(spark, rows):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("x", "y")], "src string, dst string")
    known = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("x", "x")], "id string, component string")
    found = unplaced_links(links, known)
    assert rows(found) == [("c", "d"), ("x", "y"), ("x", "y")]
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_spread_deals_one_task_over_all(spark, rows):
    df = spark.range(0, 1000, 1, 1).withColumn("v", F.col("id").cast("string"))
    dealt = spread(df)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in sizes) < 250
    assert rows(dealt) == rows(df)


def test_raw_rows_are_dealt_over_all_cores(spark):
    from checks import fixtures as X

    for made in (X.bronze_customers, X.bronze_transactions):
        busy = made(spark, "/root/testdata/sf0.001").select(F.spark_partition_id()).distinct().count()
        assert busy >= spark.sparkContext.defaultParallelism


def test_small_files_are_dealt_by_their_bytes(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(24):  # eight long files among short ones
        spark.range(0, 400_000 if i < 8 else 10, 1, 1).select(F.xxhash64("id").alias("v")).write.mode("append").parquet(path)
    sizes = sorted(r["count"] for r in adopt(spark).read.parquet(path).groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 500_000


def test_shuffles_follow_the_rows(spark, rows, monkeypatch):
    name = "spark.sql.shuffle.partitions"
    before, seen = spark.conf.get(name), []
    with shuffles_for(spark, 10_000_000):
        assert int(spark.conf.get(name)) == 20
    assert spark.conf.get(name) == before
    kept = G._pairs
    monkeypatch.setattr(G, "shuffles_for", lambda s, n: shuffles_for(s, n, 3))
    monkeypatch.setattr(G, "_pairs", lambda lines: seen.append(int(spark.conf.get(name))) or kept(lines))
    lines = spark.createDataFrame([(o, p) for o in range(20) for p in range(3)], "order_id int, product_id int")
    assert rows(G.product_affinity(lines, min_count=2)) == [(0, 1, 20), (0, 2, 20), (1, 2, 20)]
    assert seen == [20, 20] and spark.conf.get(name) == before


def test_pagerank_finds_its_edges_once(spark):
    met = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(v):
        met.add(1)
        return v

    edges = spark.range(0, 10, 1, 1).select(counted.asNondeterministic()(F.col("id")).alias("src"), ((F.col("id") + 1) % 10).alias("dst"))
    P.pagerank(edges, iterations=1).collect()
    assert met.value == 10


def test_only_profiles_met_in_another_source_are_paired(spark, rows):
    from oreline.operators import matching as M
    from tests.test_entities_graph import frame, people

    alone = [(f"x{i:03}", "app", "ann lee", f"x{i}@x.org", f"9{i}", "L000", "A1", "annA1", 20, "US") for i in range(200)]
    lost = [("n1", None, "ann lee", "m1", "p1", "L000", "A1", "annA1", 20, "US"), ("n1", "app", "zed", "m1", "p1", "R000", "B2", "zedB2", 40, "GB")]
    nodes = M.profiles(M.with_profile_key(frame(spark, [*people(n=60), *lost, *alone])))
    live = M.live_profiles(nodes)
    kept = {r.id for r in live.collect()}
    assert kept and not any(i.startswith("x") for i in kept)
    entries = M._with_signature_keys(live, M.threshold_signatures(0.75), sets=M.shared_sets(0.75))
    assert not entries.where("id like 'x%'").count() and "live" not in entries.columns
    for threshold in (0.75, 0.6, 0.0):
        every = nodes.withColumn("live", F.array(*[F.lit(i) for i in range(len(M.shared_sets(threshold)))]))
        for made in (M.candidate_pairs, M.certain_links):
            # with every set live nothing is left out
            assert rows(made(M.live_profiles(nodes, threshold), threshold)) == rows(made(every, threshold))


def test_a_fact_that_is_joined_is_found_once_by_the_next_join(spark, rows):
    from oreline.operators.asof import asof_join

    met = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(v):
        met.add(1)
        return v

    at = F.timestamp_seconds(F.col("id") * 86_400)
    stg = spark.range(0, 40, 1, 1).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("k"), F.when(F.col("id") % 5 > 0, at).alias("ts"))
    versions = spark.range(0, 3, 1, 1).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(10 * 86_400)).alias("since"), (F.col("id") * 10).alias("v"))
    costly = stg.withColumn("seen", counted.asNondeterministic()(F.col("id")))
    found = rows(asof_join(costly, versions, "k", "ts", "since", ["v"], times=stg), "id", "v")
    assert met.value == 40
    assert found == sorted(((i, i % 3 * 10 if i % 4 and i % 5 and i >= 10 else None) for i in range(40)), key=repr)
    assert found == rows(asof_join(stg, versions, "k", "ts", "since", ["v"]), "id", "v")


def test_names_that_meet_again_are_compared_once(monkeypatch):
    import pandas as pd

    from oreline.functions import similarity as S

    left = pd.Series(["ana müller", "anna muller", None, "", "ana müller", "x"] * 500)
    right = pd.Series(["anna muller", "ana müller", "ana müller", "x", "anna muller", "x"] * 500)
    compared, kept = [], S._block
    monkeypatch.setattr(S, "_block", lambda a, b: compared.append(len(a)) or kept(a, b))
    got = S.jaro_winkler_batch(left, right)
    assert sum(compared) == 3
    assert list(got) == [float(S.jaro_winkler_batch(left[i:i + 1], right[i:i + 1])[0]) for i in range(6)] * 500
    assert S.jaro_winkler_batch(left[:0], right[:0]).empty


def test_whole_rows_are_sorted_by_a_hash_of_their_key(spark, rows):
    df = spark.createDataFrame([("txn_1", 1, "x"), ("txn_1", 2, "y"), ("txn_2", None, "z"), (None, 5, "a"), (None, 4, "b")], "k string, t int, v string")
    out = latest_per_key(df, ["k"], "t")
    assert rows(out) == sorted([("txn_1", 2, "y"), ("txn_2", None, "z"), (None, 5, "a")], key=repr)
    assert re.search(r"Sort \[_w\d+#\d+L ASC NULLS FIRST, k#", plan_of(out))


def test_whole_rows_meet_their_signals_unsorted(spark, rows):
    df = spark.createDataFrame([("t1", "c", 10, 1.0), ("t2", "c", 20, 2.0), ("t2", "c", 20, 2.0), ("t3", None, 20, 2.0), ("t4", "d", None, 2.0)],
                               "transaction_id string, customer_id string, s long, amount double") \
        .select("transaction_id", "customer_id", F.timestamp_seconds("s").alias("transaction_ts"), "amount")
    base = spark.createDataFrame([("c", 1.5, 0.5, 3)], "customer_id string, avg_amount_30d double, stddev_amount_30d double, txn_count_30d long")
    out = fraud.with_signals(df, base)
    assert rows(out, "transaction_id", "txn_velocity_1h", "txn_count_30d") == sorted(
        [("t1", 1, 3), ("t2", 3, 3), ("t2", 3, 3), ("t3", None, None), ("t4", None, None)], key=repr)
    assert re.search(r"ShuffledHashJoin \[customer_id#\d+, second#\d+L\]", plan_of(out))


def test_plain_times_are_parsed_without_a_formatter(spark):
    texts = ["2024-01-01", "2024-01-01 10:11:12", "2024-02-30 10:11:12", " 024-01-01 00:00:00", "2024-01-01 00:00:1 ", "2024-01-01 00:00:5Z", "2024-01-01 24:00:00",
             "2024-01-01 23:59:60", "0000-01-01 00:00:00", "abcd-ef-gh ij:kl:mn", "2024-01-01 +1:00:00", "2024-03-31 02:30:00", "2024-01-0Z", "1582-10-10", "bad", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    text = F.col("t")
    by_layout = F.coalesce(*[F.when(parse._may_fit(text, x), F.try_to_timestamp(text, F.lit(x))) for x in parse.ORDER_LAYOUTS], F.try_to_timestamp(text))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for where in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", where)
            made = df.select("t", parse.parse_ts("t", parse.ORDER_LAYOUTS).alias("got"), by_layout.alias("want"))
            assert made.where(~F.col("got").eqNullSafe(F.col("want"))).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert re.search(r"CASE WHEN .*length\(t#\d+\) = 19.* THEN (try_)?(to_timestamp|gettimestamp|cast)\(t#\d+", plan_of(df.select(parse.parse_ts("t", parse.ORDER_LAYOUTS))))
