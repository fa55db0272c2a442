"""What keeps the daily run and PageRank within time and disk on large tables."""

import re

from pyspark.sql import functions as F

from oreline.operators import matching as M, pagerank as P
from oreline.plans import entities, marts
from oreline.session import shared_dir
from oreline.sources import tables as io
from oreline.sources.snapshots import folder_names
from tests.test_scaling_r03 import plan_of


def test_stored_batches_are_not_stored_again(spark, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(io, "keep_table", lambda df, label: stored.append(label) or df)
    batch = spark.createDataFrame([(1, "a"), (2, None)], "k int, p string")
    for write, path in ((io.upsert_table, "u"), (io.append_new, "a")):
        for _ in range(2):
            write(spark, str(tmp_path / path), batch, ["k"], ["p"], kept=True)
        assert sorted(r.k for r in io.read_table(spark, str(tmp_path / path)).collect()) == [1, 2]
    assert not stored
    io.upsert_table(spark, str(tmp_path / "u"), batch, ["k"], ["p"])
    assert stored == ["batch"]


def test_labels_of_nothing_and_of_no_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, ""), (2, "a")], "k int, p string")
    assert sorted(map(str, (v["p"] for v in io._labels(df, ["p"]).values()))) == ["", "None", "a"]
    assert list(io._labels(df, ())) == ["all"] and io._labels(df.limit(0), ()) == {} == io._labels(df.limit(0), ["p"])


def test_matched_pairs_are_counted_among_profiles_that_can_match(spark):
    from tests.test_entities_graph import frame, people

    alone = [(f"x{i:03}", "app", "ann lee", f"x{i}@x.org", f"9{i}", "L000", "A1", "annA1", 20, "US") for i in range(200)]
    nobody = [(i, s, "bo li", "m1", "p1", "L000", "A1", "boA1", 20, "US") for i, s in (("n1", None), ("n2", None), ("n3", "app"))]
    df = frame(spark, [*people(n=60), *nobody, *alone])
    nodes = entities.live_nodes(df)
    assert nodes.count() < 100 and nodes.where("id like 'x%'").isEmpty()
    links = entities.match_links(df, nodes=nodes)
    want = entities.matched_pair_count(df, links).first()[0]
    assert entities.matched_pair_count(df, links, nodes=nodes).first()[0] == want > 0
    found = entities.resolve(df, "2024-01-01", links=links)
    assert entities.er_metrics(df, links, found, nodes=nodes).collect() == entities.er_metrics(df, links, found).collect()


def test_pair_counts_by_hash(spark, rows):
    data = [("a", "x", "1"), ("b", "x", "1"), ("b", "x", None), (None, "x", "1"), ("a", "x1", ""), ("b", "x", "1"), ("c", None, "1")]
    df = spark.createDataFrame(data, "s string, p string, q string")
    pairs = lambda key: sum(x[0] != y[0] and None not in key(x) and key(x) == key(y) for i, x in enumerate(data) for y in data[:i])
    got = rows(M.pair_counts(df, [("p",), ("p", "q")], "s", F.lit(1)))
    assert got == [("p", pairs(lambda r: r[1:2]), 5), ("p+q", pairs(lambda r: r[1:]), 4)]
    assert re.search(r"hashpartitioning\(set#\d+, h0#\d+L, h1#\d+L, _source", plan_of(M.pair_counts(df, [("p",), ("p", "q")], "s", F.lit(1))))


def test_customer_metrics_count_kinds_without_copies_of_their_rows(spark, rows):
    orders = spark.createDataFrame(
        [("o1", "c", "card", "US", "2024-01-01"), ("o2", "c", "card", "GB", "2024-01-02"), ("o3", "c", None, "US", "2024-01-03"), ("o4", "c", "cash", None, None),
         ("o5", None, "cash", "US", "2024-01-01"), ("o6", "d", None, None, "2024-01-01")],
        "order_id string, customer_id string, payment_method string, shipping_country string, d string").select(
        "order_id", "customer_id", "payment_method", "shipping_country", F.lit("delivered").alias("order_status"), F.lit(2).cast("decimal(18,2)").alias("net_amount"),
        F.lit(0).cast("decimal(18,2)").alias("discount_amount"), F.lit(0).cast("decimal(8,4)").alias("discount_pct"), F.lit(1).alias("item_count"),
        F.lit(False).alias("is_weekend"), F.to_timestamp("d").alias("order_ts"))
    for method in marts.MOST_RECENT:
        made = marts.customer_order_metrics(orders, "2024-02-01", method)
        assert rows(made) == rows(marts.customer_order_metrics(orders, "2024-02-01", method, unique_ids=False)) or method == "mode"
        assert rows(made, "customer_id", "total_orders", "distinct_payment_methods", "distinct_shipping_countries") == sorted(
            [("c", 4, 2, 2), (None, 1, 1, 1), ("d", 1, 0, 0)], key=repr)
        assert "Expand" not in plan_of(made)
    bought = [("c", "2024-01-01", "web", "purchase"), ("c", "2024-01-01", "app", "purchase"), ("c", "2024-01-02", "app", "purchase"), ("c", "2024-01-03", "tv", "refund"),
              ("c", None, None, "purchase"), ("d", "2024-01-01", "web", "refund"), (None, "2024-01-01", None, "purchase")]
    txns = spark.createDataFrame(bought, "customer_id string, d string, device_type string, transaction_type string").select(
        "customer_id", F.to_date("d").alias("txn_date"), F.to_timestamp("d").alias("transaction_ts"), "device_type", "transaction_type", F.lit("completed").alias("status"),
        F.lit(3).cast("decimal(18,2)").alias("amount"), F.lit(True).alias("is_international"), F.lit(1).alias("risk_score"), F.lit("LOW").alias("risk_tier"),
        F.lit(None).cast("boolean").alias("flag_velocity_spike"), F.lit(True).alias("flag_amount_anomaly"))
    for method, device in (("max", "web"), ("latest", "app")):
        made = marts.customer_txn_metrics(txns, "2024-02-01", method)
        assert rows(made, "customer_id", "total_txn_count", "active_days", "distinct_devices", "most_recent_device", "refund_count", "max_risk_score") == sorted(
            [("c", 4, 2, 2, device, 1, 1), (None, 1, 1, 0, None, 0, 1)], key=repr)
        assert "Expand" not in plan_of(made)


def plain_ranks(edges, rounds, d=0.85):
    links = {(a, b) for a, b in edges if a is not None}
    out = {a: sum(x == a for x, _ in links) for a, _ in links}
    nodes = {x for e in edges for x in e if x is not None} | {b for _, b in links}
    score = dict.fromkeys(nodes, 1 - d)
    for _ in range(rounds):
        score = {n: 1 - d + sum(score[a] * d / out[a] for a, b in links if b == n) for n in nodes}
    return score


def test_pagerank_in_turns_with_hubs_salts_and_unknown_ends(spark, monkeypatch):
    key = P._key
    # without salt the even nodes share a key
    monkeypatch.setattr(P, "_key", lambda name, salt: key(name, salt) if salt else F.when(F.col(name).cast("int") % 2 == 0, F.lit(1).cast("long")).otherwise(key(name, 0)))
    edges = [(str(i), str(j)) for i in range(12) for j in range(12) if (i * 7 + j * 5) % 4 == 0] + [("1", "2"), ("1", "2"), ("3", "3"), ("4", None), (None, "40"), (None, None)]
    df = spark.createDataFrame(edges, "src string, dst string")
    for together, at_a_time, cut_every in ((10_000, 10_000, 1), (2, 10, 1), (2, 10_000, 3)):
        monkeypatch.setattr(P, "TOGETHER", together)
        monkeypatch.setattr(P, "AT_A_TIME", at_a_time)
        got = {r.id: r.score for r in P.pagerank(df, iterations=4, cut_every=cut_every).collect()}
        want = plain_ranks(edges, 4)
        assert got.keys() == want.keys() and None in got
        assert all(abs(got[n] - want[n]) < 1e-9 for n in want)


def test_pagerank_leaves_its_scores_only(spark):
    folder = f"{shared_dir(spark)}/oreline"
    kept = lambda: {n for n in folder_names(spark, folder) if n.startswith("pagerank")}
    before, tables = kept(), spark.catalog.listTables()
    edges = spark.range(0, 30, 1, 2).select((F.col("id") % 7).alias("src"), (F.col("id") % 5).alias("dst"))
    scores = P.pagerank(edges, iterations=2)
    assert len(kept() - before) == 1 and spark.catalog.listTables() == tables
    assert scores.count() == 7 and scores.schema["id"].dataType.simpleString() == "bigint"


def test_shuffles_of_earlier_rounds_are_freed(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(P, "free_shuffles", lambda s: freed.append(1))
    P.pagerank(spark.range(8).select(F.col("id").alias("src"), ((F.col("id") + 1) % 8).alias("dst")), iterations=5)
    assert len(freed) >= 5
