"""Incremental and as-of forms against whole runs and brute force."""

import datetime as dt
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from oreline.operators import asof, bitmaps, fraud, paths
from oreline.operators.components import connected_components, extend_components, merge_components
from oreline.plans import graph as G, serving


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_two_days_equal_one_run(spark, rows, seed):
    rnd = random.Random(seed)
    edges = [(f"n{rnd.randrange(90):02}", f"n{rnd.randrange(90):02}") for _ in range(70)] + [("n00", "n00"), (None, "n01")]
    old = [f"n{i:02}" for i in range(20, 90)]
    first = [e for e in edges[:40] if e[0] in old and e[1] in old]
    today = [e for e in edges if e not in first]
    frame = lambda e: spark.createDataFrame(e, "src string, dst string")
    nodes = spark.createDataFrame([(n,) for n in old], "id string")
    known = connected_components(nodes, frame(first))
    changed = extend_components(known, frame(today))
    ids = sorted({n for e in edges if None not in e for n in e} | set(old))
    full = connected_components(spark.createDataFrame([(n,) for n in ids], "id string"), frame([e for e in edges if None not in e]))
    assert rows(merge_components(known, changed)) == rows(full)
    before, after = dict(map(tuple, known.collect())), dict(map(tuple, full.collect()))
    assert {r.id for r in changed.collect()} == {n for n in ids if before.get(n) != after[n]}


def test_components_without_new_edges_stay(spark, rows):
    known = spark.createDataFrame([("b", "a"), ("a", "a")], "id string, component string")
    none = spark.createDataFrame([], "src string, dst string")
    assert extend_components(known, none).collect() == []
    assert rows(merge_components(known, extend_components(known, none))) == [("a", "a"), ("b", "a")]


def all_paths(links, start, hops):
    out, todo = [], [(start, ())]
    for length in range(1, hops + 1):
        todo = [(b if a == node else a, used + (i,)) for node, used in todo for i, (a, b) in enumerate(links)
                if None not in (a, b) and node in (a, b) and i not in used]
        out += [(start, node, length) for node, _ in todo]
    return out


def test_paths_on_a_chain_and_random_links(spark, rows):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(6)]
    tangled = [(rnd.randrange(8), rnd.randrange(8)) for _ in range(11)] + [(1, 2), (1, 2), (3, 3), (None, 1)]
    for links in (chain, tangled):
        starts = [0, 3, 99]
        df, ids = spark.createDataFrame(links, "src int, dst int"), spark.createDataFrame([(s,) for s in [*starts, 3]], "id int")
        want = [p for s in starts for p in all_paths(links, s, 4)]
        assert rows(paths.link_paths(df, ids, 4)) == sorted(want, key=repr)
        least = defaultdict(lambda: 9)
        for s, e, n in want:
            if s != e:
                least[s, e] = min(least[s, e], n)
        assert rows(paths.reached(df, ids, 4)) == sorted([(s, e, n) for (s, e), n in least.items()], key=repr)


@pytest.mark.parametrize("slice_seconds", [3, 50, 10 ** 6])
def test_as_of_join_equals_brute_force(spark, rows, slice_seconds):
    rnd = random.Random(slice_seconds)
    versions = [(rnd.choice(["hot", "b", "c"]), rnd.randrange(0, 200), None if rnd.random() < 0.6 else rnd.randrange(0, 260), f"v{i}", i) for i in range(14)]
    versions += [("hot", 50, None, "tie", 1), ("hot", 50, None, "tie", 2), (None, 1, None, "x", 0), ("b", None, None, "y", 0)]
    facts = [(i, "hot" if i % 3 else rnd.choice(["b", "c", "d", None]), None if i == 7 else rnd.randrange(-20, 260)) for i in range(150)]
    at = lambda s: F.timestamp_seconds(s)
    v = spark.createDataFrame(versions, "k string, s int, u int, name string, n int").withColumns({"since": at("s"), "until": at("u")})
    f = spark.createDataFrame(facts, "i int, k string, s int").withColumn("at", at("s"))
    want = []
    for i, k, s in facts:
        held = [x for x in versions if k is not None and s is not None and x[0] == k and x[1] is not None and x[1] <= s]
        # of equal beginnings the greatest (until, values); without an end counts as smallest
        best = max(held, key=lambda x: (x[1], x[2] is not None, x[2] or 0, x[3], x[4])) if held else None
        best = best if best and (best[2] is None or best[2] > s) else None
        want.append((i, best and best[3], best and best[4]))
    got = asof.asof_join(f, v.drop("s"), "k", "at", "since", ["name", "n"], "until", slice_seconds)
    assert got.columns == ["i", "k", "s", "at", "name", "n"]
    assert rows(got, "i", "name", "n") == sorted(want, key=repr)


def test_as_of_join_without_versions(spark, rows):
    f = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "i int, k string, at timestamp")
    v = spark.createDataFrame([], "k string, since timestamp, name string")
    assert rows(asof.asof_join(f, v, "k", "at", "since", ["name"]), "i", "name") == [(1, None)]
    assert asof.asof_join(f.limit(0), v, "k", "at", "since", ["name"]).collect() == []


def test_bitmaps_roll_up(spark, rows):
    rnd = random.Random(6)
    data = [(f"2024-0{1 + rnd.randrange(2)}-{1 + rnd.randrange(28):02}", None if rnd.random() < 0.05 else f"c{rnd.randrange(400)}") for _ in range(3000)]
    df = spark.createDataFrame(data, "day string, who string")
    first = bitmaps.dense_numbers(df.where("day < '2024-02'"), "who")
    numbers = bitmaps.dense_numbers(df, "who", first)
    assert sorted(r.number for r in numbers.collect()) == list(range(len({w for _, w in data if w})))
    assert first.exceptAll(numbers.select("who", "number")).isEmpty()
    far = numbers.withColumn("number", F.col("number") * 1000)  # numbers with gaps fill several buckets
    for n in (numbers, far):
        daily = bitmaps.distinct_bitmaps(df.join(n, "who", "left"), ["day"])
        months = bitmaps.merged_bitmaps(daily, [F.substring("day", 1, 7).alias("month")])
        want = Counter(d[:7] for d, w in {(d[:7], w) for d, w in data if w})
        assert rows(bitmaps.distinct_counts(months, ["month"])) == sorted(want.items())
    assert bitmaps.dense_numbers(df.limit(0), "who").collect() == []


def test_baseline_from_days_equals_the_rows(spark):
    rnd = random.Random(8)
    data = [(f"c{rnd.randrange(6)}", None if rnd.random() < 0.1 else round(rnd.uniform(0, 9000), 2), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 40))) for _ in range(400)]
    data += [("single", 5.0, dt.datetime(2024, 2, 1)), ("none", None, dt.datetime(2024, 2, 1)), ("same", 7.1, dt.datetime(2024, 2, 1)), ("same", 7.1, dt.datetime(2024, 2, 2))]
    df = spark.createDataFrame(data, "customer_id string, amount double, transaction_ts timestamp")
    on_time, late = df.randomSplit([0.8, 0.2], 3)
    days = fraud.merged_partials(fraud.daily_partials(on_time), fraud.daily_partials(late))
    got = {r.customer_id: r for r in fraud.baseline_from_partials(days, "2024-02-05").collect()}
    window = defaultdict(list)
    for c, amount, ts in data:
        if dt.datetime(2024, 1, 6) <= ts < dt.datetime(2024, 2, 5):
            window[c].append(amount)
    assert set(got) == set(window)
    for c, amounts in window.items():
        known = [a for a in amounts if a is not None]
        assert got[c].txn_count_30d == len(amounts)
        assert got[c].avg_amount_30d == (pytest.approx(statistics.mean(known)) if known else None)
        assert got[c].stddev_amount_30d == (pytest.approx(statistics.stdev(known), abs=1e-9) if len(known) > 1 else None)
    assert got["same"].stddev_amount_30d == 0.0


def test_guarded_sql_refuses_a_name_defined_in_another_scope(spark):
    given = {"customers": spark.createDataFrame([(1,)], "x int")}
    spark.createDataFrame([(42,)], "x int").createOrReplaceTempView("secret")
    try:
        for sql in ("SELECT b.x FROM (WITH secret AS (SELECT 1 AS a) SELECT * FROM secret) q CROSS JOIN secret b", "SELECT * FROM secret",
                    "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret"):
            with pytest.raises(ValueError):
                serving.safe_sql(spark, sql, given).collect()
        assert serving.safe_sql(spark, "WITH own AS (SELECT x + 1 AS y FROM customers) SELECT y FROM own", given).first().y == 2
    finally:
        spark.catalog.dropTempView("secret")


def test_search_by_the_stored_index_reads_the_asked_words_only(spark, tmp_path, rows):
    people = [(f"c{i}", f"ann {'lee' if i % 3 else 'roy'} w{i}", f"user{i}@x.org" if i % 5 else None) for i in range(300)] + [("none", None, None), ("odd", "  Ünal-ann ", "")]
    df = spark.createDataFrame(people, "customer_id string, full_name string, email_normalised string")
    path = str(tmp_path / "terms")
    for _ in range(2):  # stored anew: the same
        G.store_search_index(df, path, 32)
    for terms in (["Roy", "w7"], ["ann", "ANN", "org"], ["ünal"], ["nobody"], []):
        got = G.search_index(df, path, terms, 32)
        assert rows(got, "customer_id", "hits") == rows(G.search_customers(df, terms), "customer_id", "hits")
    plan = G.search_index(df, path, ["w7"], 32)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
