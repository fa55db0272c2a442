"""Matching, components and graph answers against brute force, with hot groups."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from oreline.functions.similarity import jaro_winkler_batch, keys_of_name
from oreline.operators import matching as M
from oreline.operators.components import connected_components
from oreline.operators.pagerank import pagerank, undirected
from oreline.plans import entities, graph as G

COLUMNS = ("customer_id source_system full_name_norm email_normalised phone_normalised last_name_soundex postal_code_norm "
           "block_key_1 age country").split()


def people(seed=3, n=260, hot=0.34):
    """Few values per field, NULLs, copies, and a third of all rows with one e-mail and one phone."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        name = rnd.choice(["ann lee", "anne lee", "bob roy", "bo roy", "", "zed"])
        postal = rnd.choice(["A1", "B2", None])
        mail, phone = rnd.choice(["m1", "m2", "m3", None]), rnd.choice(["p1", "p2", None])
        if rnd.random() < hot:
            mail, phone = "hot", "hot"
        out.append((f"id{i:04}", rnd.choice(["app", "pay", "mob"]), name, mail, phone, rnd.choice(["L000", "R000", None]), postal,
                    None if postal is None else name[:3] + postal, rnd.choice([20, 21, 40, None]), rnd.choice(["US", "GB", None])))
    return out


def frame(spark, data):
    kinds = " string, ".join(COLUMNS[:8]) + " string, age long, country string"
    df = spark.createDataFrame(data, kinds)
    return df.withColumns({"block_key_2": F.col("email_normalised"), "block_key_3": F.col("phone_normalised"), "city_norm": F.lit(None).cast("string")})


def brute_pairs(data):
    found = []
    for a, b in combinations(sorted(data), 2):
        if a[1] == b[1]:
            continue
        same = {c: x is not None and x == y for c, x, y in zip(COLUMNS, a, b)}
        if not (same["email_normalised"] or same["phone_normalised"] or same["block_key_1"]):
            continue
        sim = float(jaro_winkler_batch(pd.Series([a[2]]), pd.Series([b[2]]))[0])
        age = a[8] is not None and b[8] is not None and abs(a[8] - b[8]) <= 2
        score = (5 * same["email_normalised"] + 4 * same["phone_normalised"] + 2 * same["last_name_soundex"]
                 + same["postal_code_norm"] + same["country"] + age + 3 * sim)
        found.append((a[0], b[0], min(score / 17, 1.0)))
    return found


def closure(ids, edges):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {i: find(i) for i in ids}


def test_signatures():
    assert M.threshold_signatures(0.75) == [
        ("email", "phone", "age"), ("email", "phone", "country"), ("email", "phone", "postal"), ("email", "phone", "soundex"),
        ("email", "soundex", "postal", "country", "age")]
    sure = M.threshold_signatures(0.75, certain=True)
    assert ("email", "phone", "soundex", "postal", "country") in sure and ("email", "phone", "name", "soundex") in sure and len(sure) == 8
    assert set(M.threshold_signatures(0.0)) == {("email",), ("phone",), ("k1",)}


@pytest.mark.parametrize("threshold", [0.75, 0.4])
def test_entities_equal_brute_force(spark, threshold):
    data = people()
    scored = brute_pairs(data)
    ids = [d[0] for d in data]
    expected = closure(ids, [(a, b) for a, b, p in scored if p >= threshold])
    df = frame(spark, data)
    got = entities.resolve(df, "2024-01-01", threshold).collect()
    assert {r.customer_id: r.component for r in got} == expected
    sizes = Counter(expected.values())
    assert all(r.cluster_size == sizes[r.component] for r in got)
    links = entities.match_links(df, threshold)
    assert entities.matched_pair_count(df, links, threshold).first()[0] == sum(p >= threshold for *_, p in scored)
    ratio = M.reduction_ratio(df).first()
    assert ratio.candidate_pairs == len(scored)


def call_centre(n, seed=7):
    """One e-mail, one phone and one country for everybody; names, postal codes and ages differ."""
    rnd = random.Random(seed)
    firsts = ["maria", "john", "wei", "fatima", "olga", "juan", "priya", "kwame", "yuki", "ahmed", "chloe", "sven", "ines", "tariq", "zoe", "bogdan"]
    lasts = ["smith", "garcia", "mueller", "okafor", "novak", "chen", "rossi", "dubois", "haddad", "kowalski", "jensen", "silva", "obrien", "nguyen", "fischer", "moreau"]
    out = []
    for i in range(n):
        name = f"{rnd.choice(firsts)} {rnd.choice('abcdefghijklmnoprstvw')} {rnd.choice(lasts)}{rnd.choice(['', 'ova', 'son', 'ez'])}"
        at = rnd.randrange(len(name))
        name = name[:at] + rnd.choice(["", "x", name[at] * 2]) + name[at + 1:] if rnd.random() < 0.5 else name
        out.append((f"id{i:04}", ["app", "pay"][i % 2], name, "desk@x.org", "555", None, f"P{i}", None, None, "US"))
    return out


def test_call_centre_pairs_follow_similar_names(spark):
    data = call_centre(400)
    nodes = M.profiles(M.with_profile_key(frame(spark, data)))
    every = M.candidate_pairs(nodes, skip_certain=True)
    few = M.candidate_pairs(nodes, skip_certain=True, least_group=64)
    pairs, made = every.count(), few.count()
    want = {(r.id_a, r.id_b) for r in M.matched(M.score_pairs(every)).collect()}
    got = [(r.id_a, r.id_b) for r in M.matched(M.score_pairs(few)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert made <= len(want) + pairs / 20, (pairs, made, len(want))


@pytest.mark.parametrize("threshold, least_group", [(0.75, 2), (0.6, 5)])
def test_entities_by_shared_name_keys_equal_brute_force(spark, threshold, least_group):
    data = people(5, 200) + [(f"cc{i}", *row[1:]) for i, row in enumerate(call_centre(60))]
    expected = closure([d[0] for d in data], [(a, b) for a, b, p in brute_pairs(data) if p >= threshold])
    df = frame(spark, data)
    links = entities.match_links(df, threshold, least_group=least_group)
    assert {r.customer_id: r.component for r in entities.resolve(df, "2024-01-01", threshold, links=links).collect()} == expected
    assert entities.matched_pair_count(df, links, threshold).first()[0] == sum(p >= threshold for *_, p in brute_pairs(data))


@pytest.mark.parametrize("similarity", [0.72, 0.8, 11 / 12, 0.95])
def test_similar_names_share_a_key(similarity):
    rnd = random.Random(2)
    letters = "abcdeinorst zé"
    names = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 15))) for _ in range(4000)]
    others = []
    for name in names:
        chars = list(name)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(chars) + 1)
            kind = rnd.randrange(3)
            if kind == 0 and len(chars) > 1:
                chars.pop(min(at, len(chars) - 1))
            elif kind == 1:
                chars.insert(at, rnd.choice(letters))
            elif len(chars) > 1:
                at = min(at, len(chars) - 2)
                chars[at], chars[at + 1] = chars[at + 1], chars[at]
        others.append("".join(chars))
    close = jaro_winkler_batch(pd.Series(names), pd.Series(others)) >= similarity
    assert close.sum() > 500
    assert all(set(keys_of_name(a, similarity)) & set(keys_of_name(b, similarity)) for a, b, c in zip(names, others, close) if c)
    assert keys_of_name("", similarity) == []


def test_certain_links_stay_linear(spark):
    """A group that agrees on every exact field gives one link per profile, not all pairs."""
    data = [(f"id{i:04}", ["app", "pay"][i % 2], f"name {i}", "hot", "hot", "N000", "P1", "namP1", i, "US") for i in range(300)]
    df = frame(spark, data)
    links = entities.match_links(df)
    assert links.count() <= 300
    assert entities.resolve(df, "2024-01-01", links=links).select("component").distinct().count() == 1


def test_unknown_evidence(spark):
    pairs = spark.createDataFrame([("a", "b", "m", None)], "id_a string, id_b string, email_a string, email_b string")
    none = lambda kind: F.lit(None).cast(kind)
    for c in ("phone", "soundex", "postal", "country", "name", "k1"):
        pairs = pairs.withColumns({f"{c}_a": none("string"), f"{c}_b": none("string")})
    pairs = pairs.withColumns({"age_a": none("long"), "age_b": none("long")})
    assert M.score_pairs(pairs).first().is_match is False
    # a NULL score counts as certain in the compatible form
    assert M.score_pairs(pairs, compat=True).first().match_probability == 1.0


def test_pair_features(spark):
    nodes = M.profiles(M.with_profile_key(frame(spark, people(n=20, hot=0))))
    ids = [r.id for r in nodes.orderBy("id").collect()]
    pairs = spark.createDataFrame([(ids[0], ids[1])], "id_a string, id_b string")
    assert M.pair_features(pairs, nodes).count() == 1


def test_matcher_can_be_trained(spark):
    scored = M.score_pairs(M.candidate_pairs(M.profiles(M.with_profile_key(frame(spark, people(n=120)))), 0.4), 0.7)
    model = entities.train_matcher(scored.withColumn("label", F.col("is_match")))
    out = entities.predict_matches(model, scored)
    assert 0 <= out.agg(F.min("match_probability")).first()[0] <= out.agg(F.max("match_probability")).first()[0] <= 1


@pytest.mark.parametrize("seed", [1])
def test_components(spark, seed):
    rnd = random.Random(seed)
    ids = [f"n{i:03}" for i in range(200)]
    edges = [(ids[0], i) for i in rnd.sample(ids[1:], 60)]  # a hub
    edges += list(zip(ids[100:160], ids[101:161]))          # a long path
    edges += [tuple(rnd.sample(ids, 2)) for _ in range(15)] + [(ids[5], ids[5])]
    v = spark.createDataFrame([(i,) for i in ids], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r.id: r.component for r in connected_components(v, e).collect()}
    assert got == closure(ids, edges)


def test_components_without_edges(spark, rows):
    v = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(connected_components(v, spark.createDataFrame([], "src string, dst string"))) == [("a", "a"), ("b", "b")]


def test_pagerank_small(spark):
    e = spark.createDataFrame([("a", "m"), ("b", "m")], "src string, dst string")
    got = {r.id: r.score for r in pagerank(undirected(e), iterations=40).collect()}
    # fixpoint: m = .15 + .85 (a + b), a = b = .15 + .425 m
    m = (0.15 + 1.7 * 0.15) / (1 - 1.7 * 0.425)
    assert got["m"] == pytest.approx(m, abs=5e-3) and got["a"] == pytest.approx(0.15 + 0.425 * m, abs=5e-3)


@pytest.fixture
def shop(spark):
    """Half of all transactions at one merchant."""
    rnd = random.Random(9)
    data = []
    for i in range(700):
        m = "hot" if rnd.random() < 0.5 else f"m{rnd.randrange(8)}"
        data.append((f"t{i}", f"c{rnd.randrange(40)}", m, f"2024-01-{rnd.randrange(1, 31):02}", rnd.choice(["HIGH", "LOW"]), rnd.choice("xy")))
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, merchant_id string, txn_date string, risk_tier string, merchant_category string") \
        .withColumns({"transaction_ts": F.to_timestamp("txn_date"), "txn_date": F.to_date("txn_date")})
    return data, G.txn_graph(df, df.select("customer_id").distinct())


@pytest.mark.parametrize("k", [3, 50])
def test_fraud_rings_equal_all_pairs(shop, k):
    data, g = shop
    n_all, n_new = Counter(), Counter()
    for _, c, m, d, tier, _ in data:
        if tier == "HIGH":
            n_all[m, c] += 1
            n_new[m, c] += d >= "2024-01-15"
    pairs = [(c1, c2, m, n_new[m, c1] * n_all[m2, c2]) for (m, c1) in n_all for (m2, c2) in n_all if m == m2 and c1 != c2]
    best = sorted((p for p in pairs if p[3] >= 3), key=lambda p: (-p[3], p[0], p[1], p[2]))[:k]
    got = G.fraud_rings(g, "2024-01-30", 3, k, days=15).select("customer_1", "customer_2", "shared_merchant", "shared_risk_events")
    assert sorted(tuple(r) for r in got.collect()) == sorted(best)


@pytest.mark.parametrize("min_count", [1, 2, 3])
def test_product_affinity_with_huge_baskets(spark, min_count):
    rnd = random.Random(min_count)
    lines = {(o, rnd.randrange(25)) for o in range(40) for _ in range(rnd.randrange(1, 6))}
    lines |= {(100, p) for p in range(25)} | {(101, p) for p in range(20)} | {(102, p) for p in range(0, 25, 2)}
    orders = defaultdict(list)
    for o, p in lines:
        orders[o].append(p)
    n = Counter(pair for ps in orders.values() for pair in combinations(sorted(ps), 2))
    best = sorted(((a, b, c) for (a, b), c in n.items() if c >= min_count), key=lambda x: (-x[2], x[0], x[1]))[:30]
    df = spark.createDataFrame(sorted(lines), "order_id int, product_id int")
    got = G.product_affinity(df, None, min_count, 30)
    assert sorted(tuple(r) for r in got.collect()) == sorted(best)


@pytest.mark.parametrize("need", [1, 3])
def test_churn_contagion_equals_brute_force(spark, need):
    rnd = random.Random(need)
    status = {f"c{i:02}": rnd.choice(["active", "churned", "loyal"]) for i in range(30)}
    visits = {(c, "hot" if rnd.random() < 0.3 else f"m{rnd.randrange(20)}") for c in status for _ in range(3)}
    orders = [(f"o{i}", c, m) for i, (c, m) in enumerate(sorted(visits))]
    people_ = spark.createDataFrame([(c, s, float(i % 7), "2024-01-20" if i % 3 else "2023-01-01") for i, (c, s) in enumerate(status.items())],
                                    "customer_id string, churn_status string, estimated_ltv double, d string") \
        .withColumns({"last_order_date": F.to_date("d"), "ltv_tier": F.lit("x"), "total_spend": F.lit(1.0)})
    g = G.order_graph(spark.createDataFrame(orders, "order_id string, customer_id string, merchant_id string"), people_)
    shops = defaultdict(set)
    for _, c, m in orders:
        shops[m].add(c)
    result = []
    for i, (c, s) in enumerate(status.items()):
        near = {x for m, cs in shops.items() if c in cs for x in cs if status[x] == "churned"}
        if s == "active" and i % 3 and len(near) >= need:
            result.append((float(i % 7), c, len(near)))
    best = sorted(result, key=lambda r: (-r[0], r[1]))[:5]
    got = G.churn_contagion(g, "2024-01-30", need, 5).collect()
    assert sorted((r.customer_id, r.churned_in_network) for r in got) == sorted((c, n) for _, c, n in best)


def test_same_as_star_and_hops(spark, rows):
    em = spark.createDataFrame([("a", "a", "s1", 3), ("b", "a", "s2", 3), ("c", "a", "s1", 3), ("d", "d", "s1", 2), ("e", "d", "s2", 2), ("f", "f", "s1", 1)],
                               "customer_id string, component string, source_system string, cluster_size long") \
        .withColumns({"resolved_entity_id": F.concat(F.lit("ent_"), "component"), "full_name_norm": F.lit("n"), "email_normalised": F.lit("e"),
                      "country": F.lit("US"), "er_confidence": F.lit(0.75)})
    g = G.Graph(customers=G.customer_vertices(em), same_as=G.same_as_edges(em))
    assert rows(g.same_as, "id_a", "id_b") == [("a", "b"), ("a", "c"), ("d", "e")]
    assert G.same_as_pairs(g.same_as).first().pairs == 4
    assert rows(G.same_as_edges(em, cross_source=True), "id_a", "id_b") == [("a", "b"), ("b", "c"), ("d", "e")]
    assert rows(G.cross_source_pairs(em)) == [("a", 2), ("d", 1)]
    assert rows(G.twin_counts(g.same_as)) == [("a", 2), ("b", 2), ("c", 2), ("d", 1), ("e", 1)]
    assert rows(G.entity_profiles(g, hops=3), "customer_id", "linked_profiles") == [("a", 3), ("b", 3), ("c", 3), ("d", 1), ("e", 1), ("f", 0)]
    assert rows(G.linked_profiles(g, "b")) == [("a",), ("c",)]
    assert rows(G.linked_profiles(g, "b", hops=3)) == [("a",), ("b",), ("c",)]


def test_graph_360_branches_do_not_multiply(spark):
    people_ = spark.createDataFrame([("c", "ent_c", "n", 1)], "customer_id string, resolved_entity_id string, full_name string, cluster_size long")
    orders = spark.createDataFrame([("o1", "c", "m1", 10.0), ("o2", "c", "m1", 5.0), ("o3", "x", "m2", 7.0)],
                                   "order_id string, customer_id string, merchant_id string, net_amount double")
    txns_ = spark.createDataFrame([("t1", "c", "m1", 4.0, "x", "2024-01-01"), ("t2", "c", "m3", 8.0, "y", "2024-01-02")],
                                  "transaction_id string, customer_id string, merchant_id string, amount double, merchant_category string, d string") \
        .withColumn("transaction_ts", F.to_timestamp("d"))
    a, b = G.order_graph(orders, people_), G.txn_graph(txns_, people_)
    g = G.Graph(customers=people_, orders=a.orders, placed=a.placed, paid_via=a.paid_via, transactions=b.transactions, made=b.made, at=b.at,
                merchants=G.merge_merchants(a.merchants, b.merchants), same_as=spark.createDataFrame([], "id_a string, id_b string"))
    one = G.graph_customer_360(g, "c").first()
    assert (one.total_orders, one.total_spend, one.distinct_merchants, one.total_transactions, one.avg_txn_amount) == (2, 15.0, 1, 2, 6.0)
    assert G.graph_customer_360(g, "c", compat=True).first().total_spend == 30.0
    assert G.graph_metrics(g, compat=True).first().graph_total_spend == 30.0
    assert a.paid_via.count() == 2  # the order of an unknown customer has no edges


def test_search(spark):
    df = spark.createDataFrame([("1", "ann lee", "a@x.org"), ("2", "bo", "lee@y.com"), ("3", "zed", None)],
                               "customer_id string, full_name string, email_normalised string")
    assert [r.customer_id for r in G.search_customers(df, ["Lee", "ann"]).collect()] == ["1", "2"]


def test_components_of_a_long_chain(spark):
    from oreline.operators.components import connected_components
    n = 300
    edges = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = connected_components(spark.range(n), edges)
    assert got.select("component").distinct().collect()[0].component == 0 and got.count() == n
