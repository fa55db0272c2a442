"""Property graph as vertex and edge tables, and the questions asked of it.

Paths are joins over aggregated edges. SAME_AS links, which make every cluster a clique, are kept as
one edge per member to the cluster's smallest id: a member's neighbours are the other members of its
star, at one hop and at any number of hops.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendar import AsOf, at_date
from ..operators.bitmaps import dense_numbers, distinct_bitmaps, distinct_counts, merged_bitmaps
from ..operators.filters import project_present, top_k
from ..operators.pagerank import pagerank, undirected
from ..operators import quality as Q
from ..session import keep_table, shuffles_for


@dataclass(frozen=True)
class Graph:
    """Vertices by label, edges by type. Parts that were not loaded are None."""

    customers: DataFrame | None = None
    orders: DataFrame | None = None
    transactions: DataFrame | None = None
    merchants: DataFrame | None = None
    products: DataFrame | None = None
    locations: DataFrame | None = None
    placed: DataFrame | None = None
    paid_via: DataFrame | None = None
    made: DataFrame | None = None
    at: DataFrame | None = None
    same_as: DataFrame | None = None
    contains: DataFrame | None = None
    lives_in: DataFrame | None = None
    located_in: DataFrame | None = None

    def parts(self) -> dict[str, DataFrame]:
        found = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in found.items() if df is not None}


# ---- loading --------------------------------------------------------------------------------------

def customer_vertices(entity_map: DataFrame) -> DataFrame:
    return entity_map.select(
        "customer_id", "resolved_entity_id", "source_system", F.col("full_name_norm").alias("full_name"),
        "email_normalised", "country", "er_confidence", "cluster_size")


# Columns of order and transaction vertices.
ORDER_COLUMNS = [
    "order_id", "customer_id", "merchant_id", "order_status", "order_ts", "order_date", "net_amount", "item_count",
    "currency", "payment_method", "shipping_country",
]
TRANSACTION_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "transaction_ts", "txn_date", "amount", "currency",
    "transaction_type", "status", "risk_score", "risk_tier", "is_international", "device_type", "merchant_category",
]


def _known(edges: DataFrame, customers: DataFrame) -> DataFrame:
    return edges.join(customers.select("customer_id"), "customer_id", "left_semi")


def order_graph(orders: DataFrame, customers: DataFrame) -> Graph:
    """Order vertices; PLACED and PAID_VIA edges of orders whose customer is known."""
    rows = project_present(orders, ORDER_COLUMNS)
    linked = _known(rows.select("order_id", "customer_id", "merchant_id"), customers)
    paid = linked.where("merchant_id is not null").select("order_id", "merchant_id").distinct()
    return Graph(
        customers=customers,
        orders=rows.drop("customer_id", "merchant_id").withColumnRenamed("order_status", "status"),
        placed=linked.select("customer_id", "order_id").distinct(), paid_via=paid,
        merchants=paid.select("merchant_id").distinct().withColumn("merchant_category", F.lit(None).cast("string")))


def txn_graph(txns: DataFrame, customers: DataFrame) -> Graph:
    """Transaction vertices; MADE and AT edges; the merchant's category is that of its latest transaction."""
    rows = project_present(txns, TRANSACTION_COLUMNS)
    linked = _known(rows.select("transaction_id", "customer_id", "merchant_id", "merchant_category",
                                "transaction_ts"), customers)
    sold = linked.where("merchant_id is not null")
    newest = F.struct("transaction_ts", "transaction_id")
    return Graph(
        customers=customers,
        transactions=rows.drop("customer_id", "merchant_id", "merchant_category", "transaction_ts")
        .withColumnRenamed("transaction_type", "txn_type"),
        made=linked.select("customer_id", "transaction_id").distinct(),
        at=sold.select("transaction_id", "merchant_id").distinct(),
        merchants=sold.groupBy("merchant_id").agg(F.max_by("merchant_category", newest).alias("merchant_category")))


def merge_merchants(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).groupBy("merchant_id").agg(F.max("merchant_category").alias("merchant_category"))


def same_as_edges(entity_map: DataFrame, cross_source: bool = False) -> DataFrame:
    """(id_a, id_b, confidence): each member of a multi-member cluster to the cluster's smallest id.

    ``cross_source`` links members of different sources only: those of another source than the smallest id's to it, and those of
    its own source to the smallest id of another one. That joins the same members as all pairs of different sources would.
    """
    multi = entity_map.where("cluster_size > 1")
    root = F.col("component")
    members = multi.where(F.col("customer_id") != root)
    other = root
    if cross_source:
        roots = multi.where(F.col("customer_id") == root).select("component", F.col("source_system").alias("_root_source"))
        members = members.join(roots, "component")
        apart = F.col("source_system") != F.col("_root_source")
        first = members.where(apart).groupBy("component").agg(F.min("customer_id").alias("_first"))
        members = members.where("source_system IS NOT NULL").join(first, "component")
        other = F.when(apart, root).otherwise(F.col("_first"))
    return members.select(F.least(other, F.col("customer_id")).alias("id_a"), F.greatest(other, F.col("customer_id")).alias("id_b"),
                          F.col("er_confidence").alias("confidence"))


def cross_source_pairs(entity_map: DataFrame) -> DataFrame:
    """(component, pairs): pairs of members of different sources, counted from the sources' sizes."""
    sizes = entity_map.where("cluster_size > 1 AND source_system IS NOT NULL").groupBy("component", "source_system").agg(F.count("*").alias("n"))
    return sizes.groupBy("component").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).cast("long").alias("pairs")).where("pairs > 0")


def product_edges(lines: DataFrame, order: str, product: str) -> DataFrame:
    return lines.select(F.col(order).alias("order_id"), F.col(product).alias("product_id")).distinct()


def location_graph(customers: DataFrame, merchants: DataFrame) -> Graph:
    """Location vertices by country and city, LIVES_IN and LOCATED_IN edges."""
    key = F.concat_ws("|", "country", "city").alias("location_key")
    usable = "country is not null or city is not null"
    lives = customers.where(usable).select("customer_id", key)
    located = merchants.where(usable).select("merchant_id", key)
    spots = customers.where(usable).select(key, "country", "city").unionByName(
        merchants.where(usable).select(key, "country", "city")).dropDuplicates(["location_key"])
    return Graph(locations=spots, lives_in=lives.distinct(), located_in=located.distinct())


def load_graph(entity_map: DataFrame, orders: DataFrame, txns: DataFrame,
               c360: DataFrame | None = None, contains: DataFrame | None = None,
               products: DataFrame | None = None) -> Graph:
    """All parts from the resolved customers and the silver tables.

    Figures the graph questions read from customers come from the customer 360 mart, if given.
    """
    people = customer_vertices(entity_map)
    if c360 is not None:
        people = people.join(c360.select(
            "customer_id", "ltv_tier", "churn_status", "estimated_ltv", "high_risk_txn_count", "total_risk_score",
            F.to_date("last_order_ts").alias("last_order_date"),
            F.col("total_order_revenue").alias("total_spend")), "customer_id", "left")
    ordered, sold = order_graph(orders, people), txn_graph(txns, people)
    return replace(
        ordered, transactions=sold.transactions, made=sold.made, at=sold.at,
        merchants=merge_merchants(ordered.merchants, sold.merchants),
        same_as=same_as_edges(entity_map), contains=contains, products=products)


def load_counts(graph: Graph) -> DataFrame:
    """(part, n) of every loaded part."""
    return Q.table_counts(graph.parts()).withColumnRenamed("table", "part")


def graph_stats(graph: Graph) -> DataFrame:
    """(label, n): vertices per label, all edges, and the SAME_AS pairs the clusters stand for."""
    parts = graph.parts()
    labels = [p for p in ("customers", "orders", "transactions", "merchants", "products", "locations") if p in parts]
    types = [p for p in ("placed", "paid_via", "made", "at", "contains", "lives_in", "located_in") if p in parts]
    counts = Q.table_counts({p: parts[p] for p in labels}).withColumnRenamed("table", "label")
    edges = Q.table_counts({p: parts[p] for p in types}).agg(F.sum("n").alias("n"))
    one = edges.select(F.lit("relationships").alias("label"), "n")
    if graph.same_as is None:
        return counts.unionByName(one)
    twins = same_as_pairs(graph.same_as)
    return counts.unionByName(one).unionByName(twins.select(F.lit("same_as").alias("label"), F.col("pairs").alias("n")))


def same_as_pairs(same_as: DataFrame) -> DataFrame:
    """One row: linked pairs. A star of k edges stands for a clique of k + 1 members."""
    star = same_as.groupBy("id_a").agg(F.count("*").alias("k"))
    return star.agg(F.coalesce(F.sum(F.expr("k * (k + 1) div 2")), F.lit(0)).cast("long").alias("pairs"))


def graph_constraints(graph: Graph) -> DataFrame:
    """Uniqueness of every vertex key, and an entity id on every customer."""
    keys = {"customers": "customer_id", "orders": "order_id", "transactions": "transaction_id",
            "merchants": "merchant_id", "products": "product_id", "locations": "location_key"}
    parts = graph.parts()
    suite = {label: [Q.unique(key)] for label, key in keys.items() if label in parts}
    suite.setdefault("customers", []).append(Q.not_null("resolved_entity_id"))
    return Q.run_suite(parts, suite)


# ---- per customer ---------------------------------------------------------------------------------

def twin_counts(same_as: DataFrame) -> DataFrame:
    """(customer_id, linked_profiles): size of the customer's star without itself."""
    star = same_as.groupBy("id_a").agg(F.count("*").alias("linked_profiles"))
    members = same_as.select("id_a", F.col("id_b").alias("customer_id")).unionByName(
        star.select("id_a", F.col("id_a").alias("customer_id")))
    return members.join(star, "id_a").select("customer_id", "linked_profiles")


def _order_side(g: Graph, placed: DataFrame) -> DataFrame:
    rows = placed.join(g.orders.select("order_id", "net_amount"), "order_id", "left")
    return rows.groupBy("customer_id").agg(F.count("*").alias("total_orders"), F.sum("net_amount").alias("total_spend"))


def _txn_side(g: Graph, made: DataFrame) -> DataFrame:
    rows = made.join(g.transactions.select("transaction_id", "amount"), "transaction_id", "left")
    return rows.groupBy("customer_id").agg(F.count("*").alias("total_transactions"),
                                           F.avg("amount").alias("avg_txn_amount"))


def graph_metrics(g: Graph, compat: bool = False) -> DataFrame:
    """Orders, transactions and spend per customer.

    Branches are aggregated on their own; ``compat`` scales spend by the number of transactions, as
    chained optional matches do.
    """
    o, t = _order_side(g, g.placed), _txn_side(g, g.made)
    joined = g.customers.select("customer_id").join(o, "customer_id", "left").join(t, "customer_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    factor = F.greatest(zero("total_transactions"), F.lit(1)) if compat else F.lit(1)
    return joined.select(
        "customer_id", zero("total_orders").alias("graph_order_count"),
        zero("total_transactions").alias("graph_txn_count"),
        (zero("total_spend") * factor).alias("graph_total_spend"))


def graph_customer_360(g: Graph, customer_id: str | None = None, compat: bool = False) -> DataFrame:
    """Graph context of one customer, or of all; the id filter reaches every edge table."""
    def mine(df: DataFrame) -> DataFrame:
        return df if customer_id is None else df.where(F.col("customer_id") == customer_id)

    placed, made, same_as = mine(g.placed), mine(g.made), g.same_as
    if customer_id is not None:
        root = same_as.where((F.col("id_a") == customer_id) | (F.col("id_b") == customer_id)).select("id_a").distinct()
        same_as = same_as.join(root, "id_a", "left_semi")
    shops = placed.join(g.paid_via, "order_id").select("customer_id", "merchant_id").distinct() \
        .groupBy("customer_id").agg(F.count("*").alias("distinct_merchants"))
    profile = [F.col(c) if c in g.customers.columns else F.lit(None).cast("string").alias(c)
               for c in ("ltv_tier", "churn_status")]
    people = mine(g.customers).select(
        "customer_id", F.col("resolved_entity_id").alias("entity_id"), F.col("full_name").alias("name"), *profile)
    sides = [_order_side(g, placed), shops, _txn_side(g, made), mine(twin_counts(same_as))]
    whole = reduce(lambda left, right: left.join(right, "customer_id", "left"), sides, people)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    spend = F.col("total_spend")
    if compat:
        spend = spend * F.greatest(zero("total_transactions"), F.lit(1)) * F.greatest(zero("linked_profiles"), F.lit(1))
    return whole.select(
        *people.columns, zero("total_orders").alias("total_orders"), spend.alias("total_spend"),
        zero("distinct_merchants").alias("distinct_merchants"),
        zero("total_transactions").alias("total_transactions"), "avg_txn_amount",
        zero("linked_profiles").alias("linked_profiles"))


def graph_context(g: Graph, customer_id: str | None = None) -> DataFrame:
    """Serving form of ``graph_customer_360``: missing sums and means are 0."""
    full = graph_customer_360(g, customer_id)
    double = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    return full.select("customer_id", "total_orders", double("total_spend"), "distinct_merchants",
                       "total_transactions", double("avg_txn_amount"), "linked_profiles")


# ---- networks -------------------------------------------------------------------------------------

def fraud_rings(g: Graph, as_of: AsOf, min_shared: int = 3, k: int = 50, days: int = 30) -> DataFrame:
    """The k customer pairs with most shared high-risk paths through one merchant.

    A path is (recent high-risk transaction of the first, high-risk transaction of the second), so a
    pair's paths are the product of two counts. Of the k best pairs at a merchant the first customer is
    among its k + 1 largest recent counts and the second among its k + 1 largest counts, hence only
    those are paired: the work per merchant is bounded whatever its number of customers, and the
    outcome is that of all pairs.
    """
    high = g.transactions.where("risk_tier = 'HIGH'").select("transaction_id", "txn_date")
    recent = F.col("txn_date") >= F.date_sub(at_date(as_of), days)
    counts = high.join(g.made, "transaction_id").join(g.at, "transaction_id") \
        .groupBy("merchant_id", "customer_id").agg(F.count_if(recent).alias("n_recent"), F.count("*").alias("n_all"))

    def best(n: str, name: str) -> DataFrame:
        ranked = Window.partitionBy("merchant_id").orderBy(F.desc(n), "customer_id")
        return counts.where(F.col(n) > 0).withColumn("_rank", F.row_number().over(ranked)) \
            .where(F.col("_rank") <= k + 1) \
            .select("merchant_id", F.col("customer_id").alias(name), F.col(n))

    pairs = best("n_recent", "customer_1").join(best("n_all", "customer_2"), "merchant_id") \
        .where("customer_1 <> customer_2") \
        .withColumn("shared_risk_events", F.col("n_recent") * F.col("n_all")) \
        .where(F.col("shared_risk_events") >= min_shared)
    order = [F.desc("shared_risk_events"), F.asc("customer_1"), F.asc("customer_2"), F.asc("merchant_id")]
    return top_k(pairs, order, k).join(g.merchants.select("merchant_id", "merchant_category"), "merchant_id", "left") \
        .select("customer_1", "customer_2", F.col("merchant_id").alias("shared_merchant"),
                F.col("merchant_category").alias("category"), "shared_risk_events")


#: Most frequent products whose pairs are counted first, and largest baskets that are looked up instead of paired, at most.
FREQUENT, LARGEST = 256, 1000


def product_affinity(contains: DataFrame, products: DataFrame | None = None, min_count: int = 10, k: int = 100) -> DataFrame:
    """The k product pairs bought together in most orders, at least ``min_count``.

    The pairs of the ``FREQUENT`` most frequent products are counted first; the k-th best of them is a floor the k best of all reach. A
    product in fewer orders than the floor cannot be in such a pair and goes, however long the baskets are. Of the baskets left,
    up to ``LARGEST`` of the largest (fewer than the floor) are not paired: a pair found only there is too rare, and one found
    elsewhere gets these baskets added by looking up which of them hold both products.
    """
    lines = keep_table(contains.select("order_id", "product_id").distinct(), "lines")
    # pairs grow with the lines, so their shuffles are sized by them
    with shuffles_for(lines.sparkSession, lines.count()):
        counts = keep_table(lines.groupBy("product_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_count), "counts")
        frequent = F.broadcast(top_k(counts, [F.desc("n"), F.asc("product_id")], FREQUENT).select("product_id"))
        first = _pairs(lines.join(frequent, "product_id", "left_semi")).where(F.col("n") >= min_count)
        reached = top_k(first.select("n"), [F.desc("n")], k).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).first()
        floor = max(min_count, reached["least"]) if reached["pairs"] == k else min_count
        kept = keep_table(lines.join(counts.where(F.col("n") >= floor).select("product_id"), "product_id", "left_semi"), "kept")
        sizes = kept.groupBy("order_id").agg(F.count("*").alias("n"))
        # at most LARGEST rows, so broadcasting it is safe
        huge = F.broadcast(top_k(sizes, [F.desc("n"), F.asc("order_id")], min(max(floor - 1, 0), LARGEST)).select("order_id"))
        pairs = _pairs(kept.join(huge, "order_id", "left_anti"))
        # of a product, the large baskets that hold it: at most LARGEST ids
        inside = kept.join(huge, "order_id", "left_semi").groupBy("product_id").agg(F.collect_set("order_id").alias("huge"))
        for side in ("1", "2"):
            pairs = pairs.join(inside.select(F.col("product_id").alias(f"product_{side}"),
                                             F.col("huge").alias(f"huge_{side}")), f"product_{side}", "left")
        both = F.coalesce(F.size(F.array_intersect("huge_1", "huge_2")), F.lit(0))
        found = pairs.withColumn("co_purchases", F.col("n") + F.greatest(both, F.lit(0))).where(F.col("co_purchases") >= floor)
        best = keep_table(top_k(found, [F.desc("co_purchases"), F.asc("product_1"), F.asc("product_2")], k)
                          .select("product_1", "product_2", "co_purchases"), "best")
    if products is None:
        return best
    for side in ("1", "2"):
        names = products.select(F.col("product_id").alias(f"product_{side}"), F.col("name").alias(f"product_{side}_name"))
        best = best.join(names, f"product_{side}", "left")
    return best.select("product_1", "product_1_name", "product_2", "product_2_name", "co_purchases")


def _pairs(lines: DataFrame) -> DataFrame:
    """(product_1, product_2, n): orders that hold both."""
    left = lines.select("order_id", F.col("product_id").alias("product_1"))
    right = lines.select("order_id", F.col("product_id").alias("product_2"))
    return left.join(right, "order_id").where("product_1 < product_2").groupBy("product_1", "product_2").agg(F.count("*").alias("n"))


def _customer_merchants(g: Graph) -> DataFrame:
    """(customer_id, merchant_id, n): orders of a customer paid to a merchant."""
    return g.placed.join(g.paid_via, "order_id").groupBy("customer_id", "merchant_id").agg(F.count("*").alias("n"))


def merchant_risk(g: Graph, min_customers: int = 5, k: int = 20) -> DataFrame:
    """Merchants with most risky customers; the mean risk counts a customer once per order."""
    risky = g.customers.where("high_risk_txn_count > 0").select("customer_id", "total_risk_score")
    linked = _customer_merchants(g).join(risky, "customer_id")
    totals = linked.groupBy("merchant_id").agg(
        F.count("*").alias("risky_customers"),
        F.try_divide(F.sum(F.col("n") * F.col("total_risk_score")), F.sum("n")).alias("avg_customer_risk"))
    best = top_k(totals.where(F.col("risky_customers") >= min_customers),
                 [F.desc("risky_customers"), F.asc("merchant_id")], k)
    # no raw source carries merchant names; a merchant table that has them is used
    name = F.col("merchant_name") if "merchant_name" in g.merchants.columns else F.lit(None).cast("string")
    shown = g.merchants.select("merchant_id", name.alias("merchant_name"), F.col("merchant_category").alias("category"))
    return best.join(shown, "merchant_id", "left").select("merchant_id", "merchant_name", "category", "risky_customers", "avg_customer_risk")


def churn_contagion(g: Graph, as_of: AsOf, min_churned: int = 2, k: int = 100, days: int = 30,
                    at_risk_status: str = "active", churned_status: str = "churned") -> DataFrame:
    """Recent customers who share merchants with several churned ones: the k of highest value.

    Whether a customer has ``min_churned`` churned neighbours shows from the ``min_churned`` smallest
    churned ids of each of its merchants. The full count is then made for the k reported only, by joining the merchants' bitmaps of
    churned customers: a hot merchant is a few kilobytes, not its churned customers once per reported one. The
    customer-merchant edges are stored once.
    """
    cm = keep_table(_customer_merchants(g).select("customer_id", "merchant_id"), "visits")
    churned = g.customers.where(F.col("churn_status") == churned_status).select(F.col("customer_id").alias("churned_id"))
    lost = keep_table(cm.join(churned, cm["customer_id"] == churned["churned_id"]).select("churned_id", "merchant_id"), "lost")
    recent = F.col("last_order_date") >= F.date_sub(at_date(as_of), days)
    active = g.customers.where((F.col("churn_status") == at_risk_status) & recent) \
        .select("customer_id", "ltv_tier", "total_spend", "estimated_ltv")
    ranked = Window.partitionBy("merchant_id").orderBy("churned_id")
    sample = lost.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= min_churned).drop("_rank")
    visits = cm.join(active.select("customer_id"), "customer_id", "left_semi")
    enough = visits.join(sample, "merchant_id").select("customer_id", "churned_id").distinct() \
        .groupBy("customer_id").agg(F.count("*").alias("seen")).where(F.col("seen") >= min_churned)
    chosen = keep_table(top_k(active.join(enough.select("customer_id"), "customer_id", "left_semi"),
                              [F.desc("estimated_ltv"), F.asc("customer_id")], k), "chosen")
    numbered = lost.join(dense_numbers(lost, "churned_id"), "churned_id")
    met = visits.join(F.broadcast(chosen.select("customer_id")), "customer_id", "left_semi")
    # k customers' merchants, each with a bitmap per 32,768 churned customers
    full = distinct_counts(merged_bitmaps(met.join(distinct_bitmaps(numbered, ["merchant_id"]), "merchant_id"), ["customer_id"]), ["customer_id"], "churned_in_network")
    return chosen.join(full, "customer_id").select("customer_id", "ltv_tier", "total_spend", "churned_in_network")


def influential_customers(g: Graph, k: int = 50, damping: float = 0.85, iterations: int = 20) -> DataFrame:
    """Customers by PageRank in the customer-merchant network."""
    edges = _customer_merchants(g).select(
        F.concat(F.lit("c:"), "customer_id").alias("src"), F.concat(F.lit("m:"), "merchant_id").alias("dst"))
    scores = pagerank(undirected(edges), damping, iterations)
    id_type = g.customers.schema["customer_id"].dataType
    people = scores.where(F.startswith("id", F.lit("c:"))) \
        .select(F.expr("substring(id, 3)").cast(id_type).alias("customer_id"), F.col("score").alias("pagerank_score"))
    best = top_k(people, [F.desc("pagerank_score"), F.asc("customer_id")], k)
    tier = F.col("ltv_tier") if "ltv_tier" in g.customers.columns else F.lit(None).cast("string")
    names = g.customers.select("customer_id", F.col("full_name").alias("name"), tier.alias("ltv_tier"))
    return best.join(names, "customer_id").select("customer_id", "name", "ltv_tier", "pagerank_score")


# ---- entities -------------------------------------------------------------------------------------

def linked_count(hops: int) -> Column:
    """Profiles reached in a clique of ``cluster_size``: the others, and from three hops on a triangle leads back."""
    others = F.col("cluster_size") - 1
    return F.when((F.col("cluster_size") >= 3) & F.lit(hops >= 3), others + 1).otherwise(others)


def entity_profiles(g: Graph, entity_id: str | None = None, hops: int = 3) -> DataFrame:
    """Profiles of one entity (or all) and how many profiles each is linked to within ``hops``.

    The ids behind the number are ``linked_profiles``; writing them out per profile would square the
    cluster.
    """
    found = g.customers if entity_id is None else g.customers.where(F.col("resolved_entity_id") == entity_id)
    return found.select("customer_id", "resolved_entity_id", "source_system", F.col("email_normalised").alias("email"),
                        F.col("er_confidence").alias("confidence"), linked_count(hops).alias("linked_profiles"))


def linked_profiles(g: Graph, customer_id: str, hops: int = 1) -> DataFrame:
    """Ids linked to one profile: the rest of its cluster, and itself where a path of ``hops`` returns."""
    me = g.customers.where(F.col("customer_id") == customer_id).select(
        "resolved_entity_id", F.lit(True).alias("_mine"))
    cluster = g.customers.join(me, "resolved_entity_id").where("cluster_size > 1")
    returns = (F.col("cluster_size") >= 3) & F.lit(hops >= 3)
    return cluster.where((F.col("customer_id") != customer_id) | returns) \
        .select(F.col("customer_id").alias("linked_customer_id"))


def _words() -> Column:
    return F.array_distinct(F.split(F.lower(F.concat_ws(" ", "full_name", "email_normalised")), r"[^\p{L}\p{N}]+"))


def store_search_index(customers: DataFrame, path: str, buckets: int = 256) -> None:
    """Write (term, customer_id) in folders by a hash of the term, sorted by term: a search reads the folders of its words only.

    A word that a third of all customers have is as many rows, not one list, and is written by several tasks.
    """
    rows = customers.select("customer_id", F.explode(_words()).alias("term")).where("term <> ''").withColumn("bucket", _bucket(F.col("term"), buckets).cast("int"))
    order = ["bucket", "term", "customer_id"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("bucket").parquet(path)


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets))


def search_index(customers: DataFrame, path: str, terms: Sequence[str], buckets: int = 256) -> DataFrame:
    """What ``search_customers`` finds, by the stored index."""
    spark, asked = customers.sparkSession, sorted({t.lower() for t in terms})
    places = spark.range(1).select(*[_bucket(F.lit(t), buckets).cast("int") for t in asked]).first() if asked else ()
    rows = spark.read.schema("term string, customer_id string, bucket int").parquet(path)
    hits = rows.where(F.col("bucket").isin(*places) & F.col("term").isin(*asked)).groupBy("customer_id").agg(F.count("*").cast("int").alias("hits"))
    return customers.join(hits.withColumn("customer_id", F.col("customer_id").cast(customers.schema["customer_id"].dataType)), "customer_id") \
        .orderBy(F.desc("hits"), "customer_id")


def search_customers(customers: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Customers with any of the words in name or e-mail; most words first."""
    asked = F.array_distinct(F.array(*[F.lit(t.lower()) for t in terms]))
    hits = F.size(F.array_intersect(_words(), asked))
    return customers.withColumn("hits", hits).where("hits > 0").orderBy(F.desc("hits"), "customer_id")
