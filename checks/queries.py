"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from oreline import schemas as S
from oreline.functions import calendar as cal, normalise as norm
from oreline.operators import asof, bitmaps, filters, fraud, matching as M, merge, paths, quality as Q, validate as V, windows
from oreline.operators.components import connected_components, extend_components, merge_components, unplaced_links
from oreline.operators.dedupe import latest_per_key
from oreline.operators.pagerank import pagerank, undirected
from oreline.catalog import Lake
from oreline.plans import entities, graph as G, jobs, marts, serving, silver, star, views
from oreline.session import adopt, keep_table, scratch_path
from oreline.sources import manifest, publish, tables as io
from oreline.streaming import landing, stateful

from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

CFG = fraud.FraudConfig(velocity_threshold=X.VELOCITY_THRESHOLD)
LOW_THRESHOLD = 0.6


def portable(df: DataFrame) -> DataFrame:
    """Times and lists as text, decimals as doubles with four digits: equal in any engine."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            # the nudge decides exact halves alike everywhere; adding zero turns -0.0 into 0.0
            c = F.round(c.cast("double") + F.lit(1e-9), 4) + F.lit(0.0)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.array_sort(c.cast("array<string>")), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(adopt(spark), sf_dir))

    REGISTRY[fn.__name__] = run
    return fn


# ---- stored stages --------------------------------------------------------------------------------
# Later stages read the tables earlier ones have written, as in a daily run. Each table is written once
# per application and input folder, below the shared folder.

_STORED: dict[tuple[str, str, str], str] = {}


def stored(fn):
    @wraps(fn)
    def read(spark, sf):
        key = (spark.sparkContext.applicationId, sf, fn.__name__)
        if key not in _STORED:
            path = scratch_path(spark, fn.__name__)
            io.write_table(fn(spark, sf), path)
            _STORED[key] = path
        return spark.read.parquet(_STORED[key])

    return read


@stored
def b_orders(spark, sf):
    return X.bronze_orders(spark, sf)


@stored
def b_txns(spark, sf):
    return X.bronze_transactions(spark, sf)


@stored
def b_customers(spark, sf):
    return X.bronze_customers(spark, sf)


def new_orders(spark, sf):
    return silver.silver_orders(b_orders(spark, sf), X.ORDERS_AS_OF)


def new_txns(spark, sf):
    return silver.silver_transactions(b_txns(spark, sf), txn_history(spark, sf), X.TXNS_AS_OF,
                                      X.BASELINE_AS_OF, CFG)


def new_customers(spark, sf):
    return silver.silver_customers(b_customers(spark, sf), X.ORDERS_AS_OF)


@stored
def txn_history(spark, sf):
    clean = V.clean_rows(silver.checked_transactions(b_txns(spark, sf), X.TXNS_AS_OF))
    return latest_per_key(clean, ["transaction_id"], "ingest_ts")


@stored
def s_orders(spark, sf):
    return new_orders(spark, sf)


@stored
def s_txns(spark, sf):
    return new_txns(spark, sf)


@stored
def s_customers(spark, sf):
    return new_customers(spark, sf)


@stored
def entity_map(spark, sf):
    return entities.resolve(er_customers(spark, sf), X.ORDERS_AS_OF)


@stored
def m_360(spark, sf):
    return new_360(spark, sf)


@stored
def m_daily(spark, sf):
    return new_daily(spark, sf)


@stored
def m_fraud(spark, sf):
    return new_fraud(spark, sf)


def er_customers(spark, sf):
    return M.load_er_customers(s_customers(spark, sf))


def g_orders(spark, sf):
    return marts.stg_orders(s_orders(spark, sf))


def g_txns(spark, sf):
    return marts.stg_transactions(s_txns(spark, sf))


def new_360(spark, sf):
    return marts.customer_360(
        marts.stg_customers(s_customers(spark, sf)), marts.customer_order_metrics(g_orders(spark, sf), X.ORDERS_AS_OF),
        marts.customer_txn_metrics(g_txns(spark, sf), X.TXNS_AS_OF), X.ORDERS_AS_OF)


def new_daily(spark, sf):
    return marts.daily_order_summary(g_orders(spark, sf), X.ORDERS_AS_OF)


def new_fraud(spark, sf):
    return marts.fraud_summary(g_txns(spark, sf), X.TXNS_AS_OF)


def whole_graph(spark, sf):
    """Graph over all silver rows; customers are those of the raw table, unmerged."""
    t = X.tables(spark, sf)
    return G.load_graph(
        entity_map(spark, sf), s_orders(spark, sf), s_txns(spark, sf), m_360(spark, sf),
        G.product_edges(t["lineitem"], "l_orderkey", "l_partkey"),
        t["part"].select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name")))


# ---- silver ---------------------------------------------------------------------------------------

@query
def silver_orders(spark, sf):
    return new_orders(spark, sf)


@query
def orders_quarantine(spark, sf):
    return V.quarantined_rows(silver.checked_orders(b_orders(spark, sf), X.ORDERS_AS_OF)).select(
        "order_id", "customer_id", "order_status", "order_ts", "gross_amount", "item_count",
        *[V.flag_name(r) for r in silver.order_rules(X.ORDERS_AS_OF)])


@query
def orders_rule_counts(spark, sf):
    return V.rule_counts(silver.checked_orders(b_orders(spark, sf), X.ORDERS_AS_OF))


@query
def orders_error_mask(spark, sf):
    typed = silver.typed_orders(b_orders(spark, sf))
    return typed.select(V.error_mask(silver.order_rules(X.ORDERS_AS_OF)).alias("mask")).groupBy("mask").agg(
        F.count("*").alias("n"))


@query
def orders_unknown_policies(spark, sf):
    raw = b_orders(spark, sf)
    parts = [V.validation_counts(silver.checked_orders(raw, X.ORDERS_AS_OF, policy)).withColumn("policy", F.lit(policy))
             for policy in V.UNKNOWN_POLICIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def orders_run_metrics(spark, sf):
    return silver.order_run_metrics(silver.checked_orders(b_orders(spark, sf), X.ORDERS_AS_OF))


@query
def silver_transactions_fraud(spark, sf):
    return new_txns(spark, sf)


@query
def silver_transactions_first_run(spark, sf):
    return silver.silver_transactions(b_txns(spark, sf), None, X.TXNS_AS_OF, cfg=CFG, dedupe_first=True) \
        .select("transaction_id", "txn_velocity_1h", "txn_count_30d", "flag_new_customer_high_value", "risk_score", "risk_tier")


@query
def transactions_compat(spark, sf):
    flagged = silver.flagged_transactions(
        V.clean_rows(silver.checked_transactions(b_txns(spark, sf), X.TXNS_AS_OF, "drop")),
        txn_history(spark, sf).where(F.col("transaction_ts") < cal.at_date(X.BASELINE_AS_OF)), X.BASELINE_AS_OF, CFG, True)
    return latest_per_key(flagged, ["transaction_id"], "ingest_ts").select(
        "transaction_id", "txn_count_30d", "flag_intl_high_value", "flag_new_customer_high_value", "risk_score", "risk_tier")


@query
def fraud_baseline(spark, sf):
    return fraud.baseline(txn_history(spark, sf), X.BASELINE_AS_OF)


LATE_BASELINE = "2024-01-28"


@query
def fraud_baseline_from_days(spark, sf):
    """Customers' days stored once, one row in seven arriving later; thirty days merged for a date near the end."""
    late = F.pmod(F.crc32(F.col("transaction_id")), F.lit(7)) == 0
    history = txn_history(spark, sf)
    stored = keep_table(fraud.daily_partials(history.where(~late)), "days")
    stored = keep_table(fraud.merged_partials(stored, fraud.daily_partials(history.where(late))), "days")
    return fraud.baseline_from_partials(stored, LATE_BASELINE)


@query
def txn_velocity(spark, sf):
    return fraud.velocity_table(txn_history(spark, sf), hours=6)


@query
def transactions_rule_counts(spark, sf):
    return V.rule_counts(silver.checked_transactions(b_txns(spark, sf), X.TXNS_AS_OF))


@query
def transactions_run_metrics(spark, sf):
    return silver.transaction_run_metrics(
        silver.checked_transactions(b_txns(spark, sf), X.TXNS_AS_OF), s_txns(spark, sf))


@query
def silver_customers(spark, sf):
    return new_customers(spark, sf)


@query
def customer_block_keys(spark, sf):
    return s_customers(spark, sf).select(
        "customer_id", "block_key_1", "block_key_2", "block_key_3", "email_domain", "last_name_soundex",
        norm.mask_email("email_normalised").alias("email_masked"))


@query
def customers_rule_counts(spark, sf):
    return V.rule_counts(silver.checked_customers(b_customers(spark, sf), X.ORDERS_AS_OF))


@query
def customers_run_metrics(spark, sf):
    checked = silver.checked_customers(b_customers(spark, sf), X.ORDERS_AS_OF)
    return silver.customer_run_metrics(checked, s_customers(spark, sf))


# ---- dedup, merge, dimensions ---------------------------------------------------------------------

@query
def latest_order_per_customer(spark, sf):
    return latest_per_key(X.tables(spark, sf)["orders"], ["o_custkey"], "o_orderdate", ["o_orderkey"])


CUT = "2001-01-01"


def _order_versions(spark, sf):
    """Stored orders up to the cut, and a batch of later ones plus changes to the urgent stored ones."""
    orders = X.tables(spark, sf)["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    stored = orders.where(F.col("o_orderdate") < CUT)
    changed = stored.where("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("X"))
    return stored, changed.unionByName(orders.where(F.col("o_orderdate") >= CUT))


@query
def upsert(spark, sf):
    return merge.upsert(*_order_versions(spark, sf), ["o_orderkey"])


@query
def upsert_keep(spark, sf):
    return merge.upsert(*_order_versions(spark, sf), ["o_orderkey"], keep=["o_orderstatus"])


@query
def insert_new(spark, sf):
    stored, batch = _order_versions(spark, sf)
    return merge.insert_new(stored, batch, ["o_orderkey"])


@query
def update_columns(spark, sf):
    stored, batch = _order_versions(spark, sf)
    return merge.update_columns(stored, batch, ["o_orderkey"], ["o_orderstatus"])


@query
def append_new_columns(spark, sf):
    stored, batch = _order_versions(spark, sf)
    return merge.align_append_new(stored.drop("o_orderpriority"), batch.withColumn("batch", F.lit("b1")))


@query
def newer_than_mark(spark, sf):
    stored, _ = _order_versions(spark, sf)
    mark = merge.high_water_mark(stored, "o_orderdate", "1970-01-01")
    return merge.newer_than(X.tables(spark, sf)["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")),
                            "o_orderdate", mark)


@query
def incremental_order_metrics(spark, sf):
    stg = g_orders(spark, sf)
    target = marts.customer_order_metrics(stg.where(F.col("order_ts") < CUT), X.ORDERS_AS_OF)
    return marts.incremental_order_metrics(target, stg, stg.where(F.col("order_ts") >= CUT), X.ORDERS_AS_OF) \
        .select("customer_id", "total_orders", "total_revenue", "revenue_last_90d", "last_order_ts")


@query
def scd2_customers(spark, sf):
    """Customer history after a second load in which the furniture segment was renamed."""
    base = X.tables(spark, sf)["customer"].select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    first = merge.scd2_apply(None, base, "customer_id", ["segment", "nation"], "2001-01-01")
    renamed = base.withColumn("segment", F.regexp_replace("segment", "FURNITURE", "HOME"))
    return merge.scd2_apply(first, renamed, "customer_id", ["segment", "nation"], "2001-06-01").drop("record_hash") \
        .withColumn("sk", merge.surrogate_key("customer_id", "valid_from"))


# ---- staging, metrics, marts, views ---------------------------------------------------------------

@query
def stg_orders(spark, sf):
    return g_orders(spark, sf)


@query
def stg_transactions(spark, sf):
    """The two baseline figures are shown with one digit: their exact halves depend on the order of summing."""
    return g_txns(spark, sf).withColumns({c: F.round(c, 1) for c in ("avg_amount_30d", "stddev_amount_30d")})


@query
def stg_customers(spark, sf):
    return marts.stg_customers(entities.apply_entities(s_customers(spark, sf), entity_map(spark, sf)))


@query
def customer_order_metrics(spark, sf):
    return marts.customer_order_metrics(g_orders(spark, sf), X.ORDERS_AS_OF)


@query
def customer_order_metrics_distinct(spark, sf):
    return marts.customer_order_metrics(g_orders(spark, sf), X.ORDERS_AS_OF, unique_ids=False)


@query
def customer_txn_metrics(spark, sf):
    return marts.customer_txn_metrics(g_txns(spark, sf), X.TXNS_AS_OF)


@query
def customer_360(spark, sf):
    return new_360(spark, sf)


@query
def daily_order_summary(spark, sf):
    return new_daily(spark, sf)


@query
def fraud_summary(spark, sf):
    return new_fraud(spark, sf)


@query
def vw_customer_segments(spark, sf):
    return views.vw_customer_segments(m_360(spark, sf))


@query
def vw_revenue_trend(spark, sf):
    return views.vw_revenue_trend(m_daily(spark, sf), X.ORDERS_AS_OF)


@query
def vw_fraud_dashboard(spark, sf):
    return views.vw_fraud_dashboard(m_fraud(spark, sf), X.TXNS_AS_OF)


@query
def vw_fraud_dashboard_calendar(spark, sf):
    return views.vw_fraud_dashboard(m_fraud(spark, sf), X.TXNS_AS_OF, wow="calendar")


@query
def vw_executive_summary(spark, sf):
    return views.vw_executive_summary(m_daily(spark, sf))


@query
def monthly_active_customers(spark, sf):
    return views.exact_active_customers(g_orders(spark, sf))


@query
def monthly_active_rollup(spark, sf):
    """Months from daily bitmaps over dense customer numbers."""
    orders = g_orders(spark, sf).where("customer_id is not null")
    numbered = orders.select("order_date", "customer_id").join(bitmaps.dense_numbers(orders, "customer_id"), "customer_id")
    daily = keep_table(bitmaps.distinct_bitmaps(numbered, ["order_date"]), "bitmaps")
    months = bitmaps.merged_bitmaps(daily, [F.date_trunc("month", "order_date").cast("date").alias("month")])
    return bitmaps.distinct_counts(months, ["month"], "active_customers")


# ---- entity resolution ----------------------------------------------------------------------------

@query
def er_source_systems(spark, sf):
    return M.source_systems(er_customers(spark, sf))


@query
def er_blocking_counts(spark, sf):
    return M.blocking_counts(er_customers(spark, sf))


@query
def er_reduction_ratio(spark, sf):
    return M.reduction_ratio(er_customers(spark, sf))


PAIR = ["id_a", "id_b", "n_a", "n_b"]
SCORES = [*PAIR, "block_sources", "block_strength", "email_match", "phone_match", "soundex_match", "postal_match",
          "country_match", "age_match", "age_diff", "name_similarity", "rule_score", "match_probability", "is_match"]


def _nodes(spark, sf):
    return M.profiles(M.with_profile_key(er_customers(spark, sf)))


@query
def er_candidate_pairs(spark, sf):
    return M.candidate_pairs(_nodes(spark, sf)).select(*PAIR, "block_sources", "block_strength")


@query
def er_scored_pairs(spark, sf):
    return M.score_pairs(M.candidate_pairs(_nodes(spark, sf))).select(*SCORES)


@query
def er_matches(spark, sf):
    return entities.match_links(er_customers(spark, sf)).select(*SCORES)


@query
def er_components(spark, sf):
    links = entities.match_links(er_customers(spark, sf), LOW_THRESHOLD)
    nodes = _nodes(spark, sf)
    return connected_components(nodes, links.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")))


@query
def er_components_two_days(spark, sf):
    """Components of the first day's links, then of the second day's by relabelling what these touch."""
    nodes = keep_table(_nodes(spark, sf).select("id"), "nodes")
    links = keep_table(entities.match_links(er_customers(spark, sf), LOW_THRESHOLD).select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")), "links")
    first_day = F.pmod(F.crc32(F.concat("src", "dst")), F.lit(5)) < 3
    known = keep_table(connected_components(nodes.where(F.pmod(F.crc32("id"), F.lit(4)) > 0), links.where(first_day)), "components")
    today = links.where(~first_day).unionByName(unplaced_links(links.where(first_day), known))
    whole = merge_components(known, extend_components(known, today))
    return nodes.join(whole, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


@query
def er_resolved(spark, sf):
    return entities.resolve(er_customers(spark, sf), X.ORDERS_AS_OF)


@query
def er_metrics(spark, sf):
    people = er_customers(spark, sf)
    return entities.er_metrics(people, entities.match_links(people), entity_map(spark, sf))


@query
def er_write_back(spark, sf):
    return entities.apply_entities(s_customers(spark, sf), entity_map(spark, sf)).select(
        "customer_id", "resolved_entity_id", "er_confidence")


# ---- graph ----------------------------------------------------------------------------------------

@query
def graph_metrics(spark, sf):
    return G.graph_metrics(whole_graph(spark, sf))


@query
def graph_metrics_compat(spark, sf):
    return G.graph_metrics(whole_graph(spark, sf), compat=True)


@query
def graph_customer_360(spark, sf):
    return G.graph_customer_360(whole_graph(spark, sf))


@query
def graph_context(spark, sf):
    return G.graph_context(whole_graph(spark, sf))


@query
def graph_stats(spark, sf):
    return G.graph_stats(whole_graph(spark, sf))


@query
def graph_load_counts(spark, sf):
    return G.load_counts(whole_graph(spark, sf))


@query
def graph_constraints(spark, sf):
    """All seven: the locations of customers and merchants are loaded as well."""
    spots = location_parts(spark, sf)
    return G.graph_constraints(replace(whole_graph(spark, sf), locations=spots.locations, lives_in=spots.lives_in, located_in=spots.located_in))


@query
def same_as_edges(spark, sf):
    return G.same_as_edges(entity_map(spark, sf))


@query
def same_as_edges_cross_source(spark, sf):
    """Members that the links join, with the pairs of different sources in their cluster."""
    found = entity_map(spark, sf)
    edges = G.same_as_edges(found, cross_source=True)
    ids = edges.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    joined = connected_components(ids, edges.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")))
    return joined.join(G.cross_source_pairs(found), "component").select(F.col("id").alias("customer_id"), "component", "pairs")


def txn_network(spark, sf, min_amount=2000):
    """All events as transactions; amounts above the bound count as high risk."""
    ev = X.tables(spark, sf)["events"]
    rows = ev.select(
        F.col("event_id").alias("transaction_id"), F.col("user_id").alias("customer_id"),
        F.pmod("event_id", F.lit(50)).alias("merchant_id"), F.col("ts").cast("timestamp").alias("transaction_ts"),
        F.to_date("ts").alias("txn_date"), F.col("event_type").alias("merchant_category"),
        F.when(F.col("value") * 20 > min_amount, "HIGH").otherwise("LOW").alias("risk_tier"))
    return G.txn_graph(rows, rows.select("customer_id").distinct())


@query
def fraud_rings(spark, sf):
    return G.fraud_rings(txn_network(spark, sf), "2024-01-30", min_shared=3, k=50, days=10)


@query
def product_affinity(spark, sf):
    t = X.tables(spark, sf)
    names = t["part"].select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"))
    return G.product_affinity(G.product_edges(t["lineitem"], "l_orderkey", "l_partkey"), names, min_count=2)


@query
def merchant_risk(spark, sf):
    return G.merchant_risk(whole_graph(spark, sf), min_customers=2)


@query
def churn_contagion(spark, sf):
    g = order_network(spark, sf)
    return G.churn_contagion(g, "2001-08-01", min_churned=3, k=100, days=60, churned_status="at_risk")


def order_network(spark, sf):
    """Customers, orders and suppliers of the given tables, with churn from the last order."""
    t = X.tables(spark, sf)
    first_supplier = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("merchant_id"))
    orders = t["orders"].join(first_supplier, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), "merchant_id",
        F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").cast("decimal(18,2)").alias("net_amount"),
        F.to_date("o_orderdate").alias("order_date"))
    facts = orders.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"), F.sum("net_amount").alias("total_spend"))
    status = F.when(F.col("last_order_date") < "2001-05-01", "at_risk").otherwise("active")
    people = t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"),
                                  F.col("c_mktsegment").alias("ltv_tier")) \
        .join(facts, "customer_id", "left").withColumns({"churn_status": status, "estimated_ltv": F.col("total_spend")})
    return G.order_graph(orders, people)


@query
def entity_profiles(spark, sf):
    return G.entity_profiles(whole_graph(spark, sf))


@query
def linked_profiles(spark, sf):
    return G.linked_profiles(whole_graph(spark, sf), "cust_25", hops=3)


@query
def customer_pagerank(spark, sf):
    edges = supplier_edges(spark, sf)
    return pagerank(undirected(edges)).withColumnRenamed("score", "pagerank_score")


def supplier_edges(spark, sf):
    t = X.tables(spark, sf)
    lines = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    # distinct as numbers, which are shorter
    return lines.select("o_custkey", "l_suppkey").distinct().select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("m"), "l_suppkey").alias("dst"))


@query
def influential_customers(spark, sf):
    return G.influential_customers(order_network(spark, sf), k=50)


def location_parts(spark, sf):
    people = s_customers(spark, sf).select("customer_id", "country", F.col("city_norm").alias("city"))
    shops = X.tables(spark, sf)["supplier"].select(
        F.col("s_suppkey").alias("merchant_id"), F.concat(F.lit("N"), "s_nationkey").alias("country"),
        F.lit(None).cast("string").alias("city"))
    return G.location_graph(people, shops)


@query
def location_graph(spark, sf):
    return G.load_counts(location_parts(spark, sf))


@query
def search_customers(spark, sf):
    people = s_customers(spark, sf).select("customer_id", F.col("full_name_norm").alias("full_name"), "email_normalised")
    return G.search_customers(people, ["Garcia", "jose", "org"])


@query
def search_customers_indexed(spark, sf):
    people = s_customers(spark, sf).select("customer_id", F.col("full_name_norm").alias("full_name"), "email_normalised")
    path = scratch_path(spark, "terms")
    G.store_search_index(people, path, 64)
    return G.search_index(people, path, ["Garcia", "jose", "org"], 64)


def urgent_links(spark, sf):
    """Customers whose urgent orders follow each other within a month."""
    orders = X.tables(spark, sf)["orders"].where("o_orderpriority = '1-URGENT'")
    within = Window.partitionBy(F.date_trunc("month", "o_orderdate")).orderBy("o_orderdate", "o_orderkey")
    return orders.select(F.lag("o_custkey").over(within).alias("src"), F.col("o_custkey").alias("dst"))


@query
def customer_paths(spark, sf):
    people = X.tables(spark, sf)["customer"].select(F.col("c_custkey").alias("id"))
    return paths.link_paths(urgent_links(spark, sf), people, 3).groupBy("start", "hops").agg(
        F.count("*").alias("n_paths"), F.count_distinct("end").alias("n_ends"))


@query
def customers_reached(spark, sf):
    people = X.tables(spark, sf)["customer"].select(F.col("c_custkey").alias("id"))
    return paths.reached(urgent_links(spark, sf), people, 3).groupBy("start", "hops").agg(F.count("*").alias("n_reached"))


# ---- star schema ----------------------------------------------------------------------------------

@query
def orders_as_of(spark, sf):
    """Orders with their customer's version of three, and the list price level of their priority, which few keys share."""
    t = X.tables(spark, sf)
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("placed_ts"))
    version = t["customer"].select("c_custkey", "c_mktsegment", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("i"))
    begin = F.date_add(F.lit("1995-06-01").cast("date"), (F.col("c_custkey") * 17 % 500 + F.col("i") * 600).cast("int")).cast("timestamp")
    people = version.select(F.col("c_custkey").alias("o_custkey"), begin.alias("since"), F.concat_ws("-", "c_mktsegment", "i").alias("segment"))
    levels = orders.groupBy("o_orderpriority", F.date_trunc("month", "placed_ts").alias("month")).agg(F.max("placed_ts").alias("since"), F.count("*").alias("level"))
    done = asof.asof_join(orders, people, "o_custkey", "placed_ts", "since", ["segment"])
    return asof.asof_join(done, levels, "o_orderpriority", "placed_ts", "since", ["level"])


@query
def order_calendar(spark, sf):
    days = X.tables(spark, sf)["orders"].select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return star.with_calendar(days).withColumn("fiscal_label", cal.fiscal_quarter_label("full_date"))


def dims(spark, sf):
    people = entities.apply_entities(s_customers(spark, sf), entity_map(spark, sf))
    first = star.dim_customer(people, None, "1995-01-01")
    changed = people.withColumn("loyalty_tier", F.when(F.col("segment") == "vip", F.lit("platinum")).otherwise(F.col("loyalty_tier")))
    customers = star.dim_customer(changed, first, "1999-01-01")
    merchants = star.dim_merchant(s_txns(spark, sf), None, "1995-01-01")
    return customers, merchants


@query
def dim_customer(spark, sf):
    return dims(spark, sf)[0].drop("record_hash")


@query
def dim_merchant(spark, sf):
    return dims(spark, sf)[1].drop("record_hash")


@query
def fact_orders(spark, sf):
    customers, merchants = dims(spark, sf)
    return star.fact_orders(g_orders(spark, sf), customers, merchants, X.ORDERS_AS_OF, first_version=True)


@query
def fact_transactions(spark, sf):
    customers, merchants = dims(spark, sf)
    return star.fact_transactions(g_txns(spark, sf), customers, merchants, X.TXNS_AS_OF)


@query
def orders_by_fiscal_quarter(spark, sf):
    customers, merchants = dims(spark, sf)
    fact = star.fact_orders(g_orders(spark, sf), customers, merchants, X.ORDERS_AS_OF)
    return star.orders_by_fiscal_quarter(fact, star.dim_date(spark, "1995-01-01", "2001-12-31"))


@query
def payments_by_category(spark, sf):
    methods = star.dim_payment_method(spark)
    keyed = g_txns(spark, sf).withColumn("payment_method_sk", star.payment_sk("payment_method"))
    return keyed.groupBy("payment_method_sk").agg(F.count("*").alias("n"), F.sum("amount").alias("amount")) \
        .join(methods, "payment_method_sk").groupBy("payment_category", "is_digital") \
        .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))


# ---- quality, publishing --------------------------------------------------------------------------

def all_tables(spark, sf):
    return {
        "orders": s_orders(spark, sf), "transactions": s_txns(spark, sf), "customers": s_customers(spark, sf),
        "customer_360": m_360(spark, sf), "daily_order_summary": m_daily(spark, sf), "fraud_summary": m_fraud(spark, sf),
        "customer_order_metrics": marts.customer_order_metrics(g_orders(spark, sf), X.ORDERS_AS_OF),
        "customer_txn_metrics": marts.customer_txn_metrics(g_txns(spark, sf), X.TXNS_AS_OF),
    }


@query
def dq_suite(spark, sf):
    return Q.run_suite(all_tables(spark, sf), Q.standard_suite())


@query
def dq_raw_orders(spark, sf):
    """The same tests on raw rows, where they find something."""
    typed = silver.typed_orders(b_orders(spark, sf))
    tests = [*Q.standard_suite()["orders"], Q.accepted_range("discount_pct", 0, 25)]
    return Q.run_suite({"orders": typed}, {"orders": tests})


@query
def dq_freshness(spark, sf):
    events = X.tables(spark, sf)["events"].withColumn("ts", F.col("ts").cast("timestamp"))
    return Q.freshness(events, "ts", "2024-02-01 06:00:00")


@query
def table_counts(spark, sf):
    return Q.table_counts({"customer_360": m_360(spark, sf), "daily_order_summary": m_daily(spark, sf),
                           "fraud_summary": m_fraud(spark, sf)})


@query
def sync_marts(spark, sf):
    """Publish the marts, then read the second store back."""
    root = scratch_path(spark, "sync")
    made = {"customer_360": m_360(spark, sf), "daily_order_summary": m_daily(spark, sf), "fraud_summary": m_fraud(spark, sf)}
    schemas = {name: S.gold_schema(name) for name in made}
    for date in ("2001-07-19", "2001-07-20", "2001-07-20"):  # an earlier date, and one date twice
        loaded = publish.sync_marts(spark, made, schemas, f"{root}/export", f"{root}/store", date, X.ORDERS_AS_OF)
    stored = Q.table_counts({name: io.read_part(spark, f"{root}/store/{name}") for name in made})
    return loaded.join(stored, "table").select("table", "rows_loaded", F.col("n").alias("rows_stored"), "execution_date")


@query
def published_360(spark, sf):
    return io.load_by_name(m_360(spark, sf), S.gold_schema("customer_360"))


@query
def autoload_daily(spark, sf):
    """The daily mart, unloaded and picked up by the continuous loader."""
    root = scratch_path(spark, "autoload")
    mart = m_daily(spark, sf)
    publish.unload(mart, f"{root}/export", "2001-07-20")
    publish.autoload(spark, f"{root}/export", mart.schema, f"{root}/store", S.gold_schema("daily_order_summary"),
                     f"{root}/ckpt", X.ORDERS_AS_OF).awaitTermination()
    return spark.read.parquet(f"{root}/store")


@query
def stored_upsert(spark, sf):
    """The upsert applied to a partitioned stored table; changed orders move to another folder."""
    root = scratch_path(spark, "upsert")
    stored, batch = _order_versions(spark, sf)
    parts = {"yr": F.year("o_orderdate"), "st": F.col("o_orderstatus")}
    io.write_table(stored.withColumns(parts), root, ["yr", "st"])
    io.upsert_table(spark, root, batch.withColumns(parts), ["o_orderkey"], ["yr", "st"])
    return io.read_table(spark, root)


@query
def clustered_orders(spark, sf):
    """Orders written in z-order and read back with a predicate on both clustering columns, which skips files."""
    root = scratch_path(spark, "zorder")
    io.cluster_write(X.tables(spark, sf)["orders"], root, ["o_custkey", "o_orderdate"])
    return spark.read.parquet(root).where("o_custkey < 100 AND o_orderdate >= TIMESTAMP '1996-01-01'")


# ---- serving --------------------------------------------------------------------------------------

@query
def serve_customers(spark, sf):
    return serving.customers(m_360(spark, sf), ltv_tier="platinum", limit=50, offset=5)


@query
def serve_customer(spark, sf):
    return serving.customer(m_360(spark, sf), "cust_7")


@query
def serve_order_summary(spark, sf):
    return serving.order_summary(m_daily(spark, sf), X.ORDERS_AS_OF, days=60)


@query
def serve_fraud_summary(spark, sf):
    return serving.fraud_summary(m_fraud(spark, sf), X.TXNS_AS_OF, days=20, risk_tier="medium")


@query
def serve_top_ltv(spark, sf):
    return serving.top_ltv(m_360(spark, sf))


@query
def serve_safe_sql(spark, sf):
    sql = ("SELECT ltv_tier, churn_status, max(last_order_ts) AS newest, count(*) AS n, sum(estimated_ltv) AS ltv FROM mart_customer_360 "
           "GROUP BY ltv_tier, churn_status")
    return serving.safe_sql(spark, sql, {"mart_customer_360": m_360(spark, sf)})


@query
def platform_metrics(spark, sf):
    g = whole_graph(spark, sf)
    return serving.platform_metrics(
        s_customers(spark, sf), s_orders(spark, sf), s_txns(spark, sf), entity_map(spark, sf),
        {"placed": g.placed, "paid_via": g.paid_via, "made": g.made, "at": g.at},
        "2024-01-31 04:00:00", "2024-01-31 04:12:00")


# ---- the daily run --------------------------------------------------------------------------------

RUN_DAYS = {"2001-07-18": ("2001-07-01 12:00:00", "1998-06-01", "2024-01-15"), "2001-07-19": (None, None, None)}


def _land_days(spark, sf, lake):
    """Raw rows as they would lie in the lake: what came in before the first day's cuts, and the rest on the second day."""
    sources = {"customers": X.bronze_customers, "orders": X.bronze_orders, "transactions": X.bronze_transactions}
    (first, cuts), (second, _) = RUN_DAYS.items()
    arrived = F.col("ingest_ts").cast("timestamp")
    for (domain, read), cut in zip(sources.items(), cuts):
        rows = read(spark, sf)
        dated = rows.withColumn("date", F.when(arrived < cut, first).when(arrived >= cut, second)).where("date is not null")
        io.write_table(dated, lake.bronze(domain), ["date"])
        for day in RUN_DAYS:  # a day without rows has a file as well
            if not io.has_files(spark, f"{lake.bronze(domain)}/date={day}"):
                rows.limit(0).write.parquet(f"{lake.bronze(domain)}/date={day}")


@query
def daily_run(spark, sf):
    """Two days from raw to marts: what the tables of the lake hold after the second, which rebuilds its metrics in full."""
    lake = Lake(scratch_path(spark, "lake"))
    _land_days(spark, sf, lake)
    for i, day in enumerate(RUN_DAYS):
        jobs.gate(spark, lake, day)
        jobs.run_orders(spark, lake, day, X.ORDERS_AS_OF)
        jobs.run_transactions(spark, lake, day, X.TXNS_AS_OF, CFG)
        jobs.run_customers(spark, lake, day, X.ORDERS_AS_OF)
        jobs.run_entities(spark, lake, day)
        jobs.build_marts(spark, lake, day, X.ORDERS_AS_OF, full_refresh=i > 0)

    def shown(part, df, key, value):
        return df.select(F.lit(part).alias("part"), F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))

    held = [
        shown("order", io.read_table(spark, lake.silver("orders")), "order_id", "order_status"),
        shown("customer", io.read_table(spark, lake.silver("customers")), "customer_id", "resolved_entity_id"),
        shown("entity", io.read_table(spark, lake.gold("entity_map")), "customer_id", "cluster_size"),
        shown("metrics", io.read_part(spark, lake.gold("customer_order_metrics")), "customer_id", "total_orders"),
        shown("transaction", io.read_table(spark, lake.silver("transactions")).groupBy("customer_id").agg(F.count_distinct("transaction_id").alias("n")), "customer_id", "n"),
    ]
    for domain in ("orders", "transactions", "customers"):
        bad = spark.read.parquet(lake.quarantine(domain)).groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"))
        held.append(shown(f"quarantine_{domain}", bad, "date", "n"))
    out = held[0]
    for more in held[1:]:
        out = out.unionByName(more)
    return out


# ---- streaming ------------------------------------------------------------------------------------

def landed_events(spark, sf, root):
    """Raw transactions as JSON lines; a list becomes nested JSON and one line per fifty is cut short."""
    raw = b_txns(spark, sf).withColumn("event_type", F.lit("transaction"))
    line = F.to_json(F.struct(*[F.col(c) for c in raw.columns], F.array("currency", "ip_country").alias("tags")))
    broken = F.col("transaction_id").rlike("77$")
    raw.select(F.when(broken, F.substring(line, 1, 40)).otherwise(line).alias("value")).write.text(f"{root}/in")
    return f"{root}/in"


EVENT_SCHEMA = T.StructType([*S.raw_schema("transactions").fields,
                             T.StructField("event_type", T.StringType()), T.StructField("tags", T.StringType())])


def _land(spark, sf):
    root = scratch_path(spark, "land")
    decoded = landing.decode_events(landing.read_event_stream(spark, landed_events(spark, sf, root)), EVENT_SCHEMA)
    routed = decoded.withColumn("domain", landing.route_domain("event_type"))
    for _ in range(2):  # the second run resumes from the checkpoint and finds nothing new
        landing.land_bronze(landing.with_source_meta(routed), f"{root}/bronze", f"{root}/ckpt",
                            available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/bronze")


@query
def stream_land(spark, sf):
    return landing.good_events(_land(spark, sf)).select(*EVENT_SCHEMA.fieldNames(), "domain", "_partition_key")


@query
def stream_bad_records(spark, sf):
    return landing.bad_events(_land(spark, sf)).select(F.col(landing.CORRUPT).alias("text"))


def _feed(df, ts, cuts, root, run):
    """Deliver rows in time order, one delivery after another; each resumes the query from its checkpoint."""
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = df
        if low is not None:
            part = part.where(F.col(ts) >= low)
        if high is not None:
            part = part.where(F.col(ts) < high)
        part.write.mode("append").parquet(f"{root}/in")
        run(df.sparkSession.readStream.schema(df.schema).parquet(f"{root}/in")).awaitTermination()


TXN_CUTS = ["2024-01-10", "2024-01-20"]


def _stream_rows(spark, sf):
    typed = silver.typed_transactions(b_txns(spark, sf))
    return typed.where("transaction_ts is not null and customer_id is not null") \
        .select("transaction_id", "customer_id", "transaction_ts")


def _drained(spark, sf, label, transform):
    root = scratch_path(spark, label)
    _feed(_stream_rows(spark, sf), "transaction_ts", TXN_CUTS, root, lambda stream: transform(stream).writeStream
          .format("parquet").option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start(f"{root}/out"))
    return spark.read.parquet(f"{root}/out")


@query
def stream_dedup(spark, sf):
    return _drained(spark, sf, "dedup", lambda s: stateful.dedup_stream(s, ["transaction_id"], "transaction_ts", "60 days"))


@query
def stream_velocity_window(spark, sf):
    """Hourly windows every half hour: all that the watermark, the newest time, has closed."""
    return _drained(spark, sf, "windows", lambda s: stateful.velocity_windows(s, "0 seconds", "1 hour", "30 minutes"))


@query
def stream_velocity(spark, sf):
    """Delivered out of order: each row up to two days after its time."""
    root = scratch_path(spark, "velocity")
    rows = _stream_rows(spark, sf).withColumn("arrival", F.timestamp_add("HOUR", F.pmod(F.crc32(F.col("transaction_id")), F.lit(48)).cast("int"), F.col("transaction_ts")))
    _feed(rows, "arrival", TXN_CUTS, root, lambda stream: stateful.velocity_stream(
        stream, f"{root}/out", f"{root}/ckpt", hours=6, delay_seconds=48 * 3600))
    stateful.velocity_close(spark, f"{root}/out", f"{root}/ckpt", hours=6)
    return stateful.velocity_rows(spark, f"{root}/out").select("transaction_id", "customer_id", "transaction_ts", "txn_velocity_1h")


@query
def stream_upsert(spark, sf):
    """Raw orders delivered in ingest order, cleaned and upserted batch by batch."""
    root = scratch_path(spark, "streamupsert")
    _feed(b_orders(spark, sf), "ingest_ts", ["1998-01-01"], root, lambda stream: stateful.foreach_upsert(
        stream, f"{root}/silver", ["order_id"], f"{root}/ckpt", ["order_year"],
        lambda batch: silver.silver_orders(batch, X.ORDERS_AS_OF)))
    return io.read_table(spark, f"{root}/silver").select("order_id", "order_status", "updated_ts", "order_year", "net_amount")


def arrivals(spark, sf):
    """A listing of arrived files, one per event, over good and bad names."""
    ev = X.tables(spark, sf)["events"]
    e = F.col("event_id")
    folder = F.element_at(F.array(*[F.lit(x) for x in (
        "bronze/ecommerce/orders", "bronze/financial/transactions", "bronze/ecommerce/unknown", "bronze/financial/merchants")]),
        (e % 4 + 1).cast("int"))
    day = F.when(e % 19 == 0, F.lit("latest")).otherwise(F.concat(F.lit("date="), F.to_date("ts").cast("string")))
    name = F.concat(F.lit("part-"), e, F.when(e % 13 == 0, ".keep").otherwise(".parquet"))
    return ev.select(
        F.concat_ws("/", folder, day, F.lit("hour%3D01"), name).alias("path"),
        (e % 1000).alias("length"), F.col("ts").cast("timestamp").alias("modificationTime"))


MANIFEST = ["path", "execution_date", "hour", "domain", "file_name", "status", "reason"]


@query
def file_manifest(spark, sf):
    return manifest.file_manifest(arrivals(spark, sf)).select(*MANIFEST)


@query
def new_work(spark, sf):
    files = manifest.file_manifest(arrivals(spark, sf))
    early = files.where(F.col("modificationTime") < "2024-01-05")
    ledger = manifest.ledger_entries(manifest.new_work(early, None, "2024-01-05"), "2024-01-05")
    return manifest.new_work(files, ledger, "2024-01-10").select("path", "execution_date", "domain", "status", "reason")


@query
def work_summary(spark, sf):
    return manifest.work_summary(manifest.new_work(manifest.file_manifest(arrivals(spark, sf)), None, "2024-01-31", "file"))
