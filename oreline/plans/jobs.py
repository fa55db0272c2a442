"""The daily run: gate, raw to silver, entities, marts, publishing. One function per step.

Each step returns a dict of counts. Counts of a write are observed while it runs, so no step scans its
input again just to count it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import catalog
from ..functions.calendar import AsOf
from ..operators import matching as M, quality
from ..operators.fraud import FraudConfig
from ..operators.validate import quarantined_rows
from ..session import adopt, cut_lineage, is_blank
from ..schemas import RAW_FIELDS, gold_schema
from ..sources import publish, tables as io
from . import entities, graph, marts, silver, star

NO_DATA = {"status": "NO_DATA"}


def gate(spark: SparkSession, lake: catalog.Lake, date: str, domains=("orders", "transactions")) -> None:
    io.require_partitions(spark, [lake.bronze(d) for d in domains], date)


def _raw(spark: SparkSession, lake: catalog.Lake, domain: str, date: str) -> DataFrame | None:
    path = lake.bronze(domain)
    if not io.has_files(spark, f"{path}/date={date}"):
        return None
    raw = io.read_bronze(spark, path, date, RAW_FIELDS[domain])
    return None if is_blank(raw) else raw


def _counts(date: str, seen: Observation, kept: Observation) -> dict:
    counts = {"status": "OK", "execution_date": date, **seen.get, **kept.get}
    counts["dupes_removed"] = counts["clean_count"] - counts["silver_count"]
    raw, clean = counts["raw_count"], counts["clean_count"]
    counts["quarantine_rate_pct"] = round(counts["quarantine_count"] / raw * 100, 2) if raw else 0.0
    counts["dupe_rate_pct"] = round(counts["dupes_removed"] / clean * 100, 2) if clean else 0.0
    return counts


def _batch(spark: SparkSession, lake: catalog.Lake, domain: str, date: str, rows: DataFrame, kept: Observation,
           *extra) -> DataFrame:
    """The cleaned batch, written once; what follows reads it."""
    path = lake.at(f"staging/batch/{domain}/date={date}")
    io.write_table(rows.observe(kept, F.count(F.lit(1)).alias("silver_count"), *extra), path)
    return spark.read.parquet(path)


def run_orders(spark: SparkSession, lake: catalog.Lake, date: str, as_of: AsOf, dry_run: bool = False,
               on_unknown: str = "pass"):
    """Counts, or with ``dry_run`` five rows and nothing written."""
    raw = _raw(adopt(spark), lake, "orders", date)
    if raw is None:
        return NO_DATA
    seen, kept = Observation(), Observation()
    rows = silver.silver_orders(raw, as_of, on_unknown, seen=seen)
    if dry_run:
        return rows.limit(5)
    batch = _batch(spark, lake, "orders", date, rows, kept)
    io.write_quarantine(quarantined_rows(silver.checked_orders(raw, as_of, on_unknown)), lake.quarantine("orders"), date)
    io.upsert_table(spark, lake.silver("orders"), batch, ["order_id"], catalog.SILVER_PARTITIONS["orders"], kept=True)
    return _counts(date, seen, kept)


def run_transactions(spark: SparkSession, lake: catalog.Lake, date: str, as_of: AsOf, cfg: FraudConfig = FraudConfig(),
                     dry_run: bool = False, on_unknown: str = "pass"):
    raw = _raw(adopt(spark), lake, "transactions", date)
    if raw is None:
        return NO_DATA
    path, history = lake.silver("transactions"), None
    if io.table_exists(spark, path):
        since = spark.range(1).select(F.date_sub(F.lit(date).cast("date"), cfg.baseline_days)).first()[0]
        history = io.read_silver(spark, path, "transaction_ts", since, "txn_year", "txn_month")
    seen, kept = Observation(), Observation()
    rows = silver.silver_transactions(raw, history, as_of, date, cfg, on_unknown, seen=seen)
    if dry_run:
        return rows.limit(5)
    batch = _batch(spark, lake, "transactions", date, rows, kept,
                   F.count_if(F.col("risk_tier") == "HIGH").alias("high_risk_count"),
                   F.count_if(F.col("risk_score") > 0).alias("flagged_count"))
    bad = quarantined_rows(silver.checked_transactions(raw, as_of, on_unknown))
    io.write_quarantine(bad, lake.quarantine("transactions"), date)
    io.append_new(spark, path, batch, ["transaction_id"], catalog.SILVER_PARTITIONS["transactions"], kept=True)
    counts = _counts(date, seen, kept)
    counts["flag_rate_pct"] = round(counts["flagged_count"] / counts["raw_count"] * 100, 2)
    return counts


def run_customers(spark: SparkSession, lake: catalog.Lake, date: str, as_of: AsOf, dry_run: bool = False,
                  on_unknown: str = "pass"):
    """An update keeps the entity columns the resolution step has set."""
    raw = _raw(adopt(spark), lake, "customers", date)
    if raw is None:
        return NO_DATA
    seen, kept = Observation(), Observation()
    rows = silver.silver_customers(raw, as_of, on_unknown, seen=seen)
    if dry_run:
        return rows.limit(5)
    reachable = F.col("block_key_2").isNotNull() | F.col("block_key_3").isNotNull()
    batch = _batch(spark, lake, "customers", date, rows, kept, F.count_if(reachable).alias("er_ready_count"))
    bad = quarantined_rows(silver.checked_customers(raw, as_of, on_unknown))
    io.write_quarantine(bad, lake.quarantine("customers"), date)
    io.upsert_table(spark, lake.silver("customers"), batch, ["customer_id"], catalog.SILVER_PARTITIONS["customers"],
                    keep=["resolved_entity_id", "er_confidence"], kept=True)
    counts = _counts(date, seen, kept)
    counts["no_contact_info"] = counts["raw_count"] - counts["er_ready_count"]
    return counts


def run_entities(spark: SparkSession, lake: catalog.Lake, date: str, threshold: float = M.MATCH_THRESHOLD) -> dict:
    """Entity map, and the entity columns of the customers whose entity changed."""
    path = lake.silver("customers")
    stored = io.read_table(adopt(spark), path)
    people = M.load_er_customers(stored)
    nodes = entities.live_nodes(people, threshold)
    links = cut_lineage(entities.match_links(people, threshold, nodes=nodes))
    found = cut_lineage(entities.resolve(people, date, threshold, links=links))
    metrics = entities.er_metrics(people, links, found, threshold, nodes=nodes).first().asDict()
    io.upsert_table(spark, lake.gold("entity_map"), found, ["customer_id"], ["source_system"], kept=True)
    new = entities.apply_entities(stored, found)
    before = stored.select("customer_id", F.struct("resolved_entity_id", "er_confidence").alias("_before"))
    changed = new.join(before, "customer_id") \
        .where(~F.struct("resolved_entity_id", "er_confidence").eqNullSafe(F.col("_before"))).drop("_before")
    io.upsert_table(spark, path, changed, ["customer_id"], catalog.SILVER_PARTITIONS["customers"])
    return metrics


def _batch_customers(spark: SparkSession, lake: catalog.Lake, domain: str, date: str) -> DataFrame:
    path = lake.at(f"staging/batch/{domain}/date={date}")
    if not io.has_files(spark, path):
        return spark.createDataFrame([], "customer_id string")
    return spark.read.parquet(path).select("customer_id")


def _refreshed(spark: SparkSession, path: str, facts: DataFrame, touched: DataFrame | None, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored metrics with the touched customers' rows built anew from all their facts; all rows if ``touched`` is None."""
    if touched is None:
        io.replace_part(spark, path, build(facts), "all")
    else:
        who = touched.where("customer_id IS NOT NULL").distinct()
        rows = build(facts.join(who, "customer_id", "left_semi"))
        kept = io.read_part(spark, path).join(who, "customer_id", "left_anti")
        io.replace_part(spark, path, kept.unionByName(rows), "all")
    return io.read_part(spark, path)


def customer_metrics(spark: SparkSession, lake: catalog.Lake, orders: DataFrame, txns: DataFrame, date: str, as_of: AsOf,
                     full_refresh: bool = False) -> tuple[DataFrame, DataFrame]:
    """Stored order and transaction metrics per customer, brought up to date.

    Rebuilt are the customers of the day's batches; for orders also those whose trailing windows can have moved (an order in
    the 91 days before their metrics were built, or after) and those whose number of orders is not the stored one (an order has
    changed hands). The result equals a full rebuild but for ``updated_at``, which tells when a row was built.
    """
    order_path, txn_path = lake.gold("customer_order_metrics"), lake.gold("customer_txn_metrics")
    moved = sold = None
    if not full_refresh and io.table_exists(spark, order_path):
        stored = io.read_part(spark, order_path)
        recent = stored.where(F.col("last_order_ts") >= F.col("updated_at") - F.expr("INTERVAL 91 DAYS")).select("customer_id")
        counts = orders.where("customer_id IS NOT NULL").groupBy("customer_id").agg(F.count("*").alias("_n"))
        other = stored.select("customer_id", "total_orders").join(counts, "customer_id", "full") \
            .where(~F.col("total_orders").eqNullSafe(F.col("_n"))).select("customer_id")
        moved = _batch_customers(spark, lake, "orders", date).unionByName(recent).unionByName(other)
    if not full_refresh and io.table_exists(spark, txn_path):
        sold = _batch_customers(spark, lake, "transactions", date)
    return (_refreshed(spark, order_path, orders, moved, lambda f: marts.customer_order_metrics(f, as_of)),
            _refreshed(spark, txn_path, txns, sold, lambda f: marts.customer_txn_metrics(f, as_of)))


def build_marts(spark: SparkSession, lake: catalog.Lake, date: str, as_of: AsOf, full_refresh: bool = False) -> dict[str, DataFrame]:
    """Gold marts from silver, customer metrics incrementally unless ``full_refresh``; returns the stored tables."""
    orders = marts.stg_orders(io.read_table(adopt(spark), lake.silver("orders")))
    txns = marts.stg_transactions(io.read_table(spark, lake.silver("transactions")))
    people = marts.stg_customers(io.read_table(spark, lake.silver("customers")))
    order_metrics, txn_metrics = customer_metrics(spark, lake, orders, txns, date, as_of, full_refresh)
    built = {
        "customer_360": marts.customer_360(people, order_metrics, txn_metrics, as_of),
        "daily_order_summary": marts.daily_order_summary(orders, as_of),
        "fraud_summary": marts.fraud_summary(txns, as_of),
    }
    for name, df in built.items():
        io.write_table(df, lake.gold(name))
    return {name: spark.read.parquet(lake.gold(name)) for name in built}


def store_graph(spark: SparkSession, lake: catalog.Lake) -> graph.Graph:
    """Vertices and edges as stored tables, which the graph questions then read."""
    made = graph.load_graph(
        io.read_table(adopt(spark), lake.gold("entity_map")), io.read_table(spark, lake.silver("orders")),
        io.read_table(spark, lake.silver("transactions")), spark.read.parquet(lake.gold("customer_360")))
    for name, df in made.parts().items():
        io.replace_part(spark, lake.graph(name), df, "all")
    return read_graph(spark, lake)


def read_graph(spark: SparkSession, lake: catalog.Lake) -> graph.Graph:
    names = [f.name for f in fields(graph.Graph)]
    return graph.Graph(**{n: io.read_part(spark, lake.graph(n)) for n in names if io.table_exists(spark, lake.graph(n))})


def store_star(spark: SparkSession, lake: catalog.Lake, as_of: AsOf) -> dict[str, DataFrame]:
    """Dimensions with history and the facts that point at them."""
    def previous(name: str) -> DataFrame | None:
        return io.read_part(spark, lake.star(name)) if io.table_exists(spark, lake.star(name)) else None

    def stored(name: str, df: DataFrame) -> DataFrame:
        io.replace_part(spark, lake.star(name), df, "all")
        return io.read_part(spark, lake.star(name))

    txns = io.read_table(adopt(spark), lake.silver("transactions"))
    people = stored("dim_customer", star.dim_customer(io.read_table(spark, lake.silver("customers")), previous("dim_customer"), as_of))
    sellers = stored("dim_merchant", star.dim_merchant(txns, previous("dim_merchant"), as_of))
    orders = marts.stg_orders(io.read_table(spark, lake.silver("orders")))
    return {
        "dim_customer": people, "dim_merchant": sellers,
        "fact_orders": stored("fact_orders", star.fact_orders(orders, people, sellers, as_of, first_version=True)),
        "fact_transactions": stored("fact_transactions", star.fact_transactions(marts.stg_transactions(txns), people, sellers, as_of, first_version=True)),
    }


def cluster_silver(spark: SparkSession, lake: catalog.Lake) -> None:
    """Lay the silver tables out by the columns they are searched by."""
    for domain, columns in catalog.CLUSTER_COLUMNS.items():
        if io.table_exists(spark, lake.silver(domain)):
            io.recluster(spark, lake.silver(domain), columns, catalog.SILVER_PARTITIONS[domain])


def run_quality(spark: SparkSession, lake: catalog.Lake, made: dict[str, DataFrame]) -> DataFrame:
    tables = {d: io.read_table(spark, lake.silver(d)) for d in ("orders", "transactions", "customers")}
    return quality.run_suite({**tables, **made}, quality.standard_suite())


def run_day(spark: SparkSession, lake: catalog.Lake, date: str, as_of: AsOf, cfg: FraudConfig = FraudConfig(), full_refresh: bool = False,
            cluster: bool = True) -> dict:
    gate(spark, lake, date)
    report = {
        "orders": run_orders(spark, lake, date, as_of),
        "transactions": run_transactions(spark, lake, date, as_of, cfg),
        "customers": run_customers(spark, lake, date, as_of),
    }
    report["entities"] = run_entities(spark, lake, date)
    made = build_marts(spark, lake, date, as_of, full_refresh)
    report["graph"] = graph.load_counts(store_graph(spark, lake))
    report["star"] = quality.table_counts(store_star(spark, lake, as_of))
    if cluster:
        cluster_silver(spark, lake)
    report["quality"] = run_quality(spark, lake, made)
    report["sync"] = publish.sync_marts(spark, made, {n: gold_schema(n) for n in made}, lake.at("export"),
                                        lake.at("second_store"), date, as_of)
    return report
