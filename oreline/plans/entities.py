"""Entity resolution: customers of all sources to one entity id each."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import AsOf, at_date, at_ts
from ..operators import matching as M
from ..operators.components import star_forest
from ..operators.merge import update_columns

ENTITY_PREFIX = "ent_"


def live_nodes(customers: DataFrame, threshold: float = M.MATCH_THRESHOLD, weights: M.Weights = M.Weights()) -> DataFrame:
    """Profiles that can be in a matching pair at all, as a stored table."""
    return M.live_profiles(M.profiles(M.with_profile_key(customers)), threshold, weights)


def match_links(customers: DataFrame, threshold: float = M.MATCH_THRESHOLD, weights: M.Weights = M.Weights(),
                least_group: int = M.LEAST_GROUP, nodes: DataFrame | None = None) -> DataFrame:
    """Scored profile pairs that match and together connect every entity.

    All uncertain matches are here, and of the certain ones as many as connect the same profiles. ``nodes`` are the ``live_nodes``
    of the same customers, threshold and weights, if known.
    """
    nodes = live_nodes(customers, threshold, weights) if nodes is None else nodes
    open_pairs = M.candidate_pairs(nodes, threshold, weights, skip_certain=True, least_group=least_group)
    sure = M.certain_links(nodes, threshold, weights)
    return M.matched(M.score_pairs(sure.unionByName(open_pairs), threshold, weights))


def matched_pair_count(customers: DataFrame, links: DataFrame, threshold: float = M.MATCH_THRESHOLD,
                       weights: M.Weights = M.Weights(), nodes: DataFrame | None = None) -> DataFrame:
    """One row: customer pairs that match; certain ones are counted by block, uncertain ones by link.

    Profiles outside ``live_nodes`` are in no pair, so only those need be counted, if ``nodes`` has them.
    """
    sets = M.threshold_signatures(threshold, weights, certain=True)
    uncertain = links.where(~reduce(or_, [M._agree(s) for s in sets], F.lit(False))) \
        .agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("open"), F.lit(1).alias("_one"))
    if not sets:
        return uncertain.select(F.col("open").alias("matched_pairs"))
    rows = M.profiles(M.with_profile_key(customers)) if nodes is None else nodes
    sure = M.distinct_pair_count(rows, sets, "source", F.col("n")).select("pairs", F.lit(1).alias("_one"))
    return sure.join(uncertain, "_one").select((F.col("pairs") + F.col("open")).alias("matched_pairs"))


def resolve(customers: DataFrame, run_date: AsOf, threshold: float = M.MATCH_THRESHOLD,
            weights: M.Weights = M.Weights(), links: DataFrame | None = None) -> DataFrame:
    """The entity map: component, entity id, cluster size and confidence of every customer.

    Customers of one profile share all their matches. Where the profile has a match they are connected
    through it; where it has none they stay apart, one entity each. So the components are found among
    profiles and handed to the customers by one join. The id of an entity is its smallest customer id:
    a cluster that gains a smaller id changes its name.
    """
    keyed = M.with_profile_key(customers)
    nodes = M.profiles(keyed).select("profile_key", "id", "n")
    found = match_links(customers, threshold, weights) if links is None else links
    forest = star_forest(found.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")))
    # members of a component are the forest's children and the root itself
    members = forest.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(
        forest.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct())
    grouped = nodes.join(members, "id")
    sizes = grouped.groupBy("component").agg(F.sum("n").alias("cluster_size"))
    linked = grouped.join(sizes, "component").select("profile_key", "component", "cluster_size")
    size = F.coalesce("cluster_size", F.lit(1).cast("long"))
    own = F.coalesce("component", "customer_id")
    return keyed.join(linked, "profile_key", "left").select(
        "customer_id", own.alias("component"),
        F.concat(F.lit(ENTITY_PREFIX), own).alias("resolved_entity_id"),
        "source_system", "full_name_norm", "email_normalised", "country",
        size.alias("cluster_size"),
        F.when(size == 1, F.lit(1.0)).otherwise(F.lit(float(threshold))).alias("er_confidence"),
        at_date(run_date).alias("er_run_date"), at_ts(run_date).alias("er_updated_at"))


def apply_entities(silver_customers: DataFrame, entity_map: DataFrame) -> DataFrame:
    """Write the entity id and confidence back onto the customers."""
    return update_columns(silver_customers, entity_map, ["customer_id"], ["resolved_entity_id", "er_confidence"])


def er_metrics(customers: DataFrame, links: DataFrame, entity_map: DataFrame,
               threshold: float = M.MATCH_THRESHOLD, weights: M.Weights = M.Weights(), nodes: DataFrame | None = None) -> DataFrame:
    """One row: customers, candidate and matched pairs, entities, clusters with several members."""
    one = F.lit(1).alias("_one")
    pairs = M.reduction_ratio(customers).select("total_customers", "candidate_pairs", "reduction_factor", one)
    hits = matched_pair_count(customers, links, threshold, weights, nodes).select("matched_pairs", one)
    # every entity id is the smallest member, so counting smallest members counts entities
    root = F.col("customer_id") == F.col("component")
    entities = entity_map.agg(F.count_if(root).alias("unique_entities"),
                              F.count_if(root & (F.col("cluster_size") > 1)).alias("multi_member_clusters"), one)
    return pairs.join(hits, "_one").join(entities, "_one").drop("_one") \
        .withColumn("match_threshold", F.lit(float(threshold)))


FEATURES = ["email_match", "phone_match", "soundex_match", "postal_match", "country_match", "age_match",
            "name_similarity"]


def train_matcher(labelled_pairs: DataFrame, label: str = "label"):
    """Logistic regression on the pair features; an alternative to the fixed weights."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    data = labelled_pairs.select(*[F.col(c).cast("double").alias(c) for c in FEATURES],
                                 F.col(label).cast("double").alias("label"))
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"),
              LogisticRegression(maxIter=50, regParam=0.01)]
    return Pipeline(stages=stages).fit(data)


def predict_matches(model, pairs: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    ready = pairs.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    scored = model.transform(ready)
    return scored.withColumn("match_probability", vector_to_array("probability")[1]) \
        .drop("features", "rawPrediction", "probability")
