"""Customer matching: which pairs can match at all, how they score, and the evidence weights.

Three facts keep pairs from growing with the square of a block:

* Customers of one source with equal evidence are one *profile*; pairs are made of profiles.
* The score is a weighted sum, so a pair below the threshold even with equal names need not be made.
  The smallest sets of fields that can still reach the threshold are the join keys (ages join when they
  are close). At the default threshold these are e-mail and phone with one of soundex, postal code,
  country or age, and e-mail with all of soundex, postal code, country and age.
* Pairs that agree on enough fields match for certain, as equal names and ages count in full. Such a
  group is connected as a whole, so one link per profile stands for all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.similarity import PREFIX_FROM, jaro_winkler, name_keys
from ..session import is_blank, keep_table

# Weight of each piece of evidence; the sum is the top score.
EXACT = {"email": 5, "phone": 4, "soundex": 2, "postal": 1, "country": 1}
FUZZY = {"age": 1, "name": 3}
MAX_SCORE = 17.0
MATCH_THRESHOLD = 0.75
AGE_UNKNOWN = 99
AGE_TOLERANCE = 2

#: Profiles of a group from which on names are compared by shared keys instead of all with all.
LEAST_GROUP = 4096

# Blocking keys by name, the field each one equals, and its strength.
BLOCKS = {"block_key_1": "k1", "block_key_2": "email", "block_key_3": "phone"}
STRENGTH = {"block_key_1": 1, "block_key_2": 3, "block_key_3": 2}

SOURCE_COLUMNS = {
    "source_system": "source",
    "email_normalised": "email",
    "phone_normalised": "phone",
    "last_name_soundex": "soundex",
    "postal_code_norm": "postal",
    "country": "country",
    "full_name_norm": "name",
    "age": "age",
    "block_key_1": "k1",
}
EVIDENCE = tuple(SOURCE_COLUMNS.values())


@dataclass(frozen=True)
class Weights:
    exact: dict[str, int] = field(default_factory=lambda: dict(EXACT))
    fuzzy: dict[str, int] = field(default_factory=lambda: dict(FUZZY))
    max_score: float = MAX_SCORE


def load_er_customers(silver: DataFrame) -> DataFrame:
    """The few columns matching needs."""
    return silver.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "source_system", "full_name_norm", "email_normalised", "phone_normalised",
        "last_name_soundex", "postal_code_norm", "city_norm", "block_key_1", "block_key_2", "block_key_3",
        "age", "country")


def source_systems(customers: DataFrame) -> DataFrame:
    return customers.select("source_system").distinct()


def with_profile_key(customers: DataFrame) -> DataFrame:
    """Key over source and evidence; NULL and empty text differ."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in SOURCE_COLUMNS]
    return customers.withColumn("profile_key", F.md5(F.concat_ws("\x1f", *parts)))


def profiles(keyed: DataFrame) -> DataFrame:
    """One row per profile: its smallest customer id, its size and its evidence."""
    return keyed.groupBy("profile_key").agg(
        F.min("customer_id").alias("id"), F.count("*").alias("n"),
        *[F.any_value(c).alias(name) for c, name in SOURCE_COLUMNS.items()]
    ).withColumn("name", F.nullif("name", F.lit("")))


def threshold_signatures(threshold: float, weights: Weights = Weights(), certain: bool = False) -> list[tuple[str, ...]]:
    """Smallest field sets whose agreement lets a blocked pair reach ``threshold``.

    Every pair that is blocked (same k1, email or phone) and scores at least the threshold agrees on
    all fields of at least one set, where ages agree when close. With ``certain`` the sets reach it
    without any other evidence, so every pair that is equal in one is a match.
    """
    pool = {**weights.exact, **weights.fuzzy}
    needed = threshold * weights.max_score + 1e-9
    if not certain:
        needed -= pool.pop("name") + 2e-9
    enough = [frozenset(c) for size in range(len(pool) + 1) for c in combinations(pool, size)
              if sum(pool[n] for n in c) >= needed]
    blocked = {chosen | {block} for chosen in enough for block in BLOCKS.values()}
    smallest = [s for s in blocked if not any(other < s for other in blocked)]
    order = ["email", "phone", "k1", "name", "soundex", "postal", "country", "age"]
    return sorted((tuple(sorted(s, key=order.index)) for s in smallest), key=lambda s: (len(s), s))


def _agree(names: Iterable[str]) -> Column:
    return reduce(and_, [F.coalesce(F.col(f"{n}_a") == F.col(f"{n}_b"), F.lit(False)) for n in names])


def _close(names: Iterable[str]) -> Column:
    near = F.coalesce(F.abs(F.col("age_a") - F.col("age_b")) <= AGE_TOLERANCE, F.lit(False))
    return reduce(and_, [near if n == "age" else _agree([n]) for n in names])


def _sides(nodes: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    left, right = (nodes.select(
        F.col("id").alias(f"id_{side}"), F.col("n").alias(f"n_{side}"),
        *[F.col(c).alias(f"{c}_{side}") for c in (*EVIDENCE, *more)]) for side in "ab")
    return left, right


def shared_sets(threshold: float, weights: Weights = Weights()) -> list[tuple[str, ...]]:
    """Smallest field sets of which every pair that can reach ``threshold`` agrees on one; ages aside, as they need not be equal."""
    bare = {frozenset(s) - {"age"} for s in threshold_signatures(threshold, weights)}
    return sorted(tuple(sorted(s)) for s in bare if not any(other < s for other in bare))


def live_profiles(nodes: DataFrame, threshold: float = MATCH_THRESHOLD, weights: Weights = Weights()) -> DataFrame:
    """The profiles that agree on one of ``shared_sets`` with a profile of another source, and in ``live`` the places of these sets.

    No other profile is in a pair, and under a signature only profiles with all its sets live. Most customers are known to one
    source only, so this look at narrow hashes spares their evidence the join. A hash met twice keeps a profile too many, never one too few.
    """
    sets = shared_sets(threshold, weights)
    if not sets:
        return nodes.withColumn("live", F.array().cast("array<int>"))
    kept = keep_table(nodes, "profiles")
    keys = [F.when(reduce(and_, [F.col(c).isNotNull() for c in s]), F.xxhash64(F.lit(i), *s)) for i, s in enumerate(sets)]
    entries = kept.select("id", "source", F.posexplode(F.array(*keys)).alias("set", "key")).where("key is not null")
    # an unknown source is one of its own, as where pairs are counted
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    several = entries.groupBy("set", "key").agg(F.min(source).alias("low"), F.max(source).alias("high")).where("low < high")
    live = entries.join(several.select("set", "key"), ["set", "key"]).groupBy(F.col("id").alias("_id")).agg(F.collect_set("set").alias("live"))
    # read several times by the joins behind
    return keep_table(kept.join(live, F.col("id").eqNullSafe(F.col("_id"))).drop("_id"), "live")


def _with_signature_keys(df: DataFrame, signatures: list[tuple[str, ...]], side: str = "", spread: bool = False,
                         sets: list[tuple[str, ...]] = ()) -> DataFrame:
    """One row per signature the profile has all fields of, with their values as one key.

    ``spread`` adds a row per age that is close enough, so that close ages meet in an equi-join. With ``sets``, the ``shared_sets``
    that ``live`` counts, signatures with a set that is not live give no row.
    """
    age = F.col(f"age{side}")
    entries = []
    for position, signature in enumerate(signatures):
        fixed = F.concat(*[F.concat(F.col(f"{c}{side}"), F.lit("\x1f")) for c in signature if c != "age"])
        within = [F.array_contains(f"live{side}", i) for i, s in enumerate(sets) if set(s) <= set(signature)]
        fixed = F.when(reduce(and_, within), fixed) if within else fixed

        def entry(tail: Column, at: int = position, head: Column = fixed) -> Column:
            return F.struct(F.lit(at).alias("sig"), F.concat(head, tail).alias("key"))

        if "age" not in signature:
            entries.append(F.array(entry(F.lit(""))))
        elif not spread:
            entries.append(F.array(entry(age.cast("string"))))
        else:
            entries.append(F.array(*[entry((age + step).cast("string")) for step in range(-AGE_TOLERANCE, AGE_TOLERANCE + 1)]))
    return df.withColumn("_entry", F.explode(F.flatten(F.array(*entries)))) \
        .where("_entry.key is not null").select("*", "_entry.sig", "_entry.key").drop("_entry", f"live{side}")


def name_need(threshold: float, weights: Weights, agreed: Iterable[str]) -> float:
    """Name similarity a pair needs if it agrees on exactly these fields."""
    pool = {**weights.exact, **weights.fuzzy}
    return (threshold * weights.max_score - sum(pool[c] for c in set(agreed) if c in pool)) / pool["name"] if pool["name"] else 0.0


def split_signatures(threshold: float, weights: Weights) -> tuple[list[tuple[str, ...]], list[tuple[str, ...]], float]:
    """(strong, weak, need): field sets whose agreement leaves little to the name, those that leave much, and the similarity of the
    names that every pair without a strong set needs at least."""
    fields = [c for c in {**weights.exact, **weights.fuzzy} if c != "name"]
    sets = [frozenset(c) for size in range(len(fields) + 1) for c in combinations(fields, size)]
    needs = {c: name_need(threshold, weights, c) for c in sets}
    strict = [n for n in needs.values() if PREFIX_FROM < n <= 1 + 1e-9]
    if not strict:
        return threshold_signatures(threshold, weights), [], 0.0
    blocked = {c | {block} for c, n in needs.items() if n <= PREFIX_FROM for block in BLOCKS.values()}
    order = ["email", "phone", "k1", "name", "soundex", "postal", "country", "age"]
    smallest = sorted((tuple(sorted(c, key=order.index)) for c in blocked if not any(other < c for other in blocked)), key=lambda c: (len(c), c))
    return smallest, [c for c in threshold_signatures(threshold, weights) if c not in smallest], min(strict) - 1e-6


def candidate_pairs(nodes: DataFrame, threshold: float = MATCH_THRESHOLD, weights: Weights = Weights(),
                    skip_certain: bool = False, least_group: int | None = None) -> DataFrame:
    """Profile pairs of different sources that are blocked together and can reach ``threshold``.

    One equi-join on (signature, key). A pair is made under the first signature it satisfies only, so
    no distinct is needed. ``threshold=0`` gives plain blocking on the three keys; ``skip_certain``
    leaves out, inside the join, the pairs that ``certain_links`` stands for.

    With ``least_group``, where a signature leaves much to the name, profiles of a group of that size or more meet only if their names
    share a key of ``name_keys``, as all names that are similar enough do: most pairs that can't match for their names are never made.
    ``nodes`` may be those of ``live_profiles`` for the same threshold and weights already.
    """
    if "live" not in nodes.columns:
        nodes = live_profiles(nodes, threshold, weights)
    sets = shared_sets(threshold, weights)
    strong, weak, need = (threshold_signatures(threshold, weights), [], 0.0) if least_group is None else split_signatures(threshold, weights)
    signatures = [*strong, *weak]
    sides = _sides(nodes)
    tagged = _sides(nodes, "live")
    left, right = _with_signature_keys(tagged[0], signatures, "_a", True, sets), _with_signature_keys(tagged[1], signatures, "_b", sets=sets)
    rest: list[Column] = []
    for position in range(1, len(signatures)):
        earlier = [~_close(s) for s in signatures[:position]]
        rest.append((F.col("sig") != position) | reduce(and_, earlier))
    if skip_certain:
        rest += [~_agree(s) for s in threshold_signatures(threshold, weights, certain=True)]
    across = (F.col("id_a") < F.col("id_b")) & (F.col("source_a") != F.col("source_b"))
    if not weak:
        return with_block_sources(left.join(right, ["sig", "key"]).where(reduce(and_, rest, across)).drop("sig", "key"))

    crowded = keep_table(right.where(F.col("sig") >= len(strong)).groupBy("sig", "key").agg(F.count("*").alias("_n"))
                         .where(F.col("_n") >= least_group).select("sig", "key", F.lit(True).alias("_crowded")), "crowded")
    if is_blank(crowded):
        return candidate_pairs(nodes, threshold, weights, skip_certain)
    left, right = (side.join(crowded, ["sig", "key"], "left") for side in (left, right))
    usual = left.where("_crowded is null").drop("_crowded").join(right.where("_crowded is null").drop("_crowded"), ["sig", "key"]) \
        .where(reduce(and_, rest, across)).drop("sig", "key")
    # of a crowded group only ids and hashed keys meet; a pair may share several
    met_a, met_b = (side.where("_crowded").select("sig", "key", f"id_{x}", f"source_{x}", F.explode(name_keys(F.col(f"name_{x}"), need)).alias("_shared"))
                    for side, x in ((left, "a"), (right, "b")))
    pairs = met_a.join(met_b, ["sig", "key", "_shared"]).where(across).select("sig", "id_a", "id_b").distinct()
    close = pairs.join(sides[0], "id_a").join(sides[1], "id_b").where(reduce(and_, rest)).drop("sig")
    return with_block_sources(usual.unionByName(close))


def certain_links(nodes: DataFrame, threshold: float = MATCH_THRESHOLD, weights: Weights = Weights()) -> DataFrame:
    """At most one cross-source pair per profile and certain signature; connects what the signature does.

    Of a group with several sources, profiles of the smallest source are paired with one profile of the
    largest, and all others with one profile of the smallest. Only a minimum and a maximum are computed
    per group, and each pair is a match of its own.
    """
    left, right = _sides(nodes)
    signatures = threshold_signatures(threshold, weights, certain=True)
    if not signatures:
        return with_block_sources(left.where("false").join(right, F.col("id_a") == F.col("id_b")))
    sets = shared_sets(threshold, weights) if "live" in nodes.columns else []
    members = _with_signature_keys(nodes, signatures, sets=sets).select("sig", "key", "source", "id")
    ends = members.groupBy("sig", "key").agg(
        F.min(F.struct("source", "id")).alias("low"), F.max(F.struct("source", "id")).alias("high"),
    ).where(F.col("low.source") < F.col("high.source"))
    other = F.when(F.col("source") == F.col("low.source"), F.col("high.id")).otherwise(F.col("low.id"))
    pairs = members.join(ends, ["sig", "key"]).select(
        F.least("id", other).alias("id_a"), F.greatest("id", other).alias("id_b")).distinct()
    return with_block_sources(pairs.join(left, "id_a").join(right, "id_b"))


def with_block_sources(pairs: DataFrame) -> DataFrame:
    """All blockings that bring a pair together, and the strength of the best one."""
    met = [F.when(_agree([c]), F.lit(block)) for block, c in BLOCKS.items()]
    strength = [F.when(_agree([c]), F.lit(STRENGTH[block])).otherwise(F.lit(0)) for block, c in BLOCKS.items()]
    return pairs.withColumns({"block_sources": F.array_compact(F.array(*met)),
                              "block_strength": F.greatest(*strength)})


def pair_features(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Put the evidence of both customers next to each pair of ids."""
    out = pairs
    for side in "ab":
        known = nodes.select(F.col("id").alias(f"id_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in EVIDENCE])
        out = out.join(known, f"id_{side}")
    return out


def exact_match(name: str, compat: bool = False) -> Column:
    """Equal and known; unknown counts as different unless ``compat`` leaves it NULL."""
    a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
    if not compat:
        return F.coalesce(a == b, F.lit(False))
    return (a == b) if name == "country" else (a == b) & a.isNotNull()


def score_pairs(pairs: DataFrame, threshold: float = MATCH_THRESHOLD, weights: Weights = Weights(),
                compat: bool = False) -> DataFrame:
    """Similarity features, rule score, match probability and decision for each pair."""
    both = F.col("age_a").isNotNull() & F.col("age_b").isNotNull()
    featured = pairs.withColumns({
        **{f"{n}_match": exact_match(n, compat) for n in weights.exact},
        "name_similarity": jaro_winkler(F.col("name_a"), F.col("name_b")),
        "age_diff": F.when(both, F.abs(F.col("age_a") - F.col("age_b"))).otherwise(F.lit(AGE_UNKNOWN)),
    }).withColumn("age_match", F.col("age_diff") <= AGE_TOLERANCE)
    terms = [F.col(f"{n}_match").cast("int") * F.lit(w) for n, w in weights.exact.items()]
    terms += [F.col("age_match").cast("int") * F.lit(weights.fuzzy["age"]),
              F.col("name_similarity") * F.lit(weights.fuzzy["name"])]
    scored = featured.withColumn("rule_score", reduce(lambda a, b: a + b, terms).cast("double"))
    probability = F.least(F.col("rule_score") / F.lit(weights.max_score), F.lit(1.0))
    return scored.withColumn("match_probability", probability) \
        .withColumn("is_match", F.col("match_probability") >= F.lit(threshold))


def matched(scored: DataFrame) -> DataFrame:
    return scored.where("is_match")


def pair_counts(rows: DataFrame, key_sets: list[tuple[str, ...]], source: str, n: Column) -> DataFrame:
    """(keys, pairs, largest_block): cross-source pairs that agree on each key set, without making them.

    In a block of n customers with n_s of source s there are (n^2 - sum n_s^2) / 2 such pairs.
    """
    wide = "decimal(38,0)"
    # one pass: each row is counted once under every key set it has all values for; two hashes (128 bits) stand for the values
    hashed = [F.when(reduce(and_, [F.col(c).isNotNull() for c in s]), F.struct(
        F.lit(i).alias("set"), *[F.xxhash64(F.lit(side), F.lit(i), *[F.col(c).cast("string") for c in s]).alias(side) for side in ("h0", "h1")]))
        for i, s in enumerate(key_sets)]
    tagged = rows.select(F.col(source).alias("_source"), n.cast("long").alias("n"), F.explode(F.array_compact(F.array(*hashed))).alias("t")) \
        .select("_source", "n", "t.*")
    per_source = tagged.groupBy("set", "h0", "h1", "_source").agg(F.sum("n").alias("n"))
    number = F.col("n").cast("decimal(18,0)")
    per_block = per_source.groupBy("set", "h0", "h1").agg(F.sum("n").alias("n"), F.sum(number * number).cast(wide).alias("squares"))
    ordered = (number * number).cast(wide) - F.col("squares")
    keys = F.element_at(F.array(*[F.lit("+".join(s)) for s in key_sets]), F.col("set") + 1)
    return per_block.groupBy(keys.alias("keys")).agg(
        (F.sum(ordered.cast("decimal(28,0)")) / 2).cast("decimal(38,0)").cast("long").alias("pairs"),
        F.max("n").cast("long").alias("largest_block"))


def distinct_pair_count(rows: DataFrame, key_sets: list[tuple[str, ...]], source: str, n: Column) -> DataFrame:
    """One row: pairs that agree on at least one key set, by inclusion and exclusion."""
    signs: dict[tuple[str, ...], int] = {}
    for size in range(1, len(key_sets) + 1):
        for chosen in combinations(key_sets, size):
            union = tuple(sorted({c for s in chosen for c in s}))
            signs[union] = signs.get(union, 0) + (1 if size % 2 else -1)
    used = {s: sign for s, sign in signs.items() if sign}
    sign = reduce(lambda acc, item: acc.when(F.col("keys") == "+".join(item[0]), F.lit(item[1])),
                  used.items(), F.when(F.lit(False), F.lit(0)))
    return pair_counts(rows, list(used), source, n).agg(
        F.coalesce(F.sum(F.col("pairs") * sign), F.lit(0).cast("long")).alias("pairs"))


def blocking_counts(customers: DataFrame) -> DataFrame:
    """Candidate pairs and largest block of each blocking key."""
    return pair_counts(customers, [(name,) for name in BLOCKS], "source_system", F.lit(1))


def reduction_ratio(customers: DataFrame) -> DataFrame:
    """Customers, distinct candidate pairs of the three blockings, and n^2/2 over pairs (NULL without pairs)."""
    one = F.lit(1).alias("_one")
    pairs = distinct_pair_count(customers, [(name,) for name in BLOCKS], "source_system", F.lit(1)) \
        .select(F.col("pairs").alias("candidate_pairs"), one)
    total = customers.agg(F.count("*").alias("total_customers"), one)
    n = F.col("total_customers").cast("double")
    return total.join(pairs, "_one").drop("_one").withColumn(
        "reduction_factor", F.try_divide(n * n / 2, F.col("candidate_pairs")))
