"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is a value assigned to a name of a secret, a published key format, or a run of 16 or more characters of the alphabets
secrets are written in that holds a digit, without a leading ``NAME=``. A random forest judges it by length, character transitions, coverage by dictionary words, the document's path and the neighbouring words. It is trained on
labelled findings and then written out as a column expression, so documents are scanned in place: no shuffle, no Python, and the
rows of a hot source cost what any other rows cost.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..session import keep_table

# fixed values: alphabets of secrets, published key formats, words around secrets and around other long strings
ALPHABET = "A-Za-z0-9_+/=-"
CANDIDATE = f"(?<![{ALPHABET}])(?=[A-Za-z_+/=-]*[0-9])[{ALPHABET}]{{16,}}"
#: Formats that only keys have, and lengths of hex digits that checksums have as well.
KEYS = [
    "AKIA[0-9A-Z]{16}", "gh[opusr]_[A-Za-z0-9]{36}", "glpat-[A-Za-z0-9_-]{20}", "xox[abpr]-[A-Za-z0-9-]{20,}", "sk_live_[A-Za-z0-9]{24,}",
    "AIza[A-Za-z0-9_-]{35}",
]
FORMATS = [*KEYS, "[0-9a-f]{32}", "[0-9a-f]{40}", "[0-9a-f]{64}"]
SECRET_WORDS = "(?i)(token|secret|passwd|password|api.?key|access.?key|private.?key|credential|bearer|auth)"
OTHER_WORDS = "(?i)(commit|sha1|sha256|md5|checksum|digest|etag|uuid|example|sample|dummy|placeholder|changeme)"
PATH_WORDS = "(?i)(test|spec|example|sample|mock|fixture|doc)"
UUID = "[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
MASK = "<secret>"
_NAMED = "(?=[TtSsPpAaCcBb])(?i:token|secret|passwd|password|api.?key|access.?key|private.?key|credential|bearer|auth)[A-Za-z0-9_-]{0,16}"
_KEY, _RUN = f"(?:{'|'.join(KEYS)})(?![A-Za-z0-9_-])", f"(?=[A-Za-z_+/=-]*[0-9])[{ALPHABET}]{{16,}}"
_NAME, _SIGN = "[A-Za-z_][A-Za-z0-9_-]{0,63}=", "[\"']?\\s{0,4}[:=]{1,2}>?\\s{0,4}"
_OPEN = "[^\\s\"'`,;&<>(){}\\[\\]]"
_HELD = f"(?![A-Za-z0-9_-]*{_NAMED}(?:=[^=\\s]|{_SIGN}[\"'`]?(?![=:>]){_OPEN}))"
#: What is judged, read forwards: a secret's name, a sign and a quoted or an open value; a key by its format; a run after NAME=; a run
#: without one. What stands before a value is in the first ``VALUE_LEADS`` groups.
NAMED_VALUE = f"({_NAMED}{_SIGN}(?:[\"'`](?=[^\\s\"'`]++[\"'`]))?)(?:(?<=[\"'`])[^\\s\"'`]++|(?![=:>]){_OPEN}*(?![.?:])(?!\\s){_OPEN})"
BARE_VALUE = "|".join([
    f"(?=[Agxs])(?<![A-Za-z0-9_-]){_KEY}",
    f"((?<![{ALPHABET}])(?=[{ALPHABET}]{{18}})(?={_NAME}(?:{_KEY}|{_RUN})){_HELD}{_NAME})(?:{_KEY}|{_RUN})",
    f"(?<![{ALPHABET}])(?=[{ALPHABET}]{{16}})(?=[A-Za-z_+/=-]*[0-9]){_HELD}[{ALPHABET}]+",
])
VALUE, VALUE_LEADS = f"{NAMED_VALUE}|{BARE_VALUE}", 2
#: One of these is in every name of a secret, and every value without one is a run of so many characters at least.
NAME_PARTS, SHORTEST = ("token", "secret", "passw", "key", "credential", "bearer", "auth"), 16

#: Characters of context on either side (the neighbouring words are taken from them).
CONTEXT = 48
#: A dictionary word makes up at least this share of all words, so there are at most 1 / share of them.
WORD_SHARE = 1e-4
#: Labelled findings that a forest is trained on at most, and its size.
FINDINGS, TREES, DEPTH = 20_000, 20, 5
FEATURES = [
    "size", "transitions", "digits", "uppers", "symbols", "distinct", "coverage", "test_path", "path_depth",
    "assigned", "quoted", "secret_before", "other_before", "secret_after", "words_before",
]


def pieces(text: Column, pattern: str, leads: int) -> tuple[Column, Column, Column]:
    """(gaps, values, rest) of a text: gaps[i] stands before values[i], rest after the last. ``leads`` groups of the pattern hold what
    stands before a value and isn't part of it."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    gaps, values = F.slice(between, F.lit(1), F.size(found)), found
    for group in range(1, leads + 1):
        lead = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        gaps, values = F.zip_with(gaps, lead, lambda g, p: F.concat(g, p)), F.zip_with(values, lead, lambda v, p: F.substr(v, F.length(p) + 1))
    return gaps, values, F.element_at(between, -1)


def holds_value(text: Column) -> Column:
    """Whether ``VALUE`` is found in a text, without reading all of it by the pattern: a value without a name lies within one word
    between spaces, and a long one; a name has one of a few parts."""
    bare = F.exists(F.split(text, " "), lambda w: (F.length(w) >= SHORTEST) & w.rlike(BARE_VALUE))
    small = F.lower(text)
    parts = [F.contains(small, F.lit(part)) for part in NAME_PARTS]
    return bare | (reduce(or_, parts) & text.rlike(NAMED_VALUE))


def candidates(text: Column, pattern: str = CANDIDATE) -> Column:
    """array<struct(start, candidate, before, after)> of a text: places in code points from 0, context on both sides. ``pattern`` is
    ``VALUE`` where candidates are judged; ``CANDIDATE`` gives the plain runs, names included."""
    gaps, values, rest = pieces(text, pattern, VALUE_LEADS if pattern == VALUE else 0)
    sides = F.zip_with(values, gaps, lambda c, gap: F.struct(gap.alias("gap"), c.alias("c")))
    sides = F.zip_with(sides, F.slice(F.concat(gaps, F.array(rest)), F.lit(2), F.size(values)), lambda s, rest: F.struct(
        s["gap"].alias("gap"), s["c"].alias("c"), rest.alias("rest")))
    empty = F.array().cast("array<struct<start:bigint,candidate:string,before:string,after:string>>")

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + F.length(s["gap"])
        one = F.struct(start.alias("start"), s["c"].alias("candidate"), F.right(s["gap"], F.lit(CONTEXT)).alias("before"),
                       F.left(s["rest"], F.lit(CONTEXT)).alias("after"))
        return F.struct((start + F.length(s["c"])).alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    # most texts have none: they are read once
    listed = F.aggregate(sides, F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("found")), step, lambda s: s["found"])
    return F.when(holds_value(text) if pattern == VALUE else text.rlike(pattern), listed).otherwise(empty)


def dictionary(docs: DataFrame, text_col: str) -> list[str]:
    """Lower-case words of 3 to 24 letters that make up at least ``WORD_SHARE`` of all words, counted over all rows."""
    words = docs.select(F.explode(F.split(F.lower(docs[f"`{text_col}`"].cast("string")), "[^a-z]+")).alias("word")).where("length(word) between 3 and 24")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    often = counts.withColumn("one", F.lit(1)).join(F.broadcast(total.withColumn("one", F.lit(1))), "one").where(F.col("n") >= WORD_SHARE * F.col("total"))
    return sorted(r.word for r in often.select("word").collect())


def classes(c: Column) -> Column:
    """A candidate with each character replaced by its kind."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]", "-"), "[a-z]", "l"), "[A-Z]", "U"), "[0-9]", "d")


def features(c: Column, path: Column, words: list[str]) -> Column:
    """struct of ``FEATURES`` for one element of ``candidates``."""
    text, before, after = c["candidate"], c["before"], c["after"]
    size, kinds = F.length(text).cast("double"), classes(text)
    known = F.lit(words) if words else F.array().cast("array<string>")
    chunks = F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))
    covered = F.aggregate(F.filter(chunks, lambda w: F.array_contains(known, w)), F.lit(0), lambda n, w: n + F.length(w))
    flag = lambda b: F.when(b, 1.0).otherwise(0.0)
    place = F.coalesce(path.cast("string"), F.lit(""))
    values = {
        "size": size,
        "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / size,
        "digits": F.length(F.regexp_replace(kinds, "[^d]", "")) / size,
        "uppers": F.length(F.regexp_replace(kinds, "[^U]", "")) / size,
        "symbols": F.length(F.regexp_replace(kinds, "[^-]", "")) / size,
        "distinct": F.size(F.array_distinct(F.split(text, ""))) / size,
        "coverage": covered / size,
        "test_path": flag(place.rlike(PATH_WORDS)),
        "path_depth": F.length(F.regexp_replace(place, "[^/]", "")).cast("double"),
        "assigned": flag(before.rlike("[=:]\\s*[\"'`]?$")),
        "quoted": flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "secret_before": flag(before.rlike(SECRET_WORDS)),
        "other_before": flag(before.rlike(OTHER_WORDS)),
        "secret_after": flag(after.rlike(SECRET_WORDS)),
        "words_before": F.size(F.filter(F.split(F.lower(before), "[^a-z]+"), lambda w: F.array_contains(known, w))).cast("double"),
    }
    return F.struct(*[values[name].cast("double").alias(name) for name in FEATURES])


def rule_label(c: Column) -> Column:
    """1, 0 or null for one element of ``candidates``: the labels used where nobody has labelled findings.

    Secret: a key by its published format; hex digits or a mixture of letters with digits or signs, 8 or more, that are assigned to a
    name of a secret. Not one: digits alone, a UUID, words joined by hyphens or underscores, or what follows a word for checksums or
    examples. Everything else stays without label and is the forest's to judge.
    """
    text, before = c["candidate"], c["before"]
    named = before.rlike(SECRET_WORDS + "[A-Za-z0-9_-]{0,16}[\"']?\\s*[:=]+>?\\s*[\"'`]?$")
    format_, mixed = text.rlike(f"^({'|'.join(FORMATS)})$"), text.rlike("^(?=.*[A-Za-z])(?=.*[0-9$!@#%^*+~?])[^\\s/]{8,}$")
    joined = text.rlike("^[A-Za-z]+([_/-][A-Za-z0-9]+){2,}$")
    other = text.rlike("^[0-9=+/_-]+$") | text.rlike(f"^{UUID}$") | joined | before.rlike(OTHER_WORDS + "\\W{0,4}$")
    return F.when(is_key(c) | (format_ & named), 1.0).when(other, 0.0).when(named & mixed, 1.0)


def is_key(c: Column) -> Column:
    """A key by its published format, unless a word for checksums or examples stands right before it."""
    return c["candidate"].rlike(f"^({'|'.join(KEYS)})$") & ~c["before"].rlike(OTHER_WORDS + "\\W{0,4}$")


@dataclass
class Forest:
    """Trees as nested (feature, threshold, left, right) or a leaf's label; ``words`` is the dictionary it was trained with."""
    trees: list
    words: list[str]
    by_rule: bool = False

    def score(self, values: Column) -> Column:
        """Share of trees that call it a secret."""
        def column(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            name, threshold, left, right = tree
            return F.when(values[name] <= threshold, column(left)).otherwise(column(right))

        return sum((column(t) for t in self.trees[1:]), column(self.trees[0])) / len(self.trees)


def read_tree(text: str):
    """A tree from the description that a trained model prints."""
    lines = [line.strip() for line in text.splitlines() if line.strip()][1:]

    def read(at: int):
        if m := re.fullmatch(r"Predict: (\S+)", lines[at]):
            return float(m[1]), at + 1
        m = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        left, at = read(at + 1)
        right, at = read(at + 1)  # after the Else
        return (FEATURES[int(m[1])], float(m[2]), left, right), at

    return read(0)[0]


def train(findings: DataFrame, words: list[str], seed: int = 11) -> Forest:
    """A forest from labelled findings (columns ``FEATURES`` and ``label``, 1 for a secret). Where all findings
    are secrets ``rule_label`` decides; where none is, nothing but a key by its format is one. Larger tables are sampled to
    ``FINDINGS`` / 2 a class."""
    known = findings.where("label is not null").groupBy("label").count().collect()
    if len(known) < 2:
        return Forest([0.0], words, bool(known) and known[0].label == 1)
    n = sum(r["count"] for r in known)
    sample = findings.where("label is not null")
    if n > FINDINGS:
        sample = sample.sampleBy("label", {r.label: min(1.0, FINDINGS / 2 / r["count"]) for r in known}, seed)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, labelCol="label", featuresCol="vector") \
        .fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample))
    return Forest([read_tree(t.toDebugString) for t in model.trees], words)


def rule_findings(docs: DataFrame, words: list[str], text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Labelled findings of a corpus by ``rule_label``."""
    c = docs.select(docs[f"`{path_col}`"].alias("path"), F.explode(candidates(docs[f"`{text_col}`"].cast("string"), VALUE)).alias("c"))
    return c.select(features(F.col("c"), F.col("path"), words).alias("f"), rule_label(F.col("c")).alias("label")).select("f.*", "label")


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", threshold: float = 0.5) -> DataFrame:
    """(id, n_candidates, secrets, redacted, row) per row, in place.

    ``secrets`` lists (start, end, score) in code points for candidates that at least ``threshold`` of the trees call secrets or that
    are keys by their published format, in order; ``redacted`` is the text with each of them replaced; ``row`` holds the columns of ``docs`` as they were. A null text has no
    candidates and stays null; a null path is an empty one; repeated rows and null ids are kept as they are.
    """
    rows = docs.select(docs[f"`{id_col}`"].alias("id_"), docs[f"`{text_col}`"].cast("string").alias("text_"), docs[f"`{path_col}`"].alias("path_"),
                       F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,score:double>>")
    judged = F.transform(F.col("found_"), lambda c: F.struct(
        c["start"].alias("start"), (c["start"] + F.length(c["candidate"])).alias("end"), F.when(is_key(c), 1.0).otherwise(F.coalesce(rule_label(c), F.lit(0.0)) if forest.by_rule else forest.score(features(c, F.col("path_"), forest.words))).alias("score")))
    held = rows.withColumn("found_", candidates(F.col("text_"), VALUE)).withColumn("judged_", F.when(F.size("found_") > 0, judged).otherwise(none))
    kept = F.filter("judged_", lambda c: c["score"] >= threshold)
    gaps, values, rest = pieces(F.col("text_"), VALUE, VALUE_LEADS)
    shown = F.zip_with(values, "judged_", lambda c, j: F.when(j["score"] >= threshold, F.lit(MASK)).otherwise(c))
    mended = F.concat(F.zip_with(gaps, shown, lambda gap, c: F.concat(gap, c)), F.array(rest))
    return held.select(
        F.col("id_").alias(id_col), F.size("judged_").cast("long").alias("n_candidates"), kept.alias("secrets"),
        F.when(F.size(kept) > 0, F.array_join(mended, "")).otherwise(F.col("text_")).alias("redacted"), "row")


def learn(docs: DataFrame, findings: DataFrame | None = None, text_col: str = "text", path_col: str = "source") -> Forest:
    """A forest trained on ``findings`` (columns ``FEATURES`` and ``label``), or on the rule-labelled findings of ``docs`` itself."""
    words = dictionary(docs, text_col)
    if findings is None:  # stored, as training reads them several times
        findings = keep_table(rule_findings(docs, words, text_col, path_col).where("label is not null"), "findings")
    return train(findings, words)
