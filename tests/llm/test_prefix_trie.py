import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from oreline.llm import prefix_trie as T
from oreline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, node string, key string, n long, ids string, conv string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 2, 1, "x", "x") for r in rows], SCHEMA)


def brute(rows):
    """Node tuples by looking at every prefix of every conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", expected_id(role, text), text or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        base, h = c - (abs(c) % 100) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for path, held in members.items():
        below = [p for p in members if p[:len(path)] == path]
        leaves = [p for p in below if not any(q != p and q[:len(p)] == p for q in members)]
        ends = sorted(c for c in held if made[c] == path)
        out.append((min(held), len(path), min(members[path[:-1]]) if path else None, len(held), sum(len(p) == len(path) + 1 for p in below), len(leaves),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def expected_id(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32] + f"{len(text):08x}"


def nodes(spark, rows):
    return sorted((tuple(r) for r in T.prefix_trie(T.rebuilt(T.sequences(table(spark, rows)))).collect()), key=repr)


def random_rows(seed, n=60, most=9):
    rng = random.Random(seed)
    return [(c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "é🙂", "same text"])) for c in range(n) for turn in range(rng.randint(1, most))]


@pytest.mark.parametrize("run", [1, 2, 5, 32_768])
def test_equals_brute_force_at_any_run_size(spark, monkeypatch, run):
    monkeypatch.setattr(T, "RUN", run)
    monkeypatch.setattr(T, "PIECE", 4)
    monkeypatch.setattr(T, "BATCH", 3)
    rows = random_rows(run) + [(c, t, "user", "hot") for c in range(200, 240) for t in range(3)] + [(c, 0, "user", f"own {c}") for c in range(300, 420)]
    assert nodes(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (None, 0, "user", "nobody"), (101, 3, None, "x"), (-5, 1, "user", "y"), (-5, 1, "a", "y"),
            (7, 0, "user", "long " * 50_000), (7, 1, "user", "\x00"), (100, 0, "user", "base")] + [(150, t, "user", "many") for t in range(300)]
    assert nodes(spark, rows) == brute(rows)
    assert nodes(spark, []) == []
    alone = nodes(spark, [(None, 0, "u", "t")])
    assert alone == []


def test_turnless_conversation_ends_at_the_root(spark):
    c = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 > 0)  # its only turn is replaced, and its base is absent
    assert nodes(spark, [(c, 0, "user", "x")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_layouts_grow_and_keep_every_child():
    tree, keys = T.RadixTree(), [bytes([7, b, 1, c]) for b in range(256) for c in (0, 200)]
    order = keys[:]
    random.Random(1).shuffle(order)
    kinds = set()
    for i, k in enumerate(order):
        tree.insert(k, 1, i, "e")
        kinds.add(type(tree.root.below).__name__ + (str(tree.root.below.room) if isinstance(tree.root.below, T.Few) else ""))
    assert kinds == {"NoneType", "Few4", "Few16", "Indexed", "Direct"} and tree.root.prefix == b"\x07" and tree.root.n == 512

    def ends(node, path):
        path += node.prefix
        found = [path] if node.ends else []
        for b, child in (node.below.items() if node.below else ()):
            found += ends(child, path + bytes([b]))
        return found

    assert ends(tree.root, b"") == keys


def test_only_turn_boundaries_emit_nodes():
    tree = T.RadixTree()
    for i, k in enumerate([b"aaaabbbb", b"aaaabbcc", b"aaaacccc", b"aaxxdddd"]):
        tree.insert(k, 1, i, "e")
    assert sorted(r[0] for r in tree.trie(4)) == [0, 1, 1, 2, 2, 2, 2]


def test_turn_ids(spark):
    got = table(spark, [(1, 0, "user", "é🙂")]).select(T.turn_id(F.col("role"), F.col("text"))).first()[0]
    assert got == expected_id("user", "é🙂") and len(got) == 2 * T.WIDTH


def test_registered_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_prefix_trie"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
