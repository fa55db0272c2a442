"""Prefix trie of conversations by adaptive radix trees.

A turn's id has a fixed width: a digest of role and text and the text's length, both big-endian, so that a conversation is a byte
string and every multiple of the width is a turn boundary. Distinct strings are dealt in sorted order, so the members of any
trie node are neighbours. Runs of bounded size go into an adaptive radix tree each (layouts for 4, 16, 48 and 256 children,
chains without a branch kept as one compressed path); only byte depths at turn boundaries emit nodes.

What a run emits is final unless the node lies on the path of its first or last string. Those partial nodes are summed, less what
two neighbouring runs both counted along the prefix their border strings share. So no hot prefix is gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import keep_table
from .columns import pick

#: Bytes of a digest and of a text's length in a turn id.
DIGEST, LENGTH = 16, 4
WIDTH = DIGEST + LENGTH
#: Strings and bytes of one tree at most (a longer string has a tree of its own), rows of an emitted batch, text of one piece to hash.
RUN, RUN_BYTES, BATCH, PIECE = 32_768, 8_000_000, 16_384, 65_536
NODES = ("depth long, conv long, parent_conv long, key binary, parent_key binary, n_convs long, n_children long, n_leaves long, "
         "spent long, once long, ends string, first binary, last binary, run long")


class Few:
    """Up to 4 or 16 children: sorted bytes beside their nodes."""
    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node) -> "Few | Indexed":
        if len(self.nodes) == self.room:
            bigger = Few(16) if self.room == 4 else Indexed()
            for b, n in self.items():
                bigger.put(b, n)
            return bigger.put(byte, node)
        at = len(self.nodes)
        while at and self.bytes[at - 1] > byte:
            at -= 1
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator:
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children: a table of 256 places into a list of nodes."""
    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node) -> "Indexed | Direct":
        if len(self.nodes) == 48:
            bigger = Direct()
            for b, n in self.items():
                bigger.put(b, n)
            return bigger.put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator:
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.index) if at)


class Direct:
    """Up to 256 children, one place for each byte."""
    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> "Direct":
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """A branch or an end. ``key`` is any string below, ``to`` the bytes of it that lead here, ``prefix`` the last of them, which come
    without a branch; ``n`` and ``least`` are the number and the smallest id of the members, ``ends`` is set if a string ends here."""
    __slots__ = ("key", "to", "prefix", "n", "least", "ends", "below")

    def __init__(self, key: bytes, to: int, prefix: bytes, n: int, least: int, ends=None):
        self.key, self.to, self.prefix, self.n, self.least, self.ends, self.below = key, to, prefix, n, least, ends, None


def shared_length(a: bytes, b: bytes) -> int:
    """Bytes two strings have in common from the start."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


class RadixTree:
    """Adaptive radix tree of byte strings; a string may be the beginning of another."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, n: int, least: int, ends: str) -> None:
        """``key`` must be new."""
        if self.root is None:
            self.root = Node(key, len(key), key, n, least, ends)
            return
        node, at = self.root, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                same = shared_length(prefix, key[at:at + len(prefix)])
                lower = Node(node.key, node.to, prefix[same + 1:], node.n, node.least, node.ends)
                lower.below = node.below
                node.to, node.prefix, node.ends = at + same, prefix[:same], None
                node.below = Few().put(prefix[same], lower)
            at = node.to
            node.n += n
            node.least = min(node.least, least)
            if at == len(key):
                node.ends = ends
                return
            below = Few() if node.below is None else node.below
            child = below.get(key[at])
            if child is None:
                node.below = below.put(key[at], Node(key, len(key), key[at + 1:], n, least, ends))
                return
            node, at = child, at + 1

    def trie(self, width: int = WIDTH) -> Iterator[tuple]:
        """(depth, least, parent's least, n, children, leaves, spent, once, ends, key, parent's key) for every turn boundary.

        ``spent`` sums n times the length of the last text over the subtree, ``once`` that length alone. The keys are digests of the
        bytes that lead to a node, given only on the paths of the first and the last string.
        """
        order: list[list] = []  # node, start, parent's place, parent boundary's least, first, last, children, leaves, spent, once
        todo = [(self.root, 0, -1, None, True, True)]
        while todo:
            node, start, parent, above, first, last = todo.pop()
            place = len(order)
            order.append([node, start, parent, above, first, last, 0, 0, 0, 0])
            if node.below is not None:
                boundary = parent < 0 or node.to // width > (start - 1) // width
                children = list(node.below.items())
                for i, (_, child) in enumerate(children):
                    todo.append((child, node.to + 1, place, node.least if boundary else above,
                                 first and i == 0 and node.ends is None, last and i == len(children) - 1))
        for node, start, parent, above, first, last, children, leaves, spent, once in reversed(order):
            edge = first or last
            up_edge = parent >= 0 and self.edge_above(order, parent, width)
            lowest = 0 if parent < 0 else (start - 1) // width + 1  # of the boundaries on the way from the branch above
            keys: dict[int, bytes] = {}
            if edge or up_edge:
                state, done = hashlib.sha256(), 0
                for depth in range(max(0, lowest - 1), node.to // width + 1):
                    state.update(node.key[done:depth * width])
                    done = depth * width
                    keys[depth] = state.copy().digest()
            for depth in range(node.to // width, lowest - 1, -1):
                size = int.from_bytes(node.key[depth * width - LENGTH:depth * width], "big") if depth else 0
                if not children:
                    leaves = 1
                spent, once = spent + node.n * size, once + size
                own_parent = depth > lowest
                key = keys[depth] if edge else None
                up = None if not depth else keys[depth - 1] if (edge if own_parent else up_edge) else None
                yield (depth, node.least, None if not depth else node.least if own_parent else above, node.n, children, leaves, spent, once,
                       node.ends if depth * width == node.to else None, key, up)
                children = 1
            if parent >= 0:
                held = order[parent]
                held[6], held[7], held[8], held[9] = held[6] + children, held[7] + leaves, held[8] + spent, held[9] + once

    @staticmethod
    def edge_above(order: list, parent: int, width: int) -> bool:
        """Whether the last boundary before a branch lies on the path of the first or last string."""
        while True:
            node, begin, up, _, first, last = order[parent][:6]
            if up < 0 or node.to // width > (begin - 1) // width:
                return first or last
            parent = up


def turn_id(role: Column, text: Column) -> Column:
    """Hex digits of a turn's id."""
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)
    return F.lower(F.concat(digest, F.lpad(F.hex(F.length(text).cast("long")), 2 * LENGTH, "0")))


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, ids): the turn ids of each conversation in order of turn, null first; ties by role, then by id. Null roles and texts are empty
    ones; rows without a conversation id are left out. One conversation's ids (40 characters a turn, no texts) meet in one row."""
    rows = pick(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv is not null")
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select(F.col("conv").cast("long").alias("conv"), F.struct("turn", role.alias("role"), turn_id(role, text).alias("id")).alias("t")) \
        .groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns")).select("conv", F.transform("turns", lambda t: t["id"]).alias("ids"))


def rebuilt(found: DataFrame, block: int = 100, kinds: int = 6) -> DataFrame:
    """(conv, ids): the first h turns of conversation ``conv - conv % block`` in place of a conversation's own, where h is the CRC-32 of the
    decimal id modulo ``kinds``."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % kinds).cast("int")
    heads = found.select(F.col("conv").alias("base"), F.slice("ids", 1, kinds - 1).alias("head"))
    rows = found.withColumns({"base": F.col("conv") - F.col("conv") % block, "h": h}).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    return rows.select("conv", F.concat(head, F.slice("ids", F.col("h") + 1, F.greatest(F.size("ids"), F.lit(1)))).alias("ids"))


def listed_ids(members: DataFrame) -> DataFrame:
    """(node, ends) for members (node binary, conv long): SHA-256 of the decimal ids in ascending order with commas between.

    Ids are sorted over all tasks and joined into pieces; only whole pieces of a node meet, and they are hashed one after another.
    """
    def pieces(batches):
        node, first, text, size = None, None, [], 0
        for batch in batches:
            rows = []
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != node or size > PIECE:
                    if text:
                        rows.append((node, first, ",".join(text)))
                    node, first, text, size = key, conv, [], 0
                text.append(str(conv))
                size += len(text[-1]) + 1
            yield columns(rows, "pieces")
        if text:
            yield columns([(node, first, ",".join(text))], "pieces")

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != node:
                    if node is not None:
                        rows.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield columns(rows, "hashed")
        if node is not None:
            yield columns([(node, state.hexdigest())], "hashed")

    types = {"pieces": [("node", pa.binary()), ("first", pa.int64()), ("text", pa.string())], "hashed": [("node", pa.binary()), ("ends", pa.string())]}

    def columns(rows, kind):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types[kind])], names=[n for n, _ in types[kind]])

    texts = members.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv") \
        .mapInArrow(pieces, "node binary, first long, text string")
    return texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node binary, ends string")


NAMES = [part.split()[0] for part in NODES.split(", ")]
KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
SCHEMA = pa.schema([(part.split()[0], KINDS[part.split()[1]]) for part in NODES.split(", ")])


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)


def run_nodes(batches) -> Iterator[pa.RecordBatch]:
    """Trie nodes of sorted strings (key, n, least, ends), a tree per run, and one row with the border strings of each run."""
    run, tree, size, count, first, last = TaskContext.get().partitionId() << 32, RadixTree(), 0, 0, None, None

    def flushed():
        rows = []
        for depth, least, up, n, children, leaves, spent, once, ends, key, up_key in tree.trie():
            rows.append((depth, least, up, key, up_key, n, children, leaves, spent, once, ends, None, None, None))
            if len(rows) == BATCH:
                yield as_batch(rows)
                rows = []
        yield as_batch([*rows, (*[None] * 11, first, last, run)])

    for batch in batches:
        for key, n, least, ends in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if count and (count == RUN or size + len(key) > RUN_BYTES):
                yield from flushed()
                run, tree, size, count = run + 1, RadixTree(), 0, 0
            first, last = (key if not count else first), key
            tree.insert(key, n, least, ends)
            size, count = size + len(key), count + 1
    if count:
        yield from flushed()


def counted_twice(batches) -> Iterator[pa.RecordBatch]:
    """For border strings (last of a run, first of the next): what both runs counted of each node on the prefix they share, below zero."""
    for batch in batches:
        rows = []
        for before, after in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shared = shared_length(before, after) // WIDTH
            inner = -1 if len(before) == shared * WIDTH else 0  # looked like a leaf, but the next run goes on from there
            once, state, keys = 0, hashlib.sha256(), []
            for depth in range(shared + 1):
                state.update(before[max(0, depth - 1) * WIDTH:depth * WIDTH])
                keys.append(state.copy().digest())
            for depth in range(shared, -1, -1):
                once -= int.from_bytes(before[depth * WIDTH - LENGTH:depth * WIDTH], "big") if depth else 0
                rows.append((depth, None, None, keys[depth], None, 0, -1 if depth < shared else 0, inner, 0, once, None, None, None, None))
                if len(rows) == BATCH:
                    yield as_batch(rows)
                    rows = []
        yield as_batch(rows)


def prefix_trie(found: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per node of the trie of
    ``found`` (conv, ids), conversation ids being distinct.

    A node is a distinct sequence of first turns, the root that of none; ``conv_id`` is its smallest member, and with the depth it names the node.
    ``saved_tokens`` sums (members - 1) times the code points of the last text over the subtree; ``ends_sha256`` lists the members that
    end at the node. Conversations without turns end at the root; equal ones are one string with several members. An
    empty table has no node.
    """
    members = keep_table(found.select("conv", F.unhex(F.array_join("ids", "")).alias("key")).withColumn("node", F.unhex(F.sha2("key", 256))), "members")
    strings = members.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("least")).withColumn("node", F.unhex(F.sha2("key", 256)))
    dealt = strings.join(listed_ids(members), "node").select("key", "n", "least", "ends").repartitionByRange("key").sortWithinPartitions("key")
    parts = keep_table(dealt.mapInArrow(run_nodes, NODES), "nodes")

    # one row per run: its border strings, next to those of the run that follows
    borders = parts.where("run is not null").select("run", "first", "last") \
        .select("last", F.lead("first").over(Window.orderBy("run")).alias("after")).where("after is not null")
    edges = parts.where("key is not null").unionByName(borders.mapInArrow(counted_twice, NODES)).groupBy("key").agg(
        F.max("depth").alias("depth"), F.min("conv").alias("conv"), F.max("parent_key").alias("parent_key"), F.max("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "once")])
    edges = keep_table(edges, "edges")
    inner = parts.where("run is null and key is null")
    kept = ["depth", "conv", "parent_key", "ends", "n_convs", "n_children", "n_leaves", "spent", "once"]
    above = edges.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv"))
    out = inner.where("parent_key is null").select(*kept, "parent_conv") \
        .unionByName(inner.where("parent_key is not null").select(*kept).join(above, "parent_key").select(*kept, "parent_conv")) \
        .unionByName(edges.select(*kept).join(above, "parent_key", "left").select(*kept, "parent_conv"))
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("spent") - F.col("once")).alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
