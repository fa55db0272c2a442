"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are scaled to length one, so the largest cosine is the smallest Euclidean distance, and projected by Gaussian directions.
The squared projected distance of a pair at distance d is d squared times a chi-square variable. Projected points are searched
outwards from the query; each is verified on the original vectors. With the distance d of the last neighbour held, the search stops
once the projected distance passed is so large that a point within d would have been met before with the probability asked for.

The kd-tree has two levels. Its upper cells are fitted on a bounded sample and deal all vectors into blocks of bounded size; a
block holds the lower tree. A query searches a block of its own cell first; the neighbours found there bound the cells it still
has to visit. Equal vectors are one point, so a very common vector is neither a hot cell nor a list of equal results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import keep_table
from .columns import pick

#: Projected dimensions (even), and the probability with which a true neighbour is met before the search stops.
DIMENSIONS, SURE = 12, 0.98
#: Points of a block, queries searched with one copy of a block, points of a lower leaf.
BLOCK, QUERIES, LEAF = 4096, 4096, 64
#: Rows the upper cells are fitted on, and how many of them make a cell at least.
SAMPLE, PER_CELL = 65_536, 16
SEED = 20_240_607


def chi_square_quantile(p: float, dims: int) -> float:
    """Where the chi-square distribution with an even number of dimensions reaches p, by bisection of its closed form."""
    def below(x):
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    low, high = 0.0, 10.0 * dims + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, DIMENSIONS))


def split_cells(points: np.ndarray, least: int) -> list[tuple[int, float, int, int]]:
    """Nodes (axis, cut, left, right) of a tree over points; a child below zero is cell ``-1 - child``."""
    nodes: list[tuple[int, float, int, int]] = []
    cells = [0]

    def grow(part):
        spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(points.shape[1])
        if len(part) < 2 * least or not spread.max() > 0:
            cells[0] += 1
            return -cells[0]
        axis = int(spread.argmax())
        cut = float(np.median(part[:, axis]))
        side = part[:, axis] < cut
        if not side.any():
            cut = float(np.nextafter(cut, np.inf))
            side = part[:, axis] < cut
        at = len(nodes)
        nodes.append((axis, cut, 0, 0))
        nodes[at] = (axis, cut, grow(part[side]), grow(part[~side]))
        return at

    grow(points)
    return nodes


def cell_of(nodes: list[tuple[int, float, int, int]], points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        at, rows = todo.pop()
        axis, cut, left, right = nodes[at]
        side = points[rows, axis] < cut
        for child, part in ((left, rows[side]), (right, rows[~side])):
            if child < 0:
                out[part] = -1 - child
            elif len(part):
                todo.append((child, part))
    return out


class Tree:
    """Lower kd-tree of one block: leaves with tight boxes."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            part = points[rows]
            spread = part.max(axis=0) - part.min(axis=0)
            if len(rows) <= LEAF or not spread.max() > 0:
                self.leaves.append(rows)
                continue
            order = np.argpartition(part[:, spread.argmax()], len(rows) // 2)
            todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
        self.low = np.stack([points[r].min(axis=0) for r in self.leaves])
        self.high = np.stack([points[r].max(axis=0) for r in self.leaves])


def box_distance(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of a point from boxes."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return (gap * gap).sum(axis=1)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two: squares neither overflow nor vanish, and no digit changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def search(tree: Tree, vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, at: np.ndarray, keep: int, bound: float, reach: float):
    """Rows and cosines of the nearest points of a block. ``bound``: squared distance that ``keep`` points are known to be within."""
    norm = np.sqrt((query * query).sum())
    rows, cosines = np.empty(0, np.int64), np.empty(0)
    away = box_distance(tree.low, tree.high, at)
    for leaf in np.argsort(away, kind="stable"):
        if away[leaf] > bound * reach:
            break  # the test holds for all that is left
        part = tree.leaves[leaf]
        gap = tree.points[part] - at
        part = part[(gap * gap).sum(axis=1) <= bound * reach]
        if not len(part):
            continue
        found = (vectors[part] * query).sum(axis=1) / (norms[part] * norm)
        rows, cosines = np.concatenate([rows, part]), np.concatenate([cosines, found])
        if len(rows) > keep:
            order = np.lexsort((rows, -cosines))[:keep]
            rows, cosines = rows[order], cosines[order]
        if len(rows) == keep:
            bound = min(bound, max(0.0, 2 - 2 * cosines.min()) * (1 + 1e-12) + 1e-15)
    return rows, cosines


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) with finite, non-zero vectors and an id; repeated rows once."""
    rows = pick(df, id=id_col, vec=vec_col).select("id", F.col("vec").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0)) \
        .withColumns({"hi": F.xxhash64("vec"), "lo": F.xxhash64(F.lit(1), "vec")})


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", sure: float = SURE) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows of each query row by cosine in double precision, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``. All rows but those with the query's own id are candidates. Vectors that are
    null, zero, or hold a null or a non-finite component take no part, nor do rows without id; vectors are compared with those
    of the same dimension only. Repeated rows count once. Fewer candidates than k give fewer rows; an empty table gives none.
    """
    spark, keep, reach = vectors.sparkSession, k + 1, chi_square_quantile(sure, DIMENSIONS)
    rows = valid_vectors(vectors, id_col, vec_col)
    best = Window.partitionBy("hi", "lo").orderBy("id")
    points = keep_table(
        rows.select("hi", "lo", "id", "vec").withColumn("at", F.dense_rank().over(best)).where(F.col("at") <= keep)
        .groupBy("hi", "lo").agg(F.first("vec").alias("vec"), F.array_sort(F.collect_set("id")).alias("ids")), "points")
    total = points.count()
    if not total:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")

    dims = sorted(r[0] for r in points.select(F.size("vec")).distinct().limit(1000).collect())
    share = min(1.0, SAMPLE / total)
    fitted = points.where(F.pmod("lo", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * SAMPLE).select("vec").toPandas()["vec"]
    trees, first_cell, cells = {}, {}, 0
    for dim in dims:
        part = [v for v in fitted if len(v) == dim]
        sample = project(np.stack(part)) if part else np.zeros((0, DIMENSIONS))
        trees[dim] = split_cells(sample, max(PER_CELL, int(BLOCK / 2 * share)))
        first_cell[dim], cells = cells, cells + len(trees[dim]) + 1
    shared = spark.sparkContext.broadcast((trees, first_cell))  # at most 2 * SAMPLE / PER_CELL cuts

    def placed(batches):
        trees, first_cell = shared.value
        for pdf in batches:
            size = pdf["vec"].map(len)
            proj, cell = np.empty(len(pdf), object), np.full(len(pdf), -1, np.int64)
            for dim in size.unique():
                at = np.flatnonzero(size == dim)
                found = project(np.stack(pdf["vec"].to_numpy()[at]))
                for i, row in zip(at, found):
                    proj[i] = row
                if dim in trees:
                    cell[at] = first_cell[dim] + cell_of(trees[dim], found)
            yield pdf.assign(proj=proj, cell=cell)

    asked = rows.where(is_query).select("id", "hi", "lo", F.size("vec").alias("dim"))
    wanted = asked.select("hi", "lo").distinct().withColumn("asked", F.lit(True))
    data = keep_table(
        points.mapInPandas(placed, "hi long, lo long, vec array<double>, ids array<long>, proj array<double>, cell long")
        .join(wanted, ["hi", "lo"], "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "placed")
    # one row per cell: at most as many as the fitted trees have
    stats = data.groupBy("cell", F.size("vec").alias("dim")).agg(F.count("*").alias("n"), *[
        f(F.col("proj")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS) for name, f in (("low", F.min), ("high", F.max))]).toPandas()
    stats["blocks"] = -(-stats["n"] // BLOCK)
    boxes = spark.sparkContext.broadcast({
        dim: (g["cell"].to_numpy(), g[[f"low{i}" for i in range(DIMENSIONS)]].to_numpy(), g[[f"high{i}" for i in range(DIMENSIONS)]].to_numpy(), g["blocks"].to_numpy())
        for dim, g in stats.groupby("dim")})

    per_cell = spark.createDataFrame(stats[["cell", "dim", "blocks"]].astype("int64"), "cell long, dim long, blocks long")
    blocks = data.join(F.broadcast(per_cell), (data["cell"] == per_cell["cell"]) & (F.size(data["vec"]) == per_cell["dim"])) \
        .select(data["cell"], "dim", F.pmod("hi", F.col("blocks")).alias("part"), "hi", "lo", "vec", "ids", "proj", "blocks", "asked")
    blocks = keep_table(blocks, "blocks")
    queries = blocks.where("asked").select("dim", "cell", "hi", "lo", "vec", "proj", "blocks", "part")

    result = "qhi long, qlo long, hi long, lo long, ids array<long>, score double"

    def answer(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asking) and len(held):
            held = held.assign(least=held["ids"].map(lambda ids: ids[0])).sort_values("least").reset_index(drop=True)
            own = scaled(np.stack(held["vec"]))
            norms, tree = lengths(own), Tree(np.stack(held["proj"]))
            his, los, ids = held["hi"].to_numpy(), held["lo"].to_numpy(), held["ids"].to_numpy()
            asked_vec = scaled(np.stack(asking["vec"]))
            for i, (qhi, qlo, proj, bound) in enumerate(zip(asking["hi"], asking["lo"], asking["proj"], asking["bound"])):
                near, cosines = search(tree, own, norms, asked_vec[i], proj, keep, bound, reach)
                out += [(qhi, qlo, his[j], los[j], ids[j], c) for j, c in zip(near, cosines)]
        return pd.DataFrame(out, columns=["qhi", "qlo", "hi", "lo", "ids", "score"])

    def visit(asking: DataFrame) -> DataFrame:
        """Queries (dim, cell, part, hi, lo, vec, proj, bound) against their blocks; a block much asked for is copied."""
        load = asking.groupBy("dim", "cell", "part").agg(F.ceil(F.count("*") / QUERIES).alias("copies"))
        chunked = asking.join(load, ["dim", "cell", "part"]).withColumn("copy", F.pmod(F.xxhash64("hi", "lo"), F.col("copies"))).drop("copies")
        copied = blocks.select("dim", "cell", "part", "hi", "lo", "vec", "ids", "proj").join(load, ["dim", "cell", "part"]) \
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
        key = ["dim", "cell", "part", "copy"]
        chunked, copied = chunked.toDF(*chunked.columns), copied.toDF(*copied.columns)  # both may stem from one table
        return chunked.groupBy(*key).cogroup(copied.groupBy(*key)).applyInPandas(answer, result)

    home = queries.withColumn("bound", F.lit(4.0)).drop("blocks")
    near = keep_table(visit(home), "near")
    # the squared distance of the last of keep points; 4 (everything) where fewer were found
    bound = near.groupBy(F.col("qhi").alias("hi"), F.col("qlo").alias("lo")).agg(F.count("*").alias("n"), F.min("score").alias("last")) \
        .select("hi", "lo", F.when(F.col("n") < keep, F.lit(4.0)).otherwise(F.greatest(F.lit(0.0), 2 - 2 * F.col("last")) + 1e-12).alias("bound"))

    def routed(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                cell, low, high, parts = boxes.value[row.dim]
                for j in np.flatnonzero(box_distance(low, high, np.asarray(row.proj)) <= row.bound * reach):
                    out += [(row.dim, cell[j], p, row.hi, row.lo, row.vec, row.proj, row.bound) for p in range(parts[j]) if (cell[j], p) != (row.cell, row.part)]
            yield pd.DataFrame(out, columns=["dim", "cell", "part", "hi", "lo", "vec", "proj", "bound"])

    routes = queries.join(bound, ["hi", "lo"]).select("dim", "cell", "part", "hi", "lo", "vec", "proj", "bound") \
        .mapInPandas(routed, "dim long, cell long, part long, hi long, lo long, vec array<double>, proj array<double>, bound double")
    far = visit(keep_table(routes, "routes"))

    # at most keep points a block, each with at most keep ids
    found = near.unionByName(far).withColumn("least", F.element_at("ids", 1))
    top = found.withColumn("at", F.row_number().over(Window.partitionBy("qhi", "qlo").orderBy(F.desc("score"), "least"))).where(F.col("at") <= keep)
    listed = top.select("qhi", "qlo", "score", F.explode("ids").alias("other"))
    pairs = asked.select("id", "hi", "lo").distinct().join(listed, (F.col("hi") == F.col("qhi")) & (F.col("lo") == F.col("qlo"))).where("id <> other")
    order = Window.partitionBy("id", "hi", "lo").orderBy(F.desc("score"), "other")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("other").alias(id_col), "score")


def project(vectors: np.ndarray) -> np.ndarray:
    unit = scaled(np.asarray(vectors, dtype=np.float64))
    return (unit / lengths(unit)[:, None]) @ directions(unit.shape[1])
