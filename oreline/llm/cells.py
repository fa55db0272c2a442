"""Near copies among embeddings: spherical k-means cells, blocked cosine products within them, one vector kept per group.

Vectors are compared within a label only. Large labels are cut into cells by spherical k-means, fitted on a bounded sample. A
vector belongs to the cell of its nearest centroid, and visits each lower-numbered cell whose border is so near that a vector
beyond it could be similar enough: the difference of its cosines to two centroids is then at most their distance times the
largest distance of a linked pair. So no link is lost at a border, and each pair of vectors meets once.

Members of a cell lie in blocks of bounded size; a task multiplies two blocks and returns, for each vector, how many it is linked
with and one member of its group there, never the pairs. Equal vectors are one point with a count.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.components import star_forest
from ..session import keep_table
from .columns import pick

#: Points a cell should have, sampled points that make a cell at least, sampled points of all labels together.
CELL, PER_CELL, SAMPLE = 1024, 16, 65_536
#: Cells a vector may visit on average; fewer, larger cells are taken where a sample shows more.
VISITS = 8.0
#: Rounds of k-means, rows and bytes of a block.
ROUNDS, BLOCK, BLOCK_BYTES = 10, 4096, 32_000_000
#: Cosines this close to the threshold are computed again from the vectors as they are.
CLOSE = 1e-9


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; powers of two first, so that squares neither overflow nor vanish."""
    even = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return even / np.sqrt((even * even).sum(axis=1))[:, None]


def k_means(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit points; begins with k points spread evenly over them. An empty cell keeps its centroid."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, points)
        size = np.sqrt((sums * sums).sum(axis=1))
        live = size > 0
        centres[live] = sums[live] / size[live, None]
    return centres


def places(points: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(cell per unit point, points x cells: which are visited). ``reach`` is the largest distance of linked unit vectors."""
    near = points @ centres.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, ((centres[:, None] - centres[None]) ** 2).sum(axis=2))) if len(centres) * centres.size < 1 << 22 \
        else np.sqrt(np.maximum(0.0, 2 - 2 * centres @ centres.T))
    gap = near[np.arange(len(points)), home][:, None] - near
    visited = (gap <= reach * apart[home] + 1e-9) & (np.arange(len(centres)) < home[:, None])
    return home, visited


def fit_cells(points: np.ndarray, total: int, reach: float) -> np.ndarray:
    """Centroids for a label of ``total`` points from a sample of them."""
    k = max(1, min(-(-total // CELL), len(points) // PER_CELL))
    while k > 1:
        centres = k_means(points, k)
        if places(points, centres, reach)[1].sum() <= VISITS * len(points):
            return centres
        k //= 2
    return np.zeros((0, points.shape[1]))


def linked(a: np.ndarray, b: np.ndarray, a_raw: np.ndarray, b_raw: np.ndarray, least: float) -> np.ndarray:
    """Which pairs have a cosine of ``least`` or more."""
    cosines = a @ b.T
    out = cosines >= least
    for i, j in zip(*np.nonzero(np.abs(cosines - least) < CLOSE)):
        x, y = a_raw[i], b_raw[j]
        x, y = np.ldexp(x, -np.frexp(np.abs(x).max())[1]), np.ldexp(y, -np.frexp(np.abs(y).max())[1])
        out[i, j] = (x * y).sum() / (math.sqrt((x * x).sum()) * math.sqrt((y * y).sum())) >= least
    return out


def joined(met: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Group of each row and of each column of a matrix of links; ``same``: rows and columns are the same points."""
    rows, cols = met.shape
    group = np.arange(rows + (0 if same else cols))
    shift = 0 if same else rows
    for i in np.flatnonzero(met.any(axis=1)):
        for g in np.unique(group[np.flatnonzero(met[i]) + shift]):
            if g != group[i]:
                low, high = min(g, group[i]), max(g, group[i])
                group[group == high] = low
    return group[:rows], group[shift:]


def near_vectors(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept): one row per row of ``vectors``.

    Rows of one label are linked if their cosine in double precision is ``least`` (above 0) or more. ``n_links`` counts the other
    rows linked directly, repeated rows each for itself; ``component_id`` is the smallest id reachable, and the row with that id is kept. A
    row without label, or whose vector is null, empty, zero or holds a null or non-finite entry, is linked with nothing (its component is
    its own id), and vectors of different dimensions are not linked. A row without id can be a member but never names a component
    that has other ids. Other columns are ignored; an empty table gives an empty one.
    """
    spark, reach = vectors.sparkSession, math.sqrt(2 - 2 * least) * (1 + 1e-9)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0)
    rows = pick(vectors, id=id_col, vec=vec_col, label=label_col).withColumn("vec", F.col("vec").cast("array<double>"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False))).withColumns({"hi": F.xxhash64("vec"), "lo": F.xxhash64(F.lit(1), "vec")})
    points = keep_table(
        rows.where("good").groupBy("label", F.size("vec").alias("dim"), "hi", "lo").agg(F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()), "points")

    large = keep_table(points.groupBy("label", "dim").agg(F.count("*").alias("total")).where(F.col("total") > CELL), "labels")
    held = large.agg(F.sum("total")).first()[0] or 0
    share = min(1.0, SAMPLE / held) if held else 0.0
    kinds = {c: points.schema[c].dataType.simpleString() for c in ("label",)}

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sample = units(np.stack(pdf.sort_values(["lo", "hi"])["vec"]))
        centres = fit_cells(sample, int(pdf["total"].iloc[0]), reach)
        return pd.DataFrame({"label": pd.Series([key[0]] * len(centres), dtype=pdf["label"].dtype), "dim": np.full(len(centres), sample.shape[1], np.int32),
                             "cell": np.arange(len(centres)), "centre": pd.Series(list(centres), dtype=object)})

    # SAMPLE / PER_CELL centroids at most, whatever the table's size
    sample = points.where(F.pmod("lo", F.lit(1 << 20)) < int(share * (1 << 20))).join(large, ["label", "dim"])
    fitted = sample.groupBy("label", "dim").applyInPandas(fit, f"label {kinds['label']}, dim int, cell long, centre array<double>").toPandas() if held else None
    centres = {} if fitted is None else {key: np.stack(g.sort_values("cell")["centre"]) for key, g in fitted.groupby(["label", "dim"])}
    shared = spark.sparkContext.broadcast(centres)

    def placed(batches):
        for pdf in batches:
            node, label, dim, vec, n, cell, visit = [], [], [], [], [], [], []
            for (lab, size), part in pdf.groupby(["label", "dim"], sort=False):
                raw, at = part["vec"].to_numpy(), shared.value.get((lab, size))
                if at is None:
                    home, more = np.zeros(len(part), np.int64), (np.empty(0, np.int64), np.empty(0, np.int64))
                else:
                    home, visited = places(units(np.stack(raw)), at, reach)
                    more = np.nonzero(visited)
                pick_rows = np.concatenate([np.arange(len(part)), more[0]])
                node.append(part["node"].to_numpy()[pick_rows])
                n.append(part["n"].to_numpy()[pick_rows])
                vec += list(raw[pick_rows])
                label += [lab] * len(pick_rows)
                dim += [size] * len(pick_rows)
                cell.append(np.concatenate([home, more[1]]))
                visit.append(np.repeat([False, True], [len(part), len(more[0])]))
            if node:
                yield pd.DataFrame({"label": label, "dim": dim, "cell": np.concatenate(cell), "visit": np.concatenate(visit), "node": np.concatenate(node),
                                    "n": np.concatenate(n), "vec": vec})

    members = keep_table(points.select("label", "dim", "node", "n", "vec").mapInPandas(
        placed, f"label {kinds['label']}, dim int, cell long, visit boolean, node long, n long, vec array<double>"), "members")
    size = F.greatest(F.lit(64), F.least(F.lit(BLOCK), (F.lit(BLOCK_BYTES) / 8 / F.greatest("dim", F.lit(1))).cast("int")))
    counts = members.groupBy("label", "dim", "cell").agg(
        F.ceil(F.count_if(~F.col("visit")) / size).alias("homes"), F.ceil(F.count_if("visit") / size).alias("visits"))
    # blocks of a cell are numbered home first; a home block meets the home blocks from its own on, and every block of visitors
    block = F.when(F.col("visit"), F.col("homes") + F.pmod(F.xxhash64("node"), F.greatest("visits", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), F.greatest("homes", F.lit(1))))
    own = members.join(counts, ["label", "dim", "cell"]).where("homes > 0").withColumn("own", block)
    others = F.when(F.col("visit"), F.sequence(F.lit(0).cast("long"), F.col("homes") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("homes") + F.col("visits") - 1))
    meeting = own.withColumn("other", F.explode(others)).select(
        "label", "dim", "cell", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).alias("right"), "node", "n", "vec")

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["a"].iloc[0] == pdf["b"].iloc[0]
        left = pdf if same else pdf[~pdf["right"]]
        right = left if same else pdf[pdf["right"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        a_raw = np.stack(left["vec"])
        b_raw = a_raw if same else np.stack(right["vec"])
        a = units(a_raw)
        met = linked(a, a if same else units(b_raw), a_raw, b_raw, least)
        if same:
            np.fill_diagonal(met, False)
        here, there = joined(met, same)
        nodes = np.concatenate([left["node"], [] if same else right["node"]]).astype(np.int64)
        links = np.concatenate([met @ right["n"].to_numpy(), [] if same else left["n"].to_numpy() @ met]).astype(np.int64)
        roots = nodes[here if same else np.concatenate([here, there])]
        live = links > 0
        return pd.DataFrame({"node": nodes[live], "links": links[live], "root": roots[live]})

    found = keep_table(meeting.groupBy("label", "dim", "cell", "a", "b").applyInPandas(products, "node long, links long, root long"), "links")
    forest = star_forest(found.select(F.col("node").alias("src"), F.col("root").alias("dst"))).withColumnsRenamed({"src": "node", "dst": "group"})
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = points.select("label", "hi", "lo", "node", "n", "least").join(links, "node", "left").join(forest, "node", "left") \
        .withColumn("group", F.coalesce("group", "node"))
    names = grouped.groupBy("group").agg(F.min("least").alias("name"))
    result = grouped.join(names, "group").select("label", "hi", "lo", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "name")
    out = rows.select("id", F.when(F.col("good"), F.col("label")).alias("label"), "hi", "lo").join(result, ["label", "hi", "lo"], "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("name", "id").alias("component_id")) \
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
