"""Near-duplicate embeddings by a forest of random-projection trees.

Every tree has one random unit direction per depth.  A vector goes to the side of
the node's threshold on which its projection lies, and to both sides within a spill
margin around it.  Thresholds are medians of a bounded sample of vectors in the upper
nodes, and the sample's overall medians below, so the forest has a fixed size; every
vector is placed in every tree.  Vectors are compared within the leaves, by exact
cosine in double precision; trees are many enough that a pair near the bound
shares a leaf in some tree (see the README for the measured recall).

Equal vectors of a label form one class and are compared once.  A leaf with more
vectors than a block is cut into blocks, and pairs of blocks are compared in tasks
of their own, so no task holds a whole leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables

COSINE = 0.98
TREES = 4
LEAF = 256  # vectors of one label that a leaf should hold
BLOCK = 512  # vectors of a leaf that are compared in one piece
SAMPLE = 20_000  # vectors that the thresholds are fitted on
SPILL = 1.0  # margin, in standard deviations of a linked pair's projected difference
NODE_SAMPLE = 64  # a node with fewer sampled vectors takes the overall median


def grow(sample: np.ndarray, depth: int, trees: int, spill: float, seed: int = 11) -> list[dict]:
    """Trees of random directions; per depth a direction, the node thresholds and a default."""
    rng = np.random.default_rng(seed)
    forest = []
    for _ in range(trees):
        directions, nodes, defaults = [], [], []
        rows, code = np.arange(len(sample)), np.zeros(len(sample), np.int64)
        for level in range(depth):
            direction = rng.normal(size=sample.shape[1])
            direction /= np.linalg.norm(direction)
            along = sample[rows] @ direction
            default = float(np.median(along)) if len(along) else 0.0
            cut: dict[int, float] = {}
            order = np.argsort(code, kind="stable")
            names, first = np.unique(code[order], return_index=True)
            for name, members in zip(names.tolist(), np.split(order, first[1:])):
                if len(members) >= NODE_SAMPLE:
                    cut[name] = float(np.median(along[members]))
            directions.append(direction)
            nodes.append(cut)
            defaults.append(default)
            rows, code = place(sample, rows, code, direction, cut, default, 0.0)
        forest.append({"directions": directions, "nodes": nodes, "defaults": defaults, "spill": spill})
    return forest


def place(vectors: np.ndarray, rows: np.ndarray, code: np.ndarray, direction: np.ndarray, cut: dict[int, float], default: float, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """One level down: (row, node) pairs, some on both sides."""
    along = (vectors @ direction)[rows] - np.array([cut.get(c, default) for c in code.tolist()])
    low, high = along < spill, along >= -spill
    return np.concatenate([rows[low], rows[high]]), np.concatenate([2 * code[low], 2 * code[high] + 1])


def usable(vector: str, label: str):
    """Label and vector are there, every component is finite, and not all are zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(col: pa.Array, width: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = flat.reshape(-1, width)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _leaf_rows(classes: DataFrame, forests: dict[int, list[dict]]) -> DataFrame:
    """(tree, width, label, leaf, class_id, vector): a class in all of its leaves."""
    shared = classes.sparkSession.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "width", "label", "leaf", "class_id", "vector"]
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                part = batch.filter(pa.array(widths == width))
                unit = _unit(part.column("vector"), width)
                for t, tree in enumerate(shared.value[width]):
                    rows, code = np.arange(len(unit)), np.zeros(len(unit), np.int64)
                    for direction, cut, default in zip(tree["directions"], tree["nodes"], tree["defaults"]):
                        rows, code = place(unit, rows, code, direction, cut, default, tree["spill"])
                    for at in range(0, len(rows), 4096):
                        some = part.take(pa.array(rows[at : at + 4096]))
                        k = some.num_rows
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, t, np.int32)), some.column("width"), some.column("label"), pa.array(code[at : at + 4096]), some.column("class_id"), some.column("vector")], names)

    return classes.select("width", "label", "class_id", "vector").mapInArrow(run, "tree int, width int, label string, leaf long, class_id long, vector array<double>")


def _compare(cosine: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        width = key[1].as_py()
        vectors = _unit(pa.concat_arrays(table.column("vector").chunks), width)
        ids, side = table.column("class_id").to_numpy(), table.column("side").to_numpy()
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)  # side 0: a block with itself
        a, b = [], []
        for at in range(0, len(left), 256):
            near = vectors[left[at : at + 256]] @ vectors[right].T >= cosine
            x, y = np.nonzero(near)
            x, y = ids[left[at + x]], ids[right[y]]
            keep = x < y if (side == 0).all() else x != y
            a.append(np.minimum(x, y)[keep])
            b.append(np.maximum(x, y)[keep])
        return pa.table({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)})

    return run


def near_pairs(classes: DataFrame, cosine: float, trees: int, leaf: int) -> DataFrame:
    """Pairs (a, b), a < b, of class ids with equal labels and a cosine of at least ``cosine``."""
    sizes = {r["width"]: r["n"] for r in classes.groupBy("width", "label").agg(F.count("*").alias("n")).groupBy("width").agg(F.max("n").alias("n")).collect()}
    forests = {}
    for width, most in sorted(sizes.items()):
        of = classes.where(F.col("width") == width).select("vector", F.xxhash64("class_id").alias("h")).orderBy("h").limit(SAMPLE)
        got = of.select("vector").toArrow().column("vector")
        sample = _unit(pa.concat_arrays(got.chunks), width) if got.num_chunks else np.zeros((0, width))
        depth = max(0, min(60, ceil(log2(most / leaf)))) if most > leaf else 0
        spill = SPILL * sqrt(2 * (1 - cosine) / width)
        forests[width] = grow(sample, depth, trees if depth else 1, spill)
    if not forests:
        return classes.sparkSession.createDataFrame([], "a long, b long")
    leaves = tables.written(_leaf_rows(classes, forests), "leaves")
    key = ["tree", "width", "label", "leaf"]
    counts = leaves.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = leaves.join(counts, key).withColumn("mine", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    # block i meets block j in the cell (i, j), i <= j
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = placed.select(*key, "class_id", "vector", "mine", others).select(
        *key,
        "class_id",
        "vector",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    return cells.groupBy(*key, "i", "j").applyInArrow(_compare(cosine), "a long, b long").distinct()


def link(rows: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows with an equal label and a cosine of at least ``cosine``
    that were found; ``component_id`` is the smallest vec_id reachable by links, itself
    included; ``kept`` tells whether that is the row's own.  Rows whose label or vector is null, whose
    vector holds a null or non-finite component or only zeros, or whose vec_id is null link with
    nothing.  Vectors of different lengths do not link.  Columns other than vec_id,
    embedding and label are ignored.
    """
    vector = F.col("embedding").cast("array<double>")
    marked = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), vector.alias("vector"))
    marked = marked.withColumn("ok", usable("vector", "label") & F.col("vec_id").isNotNull())
    k1, k2 = F.xxhash64("label", "vector"), F.xxhash64(F.lit(1), "label", "vector")
    keyed = marked.select("vec_id", F.when(F.col("ok"), k1).alias("k1"), F.when(F.col("ok"), k2).alias("k2"))
    classes = tables.written(
        marked.where("ok")
        .withColumns({"k1": k1, "k2": k2})
        .groupBy("k1", "k2", "label", "vector")
        .agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
        .withColumn("width", F.size("vector")),
        "classes",
    )
    links = tables.written(near_pairs(classes, cosine, trees, leaf), "links")
    sizes = classes.groupBy("class_id").agg(F.sum("copies").alias("copies"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(sizes.withColumnRenamed("class_id", "b"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    roots = tables.components(links)
    described = (
        classes.select("k1", "k2", "class_id", "copies")
        .join(degree.withColumnRenamed("a", "class_id"), "class_id", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("k1", "k2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    )
    out = keyed.join(described, ["k1", "k2"], "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
