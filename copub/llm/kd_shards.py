"""Sharding by a k-d tree over metadata, with DataFrame functions only.

The tree starts from all rows and splits a node along its widest dimension (the
largest spread, each dimension scaled to its overall range), at the weighted
quantile that gives either side its part of the leaves: with an even number of
leaves the weighted median.  Weights are the rows' bytes.  Quantiles are found by
counting: a pass adds up the bytes of 4096 equal key ranges of every node, the
range that holds the quantile is refined by the next pass, until it weighs little
against a leaf or holds one row.  A key is a dimension value followed by a hash of the row, so rows
of equal value can be told apart.  Nodes and splits are small written tables, joined with the rows.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tables

VALUE_BITS = 20
TIE_BITS = 42
STEP_BITS = 12
TOLERANCE = 1 / 500  # of a leaf's bytes
SLOT_ROWS = 50_000  # about so many rows of a shard are numbered in one task


def _key(n_dims: int) -> Column:
    """A row's key in the dimension ``dim``."""
    return F.element_at(F.array(*(F.col(f"k{i}") for i in range(n_dims))), F.col("dim") + 1)


def _wanted(rows: DataFrame, ranges: list[int]) -> DataFrame:
    """(first, dim, prefix, rest) of every node: its widest dimension, and the bytes that its left leaves get."""
    spread = [(F.max(f"k{i}") - F.min(f"k{i}")) / F.lit(max(1, ranges[i])) for i in range(len(ranges))]
    widest = F.array_max(F.array(*(F.struct(s.alias("spread"), F.lit(-i).alias("dim")) for i, s in enumerate(spread))))
    nodes = rows.groupBy("first", "leaves").agg(F.sum("size").alias("bytes"), widest.alias("widest"))
    rest = F.col("bytes") * F.floor(F.col("leaves") / 2) / F.col("leaves")
    return nodes.select("first", (-F.col("widest.dim")).alias("dim"), F.lit(0).cast("long").alias("prefix"), rest.alias("rest"))


def _quantile_keys(rows: DataFrame, ranges: list[int], tolerance: float) -> list[DataFrame]:
    """Written tables (first, dim, ..., at), a node in one of them: ``at`` is the key to split it at."""
    shift = VALUE_BITS + TIE_BITS
    wanted = tables.written(_wanted(rows, ranges), "kd-wanted")
    state = wanted
    by_bin = Window.partitionBy("first").orderBy("bin")
    found = []
    while not state.isEmpty():
        width = min(STEP_BITS, shift)
        shift -= width
        bins = (
            rows.join(state, "first")
            .withColumn("bin", F.shiftright(_key(len(ranges)), shift))
            .where(F.shiftright("bin", width) == F.col("prefix"))
            .groupBy("first", "dim", "rest", "bin")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
            .withColumns({"upto": F.sum("bytes").over(by_bin), "next": F.lead("bin").over(by_bin)})
        )
        hit = (
            bins.where((F.col("upto") >= F.col("rest")) | F.col("next").isNull())
            .groupBy("first", "dim", "rest")
            .agg(F.min(F.struct("bin", "bytes", "n", "upto")).alias("hit"))
            .withColumn("rest", F.col("rest") - (F.col("hit.upto") - F.col("hit.bytes")))
        )
        light = (F.col("hit.bytes") <= tolerance) | (F.col("hit.n") == 1) | F.lit(not shift)
        behind = (F.col("rest") * 2 > F.col("hit.bytes")).cast("long")
        at = F.when(light, F.shiftleft(F.col("hit.bin") + behind, shift))
        found.append(tables.written(hit.select("first", "dim", F.col("hit.bin").alias("prefix"), "rest", at.alias("at")), "kd-splits"))
        state = found[-1].where("at is null").drop("at")
    tables.drop(wanted)
    return found


def kd_leaves(rows: DataFrame, ranges: list[int], leaves: int, tolerance: float) -> DataFrame:
    """``rows`` with ``shard``, the leaf number (0 to leaves-1), as a written table.

    Rows are a written table with a size, one key k0, k1, ... per dimension, and ``first``, 0 (read, not
    a literal, so that the first level's joins have a key too); ``ranges`` are the keys' overall spreads.  A node is known by its first leaf's number; its rows carry this and its number of
    leaves.  Each level splits all its nodes at once and writes the rows anew, so plans are as
    large for many leaves as for few, and the driver sees no node.  A node without rows
    keeps its leaves empty.
    """
    placed = rows.withColumn("leaves", F.lit(leaves))
    most, last = leaves, None
    while most > 1:
        parts = _quantile_keys(placed.where("leaves > 1"), ranges, tolerance)
        splits = reduce(DataFrame.unionByName, parts).where("at is not null").select("first", "dim", "at") if parts else None
        if splits is None:
            break  # no rows
        half = F.floor(F.col("leaves") / 2).cast("int")
        right = F.coalesce(_key(len(ranges)) >= F.col("at"), F.lit(False))
        left = F.col("at").isNotNull() & ~right
        moved = placed.join(splits, "first", "left").withColumns({
            "first": F.when(right, F.col("first") + half).otherwise(F.col("first")),
            "leaves": F.when(right, F.col("leaves") - half).when(left, half).otherwise(F.col("leaves")),
        })
        placed = tables.written(moved.drop("dim", "at"), "kd-level")
        for table in [*parts, *([last] if last else [])]:
            tables.drop(table)
        last = placed
        most = (most + 1) // 2
    return placed.withColumnRenamed("first", "shard").drop("leaves")


def shard(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, metadata: tuple[str, ...] = ("lang", "source", "n_chars")) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, shards being near equal in bytes.

    Give either the bytes a leaf should hold or the number of leaves.  ``size`` is the UTF-8
    bytes of the text (null: none) plus 16.  Dimensions: the ``metadata`` columns (numbers by
    log2 of their size, others by a hash, nulls lowest) and the size.  Rows that are equal
    in all of these, repeated rows too, are told apart by a hash with the row's number.  ``slot`` counts a
    shard's rows from 0 without gaps.  An empty table gives no rows.  Columns not named are ignored.
    """
    if (target_bytes is None) == (shards is None):
        raise ValueError("give target_bytes or shards")
    kinds = dict(docs.dtypes)
    text = F.col("text").cast("string")

    def scaled(name: str) -> Column:
        column = F.col(f"`{name}`")
        if kinds[name] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
            number = F.coalesce(F.nanvl(column.cast("double"), F.lit(0.0)), F.lit(0.0))
            return F.least(F.log2(F.abs(number) + 1) / 64, F.lit(1.0)) * (2**VALUE_BITS - 1)
        return F.coalesce(F.pmod(F.xxhash64(column.cast("string")), F.lit(2**VALUE_BITS - 1)) + 1, F.lit(0))

    size = F.coalesce(F.octet_length(text).cast("long"), F.lit(0)) + 16
    values = [*(scaled(m) for m in metadata), F.log2(size.cast("double")) / 64 * (2**VALUE_BITS - 1)]
    # written below, once, so that a row's number stays
    tie = F.pmod(F.xxhash64("doc_id", text, F.monotonically_increasing_id()), F.lit(2**TIE_BITS))
    rows = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), tie.alias("tie"), *(v.cast("long").alias(f"v{i}") for i, v in enumerate(values)))
    keys = [(F.shiftleft(f"v{i}", TIE_BITS) + F.col("tie")).alias(f"k{i}") for i in range(len(values))]
    rows = tables.written(rows.select("doc_id", "size", "text_crc32", "tie", F.lit(0).alias("first"), *keys), "kd-rows")
    spreads = [(F.max(f"k{i}") - F.min(f"k{i}")).alias(f"s{i}") for i in range(len(values))]
    whole = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *spreads).first()
    total = whole["bytes"] or 0
    leaves = shards or max(1, ceil(total / target_bytes))
    placed = kd_leaves(rows, [whole[f"s{i}"] or 0 for i in range(len(values))], leaves, total / leaves * TOLERANCE)
    if leaves > 1 and whole["n"]:
        tables.drop(rows)  # the last level's table has them all
    return number_slots(placed.select("doc_id", "size", "text_crc32", "tie", "shard"), ceil(whole["n"] / leaves / SLOT_ROWS))


def number_slots(placed: DataFrame, parts: int) -> DataFrame:
    """Adds ``slot``: a shard's rows counted from 0, in ``parts`` hash parts that are numbered apart."""
    placed = placed.withColumn("part", F.pmod("tie", F.lit(max(1, parts))))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    offsets = counts.select("shard", "part", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "tie")) - 1
    return (
        placed.withColumn("inside", inside)
        .join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.col("shard").cast("int"), (F.col("before") + F.col("inside")).alias("slot"))
    )
