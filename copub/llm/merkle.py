"""A Merkle manifest of a dataset, as a persistent tree that copies paths.

Every row is a leaf, a digest of its fields.  The leaves of a group (a source), in the order of
their ids, are reduced run by run to the group's subroot, and the subroots in the order of
their groups to the root: a run of ``FAN`` consecutive nodes becomes the digest of their digests.

Trees are never changed.  A tampered leaf makes a new version: only the leaf's ancestors are
copied, each with one child exchanged, and all other nodes are shared with the first version.
The root of a version is what the tampered leaf folds to.

At scale, the nodes of one level are cut into aligned blocks of ``FAN ** TIER`` nodes.  A block is a
whole subtree of ``TIER`` levels, so its nodes and the copies that its versions need are made where the block
lies, and only its top goes on: the tops of all blocks are the next tier's nodes, ``FAN ** TIER`` times
fewer.  On the way back each block takes one path (siblings of its top, level by level
up to the root), in which the versions of all its leaves go on.  So a group, or the
root above all versions, is never gathered in one task: a task streams block by block.
Positions within a group come from a range partitioning and counts of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import tables

FAN = 16
TIER = 3
BLOCK = FAN**TIER
ROWS = 10_000  # rows of an Arrow batch given out
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """The digest of the fields' texts, each with its length in bytes before it, or ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lower_cased(text: Column) -> Column:
    """A-Z lower-cased: how the check tampers with a text."""
    return F.translate(text.cast("string"), _UPPER, _LOWER)


def levels(n: int) -> int:
    """Levels above n nodes."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def runs(nodes: list[str], up: int) -> list[list[str]]:
    """The levels of a block: its nodes, then ``up`` levels of digests of runs."""
    out = [nodes]
    for _ in range(up):
        below = out[-1]
        out.append([digest(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return out


def path(tree: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    """For the node ``at`` of a block, level by level: its place in its run, and its siblings."""
    steps = []
    for level in tree[:-1]:
        run, place = at // FAN * FAN, at % FAN
        steps.append((place, level[run : run + place] + level[run + place + 1 : run + FAN]))
        at //= FAN
    return steps


def copies(node: str, steps: list[tuple[int, list[str]]]) -> list[str]:
    """The ancestors that a version with ``node`` in this place copies, the root last."""
    made = []
    for place, others in steps:
        node = digest([*others[:place], node, *others[place:]])
        made.append(node)
    return made


PATH = "array<struct<place:int,others:array<string>>>"
NODE = "grp string, name string, pos long, size long, hash string"


def _given(steps: list[tuple[int, list[str]]]) -> list[dict]:
    return [{"place": place, "others": others} for place, others in steps]


def _taken(steps: list[dict]) -> list[tuple[int, list[str]]]:
    return [(s["place"], s["others"]) for s in steps]


# -- positions ----------------------------------------------------------------


def placed(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, counted from 0 within ``group`` in the order given, and ``size``, the group's rows.

    Rows that are equal in all of ``order`` are told apart by a number of the row, so that they too
    are dealt to several tasks.
    """
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    sorted_ = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    at = sorted_.columns.index(group)
    schema = T.StructType([*sorted_.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("inside", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            inside = []
            for value in batch.column(at).to_pylist():
                count = count + 1 if last == (value,) else 0
                last = (value,)
                inside.append(count)
            parts = pa.array([part] * len(inside), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(inside, pa.int64())], schema.names)

    dealt = tables.written(sorted_.mapInArrow(run, schema), name)
    counts = dealt.groupBy(group, "part").agg(F.count("*").alias("_n"))  # parts of a group: as many as tasks
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("part")) - F.col("_n")
    offsets = counts.select(F.col(group).alias("_group"), F.col("part").alias("_part"), before.alias("_before"), F.sum("_n").over(Window.partitionBy(group)).alias("size"))
    same = dealt[group].eqNullSafe(F.col("_group")) & (dealt["part"] == F.col("_part"))
    return dealt.join(offsets, same).select(*rows.columns, (F.col("_before") + F.col("inside")).alias("pos"), "size")


# -- blocks -------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other, of rows sorted by group and block."""
    rows, last = [], None
    for row in chain.from_iterable(batch.to_pylist() for batch in batches):
        key = (row["grp"], row["block"])
        if rows and key != last:
            yield rows
            rows = []
        last = key
        rows.append(row)
    if rows:
        yield rows


def _each_block(rows: DataFrame, work: Callable[[list[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``work`` on every block of the rows (grp, pos, ...), in the order of ``pos``.

    A block's path, where it has one, comes as a row with pos -1 and ``block`` given.
    """
    kind = T.DataType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for block in _blocks(batches):
            out.extend(work(block))
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos").mapInArrow(run, kind)


def _in_blocks(nodes: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """The nodes with the number of their block, and each block's path before them."""
    dealt = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
    if above is None:
        return dealt
    paths = above.select("grp", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path")
    return dealt.unionByName(paths, allowMissingColumns=True)


def _tops(block: list[dict]) -> Iterator[dict]:
    """The top of a block, as a node of the next tier."""
    first = block[0]
    top = runs([row["hash"] for row in block], min(TIER, levels(first["size"])))[-1][0]
    yield {"grp": first["grp"], "pos": first["block"], "size": -(-first["size"] // BLOCK), "hash": top}


def _paths(block: list[dict]) -> Iterator[dict]:
    """The path of every node of a block up to the root."""
    above, nodes = block[0]["path"], block[1:]
    tree = runs([row["hash"] for row in nodes], min(TIER, levels(nodes[0]["size"])))
    for at, row in enumerate(nodes):
        yield {"grp": row["grp"], "name": row["name"], "pos": row["pos"], "path": _given(path(tree, at)) + above}


def _versions(block: list[dict]) -> Iterator[dict]:
    """The answer for every leaf of a block; each leaf's version copies its path only."""
    above, nodes = _taken(block[0]["path"]), block[1:]
    size = nodes[0]["size"]
    tree = runs([row["hash"] for row in nodes], min(TIER, levels(size)))
    tops = [tree[-1][0], *copies(tree[-1][0], above)]  # the block's top and its ancestors, unchanged
    subroot, root = tops[levels(size) - len(tree) + 1], tops[-1]
    for at, row in enumerate(nodes):
        steps = path(tree, at) + above
        tampered = row["changed"] is not None
        first = row["changed"] if tampered else row["hash"]
        copied = copies(first, steps)
        folded = copied[-1] if copied else first
        yield {
            "doc_id": row["doc_id"], "leaf": row["hash"], "subroot": subroot, "root": root,
            "proof_sha256": digest([other for _, others in steps for other in others]),
            "folded_root": folded, "verified": folded == root, "copied": copied if tampered else None,
        }


# -- trees --------------------------------------------------------------------


def _climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of every tier (grp, name, pos, size, hash); in the last, each group has one."""
    tiers = [nodes]
    while True:
        tops = tables.written(_each_block(_in_blocks(tiers[-1]), _tops, NODE), name)
        tiers.append(tops)
        if (tops.agg(F.max("size")).first()[0] or 1) == 1:
            return tiers


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """(grp, name, pos, path) of the nodes of the first of ``tiers``; ``above`` has the path of the block tops over the last."""
    for nodes in reversed(tiers):
        above = _each_block(_in_blocks(nodes, above), _paths, f"grp string, name string, pos long, path {PATH}")
    return above


def audit(docs: DataFrame, tampered: Column, text: Column, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id") -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copied.

    The manifest is built from ``docs`` as it is.  Where ``tampered`` holds, the column ``text`` is
    exchanged for the expression given, and the row's leaf makes a version of the tree; ``copied``
    lists the digests of the nodes that this version alone has, from the leaf's parent to its root (null:
    not tampered).  ``folded_root`` is the root that the tampered, else the original, leaf and
    the original siblings lead to; ``verified`` says whether it is the manifest's root.
    ``proof_sha256`` is the digest of all siblings on the way.

    A null field is a leaf's ``-``; rows without group form a group of their own, which comes
    first, as rows without id do in their group; a row whose ``tampered`` is null is not tampered.
    Empty and very long texts are fields like others.  Repeated rows are leaves each; rows of one id stand in the order of
    their digests.  An empty table has no leaves and gives no rows.  Other columns are ignored.
    """
    columns = {name: F.col(f"`{name}`") for name in fields}
    changed = leaf(list((columns | {"text": text}).values()))
    own = leaf(list(columns.values()))
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{order}`").cast("long").alias("doc_id"),
        own.alias("hash"), F.when(tampered, changed).alias("changed"),
    )
    # written, so that the range partitioning's sample reads digests instead of texts
    unordered = tables.written(leaves, "merkle-leaves")
    leaves = placed(unordered, "grp", ["doc_id", "hash"], "merkle-places")
    tables.drop(unordered)  # placed and written anew
    tiers = _climb(leaves.select("grp", F.lit(None).cast("string").alias("name"), "pos", "size", "hash"), "merkle-tops")
    roots = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "hash")
    roots = placed(roots, "grp", ["name"], "merkle-subroots").select("grp", "name", "pos", "size", "hash")
    upper = _climb(roots, "merkle-upper")
    start = upper[-1].select("grp", "pos", F.array().cast(PATH).alias("path"))
    subroots = _descend(upper[:-1], start)
    above = _descend(tiers[1:-1], subroots.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), "path"))
    out = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>"
    return _each_block(_in_blocks(leaves, above), _versions, out)
