"""Topic id lists stored as keyed JSON objects.

One file holds one JSON object ``{"<key>": {"id": <paper id>, ...}, ...}``, often on one line,
and may be of any size.  It is read by many tasks: as text cut at ``}``, which Spark splits
anywhere.  Where a split begins, a brace may be inside a text or an inner object; that follows from
the quotes and braces of all splits before it, so

1. each split is summed up: whether its quotes change inside to outside, and by how much
   its braces change the depth, if it begins outside a text and if it begins inside;
2. running sums over a file's splits (few rows) give the state in which each begins;
3. each split gives its whole records; pieces of a record that spans splits are put together.

The records are parsed by Spark.  Cutting them out is the one place where this package runs Python on
rows: what is inside a text depends on all bytes before, which no expression sees.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copub.functions.columns import clean_id

_ESCAPED = re.compile(r"\\.", re.DOTALL)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """The pieces of each split of the task, in the order of the file; columns after ``value`` name the split."""
    rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))))
    for key, group in groupby(rows, key=lambda row: row[1:]):
        yield key, (row[0] for row in group)


def _plain(piece: str) -> str:
    """The piece with escaped characters blotted out, as long as before; they only occur in texts."""
    return _ESCAPED.sub("__", piece) if "\\" in piece else piece


def _summary(pieces: Iterator[str]) -> tuple[int, int, int]:
    """Whether the quotes of a split are odd, and the change of depth if it begins outside and inside a text."""
    inside, depth = 0, [0, 0]
    for piece in pieces:
        parts = _plain(piece).split('"')
        even, odd = "".join(parts[::2]).count("{"), "".join(parts[1::2]).count("{")
        depth[inside] += even  # `inside` is the state of the first case; the other case is its opposite
        depth[1 - inside] += odd
        inside ^= (len(parts) - 1) & 1
        depth[inside] -= 1  # the brace behind the piece, for the case that is outside now
    return inside, depth[0], depth[1]


def _records(pieces: Iterator[str], inside: bool, depth: int) -> Iterator[tuple[str, str]]:
    """The records of a split: ("whole", text), ("tail", text) of one begun before, ("head", text) of one not ended.

    ``depth`` is 1 in the file's object and 2 in a record.
    """
    kept: list[str] | None = [] if depth >= 2 else None  # pieces of the open record
    kind = "tail"
    for piece in pieces:
        at = begin = 0
        for part in _plain(piece).split('"'):
            if not inside:
                brace = part.find("{")
                while brace >= 0:
                    depth += 1
                    if depth == 2:
                        kept, kind, begin = [], "whole", at + brace
                    brace = part.find("{", brace + 1)
            at += len(part) + 1
            inside = not inside
        inside = not inside  # one quote less than parts
        if kept is not None:
            kept.append(piece[begin:] + "}")
        if not inside:
            depth -= 1
            if depth == 1 and kept is not None:
                yield kind, "".join(kept)
                kept = None
    if kept:
        yield ("tail" if kind == "tail" else "head"), "".join(kept)


def _states(pieces: DataFrame) -> DataFrame:
    """(file, block, inside, depth): the state in which each split begins; one row per split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(*key, *_summary(some)) for key, some in _splits(batches)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["file", "block", "odd", "outer", "inner"])

    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.mapInArrow(run, "file string, block long, odd long, outer long, inner long")
    turned = summed.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))
    return turned.withColumn("change", change).select("file", "block", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(record)``: the text of every record of every file under ``path``, each file read by as many tasks as it has splits."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "}").text(path)
    pieces = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for (file, block, inside, depth), some in _splits(batches):
            for kind, record in _records(some, inside, depth):
                found.append((file, block, kind, record))
                if len(found) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["file", "block", "kind", "record"])
                    found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["file", "block", "kind", "record"])

    # one row per split; broadcast, because the pieces must stay in their order
    begun = pieces.join(F.broadcast(_states(pieces)), ["file", "block"]).select("value", "file", "block", "inside", "depth")
    found = begun.mapInArrow(run, "file string, block long, kind string, record string")
    parts = found.where("kind <> 'whole'")  # at most two a split
    in_order = Window.partitionBy("file").orderBy("block", F.col("kind") == "head")
    numbered = parts.withColumn("number", F.sum(F.when(F.col("kind") == "head", 1).otherwise(0)).over(in_order))
    ordered = F.array_sort(F.collect_list(F.struct("block", F.col("kind").alias("kind"), "record")))
    # of one split the tail belongs to the record before, so a record has one part a split
    spanning = numbered.groupBy("file", "number").agg(ordered.alias("parts")).select(F.array_join(F.col("parts.record"), "").alias("record"))
    return found.where("kind = 'whole'").select("record").unionByName(spanning)


def read_topic_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(id)`` of every record of every file under ``path``; records without a readable id give no row."""
    ids = read_records(spark, path).select(F.from_json("record", "id string").alias("r"))
    return ids.select(clean_id("r.id").alias("id")).where(F.col("id").isNotNull())


def write_topic_ids(ids: DataFrame, path: str, rows_per_file: int = 100_000, mode: str = "errorifexists") -> None:
    """Write ``(id)`` rows as keyed JSON objects, about ``rows_per_file`` per file.

    An id is a key, so a repeated one is written once; NULL ids are no ids and are left out.
    """
    ids = ids.select(F.col("id").cast("bigint").alias("id")).where("id is not null").distinct()
    n = ids.count()
    files = max(1, math.ceil(n / max(1, rows_per_file)))
    entries = ids.select(
        F.pmod(F.xxhash64("id"), F.lit(files)).alias("file"),
        F.struct(F.col("id").cast("string").alias("key"), F.struct(F.col("id").alias("id")).alias("value")).alias("e"),
    )
    docs = entries.groupBy("file").agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value"))
    docs.write.mode(mode).partitionBy("file").text(path)
