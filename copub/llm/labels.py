"""Bounded, reproducible samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(key: str, folds: int):
    """crc32 of the key as text, modulo the number of folds; null keys have none."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int, limit: int, numbers: list[str] = ()) -> DataFrame:
    """(doc_id, text, label, quarter, and the columns ``numbers`` as double) of at most ``limit`` labelled rows outside the held-out fold.

    The rows with the lowest hashes of doc_id are taken.  A doc_id that is null, or whose
    labels are null or contradict each other, is left out; of the rows that share a doc_id the one
    with the smallest text is taken.  At most ``limit`` ids are broadcast.  ``quarter`` (0 to 3) is two further hash bits.  ``text`` is cast to string.
    """
    known = (
        labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min(column).alias("label"), F.max(column).alias("other"))
        .where("label = other")
        .select("doc_id", F.col("label").cast("int"), F.xxhash64("doc_id").alias("hash"))
    )
    chosen = known.orderBy("hash", "doc_id").limit(limit)
    quarter = F.shiftrightunsigned(F.xxhash64(F.lit(1), "doc_id"), 62).cast("int")
    more = [F.col(f"`{c}`") for c in numbers]
    given = [c.cast("double").alias(name) for c, name in zip(more, numbers)]
    rows = docs.select("doc_id", F.col("text").cast("string"), *given)
    labelled = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", F.struct("text", *more, "label", quarter.alias("quarter")).alias("row"))
    one = labelled.groupBy("doc_id").agg(F.min("row").alias("row"))
    return one.select("doc_id", "row.text", "row.label", "row.quarter", *(F.col(f"row.`{c}`") for c in numbers))
