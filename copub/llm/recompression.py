"""Removal of passages that repeat anywhere, found by recompression.

Every text is compressed in rounds.  A round names runs of one symbol and then
pairs of a left symbol and a right symbol, the side being a hash bit of the symbol.
A name is a hash of what it stands for, so names are global without a
dictionary, and equal stretches get equal symbols but for a margin at either
end.  For each symbol the stretch of words that decides it is kept: where a
window holds that stretch whole, every copy of the window holds the symbol.

Steps, over buckets of documents of a bounded size:

1. each bucket gives its distinct last-round symbols; one shuffle by symbol
   finds those of two buckets (those that repeat in a bucket are known there);
2. a window that holds the stretch of an unrepeated symbol cannot repeat; the
   other windows, long repeats nearly all, are hashed, and one shuffle by hash
   verifies them;
3. each bucket covers its repeated windows and gives back its documents.

A symbol or window occurs at most once a bucket in the shuffles, so a passage
that very many documents share is not gathered in one task.  The documents are
shuffled once; later steps read the same exchange.  Windows without a deciding
stretch (long runs of a word) are always hashed.

Equal rows (doc_id and text) would share a bucket.  Where they are more than one holds,
one of them stands for all in the steps above, and the rows themselves are answered
where they are read: as copies of each other they lose every window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables
from .words import U, Words, _tables, chunks, drawn_key, members_of_repeated, mix, split_words

WINDOW = 35
ROUNDS = 5
RUN_ROUNDS = (0, 2)
BUCKET_BYTES = 4 << 20
ROW_BYTES = 64  # what a row's other columns count
BROADCAST_ROWS = 2_000_000  # keys of heavy copies up to which they are broadcast
_FAR = 1 << 60


def symbols(words: Words, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Last-round symbols, and for each the begin and end of the words that decide it."""
    sym, doc = words.hash.copy(), words.doc
    low = np.arange(len(sym), dtype=np.int64)
    high = low + 1
    for step in range(rounds):
        if step in RUN_ROUNDS:
            joins = np.zeros(len(sym), bool)  # same as the symbol before
            joins[1:] = (sym[1:] == sym[:-1]) & (doc[1:] == doc[:-1])
            at = np.flatnonzero(~joins)
            length = np.diff(np.append(at, len(sym)))
            last = at + length - 1
            before, after = _neighbours(doc, low, high)
            low, high = before[at], after[last]
            sym, doc = sym[at], doc[at]
            long = length > 1
            sym[long] = mix(sym[long] + mix(length[long].astype(U), 20), 21)
        right = (mix(sym, 22 + step) >> U(63)).astype(bool)
        pair = np.zeros(len(sym), bool)  # begins a pair
        pair[:-1] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
        taken = np.zeros(len(sym), bool)
        taken[1:] = pair[:-1]
        before, after = _neighbours(doc, low, high)
        new_low = np.where(right & ~taken, before, low)
        new_high = np.where(~right & ~pair, after, high)
        second = np.flatnonzero(taken)
        new_high[second - 1] = high[second]
        value = sym.copy()
        value[second - 1] = mix(mix(sym[second - 1], 40) + sym[second], 41)
        keep = ~taken
        sym, doc, low, high = value[keep], doc[keep], new_low[keep], new_high[keep]
    return sym, low, high


def _neighbours(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the deciding stretch of each symbol's neighbours begins and ends; a text's edge is far off."""
    before, after = np.full(len(doc), -_FAR), np.full(len(doc), _FAR)
    same = doc[1:] == doc[:-1]
    before[1:][same] = low[:-1][same]
    after[:-1][same] = high[1:][same]
    return before, after


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every window of ``width`` words of one text."""
    total = len(words.hash)
    if total < width:
        return np.zeros(0, np.int64), np.zeros(0, U)
    powers, inverses = _tables(total + 1)
    sums = np.zeros(total + 1, U)
    np.cumsum(mix(words.hash, 50) * powers[:total], out=sums[1:])
    start = np.flatnonzero(words.doc[: total - width + 1] == words.doc[width - 1 :])
    return start, mix((sums[start + width] - sums[start]) * inverses[start], 51)


def _often(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def _marked(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of 0..size-1 lie in a stretch [start, end)."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def _candidates(words: Words, width: int, known: np.ndarray) -> np.ndarray:
    """Start words of the windows that hold no deciding stretch of an unrepeated symbol."""
    sym, low, high = symbols(words)
    start, _ = windows(words, width)
    lone = (high - low <= width) & ~_often(sym) & ~np.isin(sym.view(np.int64), known)
    hit = _marked(np.maximum(high[lone] - width, 0), low[lone] + 1, len(words.hash))
    return start[~hit[start]]


def _table(table: pa.Table, column: str) -> pa.Array:
    col = table.column(column)
    return pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)


def _symbol_rows(width: int, key: int) -> Callable[[pa.Table], pa.Table]:
    def run(docs: pa.Table) -> pa.Table:
        words = split_words(_table(docs, "text"), lower=False, key=key)
        sym, low, high = symbols(words)
        sym = np.unique(sym[high - low <= width])
        return pa.table({"symbol": sym.view(np.int64), "bucket": np.full(len(sym), docs.column("bucket")[0].as_py(), np.int32)})

    return run


def _window_rows(width: int, key: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"window": np.zeros(0, np.int64), "bucket": np.zeros(0, np.int32)})
        words = split_words(_table(docs, "text"), lower=False, key=key)
        start, value = windows(words, width)
        at = np.searchsorted(start, _candidates(words, width, known.column("symbol").to_numpy()))
        out = np.unique(value[at])
        return pa.table({"window": out.view(np.int64), "bucket": np.full(len(out), docs.column("bucket")[0].as_py(), np.int32)})

    return run


def _without(words: Words, gone: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of each text what is left without the words in ``gone``, its words, and the words gone."""
    kept = np.flatnonzero(~gone)
    n = np.diff(words.first)
    removed = np.bincount(words.doc[gone], minlength=words.n)
    # Of the bytes stay those of kept words, and one separator after each but a text's last.
    data = words.data.copy()
    follows = np.zeros(len(kept), bool)
    follows[:-1] = words.doc[kept[1:]] == words.doc[kept[:-1]]
    stay = np.zeros(len(data) + 1, bool)
    stay[:-1] = _marked(words.start[kept], words.end[kept], len(data))
    spaces = words.end[kept[follows]]
    stay[spaces] = True
    data[spaces] = 0x20
    total = np.concatenate([[0], np.cumsum(stay[:-1])])
    lengths = np.zeros(words.n, np.int64)
    np.add.at(lengths, words.doc[kept], words.end[kept] - words.start[kept])
    np.add.at(lengths, words.doc[kept[follows]], 1)
    assert total[-1] == lengths.sum()
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError("the kept texts of one bucket exceed 2 GB")
    offsets = offsets.astype(np.int32)
    text = pa.StringArray.from_buffers(words.n, pa.py_buffer(offsets), pa.py_buffer(data[stay[:-1]].tobytes()))
    return text, n, removed


def _kept_rows(width: int, key: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        words = split_words(_table(docs, "text"), lower=False, key=key)
        start, value = windows(words, width)
        again = np.isin(value.view(np.int64), known.column("window").to_numpy()) | _often(value)
        text, n, removed = _without(words, _marked(start[again], start[again] + width, len(words.hash)))
        return pa.table({"rest": docs.column("rest"), "kept_text": text, "n_words": n, "n_removed": removed})

    return run


def _copies(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows that others equal: a text with a window loses every word, a shorter one none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=False)
            text, n, removed = _without(words, (np.diff(words.first) >= width)[words.doc])
            yield pa.RecordBatch.from_arrays([batch.column("rest"), text, pa.array(n), pa.array(removed)], ["rest", "kept_text", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with kept_text, n_words and n_removed.

    A word ``[^\\x20\\x09-\\x0D]+`` goes if a window of ``width`` consecutive words
    covers it whose word sequence also starts anywhere else, in the same text or
    in another; windows are judged on the input.  ``kept_text`` joins the kept
    words by one space.  Null and empty texts have no words and keep an empty
    text; texts shorter than a window lose nothing; copies lose every window.
    The other columns are carried in the struct ``rest``, whatever their names.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(size // BUCKET_BYTES + 1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("copy"),
        F.col("text").cast("string"),
        F.struct(*others).alias("rest"),
    )
    schema = T.StructType([T.StructField("rest", rows.schema["rest"].dataType)]).add("kept_text", "string").add("n_words", "long").add("n_removed", "long")
    heavy = tables.written(_heavy(rows), "heavy-copies")
    if heavy.isEmpty():
        return _compared(rows, buckets, width, schema)
    # One row stands for such copies among the others; of themselves every window repeats.
    heavy = _small(heavy)
    alone = rows.join(heavy, "copy", "left_anti").withColumn("stands", F.lit(False))
    one = rows.join(heavy, "copy", "left_semi").groupBy("copy").agg(F.first("text").alias("text"))
    one = one.select("copy", "text", F.lit(None).cast(rows.schema["rest"].dataType).alias("rest"), F.lit(True).alias("stands"))
    both = alone.unionByName(one).select("copy", "text", F.struct(F.col("rest").alias("row"), "stands").alias("rest"))
    whole = T.StructType([both.schema["rest"], *schema.fields[1:]])
    kept = _compared(both, buckets, width, whole).where("not rest.stands").select(F.col("rest.row").alias("rest"), *schema.names[1:])
    copies = rows.join(heavy, "copy", "left_semi").select("text", "rest").mapInArrow(_copies(width), schema)
    return kept.unionByName(copies)


def _heavy(rows: DataFrame) -> DataFrame:
    """(copy): the keys of equal rows that would fill a bucket on their own; few, as buckets are.

    A row counts as some bytes more than its text, for its other columns.
    """
    weight = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES)
    return rows.groupBy("copy").agg(F.count("*").alias("n"), weight.alias("bytes")).where((F.col("n") > 1) & (F.col("bytes") > BUCKET_BYTES)).select("copy")


def _small(heavy: DataFrame) -> DataFrame:
    """Broadcast as far as its count allows: else copies would meet in one task after all."""
    return F.broadcast(heavy) if heavy.count() <= BROADCAST_ROWS else heavy


def _compared(rows: DataFrame, buckets: int, width: int, schema: T.StructType) -> DataFrame:
    """The rows (copy, text, rest) without repeated passages, dealt to buckets by ``copy``."""
    key = drawn_key()
    rows = rows.select(F.pmod("copy", F.lit(buckets)).cast("int").alias("bucket"), "text", "rest")
    symbol_rows = rows.groupBy("bucket").applyInArrow(_symbol_rows(width, key), "symbol long, bucket int")
    known = members_of_repeated(symbol_rows, "symbol", "bucket")
    window_rows = rows.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_window_rows(width, key), "window long, bucket int")
    again = members_of_repeated(window_rows, "window", "bucket")
    return rows.groupBy("bucket").cogroup(again.groupBy("bucket")).applyInArrow(_kept_rows(width, key), schema)
