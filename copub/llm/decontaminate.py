"""Benchmark decontamination with DataFrame functions only.

The test items' word windows form a hash set that is broadcast where its counted
size allows it (and joined by shuffle where not).  A document need not look up every
window: any ``width`` consecutive words contain a whole block of ``(width + 1) // 2``
words that begins at a multiple of the block length, so only these blocks are looked
up, each carrying the few words around it.  Around a block that some test window
holds, the whole windows are compared word for word.  Results are per distinct
text, so a text's copies cost one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables

WIDTH = 10
BROADCAST_ROWS = 2_000_000  # windows (about 100 bytes each) up to which the set is broadcast
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of lower-cased text: ASCII letters, digits and non-ASCII characters."""
    parts = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _MARKS)
    return F.filter(parts, lambda w: w != "")


def _joined(array: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(array, start, length), " ")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def test_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(length, gram, item_id): every item's windows; an item of fewer words is one window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    length = F.least(F.size("w"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    grams = F.transform(starts, lambda i: F.array_join(F.slice("w", i, length), " "))
    return items.select("item_id", length.alias("length"), F.explode(grams).alias("gram")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, start, length, gram): where a test window occurs in a text; ``key`` is the text's digest."""
    grams = tables.written(test_windows(benchmark, width).groupBy("length", "gram").agg(F.count("*").alias("items")), "windows")
    sizes = {r["length"]: r["count"] for r in grams.groupBy("length").count().collect()}  # at most `width` rows
    texts = docs.select(F.md5(F.col("text").cast("string").cast("binary")).alias("key"), words(F.col("text")).alias("w"))
    found = None
    for length, n in sorted(sizes.items()):
        one = _hits_of_length(texts, grams.where(F.col("length") == length).select("gram"), length, n)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], "key string, start int, length int, gram string")
    return found.distinct()


def _hits_of_length(texts: DataFrame, grams: DataFrame, length: int, n: int) -> DataFrame:
    """As ``hits``, for the ``n`` windows (gram) of one length; texts has key and words w."""
    block = (length + 1) // 2
    reach = length - block  # words before or behind a block that a window around it may take
    parts = F.split("gram", " ")
    inner = F.transform(F.sequence(F.lit(1), F.lit(reach + 1)), lambda i: F.xxhash64(_joined(parts, i, block)))
    blocks = grams.select(F.explode(inner).alias("block")).distinct()
    whole = F.floor(F.size("w") / block).cast("int")

    def around(i: Column) -> Column:
        begin = i * block + 1
        low = F.greatest(begin - reach, F.lit(1))
        near = F.slice("w", low, begin + block + reach - low)
        return F.struct(F.xxhash64(_joined(F.col("w"), begin, block)).alias("block"), low.alias("low"), near.alias("near"))

    places = F.when(whole > 0, F.transform(F.sequence(F.lit(0), whole - 1), around))
    near = texts.select("key", F.explode(places).alias("p")).select("key", "p.*").join(_small(blocks, n * (reach + 1)), "block", "left_semi")
    starts = F.when(F.size("near") >= length, F.sequence(F.lit(1), F.size("near") - length + 1))
    shown = near.select("key", "low", "near", F.explode(starts).alias("i"))
    shown = shown.select("key", (F.col("low") + F.col("i") - 1).alias("start"), _joined(F.col("near"), F.col("i"), length).alias("gram"))
    return shown.join(_small(grams, n), "gram").select("key", "start", F.lit(length).alias("length"), "gram")


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items (item_ids as sorted strings), contaminated.

    A word is hit where any occurrence of a test window covers it.  Null and wordless texts
    have no words; null or wordless items have no windows; a null item_id is not listed.
    Repeated rows each give a row.  Columns other than doc_id, text and item_id are ignored.
    """
    # read twice below: once per hit word, once per item
    found = tables.written(hits(docs, benchmark, width), "hits")
    covered = found.select("key", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    n_hit = covered.groupBy("key").agg(F.count("*").alias("n_hit"))
    items = found.select("key", "length", "gram").distinct().join(test_windows(benchmark, width), ["length", "gram"])
    listed = items.groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    per_text = n_hit.join(listed, "key", "left")
    rows = docs.select("doc_id", F.md5(F.col("text").cast("string").cast("binary")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    out = rows.join(per_text, "key", "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"), "items": F.coalesce("items", none)})
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated documents or without hit words.

    With ``mode="spans"`` hit words go with the characters up to the next word, and the texts
    stay.  Rows whose text is null stay.
    """
    found = hits(docs, benchmark, width)
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.md5(F.col("text").cast("string").cast("binary")).alias("key"))
    if mode == "documents":
        # written, so that the join is between plain exchanges and a much copied text can be split
        gone = tables.written(found.select("key").distinct(), "contaminated")
        return keyed.join(gone, "key", "left_anti").select("row.*")
    if mode != "spans":
        raise ValueError("mode is documents or spans")
    at = found.select("key", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
    gone = at.groupBy("key").agg(F.collect_set("at").alias("gone"))
    joined = keyed.join(gone, "key", "left")
    text = F.col("row.text").cast("string")
    word, mark = r"[0-9A-Za-z\x{80}-\x{10FFFF}]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    lead = F.regexp_extract(text, f"^{mark}*", 0)
    parts = F.regexp_extract_all(text, F.lit(f"({word}+{mark}*)"), 1)
    stay = F.filter(parts, lambda x, i: ~F.array_contains("gone", i + 1))
    text = F.when(F.col("gone").isNull(), text).otherwise(F.concat(lead, F.array_join(stay, "")))
    return joined.withColumn("text", text).select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
