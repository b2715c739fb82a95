"""N-gram Jaccard self-join with PartEnum signatures.

Each text becomes the set of its distinct word shingles; two texts link when
``100 * |A & B| >= percent * |A | B|``.  Sets are put into size bands, a band's
largest size being the smallest over the threshold, so linked sets lie in
one band or in two neighbouring ones; every set takes part in its own band
and in the next one.  In a band, linked sets differ in at most ``k`` shingles,
with ``k`` from their sizes.  The shingle domain is hashed into ``n`` partitions
(``n > k``), so linked sets agree on at least ``n - k`` partitions.  A set
enumerates ``m``-subsets of its partitions' projections: in bands of small ``k``
pairs of partitions, elsewhere single ones.  Not all subsets are needed: with
one global order of projections (most shingles first, then hash), the ``k + m``
first projections of either set contain ``m`` that both share, because at most
``n - k - m`` are left out.  An empty projection counts like any other and comes
last in the order.  Equal signatures are only candidates; a pair links after
its whole sets were compared.

Work on skewed data: texts with equal sets form one class; a task forwards
a signature once per class; candidates of one signature are linked to one
centre first (a star, not all pairs), and only members that the verified links
leave in other components are compared further, a large group block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tables
from .words import U, chunks, distinct, drawn_key, members_of_repeated, mix, shingles, split_words

WIDTH = 5
PERCENT = 80
BLOCK = 1024  # members of a centre that one side of a join key holds, about


def bands(largest: int, percent: int) -> np.ndarray:
    """Upper ends of the size bands, from 1 to at least ``largest``."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))  # the next band of the largest
    return np.array(ends, np.int64)


def partitions(end: np.ndarray) -> np.ndarray:
    """Partitions of the shingle domain in the band that ends at ``end``."""
    return np.array([ceil(0.27 * r) + isqrt(int(r)) + 1 for r in end], np.int64)


def signatures(docs: np.ndarray, values: np.ndarray, n_docs: int, percent: int) -> tuple[np.ndarray, ...]:
    """Signatures of the distinct (text, shingle) pairs given, sorted by text.

    Returns (text, signature) pairs, and per text and step (own band, next
    band) the number of its signatures that may be left out.  A signature's
    lowest bit is the parity of its band.
    """
    sizes = np.bincount(docs, minlength=n_docs)
    spare = np.zeros((2, n_docs), np.int64)
    if not len(docs):
        return np.zeros(0, np.int64), np.zeros(0, U), spare
    ends = bands(int(sizes.max()), percent)
    counts = partitions(ends)
    own = np.searchsorted(ends, sizes)  # band of each text; empty texts are in the first and emit nothing
    out_docs, out = [], []
    hashed, mixed = mix(values, 3), mix(values, 4)
    for step in (0, 1):
        band = own + step
        n = np.where(sizes > 0, counts[band], 0)
        partner = np.minimum(ends[band], sizes * 100 // percent)
        k = (sizes + partner) * (100 - percent) // (100 + percent)
        pairs = 2 * ends[band] * (100 - percent) // (100 + percent) <= 4
        base = np.concatenate([[0], np.cumsum(n)])
        slot = base[docs] + (hashed % n[docs].astype(U)).astype(np.int64)
        total = int(base[-1])
        filled = np.bincount(slot, minlength=total)
        content = np.zeros(total, U)
        np.add.at(content, slot, mixed)
        of = np.repeat(np.arange(n_docs), n)
        number = np.arange(total) - base[of]
        name = mix(content + mix(number.astype(U) * U(0x10001) + band[of].astype(U) * U(0x100000001B3), 5), 6)
        parity = (band & 1).astype(U)
        occupied = np.bincount(of[filled > 0], minlength=n_docs)
        enough = (occupied >= k + 1) & ~pairs
        single = (filled > 0) & (enough & (k > 0))[of]
        out_docs.append(of[single])
        out.append(name[single])
        spare[step] = np.where(enough & (k > 0), occupied - k - 1, 0)
        rest = np.flatnonzero((~enough & (k > 0))[of])
        order = rest[np.lexsort((name[rest], -filled[rest], of[rest]))]
        begin = np.concatenate([[0], np.cumsum(np.bincount(of[rest], minlength=n_docs))])
        rank = np.arange(len(order)) - begin[of[order]]
        keep = rank < (k + np.where(pairs, 2, 1))[of[order]]
        lone = keep & ~pairs[of[order]]
        out_docs.append(of[order][lone])
        out.append(name[order][lone])
        chosen, names = of[order][keep & pairs[of[order]]], name[order][keep & pairs[of[order]]]
        for gap in range(1, 6):  # k <= 4 here, so at most six projections are paired
            both = np.flatnonzero(chosen[gap:] == chosen[:-gap]) if len(chosen) > gap else np.zeros(0, np.int64)
            out_docs.append(chosen[both])
            out.append(mix(names[both] + names[both + gap], 7))
        for i in range(-7, 0):  # this step's seven pieces
            out[i] = out[i] & ~U(1) | parity[out_docs[i]]
    return np.concatenate(out_docs), np.concatenate(out), spare


def set_keys(docs: np.ndarray, values: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text's set (order plays no part)."""
    keys = []
    for salt in (8, 9):
        key = np.zeros(n_docs, U)
        np.add.at(key, docs, mix(values, salt))
        keys.append(mix(key, salt).view(np.int64))
    return keys[0], keys[1]


SKETCH = 8  # longs: parities of the set's shingles in 512 buckets


def sketches(docs: np.ndarray, values: np.ndarray, n_docs: int) -> np.ndarray:
    """Bucket parities of each set; two sets' sketches differ in at most |A ^ B| bits."""
    bucket = (mix(values, 10) % U(64 * SKETCH)).astype(np.int64)
    odd = (np.bincount(docs * 64 * SKETCH + bucket, minlength=n_docs * 64 * SKETCH) & 1).astype(bool)
    return np.packbits(odd.reshape(-1, 64), axis=1, bitorder="little").view(np.int64).reshape(n_docs, SKETCH)


PARITY = [f"p{i}" for i in range(SKETCH)]
PROFILE = "doc_id long, row_key long, n long, set_id long, set_check long, spare0 long, spare1 long, odd_band int, " + ", ".join(f"{p} long" for p in PARITY)


def _row_key():
    """Tells rows apart, copies of a text too, so that fetching one row of a class stays one row."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def profile(docs: DataFrame, key: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: size, hashes and sketch of its shingle set, signatures to spare.

    ``key`` is that of the word hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=True, key=key)
            of, values = distinct(*shingles(words, width))
            sizes = np.bincount(of, minlength=words.n)
            _, _, spare = signatures(of, values, words.n, percent)
            own = np.searchsorted(bands(max(1, int(sizes.max(initial=1))), percent), sizes)
            columns = [sizes, *set_keys(of, values, words.n), spare[0], spare[1], (own & 1).astype(np.int32)]
            arrays = [pa.array(x) for x in [*columns, *sketches(of, values, words.n).T.copy()]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), *arrays], ["doc_id", "row_key", "n", "set_id", "set_check", "spare0", "spare1", "odd_band", *PARITY])

    rows = docs.select(F.col("doc_id").cast("long"), _row_key(), F.col("text").cast("string"))
    return rows.mapInArrow(run, PROFILE)


def signature_rows(docs: DataFrame, key: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(sig, set_id) of every document's set; a task's equal sets emit them once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=True, key=key)
            of, values = distinct(*shingles(words, width))
            ids = set_keys(of, values, words.n)[0]
            if len(seen) > 1_000_000:  # memory bound; a repeated row is dropped after the shuffle
                seen.clear()
            fresh = np.zeros(words.n, bool)
            for i, set_id in enumerate(ids.tolist()):
                if set_id not in seen:
                    seen.add(set_id)
                    fresh[i] = True
            keep = fresh[of]
            sig_of, sig, _ = signatures(of[keep], values[keep], words.n, percent)
            for at in range(0, len(sig), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(sig[at : at + 200_000].view(np.int64)), pa.array(ids[sig_of[at : at + 200_000]])], ["sig", "set_id"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "sig long, set_id long")


def shingle_sets(docs: DataFrame, chosen: DataFrame, key: int, width: int = WIDTH) -> DataFrame:
    """(set_id, shingles) of the documents whose ``row_key`` is in ``chosen``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=True, key=key)
            of, values = distinct(*shingles(words, width))
            offsets = np.searchsorted(of, np.arange(words.n + 1)).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(of, values, words.n)[0]), sets], ["set_id", "shingles"])

    rows = docs.select(_row_key(), F.col("text").cast("string"))
    one = rows.join(chosen, "row_key", "left_semi").dropDuplicates(["row_key"])
    return one.select("text").mapInArrow(run, "set_id long, shingles array<long>")


def _near(percent: int):
    """A bound that every linked pair meets: sizes, and sketches that differ in few bits."""
    bits = sum((F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in PARITY), F.lit(0))
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    return (small * 100 >= large * percent) & (bits * (100 + percent) <= (small + large) * (100 - percent))


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, key: int, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets link, as a written table."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    chosen = classes.join(ends, "set_id", "left_semi").select("row_key")
    sets = tables.written(shingle_sets(docs, chosen, key, width), "sets")
    joined = (
        pairs.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb")), "b")
        .join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("sa")), "a")
        .withColumn("both", F.size(F.array_intersect("sa", "sb")).cast("long"))
    )
    union = F.size("sa").cast("long") + F.size("sb") - F.col("both")
    links = tables.written(joined.where(F.col("both") * 100 >= union * percent).select("a", "b"), "links")
    tables.drop(sets)
    return links


def _classes(docs: DataFrame, width: int, percent: int) -> tuple[int, DataFrame, DataFrame]:
    """The key of the hashes, the rows' profiles, and one row per distinct set that is not empty.

    A set is known by a 64-bit hash.  A second, independent hash tells whether two sets share
    the first one; then all is hashed anew with another key.
    """
    while True:
        key = drawn_key()
        profiles = tables.written(profile(docs, key, width, percent), "profiles")
        of_set = profiles.where("n > 0").groupBy("set_id").agg(
            F.min("doc_id").alias("low_id"), F.min("row_key").alias("row_key"), F.min("set_check").alias("set_check"), F.max("set_check").alias("other"),
            *(F.min(c).alias(c) for c in ("n", "spare0", "spare1", "odd_band", *PARITY)),
        )
        classes = tables.written(of_set, "classes")
        if classes.where("set_check <> other").isEmpty():
            return key, profiles, classes
        tables.drop(profiles)
        tables.drop(classes)


def _groups(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows' profiles, and (set_id, low_id, component) of every set that is not empty."""
    key, profiles, classes = _classes(docs, width, percent)
    shared = tables.written(members_of_repeated(signature_rows(docs, key, width, percent), "sig", "set_id"), "shared")
    # Of its signatures a set may leave out its `spare` commonest: see the module's docstring
    # (any global order of signatures will do; this one starts with the rarest).
    sized = shared.join(shared.groupBy("sig").agg(F.count("*").alias("size")), "sig")
    described = sized.join(classes.select("set_id", "spare0", "spare1", "odd_band"), "set_id")
    next_band = F.col("sig").bitwiseAND(F.lit(1)) != F.col("odd_band")
    ranked = described.withColumn("next_band", next_band).withColumn(
        "rank", F.row_number().over(_commonest_first())
    )
    kept = tables.written(
        ranked.where(F.col("rank") > F.when(F.col("next_band"), F.col("spare1")).otherwise(F.col("spare0"))).select("sig", "set_id"), "kept"
    )
    tables.drop(shared)
    sides = classes.select("set_id", "n", *PARITY)
    stars = kept.join(kept.groupBy("sig").agg(F.min("set_id").alias("a")), "sig").where("a <> set_id").select("a", F.col("set_id").alias("b")).distinct()
    stars = tables.written(_close(stars, sides, percent), "stars")
    links = verify(docs, classes, stars, key, width, percent)
    found = tables.components(links)
    first = tables.written(found, "first")
    tables.drop(found)

    # Members of a signature that are not in one component yet: all their pairs but the stars.
    # Near copies share many signatures, most of them with one centre, the smallest member; the
    # signatures of a centre are compared together, so that a pair seldom meets twice.  `shared`
    # has one bit set for each signature that a member has with the centre (numbers modulo 64).
    placed = kept.join(first.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    mixed = (
        placed.groupBy("sig")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("c"), F.min("set_id").alias("centre"))
        .where("lo <> hi and c > 2")
        .select("sig", "centre")
    )
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(sig), 64) as int))")
    around = placed.join(mixed, "sig").groupBy("centre", "set_id", "component").agg(F.bit_or(bit).alias("shared"))
    members = tables.written(around.join(sides, "set_id"), "members")
    tables.drop(kept)
    tables.drop(first)
    cells = _cells(members)
    x, y = cells.alias("x"), cells.alias("y")
    meet = F.expr("x.centre = y.centre and x.i = y.i and x.j = y.j and x.component <> y.component and x.shared & y.shared <> 0")
    once = F.expr("x.mine < y.mine or (x.i = x.j and x.set_id < y.set_id)")
    rest = (
        x.join(y, meet & once & _near(percent))
        .select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    rest = tables.written(rest, "rest")
    tables.drop(members)
    tables.drop(stars)
    more = verify(docs, classes, rest, key, width, percent)
    tables.drop(rest)
    nodes = tables.components(links.unionByName(more))
    tables.drop(links)
    tables.drop(more)

    placed = classes.select("set_id", "low_id").join(nodes.withColumnRenamed("node", "set_id"), "set_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "set_id"))
    return profiles, placed


def link(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links, the document
    itself included.  Null and wordless texts have empty sets and link with
    nothing.  Repeated rows each give a row.  A row whose doc_id is null takes
    part like any other, but names no component while another member has an
    id.  Columns other than doc_id and text are ignored.  Sets are told apart
    by two 64-bit hashes of the whole set, under a key drawn for the run.
    """
    profiles, placed = _groups(docs, width, percent)
    lowest = placed.groupBy("component").agg(F.min("low_id").alias("component_id"))
    answer = placed.join(lowest, "component").select("set_id", "component_id")
    out = profiles.join(answer, "set_id", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _commonest_first() -> Window:
    return Window.partitionBy("set_id", "next_band").orderBy(F.desc("size"), F.desc("sig"))


def _cells(members: DataFrame, block: int | None = None) -> DataFrame:
    """Members of a centre in the cells (i, j), i <= j, of its blocks of about ``block`` members.

    Block i meets block j in one cell and itself in (i, i), so every pair of a centre's members
    meets in exactly one cell, and no join key has more than two blocks, however large a
    centre's group is.
    """
    blocks = F.ceil(F.count("*") / F.lit(block or BLOCK)).cast("int").alias("blocks")
    # written, so that the join is between plain exchanges and a large group can be split
    large = tables.written(members.groupBy("centre").agg(blocks).where("blocks > 1"), "large")
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("set_id"), blocks).cast("int").alias("mine")
    others = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = members.join(large, "centre", "left").select(*members.columns, mine, others)
    return dealt.select(*members.columns, "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def _close(pairs: DataFrame, sides: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that meet the bound of linked pairs."""
    x, y = sides.alias("x"), sides.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.set_id")).join(y, (F.col("b") == F.col("y.set_id")) & _near(percent)).select("a", "b")


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows without near duplicates: of each component one row stays, all its columns.

    It is the row with the smallest doc_id, then the smallest hash of doc_id and text; a row
    whose doc_id is null stays only where no other member has an id.  Rows are judged by their
    own text, so texts that share a doc_id but no component all stay.  Of rows that are equal in
    doc_id and text any one stays.  Null and wordless texts link with nothing and all stay.
    """
    id_ = F.col("doc_id").cast("long")
    key = [id_.isNull().alias("no_id"), F.coalesce(id_, F.lit(0)).alias("id")]
    profiles, placed = _groups(docs, width, percent)
    first = F.min(F.struct(*key, "row_key")).alias("first")
    of_set = profiles.where("n > 0").groupBy("set_id").agg(first)
    chosen = of_set.join(placed.select("set_id", "component"), "set_id").groupBy("component").agg(F.min("first").alias("first"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # repeated rows go before the join, in the task that reads them
    rows = docs.where(worded).select(row, *key, _row_key()).dropDuplicates(["no_id", "id", "row_key"])
    kept = rows.join(chosen.select("first.*"), ["no_id", "id", "row_key"], "left_semi")
    return kept.select("row").unionByName(docs.where(~worded).select(row)).select("row.*")
