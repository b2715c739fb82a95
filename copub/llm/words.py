"""Words of Arrow text columns as numpy arrays.

A whole batch of texts is handled with a few array passes over its UTF-8
bytes: no Python loop over words, and no copy of the text.  A word's hash is the sum of
its eight-byte pieces, each sent through a 64-bit mixer together with its place and a key, mixed
once more with the length: no polynomial, so no pattern of letters makes words collide, and a
key drawn anew (``drawn_key``) leaves nothing to craft words against.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 20

# ASCII white space: 0x20 and 0x09-0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# ASCII other than letters and digits.
_MARKS = np.zeros(256, bool)
_MARKS[:128] = True
_MARKS[48:58] = _MARKS[65:91] = _MARKS[97:123] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, U)
_inverses = np.ones(1, U)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, U)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=U))
        _powers, _inverses = made
    return _powers, _inverses


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finisher; another salt gives an independent function."""
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def drawn_key() -> int:
    """A key for one run's hashes; it travels with the functions, so a repeated task hashes alike."""
    return secrets.randbits(63)


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """A hash of each span of bytes [start, end), none of them empty."""
    if not len(start):
        return np.zeros(0, U)
    size = end - start
    pieces = (size + 7) >> 3
    first = np.cumsum(pieces) - pieces
    of = np.repeat(np.arange(len(start)), pieces)
    at = 8 * (np.arange(len(of)) - first[of])
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from every byte on
    value = eight[start[of] + at] & _LOW_BYTES[np.minimum(size[of] - at, 8)]
    total = np.add.reduceat(mix(value + mix(at.astype(U) + U(key), 11), 12), first)
    return mix(total + mix(size.astype(U) ^ U(key), 13), 14)


@dataclass
class Words:
    """The words of n texts: byte spans, the text each lies in, and hashes."""

    n: int
    data: np.ndarray  # bytes, lower-cased where asked
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each text's first word; one entry more at the end


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a text column; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    offsets = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(col: pa.Array, lower: bool, marks: bool = False, key: int = 0) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; ``lower`` maps A-Z to a-z first.

    With ``marks`` words are cut at every ASCII character but letters and digits.  ``key`` is
    that of the hashes.
    """
    data, offsets = text_buffers(col)
    if lower:
        data = _LOWER[data]
    n, size = len(offsets) - 1, len(data)
    inside = np.zeros(size + 1, bool)
    inside[:size] = ~(_MARKS if marks else _SPACE)[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1]
    begins[edges] |= inside[edges]  # a text's first byte never continues the text before it
    ends = np.zeros(size + 1, bool)
    ends[1:] = inside[:-1] & ~inside[1:]
    last = offsets[1:]
    ends[last[last > 0]] |= inside[last[last > 0] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    value = word_hashes(data, start, end, key)
    first = np.searchsorted(start, offsets).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(first))
    return Words(n, data, start, end, doc, value, first)


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one chunk's texts hold about ``size`` bytes (or are one text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            to = max(at + 1, min(to, batch.num_rows))
            yield batch.slice(at, to - at)
            at = to


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``width`` words; a shorter text is one run."""
    h, n = words.hash, np.diff(words.first)
    total = len(h)
    value = np.zeros(max(0, total - width + 1), U)
    for j in range(width):
        value = value * U(_BASE) + h[j : total - width + 1 + j] if total >= width else value
    whole = words.doc[: len(value)] == words.doc[width - 1 :] if total >= width else np.zeros(0, bool)
    docs, values = words.doc[: len(value)][whole], mix(value[whole], 1)
    few = np.flatnonzero((n > 0) & (n < width))
    if len(few):
        short = np.zeros(len(few), U)
        for j in range(width - 1):
            has = n[few] > j
            short[has] = short[has] * U(_BASE) + h[words.first[few][has] + j]
        docs = np.concatenate([docs, few])
        values = np.concatenate([values, mix(short, 2) + n[few].astype(U)])
    return docs, values


def distinct(docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs in order of text, then value."""
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    keep = np.ones(len(docs), bool)
    keep[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    return docs[keep], values[keep]


def repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, member): the distinct rows of keys with two members or more.

    Only the last row is carried from batch to batch, however large a group is.
    """
    last_key = last_member = None
    pending = False  # the carried row is its group's first and not yet given out
    for batch in batches:
        if not batch.num_rows:
            continue
        key, member = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        carried = last_key is not None
        if carried:
            key, member = np.concatenate([[last_key], key]), np.concatenate([[last_member], member])
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
        key, member = key[new], member[new]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        if carried:
            first[0] = pending
        more = np.zeros(len(key), bool)
        more[:-1] = key[1:] == key[:-1]
        out = ~first | more
        if carried and not pending:
            out[0] = False  # given out before
        pending = bool(first[-1] and not more[-1])
        last_key, last_member = key[-1], member[-1]
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(member[out])], batch.schema.names)


def members_of_repeated(rows: DataFrame, key: str, member: str) -> DataFrame:
    """(key, member) of keys that two members have; one shuffle, streamed through each task."""
    kinds = dict(rows.dtypes)
    return rows.repartition(key).sortWithinPartitions(key, member).mapInArrow(repeated_keys, f"{key} {kinds[key]}, {member} {kinds[member]}")
