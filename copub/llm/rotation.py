"""Fill-in-middle by rotating blocks of a text in place.

A text is cut in lines; two cuts, drawn from a digest of the document's id, part it into
prefix, middle and suffix.  The text's bytes lie in a bytearray, a sentinel is put before
each part, and the parts change places there by rotations: two neighbouring blocks are
exchanged by reversing each of them and then both together.

- ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle: middle and suffix change places;
- ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle: the suffix changes places with the rest;
- ``plain``: the text as it is, where it is empty or holds a sentinel itself.

A rotation that exchanges blocks of p and q bytes is undone by the one that exchanges blocks
of q and p bytes, so ``restore`` needs the output and its form only: it finds the sentinels,
turns the blocks back and takes the sentinels out.

Every text is transformed by itself, in the task that reads it: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks, text_buffers

SEED = 7
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def rotate(buffer: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchange the blocks [begin, cut) and [cut, end) in place, by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for low, high in ((begin, cut), (cut, end), (begin, end)):
        view[low:high] = view[low:high][::-1].copy()


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the id; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def forward(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The output for a text cut at the bytes ``first`` <= ``second``."""
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)  # where the blocks begin
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def backward(output: bytes, form: str) -> bytearray:
    """The text of an output.

    The sentinels are the first of their kind: the parts hold none, and none arises where parts meet.
    """
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    if form == "psm":
        begin = buffer.index(SUFFIX)
        cut = buffer.index(MIDDLE, begin)
    else:
        begin, cut = 0, buffer.index(PREFIX)
    rotate(buffer, begin, cut, len(buffer))
    middle = buffer.index(MIDDLE)
    suffix = buffer.index(SUFFIX, middle)
    del buffer[suffix : suffix + len(SUFFIX)], buffer[middle : middle + len(MIDDLE)], buffer[: len(PREFIX)]
    return buffer


def _code_points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all bytes but continuations."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transform(docs: DataFrame, seed: int = SEED, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """One row per row: doc_id, n (lines), form, prefix_chars, middle_chars, output.

    Of the texts that can be cut, about ``percent`` of 100 are, ``spm_percent`` of these in the
    form ``spm``.  Lines are ``[^\\n]*\\n|[^\\n]+``.  A null text counts as empty, and an empty
    one stays plain; ``prefix_chars`` and ``middle_chars`` are code points, null where plain.
    Rows with equal ids are cut by the same numbers, each in its own text; null ids count as an
    empty id.  An empty table gives no rows.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            data, offsets = text_buffers(batch.column("text"))
            breaks = np.flatnonzero(data == 10) + 1  # where a line ends
            rows = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output")}
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                low, high = int(offsets[i]), int(offsets[i + 1])
                text = data[low:high].tobytes()
                at, to = np.searchsorted(breaks, [low, high], side="right")
                n = int(to - at) + (high > low and text[-1:] != b"\n")
                h1, h2, h3, h4 = draws(doc_id, seed)
                form, prefix, middle, output = "plain", None, None, text
                if text and not (PREFIX in text or SUFFIX in text or MIDDLE in text) and h3 % 100 < percent:
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    ends = [0, *(int(x) - low for x in breaks[at:to])]
                    if len(ends) <= n:
                        ends.append(high - low)  # the last line has no line break
                    first, second = (ends[k] for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    output = forward(text, first, second, form)
                    prefix, middle = _code_points(data[low : low + first]), _code_points(data[low + first : low + second])
                for name, value in zip(rows, (n, form, prefix, middle, bytes(output))):
                    rows[name].append(value)
            arrays = [pa.array(rows["n"], pa.int64()), pa.array(rows["form"], pa.string()), *(pa.array(rows[c], pa.int64()) for c in ("prefix_chars", "middle_chars"))]
            output = pa.array(rows["output"], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays, output], ["doc_id", *rows])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, OUT)


def restore(rows: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``text``, rebuilt from output and form; a null text has become empty."""
    names = [name for name in rows.columns if name != "text"]
    schema = rows.select(*(F.col(f"`{c}`") for c in names)).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "output"):
            data, offsets = text_buffers(batch.column("output"))
            forms = batch.column("form").to_pylist()
            texts = [bytes(backward(data[offsets[i] : offsets[i + 1]].tobytes(), form)) for i, form in enumerate(forms)]
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary()).cast(pa.string())], [*names, "text"])

    return rows.mapInArrow(run, schema)
