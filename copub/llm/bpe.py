"""BPE encoding with forced boundaries, and decoding.

A byte pair that lies inside no vocabulary token can never end up in one token,
so every place where it occurs in a word is a certain cut.  Words are cut there
and the fragments are encoded independently of each other: the last one with the
vocabulary's word-end mark, the others without.  A word's ids are its
fragments' ids in order.

The vocabulary is read on the driver and travels to the tasks.  A task encodes
each distinct word and each distinct fragment once while they stay in its
caches, which hold a bounded number of bytes; results do not depend on them.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks

CACHE_BYTES = 96 << 20  # of each of the three caches
ENTRY_BYTES = 150  # of an entry, beside its text and ids
_BLANK = re.compile("[ \t\n\r\x0b\x0c]+")
_ODD = re.compile("[\x1c-\x1f]")


def inner_pairs(tokens: list[str], end_mark: str) -> np.ndarray:
    """[x, y] is true where the symbols (byte characters) x, y are neighbours inside a token."""
    found = np.zeros((512, 512), bool)
    for token in tokens:
        token = token[: -len(end_mark)] if end_mark and token.endswith(end_mark) else token
        for x, y in zip(token, token[1:]):
            found[ord(x), ord(y)] = True
    return found


def forced_cuts(code: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and word number of the fragments of words; a blank ends each word."""
    blank = code == 0x20
    starts = ~blank
    starts[1:] &= blank[:-1] | ~inside[code[:-1], code[1:]]
    begin = np.flatnonzero(starts)
    ends = ~blank
    ends[:-1] &= blank[1:] | starts[1:]
    return begin, np.flatnonzero(ends) + 1, np.cumsum(blank)[begin]


# The rules of the word-end vocabulary, as its file states them.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# Under these rules characters below U+0250 need no library call: letter, number, other; 0 is a blank.
_SIMPLE = 0x250
_KIND = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(i))[0], 3) for i in range(_SIMPLE)] + [4], np.uint8)
_KIND[0x20] = 0
_KIND[[0x27, 0x85, 0xA0]] = 4  # contractions and white space are left to the library


def byte_characters() -> np.ndarray:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = np.zeros(256, np.uint16)
    table[shown] = shown
    hidden = np.setdiff1d(np.arange(256), shown)
    table[hidden] = 0x100 + np.arange(len(hidden))
    return table


_BYTE = byte_characters()
_BYTE[0x20] = 0x20  # only between words


def _kinds(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the lower-cased pieces, a blank after each, and their kinds."""
    code = np.frombuffer("".join([p + " " for p in pieces]).lower().encode("utf-32-le"), np.uint32)
    return code, _KIND[np.minimum(code, _SIMPLE)]


def _simple(pieces: list[str]) -> tuple[list[str], list[str]]:
    """Pieces that need no library call to be cut into words, and the others."""
    code, kind = _kinds(pieces)
    odd = np.flatnonzero(np.bincount(np.cumsum(code == 0x20)[kind == 4], minlength=1)).tolist()
    if not odd:
        return pieces, []
    marked = set(odd)
    return [p for i, p in enumerate(pieces) if i not in marked], [pieces[i] for i in odd]


def _simple_words(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``Encoder._words``, for pieces that ``_simple`` has let through."""
    code, kind = _kinds(pieces)
    if not len(code):
        return np.zeros(0, np.uint16), np.zeros(0, np.int64)
    begins = kind > 0
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    of = np.cumsum(kind == 0)[begins]
    inner = begins.copy()
    inner[0] = False
    inner[1:] &= kind[:-1] > 0
    code = np.insert(code, np.flatnonzero(inner), 0x20)
    text = code.tobytes().decode("utf-32-le").encode()
    return _BYTE[np.frombuffer(text, np.uint8)], of


class Cache(dict[str, bytes]):
    """Texts already encoded -> their ids; ``trim`` empties it when it holds more than ``CACHE_BYTES``."""

    held = 0

    def learn(self, texts: list[str], ids: list[bytes]) -> None:
        self.held += ENTRY_BYTES * len(texts) + sum(map(len, texts)) + sum(map(len, ids))
        self.update(zip(texts, ids))

    def trim(self) -> None:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0


class Encoder:
    """Encodes and decodes texts with a vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.whole = Tokenizer.from_str(vocabulary)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.loads(vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a BPE vocabulary without byte fallback, prefix or ignored merges is needed")
        self.mark = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be matched as they are")
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

        def part(**mark: str) -> Tokenizer:
            made = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, **mark))
            made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            return made

        self.last = part(end_of_word_suffix=self.mark) if self.mark else part()
        self.inner = part()
        self.inside = inner_pairs(list(model["vocab"]), self.mark)
        self.plain = spec.get("decoder") is None
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*model["vocab"].items(), *self.special.items()]:
            self.tokens[i] = token
        self.simple = spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PRE_TOKENIZER
        # ids, as bytes, of pieces and of inner and last fragments already encoded
        self.ids = Cache()
        self.known = (Cache(), Cache())

    def _encode_fragments(self, fragments: list[str], last: bool) -> None:
        known = self.known[last]
        new = list(set(fragments).difference(known))
        if not new:
            return
        made = (self.last if last else self.inner).encode(" ".join(new), add_special_tokens=False)
        ids = np.array(made.ids, "<u4").tobytes()
        ends = (4 * np.searchsorted(np.array(made.word_ids), np.arange(len(new)), side="right")).tolist()
        known.learn(new, [ids[x:y] for x, y in zip([0, *ends], ends)])

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' words, as byte characters with a blank after each, and each word's piece."""
        normal = self.whole.normalizer.normalize_str(" ".join(pieces)) if self.whole.normalizer else " ".join(pieces)
        parts = normal.split(" ")
        if len(parts) != len(pieces):  # white space that only the vocabulary's rules know
            if len(pieces) > 1:
                half = len(pieces) // 2
                (x, of_x), (y, of_y) = self._words(pieces[:half]), self._words(pieces[half:])
                return np.concatenate([x, y]), np.concatenate([of_x, of_y + half])
            edges = np.array([len(normal)])
        else:
            edges = np.cumsum([len(p) + 1 for p in parts])
        cut = self.whole.pre_tokenizer.pre_tokenize_str(normal)
        of = np.searchsorted(edges, np.array([span[0] for _, span in cut], np.int64), side="right")
        return np.frombuffer("".join([word + " " for word, _ in cut]).encode("utf-16-le"), np.uint16), of

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces of text (no blanks inside) that are not cached yet."""
        code, of = np.zeros(0, np.uint16), np.zeros(0, np.int64)
        hard = pieces
        if self.simple:
            easy, hard = _simple(pieces)
            code, of = _simple_words(easy)
            pieces = easy + hard
        if hard:
            more, of_more = self._words(hard)
            code, of = np.concatenate([code, more]), np.concatenate([of, of_more + len(pieces) - len(hard)])
        line = code.tobytes().decode("utf-16-le")
        begin, end, word = forced_cuts(code, self.inside)
        last = np.ones(len(word), bool)
        last[:-1] = word[1:] != word[:-1]
        fragments = [line[x:y] for x, y in zip(begin.tolist(), end.tolist())]
        flags = last.tolist()
        for kind in (False, True):
            self.known[kind].trim()
            self._encode_fragments([f for f, flag in zip(fragments, flags) if flag == kind], kind)
        inner, final = self.known
        ids = [final[f] if flag else inner[f] for f, flag in zip(fragments, flags)]
        upto = np.searchsorted(of[word], np.arange(len(pieces)), side="right").tolist()
        self.ids.learn(pieces, [ids[x] if y == x + 1 else b"".join(ids[x:y]) for x, y in zip([0, *upto], upto)])

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of every text."""
        self.ids.trim()
        cut_texts = [self._pieces(text) for text in texts]
        new = list(set(chain.from_iterable(cut_texts)).difference(self.ids))
        if new:
            self._learn(new)
        ids = [b"".join(map(self.ids.__getitem__, pieces)) for pieces in cut_texts]
        numbers = [np.frombuffer(x, "<u4").tolist() for x in ids]
        if self.plain:
            return ids, [" ".join(map(self.tokens.__getitem__, x)) for x in numbers]
        return ids, [self.whole.decode(x, skip_special_tokens=False) for x in numbers]

    def _pieces(self, text: str) -> list[str]:
        """The text cut at blanks and around special tokens."""
        spans = self.split_special.split(text) if self.split_special else [text]
        if len(spans) == 1:
            return _split(text)
        pieces: list[str] = []
        for span, token in zip(spans[::2], [*spans[1::2], None]):
            pieces += _split(span)
            if token is not None:
                pieces.append(token)
                self.ids[token] = np.array([self.special[token]], "<u4").tobytes()
        return pieces


def _split(text: str) -> list[str]:
    """Split at blanks; str.split also takes 0x1C-0x1F, which are none here."""
    return [p for p in _BLANK.split(text) if p] if _ODD.search(text) else text.split()


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded text of every row.

    ``vocabulary`` is the path of a tokenizer file, read on the driver.  The ids are
    those of the tokenizers library without added special tokens; strings of special
    tokens inside a text become these tokens, as there.  Null counts as the empty text;
    its ids and decoded text are empty.  Repeated rows each give a row; columns other
    than doc_id and text are ignored.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        encoder = Encoder(shared.value)
        gc.disable()  # the caches are large and hold no cycles
        try:
            for batch in chunks(batches, "text"):
                ids, decoded = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])
        finally:
            gc.enable()  # the worker may go on with other jobs

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary, decoded string")
