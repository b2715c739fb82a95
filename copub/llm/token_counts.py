"""Token counts of a unigram tokenizer, by dynamic programming over a trie.

Each text is cut into pre-tokens.  A task inserts its distinct pre-tokens, block by block, in
one trie of bytes.  The best unigram score of a prefix (the largest sum of token log
probabilities over its segmentations) depends on nothing behind it, so every
trie node is computed once, however many pre-tokens pass through it, and a
pre-token's node stores its token count.  Texts then add up their pre-tokens.

The vocabulary file gives ranks, not probabilities; a token's probability is
taken from Zipf's law: proportional to 1 / (rank + 1).
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import chain
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks

TRIE_BYTES = 256 << 20
NODE_BYTES = 200  # about so many a node, or an entry of the index, takes
LONG = 1_000
NONE = float("-inf")


def read_scores(path: str) -> dict[bytes, float]:
    """Token bytes -> log probability, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    total = log(sum(1 / (r + 1) for r in ranks.values()))
    return {token: -log(rank + 1) - total for token, rank in ranks.items()}


def endings(scores: dict[bytes, float]) -> tuple[dict[int, int], list[float | None]]:
    """Tokens read backwards as a state table: (state << 8 | byte) -> state, and a state's score."""
    step: dict[int, int] = {}
    value: list[float | None] = [None]
    for token, score in scores.items():
        state = 0
        for byte in reversed(token):
            state = step.setdefault(state << 8 | byte, len(value))
            if state == len(value):
                value.append(None)
        value[state] = score
    return step, value


class Trie:
    """Pre-tokens in a trie of bytes; every node holds its prefix's best score and its token count.

    Nodes stay from one block of pre-tokens to the next, so a prefix is scored once while the trie
    lives; ``ends`` leads from a pre-token inserted before to its node.  Beyond about
    ``TRIE_BYTES`` the trie is emptied.  Pre-tokens of more than ``LONG`` bytes share few
    prefixes and are scored beside it, in pieces, with a bounded number of scores in memory.
    """

    def __init__(self, step: dict[int, int], value: list[float | None], longest: int) -> None:
        self.step, self.value, self.longest = step, value, longest
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # (node << 8 | byte) -> node
        self.best, self.tokens = [0.0], [0]
        self.ends: dict[str, int] = {}
        self.held = 0  # bytes of the pre-tokens in ``ends``

    def _grow(self, word: bytes, at: int, to: int, scores: list[float], counts: list[int]) -> None:
        """Append the best scores and token counts of word[: at + 1] to word[:to].

        The lists end with those of word[:at], and reach back as far as the longest token.
        """
        step, value = self.step.get, self.value
        for end in range(at + 1, to + 1):
            top, length, state = NONE, 0, 0
            for n in range(1, end + 1):
                state = step(state << 8 | word[end - n])
                if state is None:
                    break
                score = value[state]
                if score is not None and scores[-n] + score >= top:
                    top, length = scores[-n] + score, n
            if not length:
                raise ValueError("the vocabulary lacks a byte")
            scores.append(top)
            counts.append(counts[-length] + 1)

    def _insert(self, word: bytes) -> int:
        """The word's node."""
        child, best, tokens = self.child, self.best, self.tokens
        path = [0]
        for byte in word:
            node = child.get(path[-1] << 8 | byte)
            if node is None:
                break
            path.append(node)
        shared = len(path)
        if shared <= len(word):
            scores, counts = [best[n] for n in path], [tokens[n] for n in path]
            self._grow(word, shared - 1, len(word), scores, counts)
            node = path[-1]
            for byte in word[shared - 1 :]:
                child[node << 8 | byte] = node = len(child) + 1
            best += scores[shared:]
            tokens += counts[shared:]
            return node
        return path[-1]

    def _beside(self, word: bytes) -> int:
        scores, counts = [0.0], [0]
        for at in range(0, len(word), LONG):
            self._grow(word, at, min(at + LONG, len(word)), scores, counts)
            del scores[: -self.longest], counts[: -self.longest]
        return counts[-1]

    def count(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of the best segmentation of each word."""
        out = {}
        for word in words:
            node = self.ends.get(word)
            if node is None:
                code = word.encode()
                if len(code) > LONG:
                    out[word] = self._beside(code)
                    continue
                if NODE_BYTES * (len(self.best) + len(self.ends)) + self.held > TRIE_BYTES:
                    self.clear()
                node = self.ends[word] = self._insert(code)
                self.held += len(code)
            out[word] = self.tokens[node]
        return out


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every row, over its whole text.

    ``vocabulary`` is the path of a rank file (read on the driver) whose tokens include
    every single byte; ``pattern`` cuts a text into pre-tokens.  Of segmentations with
    equal scores the one whose last token is longest counts, likewise before it.  Null
    and empty texts have no tokens.  Repeated rows each give a row; columns other than
    doc_id and text are ignored.
    """
    scores = read_scores(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((*endings(scores), max(map(len, scores))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        import regex

        find = regex.compile(pattern).findall
        trie = Trie(*shared.value)
        gc.disable()  # the tables are large and hold no cycles
        try:
            for batch in chunks(batches, "text"):
                cut = [find(t) if t else [] for t in batch.column("text").to_pylist()]
                of = trie.count(set(chain.from_iterable(cut)))
                total = [sum(map(of.__getitem__, c)) for c in cut]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(c) for c in cut], pa.int64()), pa.array(total, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])
        finally:
            gc.enable()  # the worker may go on with other jobs

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_pretokens long, n_tokens long")
