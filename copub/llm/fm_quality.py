"""Quality classifier: a factorisation machine.

Features of a text are its hashed words (damped counts, scaled to unit length),
statistics of its structure, and numeric metadata columns where given.  A score
is the logistic of

    b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

so all pairwise interactions cost one pass over the features.  The machine is
fitted with mini-batch Adam on a bounded sample of labelled rows; its table has a
fixed number of rows, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import labelled_sample
from .words import U, Words, chunks, split_words, text_buffers

WORD_BUCKETS = 1 << 15
FACTORS = 8
MAX_LABELLED = 6_000
STATISTICS = 16


@dataclass
class Machine:
    bias: float
    weight: np.ndarray  # one per feature
    factor: np.ndarray  # features x FACTORS
    mean: np.ndarray  # of the dense features
    spread: np.ndarray


def structure(words: Words, offsets: np.ndarray) -> np.ndarray:
    """Statistics of each text's structure, one row per text; zeros without words."""
    n = np.diff(words.first).astype(float)
    some = np.maximum(n, 1)
    data, size = words.data, np.maximum(np.diff(offsets), 1).astype(float)
    bounds = np.minimum(offsets[:-1], max(len(data) - 1, 0))

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    length = words.end - words.start
    per_word = lambda x: np.bincount(words.doc, x, words.n) / some
    repeat = np.zeros(len(words.hash))
    repeat[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    again = np.zeros(len(words.hash))
    again[2:] = (words.hash[2:] == words.hash[:-2]) & (words.doc[2:] == words.doc[:-2])
    order = np.lexsort((words.hash, words.doc))
    fresh = np.ones(len(order))
    fresh[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    lone = length == 1
    columns = [
        np.log1p(n),
        np.log1p(np.diff(offsets)),
        per_word(length),
        np.sqrt(per_word(length**2.0)),
        per_word(repeat),
        per_word(again),
        np.bincount(words.doc[order], fresh, words.n) / some,
        per_word(lone & np.isin(data[words.start], np.frombuffer(b"|-*#=_~+<>", np.uint8))),
        share((data >= 65) & (data <= 90)),
        share((data >= 48) & (data <= 57)),
        share(np.isin(data, np.frombuffer(b".,;:!?", np.uint8))),
        share(np.isin(data, np.frombuffer(b"|#$%&*@^~<>{}[]\\=+_", np.uint8))),
        share(data == 10),
        share(data >= 128),
        (n == 0).astype(float),
        (np.diff(offsets) > 0) & ((data[bounds] >= 65) & (data[bounds] <= 90)) if len(data) else np.zeros(words.n),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value): damped counts of hashed words, unit length per text."""
    bucket = (words.hash % U(WORD_BUCKETS)).astype(np.int64)
    key, count = np.unique(words.doc * WORD_BUCKETS + bucket, return_counts=True)
    doc, bucket = key // WORD_BUCKETS, key % WORD_BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, value**2, words.n))
    return doc, bucket, value / norm[doc]


def features(batch: pa.RecordBatch, metadata: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse word features and dense features of a batch's texts; a null number counts as 0."""
    col = batch.column("text")
    words = split_words(col, lower=True)
    dense = structure(words, text_buffers(col)[1])
    given = [np.sign(x) * np.log1p(np.abs(x)) for m in metadata for x in [np.nan_to_num(batch.column(m).fill_null(0).to_numpy(zero_copy_only=False).astype(float), posinf=0, neginf=0)]]
    return *word_features(words), np.column_stack([dense, *given]) if given else dense


def raw_scores(m: Machine, doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """The machine's output, by the sum-of-squares identity."""
    n = len(dense)
    d = np.clip((dense - m.mean) / m.spread, -4, 4)
    out = m.bias + np.bincount(doc, m.weight[bucket] * value, n) + d @ m.weight[WORD_BUCKETS:]
    for f in range(m.factor.shape[1]):
        v = m.factor[bucket, f] * value
        vd = d * m.factor[WORD_BUCKETS:, f]
        out += 0.5 * ((np.bincount(doc, v, n) + vd.sum(1)) ** 2 - np.bincount(doc, v * v, n) - (vd * vd).sum(1))
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], factors: int = FACTORS, epochs: int = 5, seed: int = 7, metadata: int = 0) -> Machine:
    """Fit on (buckets, values, dense features, label) rows; without rows every score is one half."""
    extra = len(rows[0][2]) if rows else STATISTICS + metadata
    rng = np.random.default_rng(seed)
    size = WORD_BUCKETS + extra
    dense = np.array([r[2] for r in rows]).reshape(len(rows), extra)
    mean = dense.mean(0) if rows else np.zeros(extra)
    spread = np.maximum(dense.std(0), 1e-6) if rows else np.ones(extra)
    label = np.array([r[3] for r in rows], float)
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, factors)), mean, spread)
    if not rows:
        m.factor[:] = 0
        return m
    m.bias = float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    d = np.clip((dense - mean) / spread, -4, 4)
    # moments of Adam, and the step sizes: words learn in the rows where they occur
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (m.weight, m.factor)]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            step += 1
            length = [len(rows[i][0]) for i in batch]
            doc = np.repeat(np.arange(len(batch)), length)
            bucket = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            x, y = d[batch], label[batch]
            v, vd = m.factor[bucket] * value[:, None], m.factor[WORD_BUCKETS:]
            sums = np.stack([np.bincount(doc, c, len(batch)) for c in v.T], axis=1) + x @ vd
            out = m.bias + np.bincount(doc, m.weight[bucket] * value, len(batch)) + x @ m.weight[WORD_BUCKETS:]
            squares = np.bincount(doc, (v * v).sum(1), len(batch)) + (x * x) @ (vd * vd).sum(1)
            out += 0.5 * ((sums**2).sum(1) - squares)
            error = (logistic(out) - y) / len(batch)
            m.bias -= 0.05 * error.sum()
            touched, at = np.unique(bucket, return_inverse=True)
            g_w = np.bincount(at, error[doc] * value, len(touched))
            pull = (error[doc] * value)[:, None] * (sums[doc] - v)
            g_v = np.stack([np.bincount(at, c, len(touched)) for c in pull.T], axis=1)
            here = np.concatenate([touched, np.arange(WORD_BUCKETS, size)])
            g_w = np.concatenate([g_w, x.T @ error]) + 1e-5 * m.weight[here]
            g_v = np.concatenate([g_v, (x * error[:, None]).T @ sums - ((x * x).T @ error)[:, None] * vd]) + 1e-4 * m.factor[here]
            for p, g, (first, second), rate in ((m.weight, g_w, moments[0], 0.02), (m.factor, g_v, moments[1], 0.005)):
                first[here] = 0.9 * first[here] + 0.1 * g
                second[here] = 0.999 * second[here] + 0.001 * g * g
                p[here] -= rate * (first[here] / (1 - 0.9**step)) / (np.sqrt(second[here] / (1 - 0.999**step)) + 1e-8)
    return m


def _columns(docs: DataFrame, metadata: list[str]) -> list:
    return [F.col("text").cast("string"), *(F.col(f"`{c}`").cast("double").alias(c) for c in metadata)]


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", folds: int = 4, held_out: int = 2, metadata: tuple[str, ...] = (), limit: int = MAX_LABELLED) -> Machine:
    """Fit on at most ``limit`` labelled documents outside the held-out fold."""
    names = list(metadata)
    sample = labelled_sample(docs, labels, column, folds, held_out, limit, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            doc, bucket, value, dense = features(batch, names)
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(bucket.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(value.astype(np.float32))),
                    pa.array(list(dense)),
                    batch.column("label"),
                ],
                ["doc_id", "buckets", "values", "dense", "label"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    got = sample.mapInArrow(run, f"doc_id {kind}, buckets array<int>, values array<float>, dense array<double>, label int").toArrow().sort_by("doc_id")
    rows = [
        (b.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(float), np.array(x.as_py()), label.as_py())
        for b, v, x, label in zip(got["buckets"], got["values"], got["dense"], got["label"])
    ]
    return fit_machine(rows, metadata=len(names))


def score(docs: DataFrame, machine: Machine, metadata: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row, over its whole text.

    Null and empty texts are scored by their structure like any other text; null metadata
    counts as 0.  Repeated rows each give a row; other columns are ignored.
    """
    names = list(metadata)
    shared = docs.sparkSession.sparkContext.broadcast(vars(machine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Machine(**shared.value)
        for batch in chunks(batches, "text"):
            out = logistic(raw_scores(made, *features(batch, names)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return docs.select("doc_id", *_columns(docs, names)).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
