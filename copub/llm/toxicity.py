"""Toxicity: maximum-scoring segments over token log-odds.

Token weights are log-odds of a word among toxic against other labelled texts,
under a Dirichlet prior that is proportional to the word's share of both; a weight
is pulled towards zero by its standard error, and every token pays a small drift,
so chance stretches score below zero.  A linear scan finds all maximal scoring
segments of a text.  Scores of the best chance segment follow an extreme-value law:
lambda solves E[exp(lambda s)] = 1 over the clean tokens, K is fitted to the clean
texts' best segments, and a segment of score S in a text of n tokens gets
``lambda S - ln(K n)``.  A text's best calibrated segment and the sum of its significant ones
give its score through a logistic curve.

All models are fitted on a bounded sample of labelled rows: token weights on three
quarters of it, calibration on the rest.  Words are hashed into a table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_quality import logistic
from .labels import labelled_sample
from .words import U, Words, chunks, split_words

BUCKETS = 1 << 20
MAX_LABELLED = 40_000
PRIOR = 500.0  # pseudo-tokens of the Dirichlet prior
DRIFT = 0.25
ERRORS = 2.5  # standard errors by which a log-odds is shrunk
SIGNIFICANT = 3.0  # calibrated score: about one chance segment in exp(3) texts


@dataclass
class Model:
    weight: np.ndarray  # score of a token, per bucket; negative but for toxic words
    rate: float  # lambda
    log_k: float
    curve: np.ndarray  # bias and the weights of the best and of the summed segments


def buckets(words: Words) -> np.ndarray:
    return (words.hash % U(BUCKETS)).astype(np.int64)


def segments(position: list[int], score: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last position, score) of one text, in linear time.

    Tokens not listed cost ``drift`` each, so segments begin and end at listed tokens
    with positive scores.
    """
    found: list[list[float]] = []  # first, last, sum before it, sum at its end
    total, before = 0.0, None
    for at, s in zip(position, score):
        if before is not None:
            total -= drift * (at - before - 1)
        before = at
        if s <= 0:
            total += s
            continue
        new = [at, at, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
        found.append(new)
    return [(int(a), int(b), right - left) for a, b, left, right in found]


def token_weights(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Shrunken log-odds with a Dirichlet prior, less the drift, from counts per bucket."""
    both = toxic + clean
    prior = PRIOR * both / max(both.sum(), 1) + 0.5 * (both > 0) + 1e-6
    total = prior.sum()
    x, y = toxic + prior, clean + prior
    odds = np.log(x / (toxic.sum() + total - x)) - np.log(y / (clean.sum() + total - y))
    error = np.sqrt(1 / x + 1 / y)
    return np.sign(odds) * np.maximum(np.abs(odds) - ERRORS * error, 0) - DRIFT


def extreme_rate(weight: np.ndarray, clean: np.ndarray) -> float:
    """lambda > 0 with E[exp(lambda s)] = 1 under the clean tokens."""
    p = clean / max(clean.sum(), 1)
    used = p > 0
    p, s = p[used], weight[used]
    low, high = 1e-6, 1.0
    mean = lambda x: float((p * np.exp(np.minimum(x * s, 500))).sum())
    while high < 64 and mean(high) < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return (low + high) / 2


def found_segments(words: Words, weight: np.ndarray) -> list[list[tuple[int, int, float]]]:
    """Maximal scoring segments of each text; positions are words of the text."""
    score = weight[buckets(words)]
    special = np.flatnonzero(score != -DRIFT)
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(words.n)]
    at = np.searchsorted(special, words.first)
    positive = np.concatenate([[0], np.cumsum(score[special] > 0)])
    for doc in np.flatnonzero(positive[at[1:]] > positive[at[:-1]]).tolist():
        here = special[at[doc] : at[doc + 1]]
        out[doc] = segments((here - words.first[doc]).tolist(), score[here].tolist(), DRIFT)
    return out


def calibrated(found: list[list[tuple[int, int, float]]], n: np.ndarray, rate: float, log_k: float) -> tuple[np.ndarray, np.ndarray]:
    """Per text its best calibrated segment (-8 without any) and the sum of the significant ones."""
    best, total = np.full(len(found), -8.0), np.zeros(len(found))
    for i, spans in enumerate(found):
        if spans:
            level = rate * np.array([s for _, _, s in spans]) - log_k - np.log(max(n[i], 1))
            best[i] = max(-8.0, level.max())
            total[i] = level[level >= SIGNIFICANT].sum()
    return best, total


def curve_features(best: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(best)), np.clip(best, -8, 30) / 4, np.log1p(total)])


def fit_curve(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, slightly ridged."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - label) + 1e-2 * w)
        w = w - step
    return w


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", folds: int = 5, held_out: int = 0, limit: int = MAX_LABELLED) -> Model:
    """Fit on at most ``limit`` labelled documents outside the held-out fold.

    Without labelled rows of both kinds every text scores below one half.
    """
    # copies of a text count once, else the words of a much copied text look telling; the quarter
    # comes from the text, so it does not depend on which copy stays
    quarter = F.shiftrightunsigned(F.xxhash64(F.lit(1), "text"), 62).cast("int")
    sample = labelled_sample(docs, labels, column, folds, held_out, limit).select("text", "label").distinct().withColumn("quarter", quarter)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, BUCKETS), np.int64)
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=True, marks=True)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            key = np.unique(words.doc * BUCKETS + buckets(words))  # a word counts once a text
            for y in (0, 1):
                np.add.at(table[y], (key % BUCKETS)[label[key // BUCKETS] == y], 1)
        used = np.flatnonzero(table.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[0, used]), pa.array(table[1, used])], ["bucket", "clean", "toxic"])

    counted = sample.where("quarter > 0").select("text", "label").mapInArrow(count, "bucket long, clean long, toxic long")
    got = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    clean[got["bucket"].to_numpy()], toxic[got["bucket"].to_numpy()] = got["clean"].to_numpy(), got["toxic"].to_numpy()
    model = Model(token_weights(toxic, clean), 1.0, 0.0, np.array([-4.0, 0.0, 0.0]))
    model.rate = extreme_rate(model.weight, clean)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=True, marks=True)
            n = np.diff(words.first)
            spans = found_segments(words, m.weight)
            scores = pa.array([[s for _, _, s in x] for x in spans], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([scores, pa.array(n), batch.column("label")], ["scores", "n", "label"])

    rows = sample.where("quarter = 0").select("text", "label").mapInArrow(measure, "scores array<double>, n long, label int").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["n"], r["scores"], r["label"]))
    label = np.array([r["label"] for r in rows], float)
    if 0 < label.sum() < len(label):
        n = np.array([r["n"] for r in rows])
        top = np.array([max(r["scores"], default=0.0) for r in rows])
        chance = (label == 0) & (n > 0)
        # the mean of a Gumbel law: E[lambda S - ln n] = ln K + 0.5772
        model.log_k = float(np.mean(model.rate * top[chance] - np.log(n[chance]))) - 0.5772 if chance.any() else 0.0
        x = curve_features(*calibrated([[(0, 0, s) for s in r["scores"]] for r in rows], n, model.rate, model.log_k))
        model.curve = fit_curve(x, label)
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Every row's ``key``, score (0 to 1, higher: toxic likelier) and significant passages.

    ``passages`` lists first and last word (counted from 0, words being runs of ASCII letters
    and digits and non-ASCII characters) and calibrated score.  Whole texts are scanned.  Null
    and wordless texts have no passages and score as texts without any.  Repeated rows each
    give a row; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    passage = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("level", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in chunks(batches, "text"):
            words = split_words(batch.column("text"), lower=True, marks=True)
            found, n = found_segments(words, m.weight), np.diff(words.first)
            out = logistic(curve_features(*calibrated(found, n, m.rate, m.log_k)) @ m.curve)
            level = lambda i, s: float(m.rate * s - m.log_k - np.log(max(n[i], 1)))
            spans = [[{"first": a, "last": b, "level": level(i, s)} for a, b, s in x if level(i, s) >= SIGNIFICANT] for i, x in enumerate(found)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out), pa.array(spans, passage)], [key, "score", "passages"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, F.col("text").cast("string")).mapInArrow(run, f"{key} {kind}, score double, passages array<struct<first: long, last: long, level: double>>")
