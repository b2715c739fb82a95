"""The learned operators and the vector join against their definitions, by brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from copub.llm import fm_quality, rpforest, toxicity
from copub.llm.words import split_words

TEXTS = ["", None, "one", "A b a b | * 12", "Ünïcode   words, and\nlines.\n", "same " * 50, " ".join(f"w{i % 37}" for i in range(300)), "\n \t"]


def test_machine_equals_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    size = fm_quality.WORD_BUCKETS + fm_quality.STATISTICS + 1
    machine = fm_quality.Machine(0.3, rng.normal(size=size), rng.normal(0, 0.3, (size, 5)), rng.normal(size=fm_quality.STATISTICS + 1), rng.uniform(0.5, 2, fm_quality.STATISTICS + 1))
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, pa.string()), pa.array([None, 1.0, -5.0, 1e300, float("nan"), 0.0, 3.0, 4.0])], ["text", "n_chars"])
    doc, bucket, value, dense = fm_quality.features(batch, ["n_chars"])
    got = fm_quality.raw_scores(machine, doc, bucket, value, dense)
    assert np.isfinite(got).all()
    for i in range(len(TEXTS)):
        x = dict(zip(bucket[doc == i].tolist(), value[doc == i].tolist()))
        scaled = np.clip((dense[i] - machine.mean) / machine.spread, -4, 4)
        x |= {fm_quality.WORD_BUCKETS + j: v for j, v in enumerate(scaled.tolist())}
        want, names = machine.bias, sorted(x)
        for p, a in enumerate(names):
            want += machine.weight[a] * x[a]
            for b in names[:p]:
                want += float(machine.factor[a] @ machine.factor[b]) * x[a] * x[b]
        assert got[i] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_words_of_a_text_have_unit_length():
    words = split_words(pa.array(TEXTS, pa.string()), lower=True)
    doc, _, value = fm_quality.word_features(words)
    length = np.bincount(doc, value**2, len(TEXTS))
    assert np.allclose(length[np.diff(words.first) > 0], 1) and (length[np.diff(words.first) == 0] == 0).all()


def maximal(scores, low, high):
    """Maximal scoring segments by their definition: the best one, then those to its left and right."""
    best = max(((sum(scores[a:b]), a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    return [*maximal(scores, low, best[1]), (best[1], best[2] - 1, best[0]), *maximal(scores, best[2], high)]


@pytest.mark.parametrize("seed", range(30))
def test_segments_equal_their_definition(seed):
    rng = np.random.default_rng(seed)
    n, drift = int(rng.integers(0, 40)), 0.3
    scores = np.where(rng.random(n) < 0.5, rng.normal(0, 1, n), -drift)  # others than the drift are listed
    listed = np.flatnonzero(scores != -drift)
    got = toxicity.segments(listed.tolist(), scores[listed].tolist(), drift)
    want = maximal(scores.tolist(), 0, n)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_segments_of_texts_use_every_word():
    rng = np.random.default_rng(2)
    weight = np.full(toxicity.BUCKETS, -toxicity.DRIFT)
    vocabulary = [f"word{i}" for i in range(12)]
    bucket = toxicity.buckets(split_words(pa.array([" ".join(vocabulary)]), lower=True, marks=True))
    weight[bucket[:6]] = rng.normal(0, 1, 6)
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) for _ in range(40)]
    score = dict(zip(vocabulary, weight[bucket]))
    found = toxicity.found_segments(split_words(pa.array(texts), lower=True, marks=True), weight)
    for text, spans in zip(texts, found):
        some = [score[w] for w in text.split()]
        for a, b, s in spans:
            assert s == pytest.approx(sum(some[a : b + 1])) and s > 0
        whole = maximal(some, 0, len(some))
        assert sum(s for *_, s in spans) == pytest.approx(sum(s for *_, s in whole))
        assert max((s for *_, s in spans), default=0) == pytest.approx(max((s for *_, s in whole), default=0))


def test_the_extreme_value_rate_solves_its_equation():
    rng = np.random.default_rng(3)
    clean, toxic = rng.integers(0, 50, 200).astype(float), rng.integers(0, 5, 200).astype(float)
    toxic[:5] += 100
    weight = toxicity.token_weights(toxic, clean)
    rate = toxicity.extreme_rate(weight, clean)
    assert rate > 0 and (clean / clean.sum() * np.exp(rate * weight)).sum() == pytest.approx(1, abs=1e-6)
    assert (weight[:5] > 0).all() and weight[5:].max() < weight[:5].min()


@pytest.mark.parametrize("leaf", [100_000, 24])
def test_vectors_against_all_pairs(spark, leaf):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(30, 12))
    vectors = [(1000 - i, (centre[i % 30] + rng.normal(size=12) * 0.08).tolist(), i % 3) for i in range(400)]
    vectors += [(2000 + i, vectors[i][1], vectors[i][2]) for i in range(0, 60, 2)]  # copies
    vectors += [(3000, (3 * np.array(vectors[0][1])).tolist(), 0), (3000, vectors[0][1], 0)]  # a multiple, and an id given twice
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").repartition(4)
    df = df.withColumns({c: F.lit("x") for c in ("k1", "class_id", "vector", "width", "copies", "a.b", "tree")})
    rows = rpforest.link(df, leaf=leaf).collect()
    x = np.array([v for _, v, _ in vectors])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([l for *_, l in vectors])
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    ids = [i for i, *_ in vectors]
    lowest = np.array(ids)
    for _ in range(len(ids)):
        spread = np.minimum(lowest, np.where(near, lowest, 10**9).min(axis=1))
        if (spread == lowest).all():
            break
        lowest = spread
    want = sorted(zip(ids, near.sum(1).tolist(), lowest.tolist()))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in rows)
    if leaf > len(ids):  # one leaf: everything is compared
        assert got == want
    else:
        links, all_links = sum(g[1] for g in got), sum(w[1] for w in want)
        assert 0.9 * all_links <= links <= all_links
        assert [g[0] for g in got] == [w[0] for w in want] and all(g[1] <= w[1] and g[2] >= w[2] for g, w in zip(got, want))
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
