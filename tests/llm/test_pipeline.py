"""The corpus pipeline's stages against plain Python, on awkward rows."""

import os
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from copub.llm import partenum, toxicity  # noqa: E402
from test_llm import brute_components, brute_repeats  # noqa: E402

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], KIND).repartition(3)


def ids_and_texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    base, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "wxy")
    rows = [
        (7, base), (3, base), (None, base), (None, base + " tail"),  # one group: 3 stays
        (None, other), (None, other), (None, other + " tail"),  # one group without ids: one row stays
        (9, third), (9, "another clean text of the same id"), (9, "another clean text of the same id"),
        (3, "the id of a kept text"), (7, "the id of a lost text"),
        (4, ""), (4, None), (None, ""), (None, None), (None, " \n"),
    ]
    df = table(spark, rows).withColumns({"row_key": F.lit(1), "no_id": F.lit(2), "id": F.lit("i"), "a.b": F.lit(0)})
    out = partenum.keep_one(df)
    assert out.columns == df.columns
    got = ids_and_texts(out)
    without = [t for i, t in got if i is None and t and t.startswith("x0 ")]
    assert len(without) == 1 and without[0] in (other, other + " tail")
    assert [x for x in got if x != (None, without[0])] == sorted(
        [(3, base), (9, third), (9, "another clean text of the same id"), (3, "the id of a kept text"), (7, "the id of a lost text"), *rows[-5:]], key=repr
    )
    assert partenum.keep_one(df.where("false")).count() == 0


@pytest.fixture()
def bad_word(monkeypatch):
    """A fitted model by which a text is toxic if it holds the word ``bad``."""
    weight = np.full(toxicity.BUCKETS, -toxicity.DRIFT)
    import pyarrow as pa

    from copub.llm.words import split_words

    weight[toxicity.buckets(split_words(pa.array(["bad"]), lower=True, marks=True))] = 20.0
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: toxicity.Model(weight, 1.0, 0.0, np.array([-4.0, 4.0, 0.0])))


def test_every_row_is_judged_by_its_own_text(spark, bad_word):
    rows = [(1, "bad"), (1, "clean"), (None, "so bad"), (None, "clean"), (2, "fine"), (2, "fine"), (3, None), (4, "")]
    got = ids_and_texts(corpus_pipeline.drop_toxic(spark, table(spark, rows), "/root/testdata/sf0.001"))
    assert got == sorted([x for x in rows if "bad" not in (x[1] or "")], key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def want_clean(spark, rows):
    numbered = spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(numbered, toxicity.fit(None, None)).collect()}
    return [r for k, r in enumerate(rows) if scores[k] < 0.5]


def want_one_of_each_group(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    return [rows[k] for k, n, low in brute_components([(k, r[1]) for k, r in enumerate(rows)]) if n == 0 or k == low]


def want_without_repeats(rows):
    out = []
    for k, n, gone, text in brute_repeats([(k, r[1]) for k, r in enumerate(rows)]):
        i, whole, lang, source, n_chars = rows[k]
        if gone == 0:
            out.append((i, whole, lang, source, n_chars if whole is None else len(whole)))
        elif gone < n:
            out.append((i, text, lang, source, len(text)))
    return out


def want_without_benchmark(rows, items):
    cut = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    grams = {tuple(w[j : j + min(len(w), 10)]) for w in map(cut, items) if w for j in range(len(w) - min(len(w), 10) + 1)}
    lengths = {len(g) for g in grams}
    return [r for r in rows if not any(tuple(w[j : j + n]) in grams for w in [cut(r[1])] for n in lengths for j in range(len(w) - n + 1))]


def test_the_five_stages(spark, bad_word):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    item = next(t for t in items if t and len(t.split()) >= 12)
    base, other, shared = (" ".join(f"{c}{i}" for i in range(60)) for c in "wxy")
    lines = [
        (5, base), (2, base), (2, base), (None, base + " tail"), (None, other), (None, other), (6, "bad " + other), (None, "so bad"),
        (7, f"one {shared} two three"), (15, f"four  {shared}"), (8, " ".join(f"u{i}" for i in range(150)) + f" {shared}"), (9, shared.replace("y59", "z")),
        (10, f"Before, {item} after"), (10, "clean text of an id twice"), (11, ""), (11, ""), (12, None), (None, None), (None, " \n\t"), (13, "é 日本 <|endoftext|> don't"),
        (14, "spaces   stay\tas they\nare"),
    ]
    docs = table(spark, lines).withColumns({"row": F.lit(1), "score": F.lit(2.0), "whole": F.lit("w"), "copy": F.lit(3), "rest": F.lit(4), "kept_text": F.lit("k")})
    stages = dict(corpus_pipeline.STAGES)
    want = {
        "toxicity": lambda rows: want_clean(spark, rows), "near_copies": want_one_of_each_group,
        "repeats": want_without_repeats, "decontamination": lambda rows: want_without_benchmark(rows, items),
    }
    for name, expected in want.items():
        rows = rows_of(docs)
        out = stages[name](spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        got = rows_of(out)
        same(got, expected(rows))
        assert 0 < len(got) <= len(rows) and got != rows  # every stage has something to do
        docs = spark.createDataFrame(got, KIND)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [whole.encode(r[1] or "", add_special_tokens=False).ids for r in got]
    coded = [(r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in stages["tokens"](spark, docs, SF).collect()]
    same(coded, [(r[0], len(x), x) for r, x in zip(got, ids)])


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_of_no_documents(spark, bad_word, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, table(spark, []), SF).count() == 0
