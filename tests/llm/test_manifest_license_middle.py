"""The manifest, the license scan and fill-in-middle against plain Python, on awkward rows."""

import hashlib
import random
import re
import zlib

import pytest
from oracle_check import compare, duck_connection
from pyspark.sql import functions as F

from copub.llm import license_scan, merkle, queries, rotation
from copub.llm.labels import fold

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    texts = ["", None, "Plain TEXT", "All rights reserved.", "ä\nÖ\n", "a\n\n\nb", "CC BY cc-by", "x " * 3000, "<P> a\nb", "Tail <S", "no break", "\n"]
    made = [(i, texts[i % len(texts)], "en", "hot", i) for i in range(300)]
    made += [(i, f"Text {i}\nline\n", None, f"s{i % 7}", None) for i in range(300, 420)]
    made += [(None, "No ID", "de", None, 3), (None, "No ID", "de", None, 3), (5, "Same", "en", None, 4), (5, "Same", "en", None, 4), (5, "Other", "en", None, 4), (6, None, None, "ü", None)]
    random.Random(1).shuffle(made)
    return made


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, KIND).repartition(5)
    return df.withColumns({c: F.lit(1) for c in ("row", "pos", "size", "grp", "hash", "a.b", "part", "w", "n", "form")})


def leaf(doc_id, text, lang, source, n_chars):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def up(nodes):
    return [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append(up(out[-1]))
    return out


def brute_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[name] = tree([leaf(*r) for r in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for g, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            changed = leaf(row[0], row[1].translate(LOWER) if row[1] is not None else None, *row[2:])
            node, proof = changed if tampered else leaf(*row), ""
            for levels, at in ((trees[name], i), (top, g)):
                for level in levels[:-1]:
                    run = level[at // 16 * 16 : at // 16 * 16 + 16]
                    proof += "".join(x for j, x in enumerate(run) if j != at % 16)
                    run[at % 16] = node
                    node = sha(*run)
                    at //= 16
            out.append((row[0], leaf(*row), trees[name][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


def audited(docs):
    return merkle.audit(docs, fold("doc_id", 5) == 0, merkle.lower_cased(F.col("text")))


@pytest.mark.parametrize("tier", [1, 3])
def test_manifest(docs, rows, tier, monkeypatch):
    monkeypatch.setattr(merkle, "TIER", tier)  # 1: the hot source has three tiers
    monkeypatch.setattr(merkle, "BLOCK", 16**tier)
    got = [tuple(r) for r in audited(docs).drop("copied").collect()]
    want = brute_manifest(rows)
    assert sorted(got, key=repr) == want
    assert {r[-1] for r in want} == {True, False}


def test_a_version_copies_its_path_only(docs, rows):
    for r in audited(docs).collect():
        if r.copied is None:
            assert r.verified
        else:
            assert r.copied[-1] == r.folded_root
            assert 1 <= len(r.copied) <= 4  # at most 300 leaves a source and 10 sources
            assert r.verified == (r.root in r.copied)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_small_manifests(spark, n):
    rows = [(i, f"T{i}", "en", None, 1) for i in range(n)]
    got = sorted((tuple(r) for r in audited(spark.createDataFrame(rows, KIND)).drop("copied").collect()), key=repr)
    assert got == (brute_manifest(rows) if n else [])


def test_every_row_its_own_source(spark):
    rows = [(i, "Text", "en", f"s{i}", 1) for i in range(40)]
    got = sorted((tuple(r) for r in audited(spark.createDataFrame(rows, KIND)).drop("copied").collect()), key=repr)
    assert got == brute_manifest(rows)


# -- licenses -------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    w = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in license_scan.EXACT:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_base_phrases(spark, docs, rows):
    words = ["cc", "by", "all", "rights", "reserved", "general", "public", "license", "CC", "é"]
    rng = random.Random(2)
    more = [(1000 + i, "-".join(rng.choices(words, k=rng.randint(0, 60))), None, None, None) for i in range(200)]
    more += [(None, "cc by " * 20_000, None, None, None)]
    some = docs.select("doc_id", "text", "w", "row").unionByName(spark.createDataFrame(more, KIND).select("doc_id", "text", F.lit(1).alias("w"), F.lit(1).alias("row")))
    got = sorted((tuple(r)[:6] for r in license_scan.scan(some).collect()), key=repr)
    assert got == sorted(((r[0], *brute_base(r[1])) for r in rows + more), key=repr)


def test_edited_notices(spark):
    mit = dict((label, phrase) for phrase, label in license_scan.NOTICES)["mit"]
    w = mit.split()
    texts = [
        ("whole", f"x {mit} y", "mit"), ("changed", " ".join(w[:8] + ["zzz"] + w[9:]), "mit"), ("longer", " ".join(w[:9] + ["a", "b"] + w[9:]), "mit"),
        ("shorter", " ".join(w[:9] + w[10:]), "mit"), ("half", " ".join(w[:10]), ""), ("apart", " ".join(w[:10] + ["x"] * 40 + w[10:]), ""),
        ("twice", f"{mit} . {mit}", "mit"), ("mixed", " ".join(reversed(w)), ""),
    ]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(texts)], "doc_id long, text string")).collect()}
    for i, (name, _, labels) in enumerate(texts):
        assert got[i].labels == labels, name
        assert got[i].n_base == 0 and got[i].base_labels == ""
        assert (got[i].score == 1.0) == (name in ("whole", "twice")) and (got[i].score > 0) == (labels == "mit")
    assert [(p.start, p.stop) for p in got[0].places] == [(1, 1 + len(w))]
    assert [(p.start, p.stop) for p in got[6].places] == [(0, len(w)), (len(w), 2 * len(w))]


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError):
        license_scan.positions(spark, [("word " * 80, "long")], [])
    none = license_scan.scan(spark.createDataFrame([(1, "cc by")], "doc_id long, text string"), [], []).collect()
    assert [(r.n_words, r.n_base, r.labels, r.score) for r in none] == [(2, 0, "", 0.0)]


# -- fill in the middle -----------------------------------------------------------


def brute_middle(doc_id, text, spm):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("spm", [0, 50, 100])
def test_fill_in_middle(spark, docs, rows, spm):
    rng = random.Random(3)
    rows = rows + [(2000 + i, "".join(rng.choices(["\n", "<", "S", ">", "<S", "M>", "ö", "日", "𝄞", "P", "\r"], k=rng.randint(0, 30))), None, None, None) for i in range(300)]
    rows += [(9, "long line of words\n" * 50_000, None, None, None)]
    out = rotation.transform(spark.createDataFrame(rows, KIND), spm_percent=spm)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted((brute_middle(r[0], r[1], spm) for r in rows), key=repr)
    back = rotation.restore(out)
    assert back.columns == [*out.columns, "text"]
    assert sorted((r.doc_id, r.text) for r in back.where("doc_id >= 7").collect()) == sorted((r[0], r[1] or "") for r in rows if r[0] is not None and r[0] >= 7)


def test_three_reversals_exchange_blocks():
    for cut in range(6):
        buffer = bytearray(b"xabcdey")
        rotation.rotate(buffer, 1, 1 + cut if cut < 6 else 6, 6)
        assert buffer == b"x" + b"abcde"[cut:] + b"abcde"[:cut] + b"y"


def test_empty_tables(docs):
    none = docs.where("false")
    assert audited(none).collect() == []
    assert license_scan.scan(none).collect() == []
    assert rotation.restore(rotation.transform(none)).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    r = compare(spark, SF, name, queries.queries()[name], queries.oracle_sql()[name], duck_connection(SF))
    assert r["status"] == "match", r


def test_the_license_scan_runs_no_python(spark):
    plan = queries.op12_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
