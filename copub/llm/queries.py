"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fm_quality, kd_shards, license_scan, merkle, partenum, recompression, rotation, rpforest, token_counts, toxicity, url_filter
from .labels import fold

SHARDS = 40
QUALITY_CUT = 0.7
QUALITY_METADATA = ("n_chars",)
TOXIC_CUT = 0.5


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; the fold crc32(doc_id) mod 4 = 2 is held out."""
    docs = _read(spark, sf_dir, "documents")
    machine = fm_quality.fit(docs, _read(spark, sf_dir, "labels"), "quality", folds=4, held_out=2, metadata=QUALITY_METADATA)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    predicted = F.when(F.col("score") >= QUALITY_CUT, 1).otherwise(0)
    return fm_quality.score(docs, machine, QUALITY_METADATA).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = kd_shards.shard(_read(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five-word shingles, Jaccard of 0.8 or more."""
    return partenum.link(_read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark windows in every document."""
    found = decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the fold crc32(doc_id) mod 5 = 0 is held out."""
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"), "toxic", folds=5, held_out=0)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    predicted = F.when(F.col("score") >= TOXIC_CUT, 1).otherwise(0)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), F.size("passages").alias("n_passages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    coded = bpe.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings: equal labels, cosine of 0.98 or more."""
    return rpforest.link(_read(spark, sf_dir, "embeddings"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; the labelled outcome of a page is the quality label under its id."""
    outcomes = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("outcome"))
    return url_filter.judge(_read(spark, sf_dir, "pages"), outcomes)


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated passages of 35 words or more, as digests."""
    kept = recompression.remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(F.col("rest.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's proof for every document, a fifth of them tampered with."""
    tampered = fold("doc_id", 5) == 0
    return merkle.audit(_read(spark, sf_dir, "documents"), tampered, merkle.lower_cased(F.col("text"))).drop("copied")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return license_scan.scan(_read(spark, sf_dir, "documents")).drop("places")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in the middle, and the text restored from it, as digests."""
    rows = rotation.restore(rotation.transform(_read(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(name) for c, name in (("output", "output_sha256"), ("text", "restored_sha256"))]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_fm_quality, op2_kd_shards, op3_partenum_join, op4_decontaminate, op5_toxicity, op6_bpe, op7_rp_forest, op8_url_filter, op9_recompression,
            op10_token_counts, op11_merkle_manifest, op12_license_scan, op13_fill_in_middle,
        )
    }


_OP4 = r"""
WITH cut AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') FROM benchmark
), items AS (
  SELECT id AS item_id, w, least(len(w), 10) AS length FROM cut WHERE kind = 'b' AND len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, length, array_to_string(w[i : i + length - 1], ' ') AS gram FROM items, unnest(range(1, len(w) - length + 2)) AS t(i)
), grams AS (SELECT DISTINCT length, gram FROM windows),
lengths AS (SELECT DISTINCT length FROM grams),
spots AS (
  SELECT id AS doc_id, length, i AS start, array_to_string(w[i : i + length - 1], ' ') AS gram
  FROM (SELECT id, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM cut, lengths WHERE kind = 'd' AND len(w) >= length)
), hits AS (SELECT doc_id, spots.length, start, gram FROM spots JOIN grams USING (length, gram)),
covered AS (SELECT DISTINCT doc_id, unnest(range(start, start + length)) AS at FROM hits),
n_hit AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
listed AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items
  FROM (SELECT DISTINCT doc_id, length, gram FROM hits) JOIN windows USING (length, gram) GROUP BY doc_id
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM (SELECT * FROM cut WHERE kind = 'd') c LEFT JOIN n_hit ON c.id = n_hit.doc_id LEFT JOIN listed ON c.id = listed.doc_id
"""

_OP8 = r"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), known AS (
  SELECT doc_id AS page_id, min(quality) AS outcome FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)
), sites AS (
  SELECT *, regexp_replace(host, '^.*@|\.*(:[0-9]*)?\z', '', 'gs') AS site FROM parsed
), counted AS (
  SELECT site AS host, count(outcome) AS n, coalesce(sum(outcome), 0) AS good, string_split(site, '.') AS labels,
         CASE WHEN regexp_matches(site, '^(\[.*|[0-9]+(\.[0-9]+){3})\z', 's') THEN 0
              WHEN regexp_matches(site, '(^|\.)((KINDS)\.[a-z][a-z]|SHARED)\z') THEN 2 ELSE 1 END AS of_suffix
  FROM sites LEFT JOIN known USING (page_id) GROUP BY site
), hosts AS (
  SELECT host, n, good, CASE WHEN of_suffix = 0 THEN 'address' ELSE array_to_string(labels[greatest(len(labels) - of_suffix + 1, 1):], '.') END AS suffix,
         CASE WHEN of_suffix = 0 THEN host ELSE array_to_string(labels[greatest(len(labels) - of_suffix, 1):], '.') END AS domain
  FROM counted
), overall AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS up FROM hosts),
s0 AS (SELECT suffix, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(good) AS DOUBLE) AS good, any_value(up) AS up FROM hosts, overall GROUP BY suffix),
sr AS (SELECT least(0.9, greatest(0.001, coalesce(sum(n * (good / n - up) ** 2 - up * (1 - up)) / nullif(sum(up * (1 - up) * (n - 1)), 0), 0.001))) AS r FROM s0 WHERE n > 0),
s1 AS (SELECT suffix, (good + (1 / r - 1) * up) / (n + (1 / r - 1)) AS rate FROM s0, sr),
d0 AS (SELECT domain, suffix, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(good) AS DOUBLE) AS good, any_value(rate) AS up FROM hosts JOIN s1 USING (suffix) GROUP BY domain, suffix),
dr AS (SELECT least(0.9, greatest(0.001, coalesce(sum(n * (good / n - up) ** 2 - up * (1 - up)) / nullif(sum(up * (1 - up) * (n - 1)), 0), 0.001))) AS r FROM d0 WHERE n > 0),
d1 AS (SELECT domain, (good + (1 / r - 1) * up) / (n + (1 / r - 1)) AS rate FROM d0, dr),
h0 AS (SELECT host, CAST(n AS DOUBLE) AS n, CAST(good AS DOUBLE) AS good, rate AS up FROM hosts JOIN d1 USING (domain)),
hr AS (SELECT least(0.9, greatest(0.001, coalesce(sum(n * (good / n - up) ** 2 - up * (1 - up)) / nullif(sum(up * (1 - up) * (n - 1)), 0), 0.001))) AS r FROM h0 WHERE n > 0),
h1 AS (SELECT host, n, 1 / r - 1 AS k, (good + (1 / r - 1) * up) / (n + (1 / r - 1)) AS rate FROM h0, hr),
bounds AS (SELECT host, round(rate - 1.645 * sqrt(rate * (1 - rate) / (n + k + 1)), 6) AS bound FROM h1),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM sites
)
SELECT page_id, ruled.host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
            ELSE CASE WHEN bound < 0.75 THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled JOIN bounds ON ruled.site = bounds.host
""".replace("KINDS", url_filter.KINDS.replace(" ", "|")).replace("SHARED", url_filter.SHARED.replace(".", "[.]").replace(" ", "|"))


def _op11(most_levels: int = 8) -> str:
    """The manifest, level by level; a tree of one node stays as it is."""

    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"

    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    own, changed = (f"sha256({' || '.join(map(field, names))})" for names in (fields, [*fields[:-1], lower]))
    bits = "flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] for c in string_split(CAST(doc_id AS VARCHAR), '')])"
    step = "lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), {step}), 4294967295)"
    parts = [
        f"l AS (SELECT row_number() OVER () AS id, doc_id, source, {own} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {changed} END AS changed FROM documents)",
        "n0 AS (SELECT id, source AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size, leaf AS hash FROM l)",
        "p0 AS (SELECT n0.id, grp, pos, coalesce(changed, leaf) AS folded, '' AS proof FROM n0 JOIN l USING (id))",
    ]

    def level(n: str, p: str, i: int) -> None:
        parts.append(f"s_{n}{i} AS (SELECT grp, pos // 16 AS run, list(hash ORDER BY pos) AS hashes, max(size) AS size FROM {n}{i} GROUP BY grp, pos // 16)")
        parts.append(f"{n}{i + 1} AS (SELECT grp, run AS pos, (size + 15) // 16 AS size, CASE WHEN size > 1 THEN sha256(array_to_string(hashes, '')) ELSE hashes[1] END AS hash FROM s_{n}{i})")
        before, after = "coalesce(array_to_string(hashes[1 : pos % 16], ''), '')", "coalesce(array_to_string(hashes[pos % 16 + 2 :], ''), '')"
        parts.append(
            f"{p}{i + 1} AS (SELECT id, p.grp, pos // 16 AS pos, CASE WHEN size > 1 THEN sha256({before} || folded || {after}) ELSE folded END AS folded, "
            f"proof || CASE WHEN size > 1 THEN {before} || {after} ELSE '' END AS proof FROM {p}{i} p JOIN s_{n}{i} s ON p.grp IS NOT DISTINCT FROM s.grp AND p.pos // 16 = s.run)"
        )

    for i in range(most_levels):
        level("n", "p", i)
    last = most_levels
    parts.append(f"m0 AS (SELECT 0 AS grp, grp AS source, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS size, hash FROM n{last})")
    parts.append(f"q0 AS (SELECT id, 0 AS grp, m0.pos, folded, proof FROM p{last} p JOIN m0 ON p.grp IS NOT DISTINCT FROM m0.source)")
    for i in range(most_levels):
        level("m", "q", i)
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, m0.hash AS subroot, r.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.hash AS verified
FROM l JOIN q{last} q USING (id) JOIN m0 ON l.source IS NOT DISTINCT FROM m0.source CROSS JOIN (SELECT hash FROM m{last}) r"""
    )


def _op12() -> str:
    """The votes joined by the grams' words instead of their hashes."""
    templates = [*license_scan.EXACT, *license_scan.NOTICES]
    values = ", ".join(f"({i}, '{label}', {str(i < len(license_scan.EXACT)).lower()}, '{phrase}')" for i, (phrase, label) in enumerate(templates))
    return rf"""
WITH cut AS (
  SELECT row_number() OVER () AS id, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), templates AS (
  SELECT *, string_split(phrase, ' ') AS w, least({license_scan.GRAM}, len(w)) AS k, len(w) - k + 1 AS n FROM (VALUES {values}) AS t(template, label, exact, phrase)
), places AS (SELECT template, label, exact, n, len(w) AS length, k, j - 1 AS j, array_to_string(w[j : j + k - 1], ' ') AS gram FROM templates, unnest(range(1, n + 1)) AS u(j)),
grams AS (
  SELECT id, k, i - 1 AS i, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cut, (SELECT DISTINCT k FROM places))
), lines AS (
  SELECT id, template, label, exact, n, length, i - j AS diagonal, bit_or(CAST(1 AS BIGINT) << j) AS bits, min(i) AS low, max(i + k) AS high
  FROM grams JOIN places USING (k, gram) GROUP BY ALL
), base AS (
  SELECT id, count(*) AS n_base, min(low) AS first_word, max(low) AS last_word, array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels
  FROM lines WHERE exact AND bit_count(bits) = n GROUP BY id
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY id, template ORDER BY diagonal) <= {license_scan.REACH} THEN 0 ELSE 1 END AS begins FROM lines WHERE NOT exact
), grouped AS (SELECT *, sum(begins) OVER (PARTITION BY id, template ORDER BY diagonal) AS island FROM marked),
merged AS (SELECT id, label, n, length, bit_or(bits) AS bits, min(low) AS low, max(high) AS high FROM grouped GROUP BY id, template, label, n, length, island),
found AS (
  SELECT id, label, CAST(1 AS DOUBLE) AS share FROM lines WHERE exact AND bit_count(bits) = n
  UNION ALL SELECT id, label, CAST(bit_count(bits) AS DOUBLE) / n FROM merged WHERE bit_count(bits) >= {license_scan.SHARE} * n AND high - low <= length * 1.5
), listed AS (SELECT id, max(share) AS score, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM found GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM cut LEFT JOIN base USING (id) LEFT JOIN listed USING (id)
"""


_OP13 = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines, len(lines) AS n,
         [CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * i + 1, 8) AS UBIGINT) for i in [0, 1, 2, 3]] AS h
  FROM documents
), cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(lines[1 : a], ''), '') AS prefix, coalesce(array_to_string(lines[a + 1 : b], ''), '') AS middle,
         coalesce(array_to_string(lines[b + 1 :], ''), '') AS suffix FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontaminate": _OP4, "op8_url_filter": _OP8, "op11_merkle_manifest": _op11(), "op12_license_scan": _op12(), "op13_fill_in_middle": _OP13,
    }
