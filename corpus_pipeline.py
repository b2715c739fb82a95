"""A training-corpus pipeline over ``documents``, stage by stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
the documents it kept, the last one their token rows.  Every stage's result is
written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copub.llm import bpe, decontaminate, partenum, recompression, tables, toxicity

TOXIC_CUT = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity cut, every row by its own text."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    return toxicity.score(rows, model, key="row").where(F.col("score") < TOXIC_CUT).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, one with the smallest doc_id, of each group of near copies, with or without ids."""
    return partenum.keep_one(docs).select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; n_chars follows.

    A text that loses nothing stays as it is; a text that loses words is its kept words joined
    by one space; a document of which no word is left goes.
    """
    kept = recompression.remove_repeats(docs.withColumn("whole", F.col("text")))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("rest.whole"))
    rows = kept.where("n_removed = 0 or n_removed < n_words").select("rest.*", text.alias("text"))
    return rows.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of what is left."""
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("decontamination", drop_contaminated),
    ("tokens", encode),
]

# Learned weights, passage removal and the vocabulary's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = tables.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
