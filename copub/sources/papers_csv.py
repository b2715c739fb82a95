"""Papers as CSV (header ``id_paper,year,doi,authors``) and generic CSV sinks.

The ``authors`` cell holds a list literal such as ``[1, 2, 3]``, which is
valid JSON, so it is decoded with ``from_json`` and written with ``to_json``.
Every column is read as text with an explicit schema and converted with
``try_cast`` (a malformed value becomes NULL instead of failing the job).
Quotes inside a cell are doubled, as spreadsheet programs and pandas write them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copub.functions.columns import clean_id, year_from_text
from copub.sources.quarantine import ASIDE, checked, write_counted

CSV_TEXT_SCHEMA = "id_paper string, year string, doi string, authors string"


def read_papers_csv(spark: SparkSession, path: str | list[str], with_order: bool = False) -> DataFrame:
    """``(paper_id, year, doi, authors array<bigint>)`` from a papers CSV.

    ``with_order`` adds ``_order`` (file path, block start, row id): the
    position of the row in the files, for "last row wins" deduplication.
    """
    raw = spark.read.schema(CSV_TEXT_SCHEMA).option("header", True).option("escape", '"').csv(path)
    ids = F.from_json(F.col("authors"), T.ArrayType(T.LongType()))
    cols = [
        clean_id("id_paper").alias("paper_id"),
        year_from_text("year").alias("year"),
        F.col("doi"),
        F.coalesce(ids, F.array().cast("array<bigint>")).alias("authors"),
    ]
    if with_order:
        cols.append(F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_order"))
    return raw.select(*cols)


KINDS = ["line", "paper id", "year", "authors"]
TYPED_SCHEMA = "paper_id bigint, year int, doi string, authors array<bigint>, defects array<string>, line string, slot int"


def ingest_papers_csv(spark: SparkSession, csv: str | list[str], path: str) -> dict[str, int]:
    """Parse a papers CSV once into typed Parquet under ``path``; returns the counts of the pass.

    A row without a readable id lies aside only; one whose year or author list cannot be read, or whose
    number of cells is wrong, is kept with NULL or an empty list and lies aside too.
    """
    raw = spark.read.schema(CSV_TEXT_SCHEMA + ", _corrupt string").option("header", True).option("escape", '"')
    raw = raw.option("columnNameOfCorruptRecord", "_corrupt").csv(csv)
    ids = F.from_json(F.col("authors"), T.ArrayType(T.LongType()))
    rows = raw.select(
        clean_id("id_paper").alias("paper_id"), year_from_text("year").alias("year"), "doi",
        F.coalesce(ids, F.array().cast("array<bigint>")).alias("authors"), ids.isNull().alias("_unread"), "_corrupt",
        F.coalesce("_corrupt", F.to_csv(F.struct("id_paper", "year", "doi", F.col("authors").alias("authors")), {"escape": '"'})).alias("_text"),
    )
    defects = {
        "line": F.col("_corrupt").isNotNull(), "paper id": F.col("paper_id").isNull(), "year": F.col("year").isNull(),
        "authors": F.col("_unread") | F.exists("authors", lambda a: a.isNull()),
    }
    dealt = checked(rows, F.col("paper_id").isNotNull(), defects, F.col("_text"), F.lit(0)).drop("_unread", "_corrupt", "_text")
    return write_counted(dealt, path, KINDS, ["paper_id"])


def read_typed_papers(spark: SparkSession, path: str) -> DataFrame:
    """``(paper_id, year, doi, authors)`` of an ingested CSV."""
    return spark.read.schema(TYPED_SCHEMA).parquet(path).where("slot = 0").select("paper_id", "year", "doi", "authors")


def read_aside(spark: SparkSession, path: str) -> DataFrame:
    """``(line, defects, paper_id)`` of an ingested CSV's rows with a defect."""
    return spark.read.schema(TYPED_SCHEMA).parquet(path).where(F.col("slot") == ASIDE).select("line", "defects", "paper_id")


def write_papers_csv(papers: DataFrame, path: str, sort: bool = True, mode: str = "errorifexists") -> None:
    """Write ``(paper_id, year, doi, authors)`` as a papers CSV, sorted by year."""
    out = papers.select(
        F.col("paper_id").alias("id_paper"), "year", "doi", F.to_json("authors").alias("authors")
    )
    if sort:
        out = out.orderBy("year", "id_paper")
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Any table as CSV with a header; array/map/struct cells become JSON text."""
    cols = [
        F.to_json(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cols).write.mode(mode).option("header", True).option("escape", '"').csv(path)
