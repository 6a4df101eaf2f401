"""From raw documents to token ids: filter, deduplicate, mix, encode and decode.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the
documents it keeps. All but the last return the columns of ``documents``.

Defined cases: a null, empty or short text is rejected by the first stage, so later ones see
none, but for texts that line dedup leaves empty; these stay, and are encoded as begin and
end alone. Rows with equal doc_id and text are one document to the duplicate stages and rows
of their own to the others. A row with a null doc_id passes through as a document of its own.
Columns of ``documents`` other than the five named are left out. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm import jaccard_join, line_dedup, mixing, piece_codec, quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_rules.train(docs, labels)
    return quality_rules.judge(docs.select(*COLUMNS), model).where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without line passages that stand elsewhere before."""
    short = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return short.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for: 0, 1 or 2 times."""
    return mixing.emit(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as little-endian unsigned 32-bit integers, their number, and the text that
    they decode to."""
    return piece_codec.round_trip(docs.select("doc_id", "source", "text")).drop("text")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mix),
    ("SentencePiece encoding and decoding", tokens),
]

#: The quality and token stages have no SQL form; a test compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, runtime.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        runtime.released(before)
    return docs
