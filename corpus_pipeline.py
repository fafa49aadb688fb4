"""The training-data pipeline: quality, repeated lines, near duplicates, source weights, packing.

Each stage takes all rows that the one before it kept, as a table that was written and read
again, and gives them back with the columns of ``documents``, fewer, changed or repeated. The last
gives the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, near_dup, packing, quality
from tidemark.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance draw keeps, by the labels beside them.

    Null and empty texts are drawn by noise alone, equal draws together. Repeated rows are rows of their
    own. No rows: no rows; no labels: all stay.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of three lines; one that had words and has none left goes.

    Null and empty texts stay. Repeated rows, rows without an id, and columns of any names stay as they are.
    """
    whole = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    kept = line_dedup.dedup_lines(whole)
    emptied = (F.col("n_removed") > 0) & (mixing.word_count(F.col("text")) == 0)
    own = [F.col("_row").getField(c).alias(c) if c != "text" else F.col("text") for c in docs.columns]
    return _with_length(kept.where(~emptied).select(*own), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates.

    Documents without a word, or without an id, are in no group and stay. Rows that repeat the
    id of a document that stays, stay with it.
    """
    judged = near_dup.near_duplicates(docs)
    gone = materialize(judged.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "near-duplicates")
    if gone.count() <= near_dup.BROADCAST_IDS:  # then no text is shuffled
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix passes over them; the one at which a source is complete is cut.

    Null sources are one source, the last. Texts without words go. Repeated rows are rows of their own; rows
    that differ in any column stay apart. No rows: no rows.
    """
    mixed = mixing.mixed_documents(docs, in_order=False)  # packing deals its rows anew
    return _with_length(mixed, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in windows of 2048 token ids, with their ids.

    Null and empty texts are their end token. Repeated rows and rows without an id are documents of their own.
    No rows: no rows.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _with_length(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``; ``n_chars``, if there, is that of the text now."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None  # Gumbel draws, hashed shuffles and token ids have no SQL; tests hold each stage against plain code


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
