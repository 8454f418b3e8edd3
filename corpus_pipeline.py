"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last give the columns of documents; the last gives the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import _store, decontam, language_id, line_dedup, ngram_join, packing

#: no SQL: language ID is a trained model, packing needs a tokeniser
ORACLE_SQL = None


def _as_before(docs: DataFrame, made: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars following the text."""
    columns = [
        F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns
    ]
    return made.select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null texts, texts without a letter) go; lang is the predicted language."""
    made = language_id.language_id(docs).where("lang_pred <> 'und'")
    return made.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in one of them. A document left without a line goes on empty."""
    return _as_before(docs, line_dedup.line_dedup(docs))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays, with all its rows; rows without an id stay."""
    slim = ngram_join.ngram_join(docs.select("doc_id", "text"), drop_text=True)
    gone = slim.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are five percent of the words or more go; others stay as they are."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(docs, bench).where("NOT contaminated").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_near_copies),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``; each stage's result is a table in the shared folder."""
    folder = _store.shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = _store.written(stage(spark, docs, sf_dir), folder, f"{k}-{name}")
    return docs
