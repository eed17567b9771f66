"""Corpus pipeline: quality classifier, line dedup, near-duplicate join, decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.llm import decontamination, jaccard_join, line_dedup, packing, quality_sampling
from kvadrat.llm.common import scratch, stored, table
from kvadrat.llm.tokens import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier samples."""
    return quality_sampling.kept_rows(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of three lines, or of fewer that hold 50 words, are cut out of the texts; a document whose lines are all
    repeats of earlier ones goes, one that had none stays as it is."""
    return line_dedup.without_repeats(docs, long_words=line_dedup.LONG_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id; documents
    without words and rows without an id are no group and stay. Rows equal in id are one."""
    found = stored(jaccard_join.near_duplicates(docs, count_links=False), "groups")
    # a table of its own, so Spark knows its size: few ids are broadcast, and no text is shuffled
    copies = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__copy")).distinct(), "copies")
    return docs.join(copies, docs["doc_id"] == copies["__copy"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL cannot say what the classifier's and the packer's stages do. tests/llm holds the operators
#: behind the stages against brute-force versions, and the stages' rows and columns.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
