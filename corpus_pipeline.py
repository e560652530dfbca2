"""From raw documents to token ids: five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm import bpe, decontaminate, near_dedup, quality, span_dedup
from veleta.llm.tables import fresh, table
from veleta.session import run_dir, stabilise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram ratio; statistics come from this stage's input.

    NULL, empty and short texts fail; every row is judged on its own, so repeated rows and NULL ids
    come out alike. An empty table gives no rows.
    """
    ratios = quality.fit_ratio(docs, quality.trusted_texts(docs, table(spark, sf_dir, "labels")))
    return quality.measure(docs, ratios).filter("kept").select("row.*")


def near_dedup_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the first in the order of the stage's input.

    NULL and wordless texts are never near-duplicates and all stay. Repeated rows are copies, so one
    stays, whatever their ids. An empty table gives no rows.
    """
    row = fresh(docs, "row_number")
    rows = stabilise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    classes = near_dedup.near_duplicates(rows, id_col=row)
    first = classes.filter("doc_id = class_id").select(F.col("doc_id").alias(row))
    return rows.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of sentences go; a document that loses all its text goes too.

    NULL and empty texts stay as they are. The least doc_id keeps a run, ties go to the lesser text
    hash; rows that repeat id and text come out alike. An empty table gives no rows.
    """
    gone = fresh(docs, "n_removed")
    cut = span_dedup.dedup_spans(docs, counts=(fresh(docs, "n_sentences"), gone))
    left = cut.filter((F.col(gone) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    NULL and empty texts hold none and stay; of repeated rows all stay or go; items with a NULL id
    count. An empty table gives no rows.
    """
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document left.

    NULL and empty texts have no ids; repeated rows and NULL ids come out alike. An empty table gives
    no rows.
    """
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup_rows),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]
# Signatures, sentence hashes and merges have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
