"""A cleaned and packed corpus: quality, repeated lines, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import jaccard_join, line_dedup, packing, pii, quality
from farelane.llm.common import row_key, saved, tokenizer_file
from farelane.scratch import scratch_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return quality.classify(docs).filter("keep").select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds."""
    return _as_documents(line_dedup.drop_repeated_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies; documents without words stay.

    Rows are judged by their texts, also those of one doc_id or of none. Of a group the
    row of smallest id stays, then of smallest text and other columns; a null id comes last.
    """
    linked = saved(jaccard_join.linked_rows(docs), "linked-rows")
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id"))["id"].alias("least")
    several = linked.groupBy("component").agg(F.count("*").alias("n"), least).filter("n > 1")
    found = linked.join(several, "component").select("id", "text_hash", "component", "least").distinct()
    found = saved(found, "near-copies")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (row_key() == F.col("text_hash"))
    others = docs.join(found, same, "left_anti")
    first = docs.join(found.filter(F.col("id").eqNullSafe(F.col("least"))), same)
    columns = ["text", *(c for c in docs.columns if c != "text")]
    first = first.groupBy("component").agg(F.min(F.struct(*columns)).alias("r")).select("r.*")
    return others.unionByName(first).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _as_documents(pii.mask_personal_data(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in packed sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), 2)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_lines),
    ("jaccard_join", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]

#: SQL has no tokenizer, expectation-maximisation or similarity join; brute force tests the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
