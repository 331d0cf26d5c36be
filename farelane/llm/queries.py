"""Registered queries of the operators in this folder, over the whole given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import ann, bpe, chat, divergence, exact_topk, jaccard_join, line_dedup, merkle, packing, pii, quality, suffix_dedup, token_files
from farelane.llm.common import in_slices, mapped, tokenizer_file
from farelane.scratch import scratch_folder

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
PACKING_END, FILE_END = 2, 0
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of poor quality of every document, and whether it is kept."""
    return quality.classify(_table(spark, sf_dir, "documents")).select("doc_id", "bad", "keep")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer products of every hundredth vector."""
    return exact_topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_file(WORD_VOCABULARY), with_ids=False)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file(WORD_VOCABULARY), PACKING_END)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and a digest of what is kept."""
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of five-word shingle sets."""
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted form."""
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role")))).alias("r"),
    )
    own = own.select("conv_id", F.col("r.turn").cast("long").alias("turn"), "r.role", F.lit(CONTROL_TEXT).alias("text"))
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    formatted = chat.format_trees(chat.linear_messages(conversations))
    return mapped(formatted, _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 64):
        rows = []
        for row in batch.to_pylist():
            turns = chat.parse_turns(row["formatted"])
            loss = chat.masked_text(row["formatted"], list(zip(row["loss_starts"], row["loss_ends"])))
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append(
                {
                    "conv_id": row["tree"], "n_turns": len(turns), "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                    "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(row["formatted"]),
                }
            )
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts, a digest of the base spans, and all spans."""
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files written."""
    folder = scratch_folder(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer_file(BYTE_VOCABULARY), FILE_END)
    return token_files.read_documents(spark, folder)


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found of every twentieth vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of every language, and the words each source favours."""
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document because a smaller one holds them, and a digest of what is kept."""
    kept = suffix_dedup.drop_repeated_strings(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document, some read without their line feeds."""
    docs = _table(spark, sf_dir, "documents")
    proven = merkle.prove(docs, merkle.tampered_text())
    return proven.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_exact_topk, op3_bpe, op4_packing, op5_line_dedup, op6_jaccard_join,
        op7_chat_format, op8_pii, op9_token_files, op10_ann, op11_source_divergence, op12_suffix_dedup,
        op13_merkle_manifest,
    )
}
