"""Registered queries of the operators and the pipeline, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontamination, hard_negatives, html_text, interpolation, jaccard_join, license_scan, line_quality, packing, simhash, suffix_dedup, token_files, toxicity, whitening
from .common import fold, read_table, scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(job):
    QUERIES[job.__name__] = job
    return job


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order as range-coded blocks, and read them back."""
    path = scratch_folder(spark, "token-files")
    token_files.write_ids(read_table(spark, folder, "documents", "doc_id", "text"), path, tokenizer_file("word_bpe_49k.json"))
    return token_files.read_ids(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids."""
    return packing.packed(read_table(spark, folder, "documents", "doc_id", "text"), tokenizer_file("byte_bpe_50k.json"))


def _classified(module, spark: SparkSession, folder: str, label: str, folds: int, held: int, threshold: float) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "text")
    labels = read_table(spark, folder, "labels", "doc_id", F.col(label).alias("label"))
    model = module.train(docs, labels.where(fold("doc_id", folds) != held))
    scored = module.scored(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@query
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents by a chain over their lines, learned outside fold 0 of 5."""
    return _classified(line_quality, spark, folder, "quality", 5, 0, 0.3)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned outside fold 1 of 3."""
    return _classified(toxicity, spark, folder, "toxic", 3, 1, 0.7)


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and their likeness; near documents of every twentieth id among all."""
    report = simhash.edit_report(read_table(spark, folder, "documents", "doc_id", "text"))
    return simhash.near_counts(report, F.col("doc_id") % 20 == 0)


@query
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extracted(read_table(spark, folder, "pages", "page_id", "url", "html"))


@query
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains to 80 % or more."""
    docs = read_table(spark, folder, "documents", "doc_id", "text")
    return decontamination.contained(docs, read_table(spark, folder, "benchmark", "item_id", "text"))


ORACLES["op7_benchmark_decontamination"] = decontamination.SQL


@query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the bytes of 200-byte strings that start twice in the corpus."""
    kept = suffix_dedup.deduplicated(read_table(spark, folder, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have 80 % Jaccard similarity or more."""
    return jaccard_join.joined(read_table(spark, folder, "documents", "doc_id", "text"))


@query
def op6_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probabilities of all documents under a model learned outside fold 2 of 7."""
    docs = read_table(spark, folder, "documents", "doc_id", "text").withColumn("training", F.coalesce(fold("doc_id", 7) != 2, F.lit(True)))
    scored = interpolation.scored(docs)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


ORACLES["op3_jaccard_join"] = jaccard_join.SQL


@query
def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return license_scan.scanned(read_table(spark, folder, "documents", "doc_id", "text"))


ORACLES["op13_license_scan"] = license_scan.SQL


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings whitened on the eight largest components."""
    return whitening.whitened(read_table(spark, folder, "embeddings", "vec_id", "embedding"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of all anchors among all embeddings; every seventh id has its label moved on."""
    rows = read_table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.withColumn("label", moved))


ORACLES["op11_hard_negatives"] = hard_negatives.SQL
