"""Corpus pipeline over `documents`: stages that each apply one operator to all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import decontamination, jaccard_join, line_quality, packing, suffix_dedup
from tallyhouse.llm.common import drop_scratch, fold, read_table, scratch_mark, small_batches, written
from tallyhouse.llm.queries import tokenizer_file

QUALITY = 0.3
PIECES = 300_000  # words whose ids a packing worker keeps: its executor has been through all stages before
_marks: list[int] = []


def stage(job: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage: when it begins, the one before is written, so the tables that one left in the shared folder go."""

    @wraps(job)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        small_batches(spark)
        if _marks:
            drop_scratch(spark, *_marks)
        begun = scratch_mark()
        out = job(spark, docs, folder)
        _marks[:] = [begun, scratch_mark()]
        return out

    return run_stage


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leave out documents that the line classifier rejects; it learns from the labels outside fold 0 of 5."""
    labels = read_table(spark, folder, "labels", "doc_id", F.col("quality").alias("label"))
    model = line_quality.train(docs, labels.where(fold("doc_id", 5) != 0))
    return line_quality.accepted(docs, model, QUALITY)


@stage
def near_copies_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


@stage
def repeats_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Take repeated passages out of the texts; n_chars follows the text."""
    found = suffix_dedup.deduplicated(docs)
    columns = {c: F.col("rest").getField(c) for c in docs.columns if c not in ("doc_id", "text")} | {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


@stage
def benchmark_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leave out documents that contain a benchmark item."""
    return decontamination.clean(docs, read_table(spark, folder, "benchmark", "item_id", "text"))


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pack the kept documents into training sequences, with the ids of each piece."""
    return packing.packed(docs, tokenizer_file("byte_bpe_50k.json"), with_ids=True, room=PIECES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("suffix-array dedup", repeats_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # trained models, byte digests and tokenizers have no SQL form; tests hold each stage against brute force


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written as Parquet and read back."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, job in STAGES:
        docs = written(job(spark, docs, folder), name.replace(" ", "-"))
    return docs
