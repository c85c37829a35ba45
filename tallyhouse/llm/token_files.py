"""Token-id files: whole texts encoded by a public tokenizer, range coded in blocks, in ascending doc_id order.

`write_ids` deals documents out by ranges of doc_id, sorts each range and writes
Parquet rows of one block each: the coded bytes of `rangecoder` with the ids and
sizes of the documents in it. A block holds whole documents and can be decoded
alone, so that a lost task costs only its own blocks. `read_ids` decodes the
blocks and adds up the sizes of the ranges before, which are few.

Defined cases: a null text is empty and has only the end id; rows that share a
doc_id stand together, ordered by text, null ids first; an empty table gives an
empty file set and result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import UNIT, batch_of, slices
from .rangecoder import decode_block, encode_block
from .tokenizing import encoder

BLOCK = 1 << 21  # ids after which a block is closed
VOCABULARY = 49_408

_FILE = "part int, block int, before long, n_ids long, doc_ids array<bigint>, sizes array<bigint>, coded binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, vocabulary: int = VOCABULARY, block: int = BLOCK) -> None:
    """Write the ids of `docs` (doc_id, text) as blocks under `path`."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).documents
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids, sizes, raw, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            body = encode_block(np.concatenate(raw), vocabulary)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": number, "before": before, "n_ids": held, "doc_ids": ids, "sizes": sizes, "coded": body}],
                schema=schema,
            )

        for s in slices(batches, budget=UNIT):
            found, lengths = encode(s.texts())
            docs, ends = s.batch.column("doc_id").to_pylist(), np.cumsum(lengths)
            first = start = 0
            while first < len(docs):
                last = min(len(docs), int(np.searchsorted(ends, start + block - held)) + 1)
                end = int(ends[last - 1])
                ids += docs[first:last]
                sizes += lengths[first:last].tolist()
                raw.append(found[start:end])
                held += end - start
                first, start = last, end
                if held >= block:
                    yield closed()
                    number, before, held = number + 1, before + held, 0
                    ids, sizes, raw = [], [], []
        if ids:
            yield closed()

    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
         ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("coded", pa.binary())]
    )
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(code, _FILE).write.parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document: doc_id, start (ids before it in the whole file set), n_tokens, ids_crc32 and, if asked for, the ids as bytes."""
    blocks = spark.read.schema(_FILE).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))  # one row for each range
    starts = parts.select("part", (F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")).alias("part_start"))
    out = "doc_id long, part int, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    schema = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        + [("ids", pa.binary())] * with_ids
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = decode_block(row["coded"]).astype("<u4").tobytes()
                ends = np.cumsum(row["sizes"])
                starts = ends - row["sizes"]
                pieces = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [row["doc_ids"], [row["part"]] * len(ends), starts + row["before"], row["sizes"], [zlib.crc32(p) for p in pieces]]
                yield batch_of(schema, *columns, *([pieces] if with_ids else []))

    # One block a batch: a block's ids are the unit of memory.
    decoded = blocks.select("part", "before", "doc_ids", "sizes", "coded").mapInArrow(decode, out)
    placed = decoded.join(F.broadcast(starts), "part")  # as many rows as ranges were written
    return placed.withColumn("start", F.col("start") + F.col("part_start")).drop("part", "part_start")
