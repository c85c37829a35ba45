"""Helpers shared by the operators: shared-folder tables, column guards, Arrow slices and word hashes.

Texts are handled as whole byte ranges of an Arrow column, in slices of about
SLICE bytes, so that a task's memory does not grow with its partition. A single
text longer than that makes a slice of its own.
"""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

SLICE = 1 << 20
SHINGLE = 5
BATCH_ROWS = 1000  # rows of an Arrow batch: texts are long, and a batch is held on both sides
BROADCAST_ROWS = 500_000  # rows of a few numbers each that may be broadcast, once they are counted
U64 = np.uint64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER_TABLE = np.arange(256, dtype=np.uint8)
_LOWER_TABLE[65:91] += 32
_SPACE_TABLE = np.zeros(256, dtype=bool)
_SPACE_TABLE[[9, 10, 11, 12, 13, 32]] = True
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


_scratch: list[str] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir)."""
    ensure_checkpoint_dir(spark)
    _scratch.append(f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def scratch_mark() -> int:
    """A point in time for drop_scratch."""
    return len(_scratch)


def drop_scratch(spark: SparkSession, since: int, until: int) -> None:
    """Delete the tables that were written between two marks, once nothing reads them any more."""
    for k in range(since, until):
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch[k])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Give workers BATCH_ROWS rows at a time, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast what is counted to be small; Spark joins the rest by shuffle. df should be cheap to read twice."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: later jobs do not recompute it."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW_GROUP = 16 << 20  # bytes that a Parquet writer holds back, where memory is short


def written_small(df: DataFrame, name: str) -> DataFrame:
    """`written` for large tables beside large workers: small row groups, which a writer holds in memory, and a denser codec."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of jobs that are done: Spark deletes them when the driver collects its garbage, every half hour unless asked."""
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def fold(doc_id: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def lowered(column):
    return F.translate(column, _UPPER, _UPPER.lower())


def word_list(column):
    """Words of a text: lower case for A-Z only, cut at space, tab, line feed, vertical tab, form feed, return."""
    return F.regexp_extract_all(lowered(column), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))


def usable_vectors(rows: DataFrame, limit: float) -> DataFrame:
    """Rows whose `embedding` (as doubles here) has only entries below `limit` in magnitude, and the most common length; the longer of equally common ones."""
    kept = rows.where("embedding is not null").withColumn("embedding", F.col("embedding").cast("array<double>"))
    # NaN is larger than every number here, so it fails the bound as infinity does.
    kept = kept.where((F.size("embedding") > 0) & F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < limit)))
    lengths = kept.groupBy(F.size("embedding").alias("length")).count()
    common = lengths.agg(F.max_by("length", F.struct("count", "length")).alias("length")).first()["length"]
    return kept.where(F.size("embedding") == F.lit(common)) if common else kept


def scaled_vectors(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """floor(scale * entry) of the usable vectors of a batch, a row each."""
    column = batch.column("embedding")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.astype(np.float64)).astype(np.int64).reshape(len(column), -1)


class Slice:
    """Rows of a batch: texts as one byte array, row i at data[offsets[i]:offsets[i+1]]."""

    def __init__(self, batch: pa.RecordBatch, offsets: np.ndarray, data: np.ndarray):
        self.batch, self.offsets, self.data = batch, offsets, data

    def column(self, name: str) -> np.ndarray:
        return self.batch.column(name).to_numpy(zero_copy_only=False)

    def texts(self) -> list[str]:
        raw, at = self.data.tobytes(), self.offsets.tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", budget: int = SLICE) -> Iterator[Slice]:
    """Cut batches at row bounds into slices of about budget bytes of text; a null text counts as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = pc.fill_null(batch.column(text).cast(pa.large_string()), "").cast(pa.large_binary())
        _, where, body = column.buffers()
        at = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(at, at[first] + budget, "right")) - 1)
            yield Slice(batch.slice(first, last - first), at[first : last + 1] - at[first], data[at[first] : at[last]])
            first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(SLICE + 4096, n + n // 4)  # slices of SLICE bytes share one size; a long text brings a larger one
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base^position, with a leading zero: range_hash() reads the hash of any byte range from it."""
    power, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(power[: len(data)] * (data.astype(U64) + U64(1)), out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes have equal hashes wherever they stand."""
    _, inverse = _power_tables(len(sums) + 1)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def row_parts(offsets: np.ndarray, budget: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows first..last-1 of about `budget` bytes: what is computed byte by byte stays small."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + budget, "right")) - 1)
        yield first, last
        first = last


def words(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte, end byte and hash of each word of a slice, in order."""
    found = []
    for first, last in row_parts(s.offsets):
        base = s.offsets[first]
        row, start, end, key = _words(s.data[base : s.offsets[last]], s.offsets[first : last + 1] - base)
        found.append((row + first, start + base, end + base, key))
    if not found:
        return (*[np.zeros(0, dtype=np.int64)] * 3, np.zeros(0, dtype=U64))
    return found[0] if len(found) == 1 else tuple(np.concatenate(v) for v in zip(*found))


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = _LOWER_TABLE[raw]
    space = _SPACE_TABLE[data]
    inner = offsets[offsets < len(data)]
    before, after = np.ones(len(data) + 1, dtype=bool), np.ones(len(data) + 1, dtype=bool)
    before[1:], after[:-1] = space, np.append(space[1:], True)
    before[inner] = True
    after[inner[inner > 0] - 1] = True
    start = np.flatnonzero(~space & before[:-1])
    end = np.flatnonzero(~space & after[:-1]) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return row, start, end, range_hash(prefix_sums(data), start, end)


def shingles(row: np.ndarray, word: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each run of `size` words; a row with fewer words has the whole sequence as one shingle."""
    n = len(word)
    rows, hashes = [], []
    if n >= size:
        total = word[: n - size + 1].copy()
        for k in range(1, size):
            total = total * _BASE + word[k : n - size + 1 + k]
        whole = row[: n - size + 1] == row[size - 1 :]
        rows.append(row[: n - size + 1][whole])
        hashes.append(mix(total[whole] + U64(size)))
    first = np.flatnonzero(np.diff(row, prepend=-1))
    count = np.diff(np.append(first, n))
    for length in range(1, size):
        at = first[count == length]
        total = word[at].copy()
        for k in range(1, length):
            total = total * _BASE + word[at + k]
        rows.append(row[at])
        hashes.append(mix(total + U64(length)))
    rows, hashes = np.concatenate(rows) if rows else row[:0], np.concatenate(hashes) if hashes else word[:0]
    order = np.argsort(rows, kind="stable")
    return rows[order], hashes[order]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


_lean = False
_trim = None


def lean_worker(encoders: bool = False) -> None:
    """Have this Python process give freed arrays back to the system: workers live on between stages beside the executor's JVM.

    The tokenizers of earlier tasks go with the pieces they keep, which are a worker's largest
    holding, unless the task says that it encodes (`encoders`).
    """
    global _lean, _trim
    if not _lean:
        _lean = True
        pa.set_memory_pool(pa.system_memory_pool())
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):  # glibc: a fixed bound beyond which blocks are mapped alone, and an early trim
            libc.mallopt(-3, 1 << 20)
            libc.mallopt(-1, 1 << 20)
        _trim = getattr(libc, "malloc_trim", None)
    held = sys.modules.get(f"{__package__}.tokenizing")  # not there: nothing is held
    if not encoders and held and held.encoder.cache_info().currsize:
        held.encoder.cache_clear()
        trimmed()


def trimmed() -> None:
    """Give back what small freed blocks leave between others."""
    if _trim:
        _trim(0)


UNIT = 4 << 20  # bytes of text whose keys travel together
RANGE = 64 << 20  # bytes of text to a key range, where that makes more ranges than shuffle partitions


def units(batches: Iterable[pa.RecordBatch], text: str = "text", budget: int = UNIT) -> Iterator[Slice]:
    """Slices of about `budget` bytes, for work that reads its input once."""
    lean_worker()
    yield from slices(batches, text, budget)
    trimmed()


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, by one pass over that column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n


def with_units(docs: DataFrame, size: int) -> DataFrame:
    """docs (doc_id, text, and more) with a unit of about UNIT bytes for each row, where all texts have `size` bytes.

    A row's unit follows from its doc_id and text alone. So units are the same whenever
    the input is read again, however its files are split and whichever executors are left.
    """
    units_ = F.lit(max(1, -(-size // UNIT)))
    return docs.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), units_))


def unit_slice(table: pa.Table, *ties: str) -> Slice:
    """All rows of a unit as one slice, by doc_id, text and `ties`: their order does not depend on how they arrived."""
    lean_worker()
    ordered = table.sort_by([(c, "ascending") for c in ("doc_id", "text", *ties)]).combine_chunks()
    return next(slices(ordered.to_batches(), budget=1 << 60))


def buckets(spark: SparkSession, size: int = 0) -> int:
    """Key ranges of an exchange: as many as shuffle partitions, and more where `size` bytes of text would make one range too large for a worker."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE))


def cuts(keys: np.ndarray, n: int) -> list[int]:
    """Places that cut sorted 64-bit keys into n ranges of equal width."""
    bounds = [min((k << 64) // n, (1 << 64) - 1) for k in range(1, n)]
    return [0, *np.searchsorted(keys, np.array(bounds, dtype=U64)).tolist(), len(keys)]


def packed_keys(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).tobytes()


def unpacked(raw: bytes, kind=U64) -> np.ndarray:
    return np.frombuffer(raw, dtype=kind)


def packed_ints(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of bytes, as many as the largest needs: high planes are mostly zero and shrink in any codec."""
    values = np.ascontiguousarray(values).astype(U64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked_ints(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view(U64).ravel()


def packed_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their differences."""
    return packed_ints(np.diff(keys, prepend=U64(0)))


def unpacked_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked_ints(raw), dtype=U64)
