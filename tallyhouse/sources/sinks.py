"""Writers: overwrite, snapshots, versions, audited versions, current state by key, exports.

Every writer stages its files beside the target and publishes them by a rename, so a
failing job leaves what was there before.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.ranking import globally_numbered
from . import files, state


def _staged(path: str) -> str:
    """A folder beside the target that no reader looks into."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.staged-{name}-{uuid.uuid4().hex}"


def _publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write into a staged folder and put it in the place of `path` when all of it is there."""
    staged = _staged(path)
    try:
        write(staged)
        files.replace_folder(spark, staged, path)
    finally:
        files.delete(spark, staged)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a folder and its schema; `df` may read the folder that it replaces."""
    _publish(df.sparkSession, path, lambda staged: df.write.parquet(staged))


def append_snapshot(df: DataFrame, path: str, day: dt.date) -> None:
    """One dated partition per run; a repeated run replaces its own day."""
    rows = df.withColumn("snapshot_date", F.lit(day).cast("date"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Finished versions of a table folder, oldest first."""
    return [n for n in files.names(spark, root, only_folders=True) if n.startswith("v") and files.exists(spark, f"{root}/{n}/_SUCCESS")]


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """Latest version of a table, nothing if there is none."""
    if files.exists(spark, f"{root}/log"):
        return state.read(spark, root)
    done = _versions(spark, root)
    return spark.read.parquet(f"{root}/{done[-1]}") if done else None


def _next_version(spark: SparkSession, root: str, staged: str) -> str:
    """Publish a staged folder under the next free name; a writer that was first only moves it on by one."""
    while True:
        done = files.names(spark, root, only_folders=True)
        last = max((int(n[1:]) for n in done if n[:1] == "v" and n[1:].isdigit()), default=0)
        if files.move_new(spark, staged, f"{root}/v{last + 1:09d}"):
            return f"v{last + 1:09d}"


def write_version(df: DataFrame, root: str) -> str:
    """Write the next version beside the old ones, so readers never see half a table."""
    staged = f"{root}/.staged-{uuid.uuid4().hex}"
    try:
        df.write.parquet(staged)
        return _next_version(df.sparkSession, root, staged)
    finally:
        files.delete(df.sparkSession, staged)


def facts_of(spark: SparkSession, root: str) -> dict | None:
    """Measures that the last audited version was published with."""
    done = [v for v in _versions(spark, root) if files.exists(spark, f"{root}/{v}/_facts.json")]
    return json.loads(files.read_text(spark, f"{root}/{done[-1]}/_facts.json")) if done else None


def publish_audited(df: DataFrame, root: str, measures: Mapping[str, Column], audit: Callable[[dict, dict | None], list[str]]) -> tuple[str, list[str]]:
    """Write, audit, publish: the measures are taken while the one write runs.

    `audit(now, before)` gets them and those of the last published version, raises to
    refuse the output, which is then removed, or returns warnings. Returns the new
    version's name and the warnings.
    """
    spark, seen = df.sparkSession, Observation()
    staged = f"{root}/.staged-{uuid.uuid4().hex}"
    try:
        df.observe(seen, *[m.alias(name) for name, m in measures.items()]).write.parquet(staged)
        now = {k: v if isinstance(v, (int, float, str, type(None))) else str(v) for k, v in seen.get.items()}
        warnings = audit(now, facts_of(spark, root))
        files.write_text(spark, f"{staged}/_facts.json", json.dumps(now))
        return _next_version(spark, root, staged), list(warnings or [])
    finally:
        files.delete(spark, staged)


def replace_keys(df: DataFrame, root: str, key: str, buckets: int = state.BUCKETS) -> str:
    """Rows whose key occurs in `df` are replaced by those of `df`; only the buckets of those keys are written again."""
    return state.replace(df, root, key, buckets)


def merge_current(df: DataFrame, root: str, key: str, newest: str | None = None, forward: bool = False, buckets: int = state.BUCKETS) -> str:
    """Update or insert by key: one row per key, the newest of `df` if it repeats; only touched buckets are written again.

    Without `newest` a key that repeats is refused. With `forward` a stored row that is newer than all of `df` stays.
    """
    return state.merge(df, root, key, newest, forward, buckets)


def drop_versions(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Remove finished versions but the last `keep`; returns their names. Readers of those must be done."""
    if files.exists(spark, f"{root}/log"):
        return state.drop(spark, root, keep)
    gone = _versions(spark, root)[:-keep]
    for name in gone:
        files.delete(spark, f"{root}/{name}")
    return gone


def write_csv(df: DataFrame, path: str, sep: str = ";", bom: bool = True, single: bool = False) -> None:
    """CSV with a header; `bom` marks UTF-8 for spreadsheets.

    With `single` all tasks write their parts, without headers, and the parts are joined in
    their order to one file, part-all.csv.
    """
    spark = df.sparkSession
    if bom:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    options = {"sep": sep, "quote": '"', "escape": '"'}

    def write(staged: str) -> None:
        if not single:
            df.write.options(**options, header=True).csv(staged)
            return
        quoted = ['"' + c.replace('"', '""') + '"' if any(x in c for x in (sep, '"', "\n")) else c for c in df.columns]
        df.write.options(**options, header=False).csv(f"{staged}/parts")
        files.write_text(spark, f"{staged}/parts/.header", sep.join(quoted) + "\n")
        parts = [n for n in files.names(spark, f"{staged}/parts") if n.startswith("part-")]
        files.join_files(spark, [f"{staged}/parts/{n}" for n in (".header", *parts)], f"{staged}/part-all.csv")
        files.delete(spark, f"{staged}/parts")

    _publish(spark, path, write)


JSON_ROWS = 500_000  # rows of a file: a compressed file is read by one task


def write_json(df: DataFrame, path: str) -> None:
    """Objects, one to a line, in compressed files: names repeat in every line, so a tenth or so of the bytes is left."""
    _publish(df.sparkSession, path, lambda staged: df.write.option("compression", "gzip").option("maxRecordsPerFile", JSON_ROWS).json(staged))


def chunk_map(counts: DataFrame, size: int = 50) -> DataFrame:
    """Chunk of each company, `size` companies per chunk, most orders first.

    Needs company_id and orders.
    """
    order = [F.desc("orders"), F.asc("company_id")]
    return globally_numbered(counts.select("company_id", "orders"), order, "_rn").select(
        "company_id", F.floor((F.col("_rn") - 1) / size).cast("int").alias("chunk")
    )


def write_chunks(records: DataFrame, chunks: DataFrame, path: str) -> None:
    """Records in one folder per chunk, beside the map from company to chunk; both appear together.

    Records are clustered by chunk first: a task opens few chunks, and only a chunk with very many rows has several files.
    """
    joined = records.join(chunks, "company_id").hint("rebalance", "chunk")

    def write(staged: str) -> None:
        chunks.write.parquet(f"{staged}/chunk_map")
        joined.write.partitionBy("chunk").json(f"{staged}/records")

    _publish(records.sparkSession, path, write)


def stamped(df: DataFrame, source: str, loaded_at: dt.datetime) -> DataFrame:
    """Constant source and load-time columns."""
    return df.withColumns({"source": F.lit(source), "loaded_at": F.lit(loaded_at).cast("timestamp")})
