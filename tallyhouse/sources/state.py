"""A keyed table in hash buckets that rewrites only what a batch touches.

    root/log/v000000001.json       one file for each version: bucket -> folder, schema, key
    root/data/<commit>/_bucket=k   rows of bucket k as that commit wrote them

A batch is first written by bucket beside the table, so its plan runs once; the
folders it has are the buckets it touches. Only those are read, merged and written
again; the new version names their new folders and the old folders of all others.
A version appears by one rename that fails if the name is taken. A writer that comes second
takes the newer version over: where the other commit touched none of its buckets it
only publishes again, else it merges those again. A job that fails leaves files that no version names.

The number of buckets is fixed when the table is made; take as many as keep a bucket
at a few hundred MB. A version file grows with the buckets, not with the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.skew import hot_join
from . import files

BUCKETS = 64
TRIES = 20


class ConflictError(RuntimeError):
    """Other writers were first too many times."""


def versions(spark: SparkSession, root: str) -> list[str]:
    return [n.removesuffix(".json") for n in files.names(spark, f"{root}/log") if n.startswith("v") and n.endswith(".json")]


def manifest(spark: SparkSession, root: str, version: str | None = None) -> dict | None:
    """What a version holds, by default the last."""
    have = versions(spark, root)
    return json.loads(files.read_text(spark, f"{root}/log/{version or have[-1]}.json")) if have else None


def _rows(spark: SparkSession, head: dict, root: str, buckets: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(head["schema"])
    folders = [f"{root}/data/{head['folders'][b]}" for b in buckets if b in head["folders"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, version: str | None = None) -> DataFrame | None:
    """All rows of a version, nothing if there is none."""
    head = manifest(spark, root, version)
    return None if head is None else _rows(spark, head, root, sorted(head["folders"]))


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_keys(spark: SparkSession, root: str, keys: list) -> DataFrame | None:
    """Rows of some keys; only their buckets are read."""
    head = manifest(spark, root)
    if head is None:
        return None
    kind = T.StructType([f for f in T.StructType.fromJson(head["schema"]) if f.name == head["key"]])
    asked = spark.createDataFrame([(k,) for k in keys], kind)
    touched = sorted({str(r["b"]) for r in asked.select(_bucket(head["key"], head["buckets"]).alias("b")).collect()})
    return _rows(spark, head, root, touched).where(F.col(head["key"]).isin(keys))


def _write_buckets(df: DataFrame, key: str, buckets: int, path: str) -> list[str]:
    """Rows by bucket; the names of the buckets that got any. A bucket with many rows is split over tasks, small ones share one."""
    placed = df.withColumn("_bucket", _bucket(key, buckets)).hint("rebalance", "_bucket")
    placed.write.partitionBy("_bucket").parquet(path)
    return [n.removeprefix("_bucket=") for n in files.names(df.sparkSession, path) if n.startswith("_bucket=")]


def commit(df: DataFrame, root: str, key: str, combine: Callable[[DataFrame | None, DataFrame], DataFrame], buckets: int = BUCKETS) -> str:
    """Publish combine(stored rows of the touched buckets, batch) as the next version; returns its name.

    `combine` may only make rows of keys that it is given.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    head = manifest(spark, root)
    if head and head["key"] != key:
        raise ValueError(f"the table is kept by {head['key']}, not by {key}")
    count, staged = head["buckets"] if head else buckets, f"{root}/staged/{name}"
    merged_from: dict | None = None
    folder, wrote, schema = "", [], None
    try:
        touched = _write_buckets(df, key, count, staged)
        batch = spark.read.schema(df.schema).parquet(staged).drop("_bucket") if touched else df.limit(0)
        for attempt in range(TRIES):
            head = manifest(spark, root)
            before = {b: head["folders"].get(b) for b in touched} if head else {}
            if merged_from is None or before != merged_from:
                if folder:
                    files.delete(spark, f"{root}/data/{folder}")
                folder = f"{name}-{attempt}"
                old = _rows(spark, head, root, touched) if head else None
                merged = combine(old, batch)
                schema = merged.schema
                wrote, merged_from = _write_buckets(merged, key, count, f"{root}/data/{folder}"), before
            folders = {b: f for b, f in head["folders"].items() if b not in touched} if head else {}
            folders |= {b: f"{folder}/_bucket={b}" for b in wrote}
            known = {f.name: f for f in schema.fields}
            others = [f for f in T.StructType.fromJson(head["schema"]).fields if f.name not in known] if head else []
            body = {"commit": name, "key": key, "buckets": count, "folders": folders, "schema": T.StructType([*schema.fields, *others]).jsonValue()}
            done = versions(spark, root)
            version = f"v{int(done[-1][1:]) + 1 if done else 1:09d}"
            # Only the version after the one that was read: in between another writer may have published.
            if (head is None) == (not done) and (not done or json.loads(files.read_text(spark, f"{root}/log/{done[-1]}.json"))["commit"] == head["commit"]):
                if files.write_text_new(spark, f"{root}/log/{version}.json", json.dumps(body)):
                    return version
        raise ConflictError(f"{root}: {TRIES} other versions came first")
    except BaseException:
        if folder:
            files.delete(spark, f"{root}/data/{folder}")
        raise
    finally:
        files.delete(spark, staged)


def merge(df: DataFrame, root: str, key: str, newest: str | None = None, forward: bool = False, buckets: int = BUCKETS) -> str:
    """Update or insert by key: one row for each key.

    `newest` orders rows of one key, whose largest wins; without it a key that
    repeats in `df` is refused. With `forward` a stored row that is newer than all of `df` stays.
    """
    if forward and not newest:
        raise ValueError("forward needs an order")

    def one(rows: DataFrame, order) -> DataFrame:
        body = F.struct(*[c for c in rows.columns if c not in (key, "_arrived")])
        return rows.groupBy(key).agg(F.max_by(body, order).alias("_r")).select(key, "_r.*")

    if newest:
        batch = one(df, F.col(newest))
    else:
        body = F.struct(*[c for c in df.columns if c != key])
        counted = df.groupBy(key).agg(F.first(body).alias("_r"), F.count("*").alias("_n"))
        repeats = F.raise_error(F.concat(F.lit(f"{key} repeats in the batch: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        batch = counted.withColumn("_r", F.when(F.col("_n") == 1, F.col("_r")).otherwise(repeats.cast(counted.schema["_r"].dataType))).select(key, "_r.*")

    def combine(old: DataFrame | None, new: DataFrame) -> DataFrame:
        if old is None:
            return new
        both = new.withColumn("_arrived", F.lit(1)).unionByName(old.withColumn("_arrived", F.lit(0)), allowMissingColumns=True)
        return one(both, F.struct(newest, "_arrived") if forward else F.col("_arrived"))

    return commit(batch, root, key, combine, buckets)


def replace(df: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> str:
    """Rows whose key occurs in `df` are replaced by those of `df`; a key may have many rows. Stored rows without a key stay."""

    def combine(old: DataFrame | None, new: DataFrame) -> DataFrame:
        if old is None:
            return new
        return new.unionByName(hot_join(old, new.select(key).distinct(), [key], "left_anti"), allowMissingColumns=True)

    return commit(df, root, key, combine, buckets)


def drop(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Remove versions but the last `keep`, with the files that only they name; returns their names. Readers of those must be done."""
    have = versions(spark, root)
    gone, kept = have[:-keep], have[-keep:]
    needed = {f for v in kept for f in manifest(spark, root, v)["folders"].values()}
    unused = {f for v in gone for f in manifest(spark, root, v)["folders"].values()} - needed
    for v in gone:
        files.delete(spark, f"{root}/log/{v}.json")
    for f in sorted(unused):
        files.delete(spark, f"{root}/data/{f}")
    for commit_folder in {f.split("/")[0] for f in unused}:
        if not any(n.startswith("_bucket=") for n in files.names(spark, f"{root}/data/{commit_folder}")):
            files.delete(spark, f"{root}/data/{commit_folder}")
    return gone
