"""Tables that lie bucketed and sorted by a key, so that merging into them moves the new rows only.

A table is a Parquet folder of Spark's own bucketed layout under a catalog name. Both sides of
a merge meet bucket by bucket: the stored side is neither shuffled nor (with `spark.sql.legacy.bucketedTableScan.outputOrdering`) sorted, the batch is
dealt to as many tasks, and each task writes its bucket of the next table. The number of buckets
stays; take as many as keep a bucket at some hundred MB (`buckets_for` a number of rows).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


ROWS = 1_000_000  # rows of a bucket, which one task sorts


def buckets_for(rows: int, least: int = 16) -> int:
    """Buckets of a new table, so that a bucket holds at most about ROWS rows however large the table is."""
    return max(least, -(-rows // ROWS))


def write(df: DataFrame, table: str, path: str, key: str, buckets: int, dealt: bool = False) -> None:
    """Write one sorted file for each bucket; `dealt` rows lie in their bucket's task already."""
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)


def attach(spark: SparkSession, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Name a folder that `write` made, where the catalog does not know it (any more)."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def merged(stored: DataFrame, batch: DataFrame, key: str, buckets: int, choose: Callable[[str], object]) -> DataFrame:
    """Stored rows and a batch that is unique by key, side by side: `choose(column)` takes from struct `_old` or `_new`, of which one may be null."""
    old = stored.select(key, F.struct(*stored.columns).alias("_old"))
    new = batch.repartition(buckets, key).select(key, F.struct(*stored.columns).alias("_new"))
    both = old.join(new.hint("merge"), key, "full")
    return both.select(F.col(key), *[choose(c).alias(c) for c in stored.columns if c != key])
