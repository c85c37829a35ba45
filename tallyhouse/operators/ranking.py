"""Top rows per key and exact row numbers that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, name: str | None = None) -> DataFrame:
    """First `n` rows per key.

    `row_number() <= n` becomes a group limit on the map side, so each task
    ships at most `n` rows of a key however many the key holds.
    """
    rn = name or "_rn"
    ranked = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(rn) <= n)
    return kept if name else kept.drop(rn)


def nth(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Exactly the n-th row per key, with the same group limit."""
    return top_n(df, keys, order, n, "_nth").filter(F.col("_nth") == n).drop("_nth")


def ranged(df: DataFrame, order: Sequence[Column], tie: Column | None = None) -> DataFrame:
    """Rows in ranges of an order, with the range as `_range`; written once, so that every later read sees the same ranges.

    Rows that are equal in the order stay in one range unless `tie` tells them apart.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.repartitionByRange(ranges, *order, *([tie] if tie is not None else []))
    return cut_lineage(sliced.withColumn("_range", F.spark_partition_id()))


def globally_numbered(df: DataFrame, order: Sequence[Column], name: str = "rn") -> DataFrame:
    """Exact row number over the whole frame; only counts of ranges meet in one task."""
    return numbered(df, [], order, name)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rn") -> DataFrame:
    """Exact row number per key, by a prefix scan that needs no key in one task.

    Rows are cut into ranges of (keys, order) and numbered inside (range, key). A key
    goes on from one range into the next only where it is the last there and the first here, so one row for each range
    carries the count on. A key with all rows spreads over all ranges, whatever its order
    looks like; only rows that are equal in keys and order stay together. Null keys are a key.
    """
    spread = ranged(df, [*[F.col(k) for k in keys], *order])
    key = F.struct(F.lit(0).alias("_"), *keys)
    ends = spread.groupBy("_range").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    counts = cut_lineage(spread.withColumn("_key", key).join(F.broadcast(ends), "_range").groupBy("_range", "first", "last").agg(
        F.count_if(F.col("_key") == F.col("last")).alias("n_last")
    ))  # a row for each range
    # Rows of a range's first key in earlier ranges: those that end with the same key, without a break.
    along = Window.partitionBy("last").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("_through", F.sum("n_last").over(along)).select("_range", "last", "_through")
    here = counts.select(F.col("_range").alias("_at"), "first")
    before = here.join(running, (F.col("last") == F.col("first")) & (F.col("_range") < F.col("_at"))).groupBy("_at").agg(F.max("_through").alias("_before"))
    carried = here.join(before, "_at", "left").select(F.col("_at").alias("_range"), F.col("first").alias("_first"), F.coalesce("_before", F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    joined = spread.withColumn("_in_range", inside).join(F.broadcast(carried), "_range")
    more = F.when(F.col("_first") == key, F.col("_before")).otherwise(F.lit(0))
    return joined.withColumn(name, (F.col("_in_range") + more).cast("long")).drop("_in_range", "_range", "_first", "_before")
