"""As-of join: the latest right row at or before each left row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .ranking import ranged


def asof_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, tie: Sequence[str]) -> DataFrame:
    """Each left row with struct `match` of the latest right row not after it.

    Among right rows of the same instant the smallest `tie` columns win. A prefix
    scan: both sides are cut into ranges of (key, time), each range hands its last
    right row on to the next, and rows look back inside their range or to what was handed
    on. So a key with all rows, in one hour or in one instant, spreads over all tasks.
    """
    payload = [right_ts, *[c for c in right.columns if c not in (on, right_ts, *tie)]]
    instants = (
        right.filter(F.col(on).isNotNull() & F.col(right_ts).isNotNull())
        .groupBy(on, F.col(right_ts).alias("_ts"))
        .agg(F.min(F.struct(*tie, *payload)).alias("_match"))
    )
    usable = F.col(on).isNotNull() & F.col(left_ts).isNotNull()
    hashable = [f.name for f in left.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    lines = left.filter(usable).select(
        on, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.xxhash64(*hashable).alias("_tie"), F.struct(*left.columns).alias("_row")
    )
    # Right rows sort before left rows of the same instant.
    both = lines.unionByName(instants.withColumns({"_side": F.lit(0), "_tie": F.lit(0).cast("long")}), allowMissingColumns=True)
    spread = ranged(both, [F.col(on), F.col("_ts"), F.col("_side")], F.col("_tie"))

    right_row = F.when(F.col("_match").isNotNull(), F.struct(F.col(on).alias("_on"), "_ts", "_match"))
    ends = spread.groupBy("_range").agg(F.max(right_row).alias("_end"))
    # One row for each range: the last right row of all ranges before it.
    handed = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    everyone = left.sparkSession.range(ranges).select(F.col("id").cast("int").alias("_range")).join(F.broadcast(ends), "_range", "left")
    carried = everyone.select("_range", F.last("_end", ignorenulls=True).over(handed).alias("_carried"))
    inside = Window.partitionBy("_range", on).orderBy("_ts", "_side")
    own = F.last("_match", ignorenulls=True).over(inside)
    earlier = F.when(F.col("_carried._on") == F.col(on), F.col("_carried._match"))
    matched = (
        spread.withColumn("_own", own)
        .filter(F.col("_row").isNotNull())
        .join(F.broadcast(carried), "_range")
        .select("_row.*", F.coalesce("_own", earlier).alias("match"))
    )
    return matched.unionByName(left.filter(~F.coalesce(usable, F.lit(False))), allowMissingColumns=True)
