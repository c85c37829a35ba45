"""Union of order sources where older records pair off with newer ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def surplus(newer: DataFrame, older: Sequence[DataFrame], keys: Sequence[str], record: str) -> DataFrame:
    """Older records left after each newer record cancels one with equal keys.

    `older` is in order of priority: the first source cancels first. Within a
    source records go in a fixed hash order of `record`, and a hot key is spread
    over the leading digits of that hash. How many rows a slice loses follows
    from counts alone, so the rows themselves are shuffled once. Records with a
    null key never pair.
    """
    pool = None
    for level, frame in enumerate(older):
        part = frame.withColumn("_level", F.lit(level))
        pool = part if pool is None else pool.unionByName(part, allowMissingColumns=True)
    paired = F.lit(True)
    for key in keys:
        paired = paired & F.col(key).isNotNull()
    mark = F.md5(F.col(record).cast("string"))
    rows = pool.filter(paired).withColumn("_slice", F.substring(mark, 1, 2))

    have = newer.groupBy(*keys).agg(F.count("*").alias("_have"))
    slices = rows.groupBy(*keys, "_level", "_slice").agg(F.count("*").alias("_n")).join(have, list(keys), "left")
    whole_key = Window.partitionBy(*keys)
    used = F.coalesce(F.sum("_n").over(whole_key.orderBy("_level").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = F.sum("_n").over(Window.partitionBy(*keys, "_level").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    budget = slices.select(
        *keys, "_level", "_slice",
        # Newer records left for this source, less the rows of earlier slices.
        (F.greatest(F.coalesce("_have", F.lit(0)) - used, F.lit(0)) - F.coalesce(before, F.lit(0))).alias("_drop"),
    )
    place = [*keys, "_level", "_slice"]
    position = F.row_number().over(Window.partitionBy(*place).orderBy(mark, record))
    kept = rows.join(budget, place).withColumn("_position", position).filter(F.col("_position") > F.col("_drop"))
    return kept.drop("_position", "_drop", "_slice", "_level").unionByName(pool.filter(~paired).drop("_level"))
