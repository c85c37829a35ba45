"""Joins whose left side may hold one key in a third of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A key is hot above 1/SHARE of the left rows, so there are fewer than SHARE of them.
SHARE = 1000


def hot_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", weight: str | None = None,
    counted: DataFrame | None = None, unique: bool = False, few: int = 0,
) -> DataFrame:
    """Equi-join to a right side that is unique on `on`: left, inner, left_semi or left_anti.

    A key that repeats on the right stops the job, where it would multiply rows; only
    `unique`, for a right side that was just grouped by these keys, leaves that check out. For
    left_semi and left_anti repeats do no harm. A null key on the right matches nothing.

    Adaptive execution splits a hot partition only where both sides come
    straight out of a shuffle, which a right side aggregated on the key does
    not. Here hot keys are found by counting; their right rows, fewer than SHARE
    by definition, are broadcast, and their left rows pass the shuffle spread
    over many slices, as do left rows with a null key. All other keys hold too
    few rows to matter and meet in the shuffle.

    `weight` names a right column that already holds the left rows per key.
    Otherwise the rows of `counted` are counted, by default the left side: a
    frame with the same keys that is cheaper to read than a left side made of joins.

    A right side that turns out to have at most `few` rows is broadcast whole and the left side
    not shuffled at all. It is counted for that, so it should be cheap to read twice.
    """
    on = list(on)
    right = right.dropna(subset=on)
    payload = [c for c in right.columns if c not in on]
    body = F.struct(F.lit(True).alias("_hit"), *payload)
    if how in ("left_semi", "left_anti"):
        right = right.select(*on, *([weight] if weight else [])).distinct()
        payload = [c for c in right.columns if c not in on]
        body = F.struct(F.lit(True).alias("_hit"), *payload)
    elif not unique:
        # Grouped by the join keys, so a side that is partitioned by them is not shuffled again.
        right = right.groupBy(*on).agg(F.first(body).alias("_body"), F.count("*").alias("_rows"))
        named = F.concat_ws(", ", *[F.col(key).cast("string") for key in on])
        repeated = F.raise_error(F.concat(F.lit(f"the right side repeats a key of ({', '.join(on)}): "), named))
        body = F.when(F.col("_rows") == 1, F.col("_body")).otherwise(repeated.cast(right.schema["_body"].dataType))
        right = right.select(*on, body.alias("_found")).select(*on, *[F.col(f"_found.{c}").alias(c) for c in payload], "_found")
        body = F.col("_found")
    packed = right.select(*on, body.alias("_found"))
    if few and packed.select(*on).limit(few + 1).count() <= few:
        return _matched(left.join(F.broadcast(packed.withColumnRenamed("_found", "_match")), on, "left"), left.columns, payload, how)
    if weight:
        counts = right.select(*on, F.col(weight).alias("_n"))
        total = counts.agg(F.sum("_n")).scalar()
        hot = right.filter(F.col(weight) * SHARE > total).select(*on, body.alias("_found"))
    else:
        counts = (left if counted is None else counted).groupBy(*on).agg(F.count("*").alias("_n"))
        total = counts.agg(F.sum("_n")).scalar()
        keys = counts.filter(F.col("_n") * SHARE > total).select(*on)
        hot = keys.join(packed, on, "left")
    hot = hot.select(*on, F.struct("_found").alias("_hot"))

    # Stable over retries: it depends on the row and its input partition only.
    hashable = [f.name for f in left.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    somewhere = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.lit(4096)) + 1
    dead = F.lit(False)
    for key in on:
        dead = dead | F.col(key).isNull()
    marked = left.join(F.broadcast(hot), on, "left")
    marked = marked.withColumn("_slice", F.when(dead | F.col("_hot").isNotNull(), somewhere).otherwise(F.lit(0)))
    # Zero, but not a literal, which the optimizer would take out of the join key.
    cold = packed.withColumn("_slice", F.pmod(F.xxhash64(*on), F.lit(1))).withColumnRenamed("_found", "_cold")
    joined = marked.join(cold, [*on, "_slice"], "left")
    return _matched(joined.withColumn("_match", F.coalesce("_hot._found", "_cold")), left.columns, payload, how)


def _matched(found: DataFrame, columns: Sequence[str], payload: Sequence[str], how: str) -> DataFrame:
    """Rows that the kind of join keeps, with what `_match` found for them."""
    if how in ("inner", "left_semi"):
        found = found.filter("_match._hit")
    elif how == "left_anti":
        found = found.filter("_match._hit is null")
    if how in ("left_semi", "left_anti"):
        return found.select(*columns)
    return found.select(*columns, *[F.col(f"_match.{c}").alias(c) for c in payload])
