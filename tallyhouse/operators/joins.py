"""Join shapes shared by several jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .skew import hot_join


def overlay(
    base: DataFrame, other: DataFrame, on: str, fill: Sequence[str] = (), force: Sequence[str] = ()
) -> DataFrame:
    """Fill empty columns from `other`; `force` columns take its value where it has one."""
    theirs = other.select(on, *[F.col(c).alias(f"_o_{c}") for c in (*fill, *force)])

    def pick(c: str) -> Column:
        mine, their = F.col(c), F.col(f"_o_{c}")
        if c in fill:
            return F.coalesce(F.nullif(mine, F.lit("")), their, mine).alias(c)
        if c in force:
            return F.coalesce(F.nullif(their, F.lit("")), mine).alias(c)
        return mine

    return base.join(theirs, on, "left").select(*[pick(c) for c in base.columns])


def fallback_key(rows: DataFrame, first: str, second: str, registry: DataFrame, owner: str) -> DataFrame:
    """Column `owner`: `first` if registered, else the owner of `second`, else no row.

    `registry` holds unique (first, second) pairs; `second` maps to the smallest id.
    """
    known = registry.select(F.col(first).alias("_known")).distinct()
    by_second = registry.groupBy(second).agg(F.min(first).alias("_owner"))
    known = known.select(F.col("_known").alias(first), "_known")
    joined = hot_join(hot_join(rows, known, [first], unique=True), by_second, [second], counted=rows, unique=True)
    found = joined.withColumn(owner, F.coalesce("_known", "_owner")).drop("_known", "_owner")
    return found.filter(F.col(owner).isNotNull())


def attach_to_headquarters(companies: DataFrame, totals: DataFrame, domain: str, measures: Sequence[str]) -> DataFrame:
    """Domain totals on the headquarters row; branches get zero.

    `companies` carries boolean `is_hq`.
    """
    joined = companies.join(totals, domain, "left")
    values = [
        F.when(F.col("is_hq"), F.coalesce(F.col(m), F.lit(0))).otherwise(F.lit(0)).alias(m) for m in measures
    ]
    return joined.select(*companies.columns, *values)


def summed_union(parts: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sources added up by key; a key may occur in any of them."""
    total = None
    for part in parts:
        slim = part.select(*keys, *measures)
        total = slim if total is None else total.unionByName(slim)
    return total.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def newest_by_key(sources: Sequence[DataFrame], key: str, ties: Sequence[str] = ()) -> DataFrame:
    """Rows of all sources by key, the first source that has the key winning."""
    pool = None
    for level, frame in enumerate(sources):
        part = frame.withColumn("_level", F.lit(level))
        pool = part if pool is None else pool.unionByName(part, allowMissingColumns=True)
    body = F.struct(*[c for c in pool.columns if c not in (key, "_level")])
    rank = F.struct("_level", *ties)
    return pool.groupBy(key).agg(F.min_by(body, rank).alias("_row")).select(key, "_row.*")
