"""Guards that stop a write, and counters for reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import hot_join


class QualityError(RuntimeError):
    """A guard refused the output."""


# Measures that a write takes along (`sinks.publish_audited`): no second run of the plan.


def order_measures() -> dict[str, Column]:
    return {
        "orders": F.count("*"),
        "months": F.size(F.collect_set(F.trunc("created_at", "MM"))).cast("long"),
        "without_status": F.count_if(F.coalesce("payment_status", F.lit("")) == ""),
    }


def mart_measures() -> dict[str, Column]:
    return {"companies": F.count("*"), "value": F.coalesce(F.sum("value"), F.lit(0)), "orders": F.coalesce(F.sum("orders"), F.lit(0))}


def row_measures() -> dict[str, Column]:
    return {"rows": F.count("*")}


# Smallest share of the previous run that each measure may fall to.
FLOORS = {"companies": 0.8, "value": 0.5, "orders": 0.5}


def _measured(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return df.agg(*[m.alias(name) for name, m in measures.items()])


def check_orders(facts: Mapping, stop_share: float = 0.6, warn_share: float = 0.2) -> list[str]:
    """Stop on empty input or mostly missing status; return warnings."""
    if not facts["orders"] and not facts["months"]:
        raise QualityError("no orders and no months")
    share = facts["without_status"] / max(facts["orders"], 1)
    if share > stop_share:
        raise QualityError(f"{share:.0%} of the orders have no status")
    return [f"{share:.0%} of the orders have no status"] if share > warn_share else []


def check_regression(now: Mapping, before: Mapping | None, floors: Mapping[str, float] = FLOORS) -> list[str]:
    """Stop if the new mart is far smaller than the previous one; nothing to compare with passes."""
    for measure, floor in floors.items():
        if before and float(before[measure] or 0) and float(now[measure]) < float(before[measure]) * floor:
            raise QualityError(f"{measure} fell from {before[measure]} to {now[measure]}")
    return []


def check_row_loss(now: Mapping, before: Mapping | None, max_loss: float = 0.1) -> list[str]:
    if before and now["rows"] < before["rows"] * (1 - max_loss):
        raise QualityError(f"rows fell from {before['rows']} to {now['rows']}")
    return []


def order_quality(orders: DataFrame) -> DataFrame:
    """One row: orders, months and orders without a status."""
    return _measured(orders, order_measures())


def guard_orders(orders: DataFrame, stop_share: float = 0.6, warn_share: float = 0.2) -> list[str]:
    """check_orders over a frame that is not being written."""
    return check_orders(order_quality(orders).first().asDict(), stop_share, warn_share)


def mart_size(mart: DataFrame) -> DataFrame:
    return _measured(mart, mart_measures())


def guard_regression(new: DataFrame, previous: DataFrame, floors: Mapping[str, float] = FLOORS) -> None:
    """check_regression over two frames that are not being written."""
    check_regression(mart_size(new).first().asDict(), mart_size(previous).first().asDict(), floors)


def guard_row_loss(merged: DataFrame, previous: DataFrame, max_loss: float = 0.1) -> None:
    check_row_loss({"rows": merged.count()}, {"rows": previous.count()}, max_loss)


def unmatched(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys without a partner."""
    lost = hot_join(rows, lookup.select(key).distinct(), [key], "left_anti")
    return lost.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"))


def or_previous(new: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values of the previous run where the new ones are missing or empty."""
    theirs = previous.select(key, *[F.col(c).alias(f"_p_{c}") for c in columns])
    joined = new.join(theirs, key, "left")

    def pick(c: str):
        mine = F.nullif(F.col(c), F.lit("")) if dict(new.dtypes)[c] == "string" else F.col(c)
        return F.coalesce(mine, f"_p_{c}").alias(c)

    return joined.select(*[pick(c) if c in columns else F.col(c) for c in new.columns])


def or_previous_table(new: DataFrame, previous: DataFrame) -> DataFrame:
    """The previous table where the new one has no rows."""
    return previous if new.isEmpty() else new


def profile(df: DataFrame) -> DataFrame:
    """Rows, filled values and distinct values per column, in one pass."""
    columns = df.columns
    per = df.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"f_{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"f_{i}").alias("filled"), F.col(f"d_{i}").alias("distinct")) for i, c in enumerate(columns)]
    )
    return per.select(F.inline(entries))


def exact_profile(df: DataFrame) -> DataFrame:
    """The same with exact distinct counts, by digests so that long texts are not shuffled."""
    texts = F.array(
        *[F.struct(F.lit(c).alias("column"), F.sha2(F.col(c).cast("string"), 256).alias("value")) for c in df.columns]
    )
    values = df.select(F.inline(texts)).groupBy("column", "value").agg(F.count("*").alias("n"))
    return values.groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"),
        F.count("value").alias("distinct"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


# --- profiles of many days from stored sketches --------------------------------

PRECISION = 12  # log2 of a sketch's registers; one sketch takes some KB at most
ERROR = 3 * 1.04 / 2 ** (PRECISION / 2)  # three standard errors of an estimate


def day_sketches(df: DataFrame, day: str) -> DataFrame:
    """Rows, filled values and a sketch of the distinct values of each column, for each day: one row for each (day, column).

    Sketches merge, so a profile of many days reads none of them again. One aggregation, no row is multiplied.
    """
    columns = [c for c in df.columns if c != day]
    per = df.groupBy(F.col(day).alias("day")).agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"f_{i}") for i, c in enumerate(columns)],
        *[F.hll_sketch_agg(F.col(c).cast("string"), PRECISION).alias(f"s_{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"f_{i}").alias("filled"), F.col(f"s_{i}").alias("sketch")) for i, c in enumerate(columns)
    ])
    return per.select("day", F.inline(entries))


def sketched_profile(sketches: DataFrame) -> DataFrame:
    """Rows, filled values and about how many distinct values per column, over all days of the sketches."""
    united = sketches.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.hll_union_agg("sketch").alias("sketch"))
    return united.select("column", "rows", "filled", F.hll_sketch_estimate("sketch").alias("distinct"))
