"""Domain panel: monthly feature flags and order totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_true_text

FLAGS = [
    "has_orders", "over25", "over80", "integration_on", "payment_on", "freight_on", "assistant_on",
    "lost25", "lost80", "lost_integration", "lost_payment", "lost_freight",
]
STICKY = ["integration_on", "payment_on", "freight_on", "assistant_on"]
# Order of the 13 values in an exported month vector.
VECTOR = [
    "orders", "gmv", "over25", "over80", "integration_on", "payment_on", "freight_on", "assistant_on",
    "lost25", "lost80", "lost_integration", "lost_payment", "lost_freight",
]


def with_flags(rows: DataFrame) -> DataFrame:
    """Text flags as booleans."""
    return rows.withColumns({f: is_true_text(F.col(f)) for f in FLAGS})


def panel_months(rows: DataFrame) -> DataFrame:
    """Domains, value and flag counts per month."""
    return with_flags(rows).groupBy("month").agg(
        F.count("*").alias("domains"), F.sum("gmv").alias("gmv"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS]
    )


def sticky_flags(rows: DataFrame) -> DataFrame:
    """Features a domain ever had."""
    return with_flags(rows).groupBy("domain_id").agg(*[F.bool_or(f).alias(f) for f in STICKY])


def month_vector(rows: DataFrame) -> DataFrame:
    """13 numbers per domain and month, for exports."""
    flagged = with_flags(rows)
    values = [F.col(c).cast("double") if c in ("orders", "gmv") else F.col(c).cast("int").cast("double") for c in VECTOR]
    return flagged.select("domain_id", F.date_format("month", "yyyy-MM").alias("month"), F.array(*values).alias("vector"))


def domain_order_totals(orders: DataFrame) -> DataFrame:
    """Orders, value, orders paid through the platform and posted orders."""
    return orders.groupBy("domain_id").agg(
        F.count("*").alias("orders"),
        F.sum("total").alias("gmv"),
        F.count_if(F.col("payment_method").isin("PIX", "CREDIT_CARD")).alias("payment_orders"),
        F.count_if(F.col("label_url").isNotNull()).alias("freight_orders"),
    )


def domain_panel(rows: DataFrame, orders: DataFrame) -> DataFrame:
    return sticky_flags(rows).join(domain_order_totals(orders), "domain_id", "left")
