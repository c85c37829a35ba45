"""First months, new payment customers and the N-orders club."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import day, in_months, month_start
from ..operators.ranking import nth, numbered
from .orders import MAX_TOTAL, clean_orders, payment_split, split_measures

SPLIT = ["pix_value", "card_value", "value", "pix_orders", "card_orders", "orders"]


def first_full_month(
    orders: DataFrame, as_of: dt.date, start: dt.date | None = None, max_total: float = MAX_TOTAL
) -> DataFrame:
    """Value of the calendar month after each domain's first order.

    The month must be over at `as_of`; domains without orders in it are left out.
    """
    months = clean_orders(orders, max_total).groupBy("domain_id", F.trunc("created_at", "MM").alias("month")).agg(
        *split_measures(), F.min("created_at").alias("first_in_month")
    )
    # A domain has few months, so the window runs over the small monthly table.
    first = F.min("first_in_month").over(Window.partitionBy("domain_id"))
    cohort = months.withColumn("first_at", first).drop("first_in_month").filter(
        (F.col("month") == F.add_months(F.trunc("first_at", "MM"), 1)) & (F.col("month") < month_start(as_of))
    )
    return cohort.filter(F.col("first_at") >= day(start)) if start else cohort


def month_map(monthly: DataFrame, key: str = "domain_id") -> DataFrame:
    """Months of each key as one sorted map; months per key are few."""
    entry = F.struct(F.date_format("month", "yyyy-MM").alias("k"), F.struct(*SPLIT).alias("v"))
    return monthly.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("months"))


def month_club(
    orders: DataFrame, start: dt.date, end: dt.date, threshold: int = 80, max_total: float = MAX_TOTAL
) -> DataFrame:
    """Domain-months with at least `threshold` orders, and when it was reached.

    `start` and `end` are first days of months; `end` is left out.
    """
    inside = in_months("created_at", start, end)
    months = payment_split(orders, max_total=max_total)
    # A domain has few months, so the window runs over the small monthly table.
    lifetime = F.sum("orders").over(Window.partitionBy("domain_id"))
    members = months.withColumn("lifetime_orders", lifetime).filter(
        (F.col("month") >= day(start)) & (F.col("month") < day(end)) & (F.col("orders") >= threshold)
    )
    window = clean_orders(orders.filter(inside), max_total).withColumn("month", F.trunc("created_at", "MM"))
    reached = nth(
        window.select("domain_id", "month", "created_at"), ["domain_id", "month"], [F.col("created_at")], threshold
    ).withColumnRenamed("created_at", "reached_at")
    return members.join(reached, ["domain_id", "month"])


def club_months(club: DataFrame) -> DataFrame:
    """Months each domain reached the threshold, in one text."""
    key = F.date_format("month", "yyyy-MM")
    return club.groupBy("domain_id").agg(
        F.array_join(F.sort_array(F.collect_set(key)), ",").alias("months_reached"), F.count("*").alias("times")
    )


def headquarters(companies: DataFrame) -> DataFrame:
    """First company of each domain by creation, then id."""
    fields = [c for c in companies.columns if c != "domain_id"]
    first = F.min_by(F.struct(*fields), F.struct("created_at", "company_id"))
    return companies.groupBy("domain_id").agg(first.alias("_hq")).select("domain_id", "_hq.*")


def with_row_number(companies: DataFrame) -> DataFrame:
    """Position of each company in its domain; 1 is the headquarters."""
    order = [F.col("created_at"), F.col("company_id")]
    return numbered(companies, ["domain_id"], order, "row_num")


def new_payment_customers(
    orders: DataFrame, companies: DataFrame, start: dt.date, max_total: float = MAX_TOTAL
) -> DataFrame:
    """Domains whose first pix or card order falls on or after `start`, with totals."""
    paying = orders.filter(F.col("payment_method").isin("PIX", "CREDIT_CARD"))
    totals = clean_orders(paying, max_total).groupBy("domain_id").agg(*split_measures(), F.min("created_at").alias("first_at"))
    hq = headquarters(companies).select("domain_id", F.col("company_id").alias("hq_id"), "status")
    return totals.filter(F.col("first_at") >= day(start)).join(hq, "domain_id")


def finished_first_month(cohort: DataFrame, month: dt.date) -> DataFrame:
    """Cohort rows whose first payment was in the month before `month`."""
    return cohort.filter(F.add_months(F.trunc("first_at", "MM"), 1) == month_start(month))
