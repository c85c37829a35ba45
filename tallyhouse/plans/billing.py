"""Recurring revenue, invoice buckets and subscriptions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import CATEGORIES, EXCLUDED_PLANS, item_categories, recurrence_class
from ..functions.dates import month_start
from ..functions.money import cents, near_zero, sum_if
from ..operators.ranking import top_n


def nps_by_domain(answers: DataFrame) -> DataFrame:
    """Promoters (9-10) minus detractors (0-6) in percent of the answers."""
    score = F.col("score")
    gap = (F.count_if(score >= 9) - F.count_if(score <= 6)).cast("double")
    return answers.groupBy("domain_id").agg(
        near_zero(gap * 100.0 / F.count("*")).alias("nps"), F.count("*").alias("answers")
    )


def mrr_last_month(invoices: DataFrame, bridge: DataFrame, as_of: dt.date) -> DataFrame:
    """Non-canceled invoice value of the last full month per domain, repeats dropped."""
    due = F.col("due_at")
    window = (due >= month_start(as_of, 1).cast("timestamp")) & (due < month_start(as_of).cast("timestamp"))
    value = cents(F.coalesce("item_price_cents", "total_cents")).alias("value")
    rows = invoices.filter(window & (F.col("status") != "canceled")).select("customer_id", "invoice_id", "due_at", value)
    # Added up per customer before the customer meets its domains.
    per_customer = rows.dropDuplicates().groupBy("customer_id").agg(F.sum("value").alias("mrr"))
    return per_customer.join(bridge.distinct(), "customer_id").groupBy("domain_id").agg(F.sum("mrr").alias("mrr"))


def invoice_items(invoices: DataFrame, paid_only: bool = True) -> DataFrame:
    """One row per invoice, customer and item out of repeated ingests.

    Rows without an item, and unless told otherwise those not paid through the
    invoice, are left out. Revenue belongs to the month of creation.
    """
    rows = invoices.filter(F.col("item_id").isNotNull())
    rows = rows.filter(F.col("status") == "paid") if paid_only else rows
    return rows.groupBy("invoice_id", "customer_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("created_at", "item_price_cents", "item_quantity", "item_text")]
    )


def classified_items(items: DataFrame, bridge: DataFrame, excluded: str = EXCLUDED_PLANS) -> DataFrame:
    """Items with a value, split into the six categories, by domain and month."""
    quantity = F.greatest(F.coalesce("item_quantity", F.lit(1)), F.lit(1))
    valued = items.withColumn("item_value", (cents(F.col("item_price_cents")) * quantity).cast("decimal(18,2)"))
    split = valued.filter("item_value <> 0 and created_at is not null").withColumn(
        "parts", item_categories(F.col("item_text"), F.col("item_value"), excluded)
    )
    kept = split.filter("parts is not null").join(bridge.distinct(), "customer_id")
    return kept.select("domain_id", "invoice_id", F.trunc("created_at", "MM").alias("month"), "parts.*")


def _category_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in CATEGORIES]


def _net(df: DataFrame) -> DataFrame:
    total = sum((F.col(c) for c in CATEGORIES if c != "desconto"), F.lit(0)) - F.col("desconto")
    return df.withColumn("total", total)


def revenue_by_month(items: DataFrame) -> DataFrame:
    return _net(
        items.groupBy("month").agg(
            *_category_sums(),
            F.countDistinct("invoice_id").alias("invoices"),
            F.countDistinct("domain_id").alias("domains"),
        )
    )


def revenue_by_domain(items: DataFrame) -> DataFrame:
    return _net(items.groupBy("domain_id").agg(*_category_sums(), F.countDistinct("invoice_id").alias("invoices")))


def revenue_by_domain_month(items: DataFrame) -> DataFrame:
    return _net(items.groupBy("domain_id", "month").agg(*_category_sums()))


def revenue_with_register(revenue: DataFrame, register: DataFrame) -> DataFrame:
    """Revenue by domain with the names of its headquarters, partner and owner; domains off the register have none."""
    head = register.filter("is_hq").select("domain_id", "company_id", F.col("name").alias("domain_name"), "trade_name", "partner_name", "angel_name")
    return head.join(revenue, "domain_id")


def unique_invoices(invoices: DataFrame) -> DataFrame:
    """One row per invoice; the smallest item and status stand for the repeats."""
    # The order is also what is kept, so every field goes through the shuffle once.
    pick = F.min(F.struct("item_id", "due_at", "status", "total_cents", "customer_id", "plan_name"))
    fields = ["customer_id", "status", "due_at", "total_cents", "plan_name"]
    return invoices.groupBy("invoice_id").agg(pick.alias("_i")).select("invoice_id", *[f"_i.{c}" for c in fields])


STATES = ["paid", "pending", "expired", "canceled"]


def _buckets() -> list[Column]:
    """Invoice values by state, their number and as `_first` the earliest invoice with a plan."""
    value, status = cents(F.col("total_cents")), F.col("status")
    plan = F.when(F.col("plan_name") != "", F.struct("due_at", "invoice_id", "plan_name"))
    return [
        sum_if(status.isin("paid", "externally_paid"), value).alias("paid"),
        *[sum_if(status == state, value).alias(state) for state in STATES[1:]],
        F.count("*").alias("invoices"),
        F.min(plan).alias("_first"),
    ]


def status_buckets(invoices: DataFrame, key: str) -> DataFrame:
    """Invoice values by state per key, with the plan of the earliest invoice."""
    return invoices.groupBy(key).agg(*_buckets()).select(key, *STATES, "invoices", F.col("_first.plan_name").alias("plan"))


def invoice_states(invoices: DataFrame, bridge: DataFrame, key: str = "domain_id") -> DataFrame:
    """`status_buckets` and `current_invoice` side by side, per key that a bridge gives customers.

    Both come out of one pass: invoices meet once per customer, and only a row
    per customer meets the bridge. `due_at` is a timestamp here.
    """
    newest = [F.col("due_at").isNull(), -F.unix_micros("due_at")]
    latest = F.min(F.struct((F.col("status") == "canceled").alias("c"), newest[0].alias("n"), newest[1].alias("d"), "invoice_id", "status", "due_at", "total_cents"))
    per = invoices.groupBy("customer_id").agg(*_buckets(), latest.alias("_latest"))
    rows = per.join(bridge.select("customer_id", key), "customer_id").groupBy(key).agg(
        *[F.sum(c).cast(per.schema[c].dataType).alias(c) for c in STATES],
        F.sum("invoices").alias("invoices"), F.min("_first").alias("_first"), F.min("_latest").alias("_latest"),
    )
    return rows.select(
        key, *STATES, "invoices", F.col("_first.plan_name").alias("plan"),
        *[F.col(f"_latest.{c}").alias(c) for c in ("invoice_id", "status", "due_at")], cents(F.col("_latest.total_cents")).alias("fee"),
    )


def current_invoice(invoices: DataFrame, key: str) -> DataFrame:
    """Latest invoice that is not canceled, else the latest one."""
    order = [(F.col("status") == "canceled").asc(), F.desc("due_at"), F.asc("invoice_id")]
    rows = top_n(invoices.select(key, "invoice_id", "status", "due_at", "total_cents"), [key], order)
    return rows.withColumn("fee", cents(F.col("total_cents"))).drop("total_cents")


def latest_invoices(invoices: DataFrame, key: str, n: int = 12) -> DataFrame:
    """Last `n` invoices per key, newest first."""
    return top_n(invoices, [key], [F.desc("due_at"), F.asc("invoice_id")], n, "position")


def latest_subscription(subscriptions: DataFrame, key: str) -> DataFrame:
    """Active subscriptions first, then the latest change."""
    order = [F.desc("active"), F.desc_nulls_last("updated_at"), F.asc("subscription_id")]
    return top_n(subscriptions, [key], order)


def last_paid_invoice(invoices: DataFrame, key: str) -> DataFrame:
    """Value of the last paid invoice, after repeats are dropped."""
    paid = invoices.filter(F.col("status").isin("paid", "externally_paid"))
    unique = paid.select(key, "invoice_id", "due_at", "total_cents").dropDuplicates()
    best = F.max(F.struct("due_at", "invoice_id", "total_cents")).alias("_i")
    return unique.groupBy(key).agg(best).select(key, "_i.*").withColumn("last_value", cents(F.col("total_cents"))).drop("total_cents")


def recurrence_totals(invoices: DataFrame) -> DataFrame:
    """Invoices by state and automatic payment."""
    return invoices.groupBy(recurrence_class(F.col("status"), F.col("has_automatic")).alias("class")).agg(
        F.count("*").alias("invoices"), F.sum(cents(F.col("total_cents"))).alias("value")
    )


def invoices_of_class(invoices: DataFrame, wanted: str) -> DataFrame:
    return invoices.filter(recurrence_class(F.col("status"), F.col("has_automatic")) == wanted)
