"""Freight: postings, margins and the half-month reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import is_posted
from ..functions.dates import day, half_month_end, half_month_start
from ..functions.money import MONEY, money_br, money_text, zero
from ..functions.text import clean_domain_id, compare_key, digits, state_key
from ..session import cut_lineage
from ..operators.ranking import top_n
from ..operators.skew import hot_join

MARKUP = "1.10"


def _marked_up(c: Column) -> Column:
    return (c.cast(MONEY) * F.lit(MARKUP).cast("decimal(3,2)")).cast(MONEY)


def postings(close: DataFrame) -> DataFrame:
    """Posting cost per volume code, split into domain and order number."""
    whole = close.filter(F.col("volume_code").rlike("^[0-9]+_[0-9]+$"))
    return whole.groupBy(
        F.split_part("volume_code", F.lit("_"), F.lit(1)).cast("bigint").alias("domain_id"),
        F.split_part("volume_code", F.lit("_"), F.lit(2)).cast("bigint").alias("order_number"),
    ).agg(
        F.sum(money_br(F.col("posting_text"))).cast(MONEY).alias("posting"),
        F.max("operator").alias("operator"),
        F.max("posted_on").alias("posted_on"),
        F.max("sheet_status").alias("sheet_status"),
    )


def freight_orders(orders: DataFrame, close: DataFrame, zero_quote_is_missing: bool = False) -> DataFrame:
    """Posted orders with quote, posting cost, final price and margin.

    The final price is the larger of the quote and the marked-up posting cost.
    """
    posted = orders.filter(is_posted(F.col("delivery_provider"))).withColumn("domain_id", clean_domain_id(F.col("domain_id")))
    dated = posted.filter("domain_id is not null and created_at is not null")
    # A domain has an order number once, so no key of this join is hot.
    rows = dated.join(postings(close), ["domain_id", "order_number"], "left")
    quote = F.when(F.col("quoted") > 0, F.col("quoted")) if zero_quote_is_missing else F.col("quoted")
    up = _marked_up(F.col("posting"))
    return rows.select(
        "order_id", "domain_id", "order_number", F.to_date("created_at").alias("day"), "delivery_provider",
        "order_status", "is_canceled", "total", "quoted", "posting", "operator", "posted_on", "sheet_status",
        (F.coalesce("label_url", F.lit("")) != "").alias("has_label"),
        # greatest skips nulls, so either side alone stands.
        F.greatest(quote, up).alias("final"),
        (quote - F.col("posting")).alias("margin"),
    )


def _not_postable() -> Column:
    return F.coalesce("is_canceled", F.lit(False)) | (F.upper(F.coalesce("order_status", F.lit(""))) == "SEPARATED")


def reconcile(
    sheet: DataFrame, system: DataFrame, start: dt.date, end: dt.date, only: Column | None = None
) -> DataFrame:
    """Sheet against system orders of one half month.

    `sheet` is the output of `postings`; `system` has domain_id, order_number,
    day, is_canceled, order_status and posting. System orders are compared
    within the days the sheet covers. Each row carries an outcome: ok,
    different, only_sheet, only_system or ignored, and the differences. With
    `only`, a condition on domain_id, other rows are left out before they meet.
    """
    # Written once: the days it covers are read off it before the join.
    window = cut_lineage(sheet.filter(F.col("posted_on").between(day(start), day(end))))
    days = [window.agg(f("posted_on")).scalar() for f in (F.min, F.max)]
    if only is not None:
        window, system = window.filter(only), system.filter(only)
    left = window.select(
        "domain_id", "order_number", F.col("posting").alias("sheet_posting"), "sheet_status", "posted_on",
        F.lit(True).alias("_sheet"),
    )
    keys = ["domain_id", "order_number"]
    # Only the covered days of the system are read in full.
    right = system.filter(F.col("day").between(*days)).select(
        *keys, "day", "is_canceled", "order_status", "quoted", "has_label", F.col("posting").alias("system_posting"), F.lit(True).alias("_system")
    )
    # A sheet order the system holds on another day is no sheet-only order.
    elsewhere = system.select(*keys).join(left.select(*keys), keys, "left_semi").distinct().withColumn("_exists", F.lit(True))
    both = left.join(right, keys, "full").join(elsewhere, keys, "left")
    gap = F.abs(F.col("sheet_posting") - F.col("system_posting")) > F.lit("0.01").cast(MONEY)
    found = F.array_compact(
        F.array(
            F.when(F.col("is_canceled"), "canceled"),
            F.when(gap, "posting").when(F.col("sheet_posting").isNotNull() & F.col("system_posting").isNull(), "no posting"),
        )
    )
    paired = F.col("_sheet").isNotNull() & F.col("_system").isNotNull()
    outcome = (
        F.when(paired & (F.size(found) == 0), "ok")
        .when(paired, "different")
        .when(F.col("_sheet").isNotNull() & F.col("_exists").isNotNull(), "ok")
        .when(F.col("_sheet").isNotNull(), "only_sheet")
        .when(_not_postable(), "ignored")
        .otherwise("only_system")
    )
    return both.withColumn("outcome", outcome).withColumn(
        "differences", F.when(paired, F.array_join(found, ",")).otherwise("")
    ).drop("_sheet", "_system", "_exists")


def reconcile_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("outcome").agg(
        F.count("*").alias("orders"), F.sum(zero(F.col("sheet_posting"))).alias("sheet_posting")
    )


def reconcile_audits(rows: DataFrame, max_share: float = 0.05, max_gap: float = 1.0) -> DataFrame:
    """Paired orders with a late status, no label or a quote far from the cost."""
    paired = rows.filter("sheet_posting is not null and day is not null").filter(~_not_postable())
    late = F.upper("order_status").isin("WAITING", "SEPARATED") & (F.coalesce("sheet_status", F.lit("")) != "") & ~F.upper(
        "sheet_status"
    ).contains("RETIRADA")
    expected = _marked_up(F.col("sheet_posting"))
    gap = F.abs(F.col("quoted") - expected)
    off = (F.col("sheet_posting") != 0) & (F.col("quoted") > 0) & (gap.cast("double") / expected.cast("double") > max_share) & (gap > max_gap)
    found = F.array_compact(
        F.array(F.when(late, "late status"), F.when(~F.col("has_label"), "no label"), F.when(off, "freight off"))
    )
    return paired.select("domain_id", "order_number", F.explode(found).alias("finding"))


def freight_charge(sheet: DataFrame) -> DataFrame:
    """Postings, cost and marked-up charge per domain."""
    return sheet.groupBy("domain_id").agg(
        F.count("*").alias("orders"), F.sum("posting").alias("posting"), F.sum(_marked_up(F.col("posting"))).alias("charge")
    )


def half_month_totals(close: DataFrame) -> DataFrame:
    """Posting totals per half month."""
    value = money_br(F.col("posting_text"))
    return close.groupBy(
        half_month_start(F.col("posted_on")).alias("from_day"), half_month_end(F.col("posted_on")).alias("to_day")
    ).agg(F.count("*").alias("lines"), F.sum(value).alias("posting"))


def reapply_sheet(orders: DataFrame, sheet: DataFrame) -> DataFrame:
    """Sheet values over freight orders: posting, day, status, final price, margin.

    Orders match by key; the sheet's day is the one that counts afterwards.
    """
    theirs = sheet.select(
        "domain_id", "order_number", F.col("posting").alias("_post"), F.col("posted_on").alias("_day"),
        F.col("sheet_status").alias("_status"),
    )
    joined = orders.join(theirs, ["domain_id", "order_number"], "left")
    hit, quoted = F.col("_post").isNotNull(), F.col("quoted") > 0
    up = _marked_up(F.col("_post"))
    values = {
        "posting": F.when(hit, F.col("_post")).otherwise(F.col("posting")),
        "day": F.coalesce("_day", "day"),
        "order_status": F.coalesce(F.nullif(F.col("_status"), F.lit("")), "order_status"),
        "margin": F.when(hit, F.when(quoted, F.col("quoted") - F.col("_post"))).otherwise(F.col("margin")),
        "final": F.when(hit, F.when(quoted, F.greatest("quoted", up)).otherwise(up)).otherwise(F.col("final")),
        "posting_source": F.when(hit, "sheet").when(F.col("posting").isNotNull(), "close").otherwise(""),
    }
    kept = [c for c in orders.columns if c not in values]
    return joined.select(*kept, *[c.alias(k) for k, c in values.items()])


def merge_sheet_snapshots(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of a new sheet replace old ones with the same domain and order."""
    kept = hot_join(old, new.select("domain_id", "order_number").distinct(), ["domain_id", "order_number"], "left_anti")
    return new.unionByName(kept, allowMissingColumns=True)


def manual_postings(new: DataFrame, old: DataFrame) -> DataFrame:
    """Postings without an order: one row per internal code, else per day, note and cost."""
    key = F.coalesce(F.nullif(F.col("internal_code"), F.lit("")), F.concat_ws("_", "posted_on", "invoice_no", "posting"))
    keyed_new, keyed_old = new.withColumn("_key", key), old.withColumn("_key", key)
    fresh = hot_join(keyed_old, keyed_new.select("_key").distinct(), ["_key"], "left_anti")
    body = F.struct(*[c for c in keyed_old.columns if c != "_key"])
    unique = fresh.groupBy("_key").agg(F.min(body).alias("_r")).select("_r.*")
    return new.unionByName(unique)


def sheet_total(rows: DataFrame) -> DataFrame:
    """Total row of a sheet: no ids and a value above 100."""
    blank = (F.coalesce("volume_code", F.lit("")) == "") & (F.coalesce("order_number", F.lit("")) == "")
    value = money_br(F.col("posting_text"))
    return rows.filter(blank & (value > 100)).agg(F.max(value).alias("sheet_total"))


def client_brands(orders: DataFrame, n: int = 5) -> DataFrame:
    """Brands each client document buys from most."""
    doc = F.nullif(digits(F.col("customer_doc")), F.lit(""))
    counts = orders.withColumn("doc", doc).filter("doc is not null and domain_id is not null").groupBy(
        "doc", "domain_id"
    ).agg(F.count("*").alias("orders"))
    return top_n(counts, ["doc"], [F.desc("orders"), F.asc("domain_id")], n, "position")


def domain_audit(sheet: DataFrame, system: DataFrame, domain_id: int | Column, start: dt.date, end: dt.date) -> DataFrame:
    """Reconciliation of one domain within the days that the whole sheet covers."""
    return reconcile(sheet, system, start, end, only=F.col("domain_id") == domain_id)


def company_freight(rows: DataFrame) -> DataFrame:
    """Freight value per company and month and per company, positive sums only."""
    company, month = F.col("company_id"), F.col("month")
    sums = rows.groupBy("company_id", "month").agg(F.sum("value").alias("value")).filter("value > 0")
    return sums.groupingSets([[company, month], [company]], company, month).agg(F.sum("value").alias("value"))


def freight_measures(rows: DataFrame) -> DataFrame:
    """One row: orders, orders with freight, total, average and distinct domains."""
    return rows.agg(
        F.count("*").alias("orders"), F.count_if(F.col("posting") > 0).alias("with_freight"), F.sum("posting").alias("total"),
        (F.sum("posting").cast("double") / F.count("posting")).alias("average"), F.countDistinct("domain_id").alias("domains"),
    )


def field_differences(sheet: DataFrame, system: DataFrame) -> DataFrame:
    """Paired rows field by field: client, destination, cancellation and posting cost.

    One row per difference, names compared without case, accents or punctuation.
    """
    theirs = system.select(
        "domain_id", "order_number", F.col("client").alias("_client"), F.col("city").alias("_city"), F.col("state").alias("_state"),
        "is_canceled", F.col("posting").alias("_posting"),
    )
    pairs = sheet.join(theirs, ["domain_id", "order_number"])

    def place(city: str, state: str) -> Column:
        return F.concat_ws("/", compare_key(F.col(city)), state_key(F.col(state)))

    def row(field: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), a.alias("sheet"), b.alias("system"))

    costs = row("posting", money_text(F.col("posting")), money_text(F.col("_posting")))
    gap = F.abs(F.col("posting") - F.col("_posting")) > F.lit("0.01").cast(MONEY)
    found = F.array_compact(
        F.array(
            F.when(compare_key(F.col("client")) != compare_key(F.col("_client")), row("client", F.col("client"), F.col("_client"))),
            F.when(place("city", "state") != place("_city", "_state"), row("destination", F.concat_ws("/", "city", "state"), F.concat_ws("/", "_city", "_state"))),
            F.when(F.col("is_canceled"), row("canceled", F.lit("posted"), F.lit("canceled"))),
            F.when(gap | (F.col("posting").isNotNull() & F.col("_posting").isNull()), costs),
        )
    )
    return pairs.select("domain_id", "order_number", F.inline(found))
