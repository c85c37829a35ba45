"""Order KPIs by merchant and month, source unions and order reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.classify import order_letter, payment_family, quote_letter
from ..functions.dates import LOCAL_ZONE, day, month_of, month_start, to_local
from ..functions.money import MONEY, percent, sum_if
from ..functions.text import clean_domain_id
from ..operators.joins import fallback_key, summed_union
from ..operators.multiset import surplus
from ..operators.ranking import top_n
from ..operators.skew import hot_join

MAX_TOTAL = 50_000
MAX_TICKET = 500_000


def clean_orders(orders: DataFrame, max_total: float = MAX_TOTAL) -> DataFrame:
    """Orders with a whole-number domain, 0 < total < max_total and a date."""
    return (
        orders.filter((F.col("total") > 0) & (F.col("total") < max_total) & F.col("created_at").isNotNull())
        .withColumn("domain_id", clean_domain_id(F.col("domain_id")))
        .filter(F.col("domain_id").isNotNull())
    )


def _status_measures() -> list[Column]:
    paid, gone, total = F.col("is_paid"), F.col("is_canceled"), F.col("total")
    return [
        F.count("*").alias("orders"),
        F.count_if(paid).alias("paid"),
        F.count_if(gone).alias("canceled"),
        F.count_if(~paid & ~gone).alias("pending"),
        F.sum("total").alias("value"),
        sum_if(paid, total).alias("paid_value"),
        sum_if(gone, total).alias("canceled_value"),
    ]


def split_measures() -> list[Column]:
    method, total = F.col("payment_method"), F.col("total")
    pix, card = method == "PIX", method == "CREDIT_CARD"
    return [
        sum_if(pix, total).alias("pix_value"), sum_if(card, total).alias("card_value"),
        F.count_if(pix).alias("pix_orders"), F.count_if(card).alias("card_orders"),
        F.sum(total).alias("value"), F.count("*").alias("orders"),
    ]


def merchant_months(orders: DataFrame, zone: str = "UTC", max_total: float = MAX_TOTAL) -> DataFrame:
    """Counts and values by state and payment method, per domain and month, in one scan."""
    clean = clean_orders(orders, max_total)
    grouped = clean.groupBy("domain_id", month_of(F.col("created_at"), zone).alias("month"))
    pending = F.col("value") - F.col("paid_value") - F.col("canceled_value")
    return grouped.agg(*_status_measures(), *split_measures()[:4]).withColumn("pending_value", pending.cast("decimal(28,2)"))


def monthly_domain_kpis(orders: DataFrame, zone: str = "UTC", max_total: float = MAX_TOTAL) -> DataFrame:
    """Counts and values by state, per domain and month."""
    return merchant_months(orders, zone, max_total).drop("pix_value", "card_value", "pix_orders", "card_orders")


def kpi_rollup(monthly: DataFrame) -> DataFrame:
    """Domain totals and month totals from the monthly table."""
    measures = ["orders", "paid", "canceled", "pending", "value", "paid_value", "canceled_value"]
    domain, month = F.col("domain_id"), F.col("month")
    totals = monthly.groupingSets([[domain], [month]], domain, month).agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping("domain_id").alias("_over")
    )
    return totals.withColumn("grain", F.when(F.col("_over") == 1, "month").otherwise("domain")).drop("_over")


def payment_split(orders: DataFrame, key: str = "domain_id", max_total: float = MAX_TOTAL) -> DataFrame:
    """Pix, card and total values and counts by key and month."""
    return (
        clean_orders(orders, max_total)
        .groupBy(key, F.trunc("created_at", "MM").alias("month"))
        .agg(*split_measures())
    )


def family_totals(orders: DataFrame) -> DataFrame:
    """Order counts and values by payment family, read from free method text."""
    return orders.groupBy(payment_family(F.col("payment_method")).alias("family")).agg(
        F.count("*").alias("orders"), F.sum("total").alias("value")
    )


def order_report(orders: DataFrame, max_ticket: float = MAX_TICKET) -> DataFrame:
    """Orders and value per company and month.

    Values are zeroed where the company's average ticket is out of range, and
    again for single months out of range.
    """
    monthly = orders.groupBy("company_id", F.trunc("created_at", "MM").alias("month")).agg(
        F.count("*").alias("orders"), F.sum("total").alias("value")
    )
    # A company has few months, so the window runs over the small monthly table.
    whole = Window.partitionBy("company_id")
    ticket = F.sum("value").over(whole) / F.sum("orders").over(whole)
    bad = (ticket > max_ticket) | (F.col("value") / F.col("orders") > max_ticket)
    return monthly.withColumn("value", F.when(bad, F.lit(0).cast(MONEY)).otherwise(F.col("value")))


def order_union(orders: DataFrame, quotes: DataFrame, quotes_old: DataFrame) -> DataFrame:
    """All sources as one list, older records paired off against orders.

    Only orders with an order number or a customer name stand for an older
    record. Records without a day pair with each other, as those of one day do.
    """
    keys = ["company_id", "day", "value"]
    dated = [rows.withColumn("day", F.coalesce("day", F.lit(""))) for rows in (orders, quotes, quotes_old)]
    named = (F.coalesce("order_number", F.lit("")) != "") | (F.coalesce("customer_name", F.lit("")) != "")
    rest = surplus(dated[0].filter(named), dated[1:], keys, "record_id")
    return dated[0].unionByName(rest, allowMissingColumns=True)


def orders_per_brand(orders: DataFrame, quotes: DataFrame, quotes_old: DataFrame, registry: DataFrame) -> DataFrame:
    """One list of orders and quotes by owning company, with a status letter each.

    Orders belong to their registered company only; quotes may fall back on the
    company of their domain. The oldest quotes have no status.
    """
    known = registry.select("company_id").distinct()
    own = hot_join(orders, known, ["company_id"], "left_semi")
    own = own.withColumn("letter", order_letter(F.col("payment_status"), F.col("order_status"), F.col("is_canceled")))
    recent = owned_records(quotes, registry).withColumn("letter", quote_letter(F.col("payment_status"), F.col("code")))
    oldest = owned_records(quotes_old, registry).withColumn("letter", F.lit("O"))
    fields = ["record_id", "company_id", "day", "value", "letter", "order_number", "customer_name"]
    parts = [own.select(*fields)] + [
        rows.select("record_id", F.col("owner_id").alias("company_id"), "day", "value", "letter", F.lit(None).cast("string").alias("order_number"), "customer_name")
        for rows in (recent, oldest)
    ]
    return order_union(*parts)


def brand_counts(records: DataFrame) -> DataFrame:
    """Records and value of each company by status letter."""
    return records.groupBy("company_id", "letter").agg(F.count("*").alias("records"), F.sum("value").alias("value"))


def owned_records(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Records of known companies, by company id or else by domain id."""
    return fallback_key(records, "company_id", "domain_id", registry, "owner_id")


def two_source_months(first: DataFrame, second: DataFrame) -> DataFrame:
    """Month values by company added over two sources."""
    return summed_union([first, second], ["company_id", "month"], ["value"])


def local_month_shift(rows: DataFrame, ts: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Rows and values per month in UTC and in local time, and what moves."""
    local, utc = F.trunc(to_local(F.col(ts), zone), "MM"), F.trunc(ts, "MM")
    grains = rows.select(utc.alias("utc"), local.alias("local"), "value").groupBy("utc", "local").agg(
        F.count("*").alias("n"), F.sum("value").alias("value")
    )
    moved = F.col("utc") != F.col("local")
    by_utc = grains.groupBy(F.col("utc").alias("month")).agg(
        F.sum("n").alias("utc_rows"), F.sum("value").alias("utc_value"),
        F.sum(F.when(moved, F.col("n")).otherwise(0)).alias("moved_out"),
    )
    by_local = grains.groupBy(F.col("local").alias("month")).agg(
        F.sum("n").alias("local_rows"), F.sum("value").alias("local_value"),
        F.sum(F.when(moved, F.col("n")).otherwise(0)).alias("moved_in"),
    )
    both = by_utc.join(by_local, "month", "full")
    nil = F.lit(0)
    return both.select(
        "month", *[F.coalesce(c, nil).alias(c) for c in both.columns if c != "month"]
    )


def three_month_average(orders: DataFrame, as_of: dt.date, keep_pix_only: bool = True) -> DataFrame:
    """Average monthly value of the last three full months: all, card and pix.

    Without `keep_pix_only` the pix column is empty for domains without card value.
    """
    window = (F.col("created_at") >= month_start(as_of, 3).cast("timestamp")) & (
        F.col("created_at") < month_start(as_of).cast("timestamp")
    )
    base = orders.filter(window & ~F.col("is_canceled") & F.col("is_closed"))

    def average(rows: Column, measure: str) -> Column:
        return F.sum(F.when(rows, F.col(measure))).cast("double") / 3.0

    paid = F.col("is_paid")
    out = base.groupBy("domain_id").agg(
        average(F.lit(True), "total").alias("gmv_avg"),
        average(paid & (F.col("payment_method") == "CREDIT_CARD"), "transaction_value").alias("card_avg"),
        average(paid & (F.col("payment_method") == "PIX"), "transaction_value").alias("pix_avg"),
    )
    if keep_pix_only:
        return out
    return out.withColumn("pix_avg", F.when(F.col("card_avg").isNotNull(), F.col("pix_avg")))


def filtered_orders(orders: DataFrame, equals: dict[str, str], contains: str = "", columns: tuple[str, ...] = ()) -> DataFrame:
    """Equality filters on several columns and a text search over some others."""
    out = orders
    for name, value in equals.items():
        out = out.filter(F.col(name) == value)
    if contains:
        hit = F.lit(False)
        for name in columns:
            hit = hit | F.coalesce(F.lower(F.col(name)).contains(contains.lower()), F.lit(False))
        out = out.filter(hit)
    return out


def kpi_totals(orders: DataFrame) -> DataFrame:
    """One row of totals for a filtered set."""
    return orders.agg(*_status_measures(), F.countDistinct("domain_id").alias("domains"))


def company_lookup(orders: DataFrame, n: int = 10) -> DataFrame:
    """Last `n` orders of each company."""
    order = [F.desc("created_at"), F.desc("order_number")]
    return top_n(orders, ["company_id"], order, n, "position").select(
        "company_id", "position", "order_number", "created_at", "total"
    )


def totals_difference(ours: DataFrame, theirs: DataFrame, min_percent: float = 10.0, n: int = 5) -> DataFrame:
    """Domains whose totals differ most between two systems."""
    joined = ours.select("domain_id", F.col("value").alias("a")).join(
        theirs.select("domain_id", F.col("value").alias("b")), "domain_id"
    )
    off = joined.withColumn("diff_pct", percent(F.abs(F.col("a") - F.col("b")), F.col("b")))
    return off.filter(F.col("diff_pct") > min_percent).orderBy(F.desc("diff_pct"), "domain_id").limit(n)


def distinct_values(orders: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-empty values of several columns, for drop-down lists."""
    pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("string") for c in columns])))
    return orders.select(pairs.alias("field", "value")).filter("value is not null and value <> ''").distinct()


def since(orders: DataFrame, start: dt.date) -> DataFrame:
    return orders.filter(F.col("created_at") >= day(start).cast("timestamp"))


def provider_totals(orders: DataFrame, providers: list[str]) -> DataFrame:
    """Payment counts and values per company over some providers."""
    paid, total = F.col("payment_status") == "PAID", F.col("total")
    return orders.filter(F.col("provider").isin(providers)).groupBy("company_id").agg(
        *split_measures(), F.count_if(F.coalesce(paid, F.lit(False))).alias("paid"), sum_if(F.coalesce(paid, F.lit(False)), total).alias("paid_value")
    )


def sorted_rows(rows: DataFrame, column: str, descending: bool = True, n: int | None = None) -> DataFrame:
    """Rows by a chosen column, text without regard to case; the first `n` if given. The other columns break ties."""
    key = F.lower(column) if dict(rows.dtypes)[column] == "string" else F.col(column)
    ordered = rows.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), *rows.columns)
    return ordered.limit(n) if n else ordered
