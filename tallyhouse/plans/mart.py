"""One wide row per company, and the global month series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.money import MONEY
from ..session import cut_lineage
from ..operators.skew import hot_join
from ..operators.joins import attach_to_headquarters, summed_union
from .churn import churn_score, quarter_sums
from .groups import drop_idle_copies

ORDER_MEASURES = [
    "orders", "paid", "canceled", "pending", "value", "paid_value", "canceled_value", "pending_value",
    "pix_value", "card_value", "pix_orders", "card_orders",
]
# Order of the 14 values in an exported month vector.
VECTOR = [
    "orders", "paid", "canceled", "pending", "value", "paid_value", "canceled_value", "pending_value",
    "card_orders", "pix_orders", "card_value", "pix_value", "links", "clicks",
]


def month_table(months: DataFrame, activity: DataFrame) -> DataFrame:
    """All month measures of a key; a month may come from either source.

    `activity` holds links and clicks by the same key.
    """
    keys = ["domain_id", "month"]
    wide = months.join(activity, keys, "full")
    return wide.select(*keys, *[F.coalesce(m, F.lit(0)).alias(m) for m in VECTOR])


def month_vectors(months: DataFrame, pending_with_canceled: bool = False) -> DataFrame:
    """Month measures in one array; `pending_with_canceled` counts canceled values as pending."""
    if pending_with_canceled:
        months = months.withColumn("pending_value", F.col("value") - F.col("paid_value"))
    return months.select(
        "domain_id", F.date_format("month", "yyyy-MM").alias("month"), F.array(*[F.col(m).cast("double") for m in VECTOR]).alias("vector")
    )


def month_series(months: DataFrame, n: int = 18) -> DataFrame:
    """Totals of the last `n` months over all merchants."""
    totals = months.groupBy("month").agg(*[F.sum(m).alias(m) for m in VECTOR])
    return totals.orderBy(F.desc("month")).limit(n)


def company_invoices(match: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Invoice totals and the current invoice (`billing.invoice_states`) of each company, by its matched invoice key."""
    # Written once, a row per key: the join reads it for hot keys and for all others.
    totals = cut_lineage(states.select(
        F.col(key).cast("string").alias("invoice_key"), F.col("paid").alias("bill_paid"), F.col("pending").alias("bill_pending"),
        F.col("expired").alias("bill_expired"), F.col("invoices").alias("bills"), F.col("plan").alias("billed_plan"),
        F.col("status").alias("bill_status"), F.col("fee").alias("bill_fee"),
    ))
    return hot_join(match.select("company_id", "invoice_key"), totals, ["invoice_key"], "inner").drop("invoice_key")


def side_by_side(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Columns of frames that are each unique by a key, by one shuffle of all of them; a repeated key stops the job."""
    pool = None
    for i, frame in enumerate(frames):
        part = frame.select(key, F.struct(*[c for c in frame.columns if c != key]).alias(f"_{i}"))
        pool = part if pool is None else pool.unionByName(part, allowMissingColumns=True)
    single = pool.groupBy(key).agg(
        *[F.first(f"_{i}", ignorenulls=True).alias(f"_{i}") for i in range(len(frames))], F.greatest(*[F.count(f"_{i}") for i in range(len(frames))], F.lit(0)).alias("_n")
    )
    once = F.when(F.col("_n") <= 1, F.col(key)).otherwise(F.raise_error(F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string"))).cast(single.schema[key].dataType))
    return single.select(once.alias(key), *[f"_{i}.{c}" for i, frame in enumerate(frames) for c in frame.columns if c != key])


def company_mart(
    register: DataFrame,
    months: DataFrame,
    invoices: DataFrame,
    freight: DataFrame,
    plans: DataFrame,
    controls: DataFrame,
    tickets: DataFrame,
    as_of: dt.date,
    extras: Sequence[DataFrame] = (),
) -> DataFrame:
    """Register rows with orders, payment, invoices, freight, plan, fee and churn risk.

    Domain totals sit on the headquarters row. `months` is the monthly order
    table and `freight` is by domain; the others are by company: `invoices` from
    `company_invoices`, `plans` from the plan match, `controls` with manual fees,
    `tickets` with the latest stage, and any `extras`. The fee is that of the
    current invoice, else the manual one, else the plan total.
    """
    per_domain = months.groupBy("domain_id").agg(*quarter_sums(as_of), *[F.sum(m).alias(m) for m in ORDER_MEASURES])
    measures = [c for c in per_domain.columns if c != "domain_id"]
    # Written once: the copy check below reads it twice.
    rows = cut_lineage(attach_to_headquarters(register, per_domain, "domain_id", measures))
    rows = drop_idle_copies(rows)
    cost = freight.select("domain_id", F.col("posting").alias("freight_cost"))
    by_company = [
        invoices, plans.select("company_id", "plan", F.col("total").alias("plan_total")), controls.select("company_id", "manual_fee"),
        tickets.select("company_id", "stage"), *extras,
    ]
    wide = rows.join(cost, "domain_id", "left").join(side_by_side(by_company, "company_id"), "company_id", "left")
    nil = F.lit(0).cast(MONEY)
    fees = [F.when(F.col(c) > 0, F.col(c)) for c in ("bill_fee", "manual_fee", "plan_total")]
    wide = wide.withColumns(
        {
            "has_integration": F.col("integration_name") != "",
            "has_payment": F.col("pix_orders") + F.col("card_orders") > 0,
            **{c: F.coalesce(c, nil) for c in ("bill_paid", "bill_pending", "bill_expired", "freight_cost")},
            "bills": F.coalesce("bills", F.lit(0)),
            "fee": F.coalesce(*fees, nil),
        }
    )
    return churn_score(wide)


def affected_companies(register: DataFrame, domains: DataFrame, companies: DataFrame) -> DataFrame:
    """(company_id, domain_id) of mart rows that a change may reach.

    Changed `companies` (company_id) change their whole domain, as its headquarters may carry their
    totals; all companies of changed `domains` (domain_id) follow, and those that share a tax id with one of
    them, as an idle copy stays or goes by the orders of the others.
    """
    own = register.join(companies.select("company_id").distinct(), "company_id", "left_semi").select("domain_id")
    hit = own.unionByName(domains.select("domain_id")).distinct()
    doc = F.nullif(F.regexp_replace(F.coalesce("tax_document", F.lit("")), "[^0-9]", ""), F.lit(""))
    keyed = register.select("company_id", "domain_id", doc.alias("_doc"))
    first = keyed.join(hit, "domain_id", "left_semi")
    docs = first.select("_doc").where("_doc is not null").distinct()
    copies = keyed.join(docs, "_doc", "left_semi")
    return first.unionByName(copies.select(*first.columns)).select("company_id", "domain_id").distinct()


def add_months(months: DataFrame, more: DataFrame) -> DataFrame:
    """The monthly order table with the measures of new orders added; months and domains that have none stay as they are."""
    return summed_union([months, more], ["domain_id", "month"], ORDER_MEASURES).select(*months.columns)


def refreshed_mart(
    before: DataFrame, register: DataFrame, months: DataFrame, invoices: DataFrame, freight: DataFrame, plans: DataFrame, controls: DataFrame,
    tickets: DataFrame, as_of: dt.date, domains: DataFrame, companies: DataFrame, extras: Sequence[DataFrame] = (),
) -> DataFrame:
    """The mart `before`, with only those companies computed again that changed domains or companies may reach.

    The other arguments are those of `company_mart` and hold the new state; each is cut to
    the affected companies before anything is joined. The result equals a full build where `as_of` is that of `before`.
    """
    touched = cut_lineage(affected_companies(register, domains, companies))
    ids, homes = touched.select("company_id"), touched.select("domain_id").distinct()

    def of_companies(df: DataFrame) -> DataFrame:
        return df.join(ids, "company_id", "left_semi")

    def of_domains(df: DataFrame) -> DataFrame:
        return df.join(homes, "domain_id", "left_semi")

    part = company_mart(
        of_companies(register), of_domains(months), of_companies(invoices), of_domains(freight), of_companies(plans), of_companies(controls),
        of_companies(tickets), as_of, [of_companies(e) for e in extras],
    )
    return before.join(ids, "company_id", "left_anti").unionByName(part)


def risk_counts(mart: DataFrame) -> DataFrame:
    return mart.groupBy("risk").agg(F.count("*").alias("companies"))


def siblings(register: DataFrame) -> DataFrame:
    """Members of each domain with several companies, HQ first, then by name.

    One row per member: a list per member would hold every pair of a domain.
    """
    several = register.groupBy("domain_id").agg(F.count("*").alias("members")).filter("members > 1")
    hq = register.filter("is_hq").select("domain_id", F.col("company_id").alias("hq_id"))
    return register.join(several, "domain_id").join(hq, "domain_id").select(
        "domain_id", "hq_id", "company_id", "trade_name", "is_hq", "members"
    )


def fee_precedence(rows: DataFrame) -> DataFrame:
    """Monthly fee: manual value, else the billed total, else the plan value."""
    positive = [F.when(F.col(c) > 0, F.col(c)) for c in ("manual_fee", "billed_total", "plan_value")]
    return rows.withColumn("monthly_fee", F.coalesce(*positive))


def patch_columns(mart: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Some columns of a mart replaced where the patch has a value."""
    theirs = patch.select(key, *[F.col(c).alias(f"_n_{c}") for c in columns])
    joined = mart.join(theirs, key, "left")
    return joined.select(*[F.coalesce(f"_n_{c}", c).alias(c) if c in columns else F.col(c) for c in mart.columns])


def active_brand(rows: DataFrame) -> DataFrame:
    """Whether a brand is active: by its own status, else by the status of the metrics."""
    on = (F.col("status_text") == "Ativa") | (F.col("metric_status") == "Ativa")
    off = (F.col("status_text") == "Desativada") | (F.col("metric_status") == "Desativada")
    flag = F.when(F.coalesce(on, F.lit(False)), "Sim").when(F.coalesce(off, F.lit(False)), "Não").otherwise("")
    return rows.withColumn("active_brand", flag)


def active_by_cards(rows: DataFrame, min_cards: int = 250) -> DataFrame:
    """The variant by number of card payments."""
    return rows.withColumn("active_brand", F.when(F.col("card_orders") >= min_cards, "Sim").otherwise("Não"))
