"""Order instalments, payment schedule, purchases and their audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import LOCAL_ZONE, day, next_business_day, seconds_between, to_local
from ..functions.money import cents, zero
from ..functions.text import tag_value
from ..operators.joins import newest_by_key
from ..operators.skew import hot_join
from ..session import cut_lineage
from ..sources import bucketed

# What an order row and an instalment both tell about an instalment.
LINE = ["rec_id", "installment", "due_at", "rec_paid_at", "rec_status", "net", "gross", "fee", "anticipation"]
VALID_STATUS = ["paid", "confirmed", "created", "pending", "processing"]


def receivable_lines(
    receivables: DataFrame, orders: DataFrame, settings: DataFrame, known_domains: DataFrame | None = None,
    zone: str = LOCAL_ZONE, provider: str | None = None,
) -> DataFrame:
    """Instalments, and for orders without any the instalment that the order row itself carries.

    Order rows have the columns of an instalment (`LINE`), null where none is
    known yet. Instalments of net 0 and unknown domains stay only for companies
    with anticipation. With `provider` both inputs are cut to that payment
    provider. All dates are local. `paid_at` of both inputs is the moment the
    customer paid; `settings` and `known_domains` hold each key once.
    """
    if provider is not None:
        receivables, orders = (rows.filter(F.col("provider") == provider) for rows in (receivables, orders))
    heads = orders.groupBy("order_id").agg(
        *[F.max(c).alias(c) for c in ("order_number", "customer_doc", "total", "payment_method")],
        F.max(F.to_date(to_local(F.col("created_at"), zone))).alias("order_date"),
        F.max(F.to_date(to_local(F.col("paid_at"), zone))).alias("_order_paid_on"),
        F.min("company_id").alias("company_id"),
        F.min("domain_id").alias("domain_id"),
        F.max(F.struct(*LINE)).alias("_own"),
    )
    enabled = F.coalesce(F.col("anticipation_d1") > 0, F.lit(False)) | F.coalesce("fee_enabled", F.lit(False))
    known = None
    if known_domains is not None:
        known = known_domains.select(F.col("domain_id").cast("string").alias("domain_id"), F.lit(True).alias("_known"))

    def checked(lines: DataFrame) -> DataFrame:
        """Lines with their anticipation flag, and whether they stay."""
        rows = lines.join(settings, "company_id", "left").withColumn("anticipates", enabled)
        stays = (zero(F.col("net")) != 0) | F.col("anticipates")
        if known is not None:
            rows = rows.join(known, "domain_id", "left")
            stays = stays & (F.col("_known").isNotNull() | F.col("anticipates"))
            return rows.withColumn("_stays", stays).drop("_known")
        return rows.withColumn("_stays", stays)

    lines = checked(receivables)
    marks = F.col("_stays") & (F.col("anticipates") | (zero(F.col("anticipation")) > 0))
    paid_on = F.when(F.col("_stays"), F.to_date(to_local(F.col("paid_at"), zone)))
    per_order = lines.groupBy("order_id").agg(
        F.bool_or(marks).alias("order_anticipates"), F.max(paid_on).alias("customer_paid_on")
    )
    # Everything about an order first, so that its lines are joined once.
    facts = per_order.join(heads.drop("company_id", "domain_id", "_order_paid_on", "_own"), "order_id", "left")
    # An order has few lines, so no key of this join is hot.
    present = lines.filter("_stays").drop("paid_at").join(facts, "order_id", "left")
    absent = checked(
        heads.join(per_order, "order_id", "left_anti").select(
            *[c for c in heads.columns if c != "_own"], *[F.col(f"_own.{c}").alias(c) for c in LINE]
        )
    ).filter("_stays").withColumn("order_anticipates", F.col("anticipates")).withColumnRenamed("_order_paid_on", "customer_paid_on")
    return (
        present.unionByName(absent, allowMissingColumns=True)
        .withColumn("due_on", F.to_date(to_local(F.col("due_at"), zone)))
        .withColumn("paid_on", F.to_date(to_local(F.col("rec_paid_at"), zone)))
        .drop("_stays")
    )


def receivable_orders(lines: DataFrame) -> DataFrame:
    """Instalment totals per order; any anticipated instalment marks the order."""
    open_line = F.col("paid_on").isNull()
    return lines.groupBy("order_id").agg(
        F.max("order_number").alias("order_number"),
        F.max("order_date").alias("order_date"),
        F.count("*").alias("instalments"),
        F.min("due_on").alias("first_due"),
        F.max("due_on").alias("last_due"),
        F.min(F.when(open_line, F.col("due_on"))).alias("next_due"),
        F.count_if(~open_line).alias("paid"),
        F.count_if(open_line).alias("open"),
        F.sum("net").alias("net"),
        F.sum("gross").alias("gross"),
        F.sum("fee").alias("fee"),
        F.bool_and(~open_line).alias("all_paid"),
        F.max("order_anticipates").alias("anticipates"),
    )


def payment_schedule(lines: DataFrame) -> DataFrame:
    """Day each instalment reaches the merchant.

    Anticipating orders settle on the business day after the customer paid;
    others when paid, else when due.
    """
    base = F.coalesce("customer_paid_on", "paid_on", "order_date")
    early = F.coalesce(next_business_day(F.date_add(base, 1)), "due_on")
    pay = F.when(F.col("order_anticipates"), early).otherwise(F.coalesce("paid_on", "due_on"))
    return lines.select(
        "order_id", "rec_id", "installment", pay.alias("pay_on"), F.col("order_anticipates").alias("anticipates"),
        F.col("paid_on").isNotNull().alias("is_paid"), "due_on", "paid_on", "gross", "fee", "net",
    )


def schedule_by_day(schedule: DataFrame) -> DataFrame:
    return schedule.groupBy("pay_on", "anticipates").agg(
        F.count("*").alias("instalments"), F.sum("net").alias("net"), F.sum("gross").alias("gross")
    )


def anticipation_default(
    orders: DataFrame, as_of: dt.date, days: int = 14, min_orders: int = 3, ratio: float = 0.7
) -> DataFrame:
    """Whether a workspace anticipates: share of its recent orders, else of all."""
    recent = F.col("order_date") >= F.date_sub(day(as_of), days)
    hit = F.col("anticipates")
    per = orders.filter("workspace_id <> ''").groupBy("workspace_id").agg(
        F.count_if(recent).alias("n_recent"), F.count_if(recent & hit).alias("hit_recent"),
        F.count("*").alias("n_all"), F.count_if(hit).alias("hit_all"),
    )
    use_recent = F.col("n_recent") >= min_orders
    share = F.when(use_recent, F.col("hit_recent") / F.col("n_recent")).otherwise(F.col("hit_all") / F.col("n_all"))
    return per.filter(use_recent | (F.col("n_all") >= min_orders)).select(
        "workspace_id", share.alias("share"), (share >= ratio).alias("anticipates_default")
    )


def merge_purchases(fresh: DataFrame, refreshed: DataFrame, previous: DataFrame, defaults: DataFrame) -> DataFrame:
    """Newest copy of each purchase; the anticipation flag is raised, never lowered."""
    merged = newest_by_key([fresh, refreshed, previous], "transaction_id", ["updated"])
    joined = hot_join(
        merged, defaults.select("workspace_id", "anticipates_default"), ["workspace_id"],
        counted=fresh.select("workspace_id").unionByName(previous.select("workspace_id")),
    )
    raised = F.coalesce("anticipation", F.lit(False)) | F.coalesce("anticipates_default", F.lit(False))
    return joined.withColumn("anticipation", raised).drop("anticipates_default")


DEFAULTS = 100_000  # workspaces whose defaults are broadcast, once they are counted


def merge_into_history(fresh: DataFrame, refreshed: DataFrame, history: DataFrame, defaults: DataFrame, buckets: int) -> DataFrame:
    """`merge_purchases` where the previous state is a table bucketed by transaction (`sources.bucketed`).

    Only the new copies are shuffled; rows come out in the buckets of the history.
    """
    batch = newest_by_key([fresh, refreshed], "transaction_id", ["updated"])

    def choose(c: str) -> Column:
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))

    merged = bucketed.merged(history, batch, "transaction_id", buckets, choose)
    known = defaults.select("workspace_id", "anticipates_default")
    if known.limit(DEFAULTS + 1).count() <= DEFAULTS:
        joined = merged.join(F.broadcast(known), "workspace_id", "left")
    else:
        joined = hot_join(merged, known, ["workspace_id"], counted=history)
    raised = F.coalesce("anticipation", F.lit(False)) | F.coalesce("anticipates_default", F.lit(False))
    return joined.withColumn("anticipation", raised).select(*history.columns)


def missing_now(previous: DataFrame, fresh: DataFrame) -> DataFrame:
    """Purchases seen before that the fresh pull lacks."""
    return previous.join(fresh.select("transaction_id"), "transaction_id", "left_anti")


def valid_purchases(purchases: DataFrame, test_brands: list[str] = ()) -> DataFrame:
    """Purchases in a valid state that were not refunded (zero amount)."""
    parts = F.aggregate("installments", F.lit(0).cast("long"), lambda s, i: s + F.coalesce(i["amount"], F.lit(0)).cast("long"))
    keep = F.lower("status").isin(VALID_STATUS) & (F.col("amount") != 0) & (parts != 0) & (F.col("order_id") != "")
    if test_brands:
        keep = keep & ~F.coalesce(F.lower(F.trim("brand")).isin(list(test_brands)), F.lit(False))
    return purchases.filter(keep)


def duplicate_orders(purchases: DataFrame) -> DataFrame:
    """Orders paid more than once, with the first and last payment."""
    return (
        purchases.groupBy("order_id")
        .agg(
            F.count("*").alias("payments"),
            F.sum(cents(F.col("amount"))).alias("value"),
            F.min(F.struct("created", "transaction_id")).alias("_first"),
            F.max("created").alias("last_at"),
        )
        .filter("payments > 1")
        .select("order_id", "payments", "value", F.col("_first.created").alias("first_at"), "last_at",
                F.col("_first.transaction_id").alias("first_id"))
    )


def duplicate_payments(purchases: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Every payment of a duplicated order, the first one marked."""
    used = purchases.select("order_id", "transaction_id", "created", cents(F.col("amount")).alias("value"), F.size("installments").alias("parts"))
    return hot_join(used, duplicates.select("order_id", "first_id", "payments"), ["order_id"], "inner", "payments").select(
        "order_id", "transaction_id", "created", "value", "parts",
        (F.col("transaction_id") == F.col("first_id")).alias("is_first"),
    )


def duplicate_totals(purchases: DataFrame) -> DataFrame:
    per = purchases.groupBy("order_id").agg(F.count("*").alias("n"), F.sum(cents(F.col("amount"))).alias("v"))
    twice = F.col("n") > 1
    return per.agg(
        F.count("*").alias("orders"), F.count_if(twice).alias("duplicate_orders"),
        F.sum(F.when(twice, F.col("n"))).alias("duplicate_payments"), F.sum(F.when(twice, F.col("v"))).alias("value"),
    )


def cancellations(purchases: DataFrame, orders: DataFrame) -> DataFrame:
    """Voided purchases with the order total and the time until the cancellation."""
    totals = orders.groupBy("order_id").agg(F.max("order_number").alias("order_number"), F.max("total").alias("order_total"))
    hours = seconds_between(F.col("created"), F.col("updated")) / 3600.0
    minutes = F.round(hours * 60).cast("int")
    text = F.when(hours < 1, F.concat(minutes.cast("string"), F.lit("m"))).otherwise(
        F.concat(F.round(hours.cast("decimal(18,6)"), 1).cast("string"), F.lit("h"))
    )
    voided = purchases.filter("status = 'voided'").select(
        "transaction_id", "order_id", "brand", F.greatest(F.size("installments"), F.lit(1)).alias("parts"),
        F.col("updated").alias("canceled_at"), text.alias("time_to_cancel"),
    )
    return hot_join(voided, totals, ["order_id"], unique=True).select(
        "transaction_id", "order_id", "brand", "order_number", "order_total", "parts", "canceled_at", "time_to_cancel"
    )


def purchase_rows(documents: DataFrame) -> DataFrame:
    """Purchase level of nested documents, with ids taken from the tags."""
    return documents.select(
        "transaction_id", "status", "amount", "created",
        tag_value(F.col("tags"), "order_").alias("tag_order"),
        tag_value(F.col("tags"), "company_").alias("tag_company"),
        tag_value(F.col("tags"), "customer_").alias("tag_customer"),
        F.to_json("tags").alias("tags_json"),
    )


def instalment_rows(documents: DataFrame) -> DataFrame:
    """Instalment level of nested documents, numbered by due date."""
    by_due = F.array_sort(F.transform("installments", lambda i: F.struct(i["due"].alias("due"), i["amount"].alias("amount"))))
    return documents.select("transaction_id", F.posexplode(by_due).alias("pos", "part")).select(
        "transaction_id", (F.col("pos") + 1).alias("number"), "part.due", "part.amount"
    )


def purchase_order_data(purchases: DataFrame, by_transaction: DataFrame, by_order: DataFrame, workspaces: DataFrame) -> DataFrame:
    """Order number by transaction id, else by tagged order; anticipation by workspace default.

    Only the four columns in use go through the shuffles: `hot_join` spreads rows by a hash of
    all columns it gets, so the optimizer could not drop the others.
    """
    tagged = purchases.select("transaction_id", "workspace_id", "anticipation", tag_value(F.col("tags"), "order_").alias("tag_order"))
    first = by_transaction.groupBy("transaction_id").agg(F.min("order_number").alias("_by_tx"))
    second = by_order.groupBy(F.col("order_id").alias("tag_order")).agg(F.max("order_number").alias("_by_tag"))
    joined = hot_join(tagged.join(first, "transaction_id", "left"), second, ["tag_order"], counted=tagged, unique=True)
    defaults = cut_lineage(workspaces.select("workspace_id", "anticipates_default"))
    joined = hot_join(joined, defaults, ["workspace_id"], counted=tagged, few=DEFAULTS)
    source = F.when(F.col("_by_tx").isNotNull(), "transaction").when(F.col("_by_tag").isNotNull(), "tag").otherwise("none")
    return joined.select(
        "transaction_id", F.coalesce("_by_tx", "_by_tag").alias("order_number"), source.alias("found_by"),
        (F.col("anticipation") | F.coalesce("anticipates_default", F.lit(False))).alias("anticipation"),
    )


def balance_rollup(balances: DataFrame, central: str) -> DataFrame:
    """Company balances and the total without the central workspace."""
    own = F.when(F.col("workspace_id") != central, F.coalesce("balance", F.lit(0))).otherwise(F.lit(0))
    return balances.agg(
        F.sum(own).cast("decimal(28,2)").alias("total"),
        F.max(F.when(F.col("workspace_id") == central, F.col("balance"))).alias("central"),
        F.count_if(F.col("balance").isNull()).alias("unknown"),
        F.count("*").alias("workspaces"),
    )


def payment_key_register(keys: DataFrame, companies: DataFrame) -> DataFrame:
    """Payment keys with the company of their brand, names compared without case.

    Of several companies with one name the one with the largest domain counts.
    """
    newest = companies.groupBy(F.lower("name").alias("_name")).agg(
        F.max_by(F.struct("company_id", "domain_id"), F.struct("domain_id", "company_id")).alias("_c")
    )
    joined = hot_join(keys.withColumn("_name", F.lower("brand")), newest, ["_name"], unique=True)
    return joined.select(*keys.columns, "_c.company_id", "_c.domain_id")


def keyed_by_tax_or_name(brands: DataFrame, by_tax: DataFrame, by_name: DataFrame, name_key: Column) -> DataFrame:
    """Payment key by tax id, else by normalised name."""
    first = by_tax.select("tax_id", F.col("payment_key").alias("_a"))
    second = by_name.select("name_key", F.col("payment_key").alias("_b"))
    keyed = brands.withColumn("name_key", name_key)
    joined = hot_join(hot_join(keyed, first, ["tax_id"]), second, ["name_key"], counted=keyed)
    return joined.withColumn("payment_key", F.coalesce("_a", "_b")).drop("_a", "_b", "name_key")
