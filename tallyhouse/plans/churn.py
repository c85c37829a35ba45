"""Product churn, payment-method churn and the churn score."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.classify import ADDON_PLANS, UPPER_PLANS, plan_level
from ..functions.dates import day, month_start
from ..functions.money import MONEY


def last_paid_plans(invoices: DataFrame, domains: DataFrame, bridge: DataFrame) -> DataFrame:
    """Last paid invoice date per domain and plan; unpaid plans have none."""
    paid = F.when(F.col("status").isin("paid", "externally_paid"), F.to_date("due_at"))
    per = (
        invoices.filter("plan_name is not null and trim(plan_name) <> ''")
        .groupBy("customer_id", F.trim("plan_name").alias("plan"))
        .agg(F.max(paid).alias("last_paid"))
    )
    plans = per.join(bridge.distinct(), "customer_id").groupBy("domain_id", "plan").agg(F.max("last_paid").alias("last_paid"))
    return plans.join(domains, "domain_id")


def _with_stop(plans: DataFrame, as_of: dt.date, months: int, inclusive: bool) -> DataFrame:
    last, cutoff = F.trunc("last_paid", "MM"), month_start(as_of, months)
    stopped = (last <= cutoff) if inclusive else (last < cutoff)
    return plans.filter("last_paid is not null").withColumn("stopped", stopped)


def _churn_month(last: Column) -> Column:
    return F.add_months(F.trunc(last, "MM"), 1)


def _inside(month: Column, start: dt.date, as_of: dt.date) -> Column:
    return month.between(day(start), month_start(as_of))


def plan_churn(plans: DataFrame, as_of: dt.date, start: dt.date, months: int = 3, inclusive: bool = False) -> DataFrame:
    """Plans that stopped, by churn month, flagged when the whole domain stopped."""
    marked = _with_stop(plans, as_of, months, inclusive)
    # A domain has few plans, so the window runs over the small plan table.
    whole = F.bool_and("stopped").over(Window.partitionBy("domain_id"))
    rows = marked.withColumn("total_churn", whole).filter("stopped")
    dated = rows.withColumn("churn_month", _churn_month(F.col("last_paid")))
    return dated.filter(_inside(F.col("churn_month"), start, as_of))


def plan_churn_pivot(churn: DataFrame) -> DataFrame:
    return churn.groupBy("churn_month", "plan", "angel_name").agg(F.count("*").alias("plans"))


def total_churn(plans: DataFrame, as_of: dt.date, start: dt.date, months: int = 3, inclusive: bool = False) -> DataFrame:
    """One row per domain where every plan stopped."""
    marked = _with_stop(plans, as_of, months, inclusive)
    per = marked.groupBy("domain_id").agg(
        F.bool_and("stopped").alias("all_stopped"),
        F.max("last_paid").alias("last_paid"),
        F.array_join(F.sort_array(F.collect_set("plan")), " | ").alias("plans"),
        F.min("domain_name").alias("domain_name"),
    )
    rows = per.filter("all_stopped").withColumn("churn_month", _churn_month(F.col("last_paid")))
    return rows.filter(_inside(F.col("churn_month"), start, as_of)).drop("all_stopped")


def tiered_churn(
    plans: DataFrame, as_of: dt.date, start: dt.date, months: int = 3, inclusive: bool = False,
    addons: list[str] = ADDON_PLANS, uppers: list[str] = UPPER_PLANS,
) -> DataFrame:
    """Total or partial churn per domain; moves to an equal or higher base plan are no churn."""
    marked = _with_stop(plans, as_of, months, inclusive).withColumn("level", plan_level(F.col("plan"), addons, uppers))
    stopped = F.col("stopped")
    per = marked.groupBy("domain_id").agg(
        F.max(F.when(stopped, F.col("level"))).alias("stopped_level"),
        F.coalesce(F.max(F.when(~stopped, F.col("level"))), F.lit(0)).alias("kept_level"),
        F.max(F.when(stopped, F.col("last_paid"))).alias("last_paid"),
        F.count_if(stopped).alias("n_stopped"),
        F.count_if(~stopped).alias("n_kept"),
        F.array_join(F.sort_array(F.collect_set(F.when(stopped, F.col("plan")))), " | ").alias("stopped_plans"),
        F.array_join(F.sort_array(F.collect_set(F.when(~stopped, F.col("plan")))), " | ").alias("kept_plans"),
    )
    moved = (F.col("stopped_level") > 0) & (F.col("kept_level") >= F.col("stopped_level"))
    rows = per.filter((F.col("n_stopped") > 0) & ~moved).withColumn("churn_month", _churn_month(F.col("last_paid")))
    kind = F.when(F.col("kept_level") == 0, "total").otherwise("partial")
    return rows.filter(_inside(F.col("churn_month"), start, as_of)).withColumn("kind", kind).drop(
        "stopped_level", "kept_level"
    )


def payment_churn(
    orders: DataFrame, as_of: dt.date, start: dt.date, months: int = 2, min_orders: int = 3, inclusive: bool = True
) -> DataFrame:
    """Domains that stopped paying by pix or card but kept ordering."""
    by_method = F.col("payment_method").isin("PIX", "CREDIT_CARD")
    per = orders.groupBy("domain_id").agg(
        F.max(F.when(by_method, F.to_date("created_at"))).alias("last_payment"),
        F.max(F.to_date("created_at")).alias("last_order"),
        F.count_if(by_method).alias("payment_orders"),
        F.count("*").alias("orders"),
    )
    last, cutoff = F.trunc("last_payment", "MM"), month_start(as_of, months)
    rows = per.filter(
        (F.col("payment_orders") >= min_orders)
        & ((last <= cutoff) if inclusive else (last < cutoff))
        & (F.col("last_order") > F.col("last_payment"))
    ).withColumn("churn_month", _churn_month(F.col("last_payment")))
    return rows.filter(_inside(F.col("churn_month"), start, as_of))


def active_payment_churn(churned: DataFrame, domains: DataFrame, angels: DataFrame) -> DataFrame:
    """Payment churn of active domains only, with domain name and owner."""
    names = domains.select(F.col("domain_id").cast("string").alias("domain_id"), "domain_name", "angel_id").join(angels, "angel_id", "left")
    return churned.join(names.select("domain_id", "domain_name", F.coalesce("angel_name", F.lit("")).alias("owner")), "domain_id")


def payment_churn_pivot(churned: DataFrame) -> DataFrame:
    """Churned domains by month and owner."""
    return churned.groupBy("churn_month", "owner").agg(F.count("*").alias("clients"))


def payment_history(churned: DataFrame, orders: DataFrame) -> DataFrame:
    """Pix and card value of churned domains by month with value."""
    pix, card, nil = F.col("payment_method") == "PIX", F.col("payment_method") == "CREDIT_CARD", F.lit(0).cast(MONEY)
    monthly = orders.filter(pix | card).groupBy("domain_id", F.trunc("created_at", "MM").alias("month")).agg(
        F.sum(F.when(pix, F.col("total")).otherwise(nil)).alias("pix"), F.sum(F.when(card, F.col("total")).otherwise(nil)).alias("card")
    )
    return monthly.filter(F.col("pix") + F.col("card") > 0).join(churned.select("domain_id").distinct(), "domain_id", "left_semi")


def value_lost(churned: DataFrame, orders: DataFrame, same_month: bool = False) -> DataFrame:
    """Payment value of the month before the last payment, else of the latest
    earlier month with value, else zero.

    With `same_month` the month of the last payment is the only second choice.
    """
    pix, card = F.col("payment_method") == "PIX", F.col("payment_method") == "CREDIT_CARD"
    nil = F.lit(0).cast(MONEY)
    monthly = (
        orders.filter(pix | card)
        .groupBy("domain_id", F.trunc("created_at", "MM").alias("month"))
        .agg(
            F.sum(F.when(pix, F.col("total")).otherwise(nil)).alias("pix_lost"),
            F.sum(F.when(card, F.col("total")).otherwise(nil)).alias("card_lost"),
        )
        .filter(F.col("pix_lost") + F.col("card_lost") > 0)
        .join(churned.select("domain_id", "last_payment"), "domain_id")
    )
    last = F.trunc("last_payment", "MM")
    preferred = F.add_months(last, -1)
    if same_month:
        pick = F.min(F.struct("month", "pix_lost", "card_lost"))
        usable = monthly.filter(F.col("month").between(preferred, last))
    else:
        pick = F.max(F.struct("month", "pix_lost", "card_lost"))
        usable = monthly.filter(F.col("month") < last)
    latest = usable.groupBy("domain_id").agg(pick.alias("_m")).select("domain_id", "_m.*")
    note = F.when(F.col("month").isNull(), "none").when(F.col("month") == preferred, "previous month").otherwise("same month" if same_month else "earlier month")
    joined = churned.join(latest, "domain_id", "left")
    return joined.select(
        *churned.columns,
        F.coalesce("pix_lost", nil).alias("pix_lost"),
        F.coalesce("card_lost", nil).alias("card_lost"),
        (F.coalesce("pix_lost", nil) + F.coalesce("card_lost", nil)).alias("value_lost"),
        note.alias("note"),
    )


def quarter_sums(as_of: dt.date) -> list[Column]:
    """Orders of the month of `as_of` and the two before, the three before those,
    and of the month itself, over a monthly table."""
    month = F.col("month")

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("orders")).otherwise(0))

    return [
        total(month.between(month_start(as_of, 2), month_start(as_of))).alias("last3"),
        total(month.between(month_start(as_of, 5), month_start(as_of, 3))).alias("prev3"),
        total(month == month_start(as_of)).alias("this_month"),
    ]


def trailing_quarters(monthly: DataFrame, as_of: dt.date, key: str = "domain_id") -> DataFrame:
    """Those sums for the keys with orders in the six months."""
    window = monthly.filter(F.col("month").between(month_start(as_of, 5), month_start(as_of)))
    return window.groupBy(key).agg(*quarter_sums(as_of))


def observed_quarters(monthly: DataFrame, key: str = "domain_id", min_months: int = 4) -> DataFrame:
    """The same over the six latest months that have orders, given at least four."""
    order = Window.partitionBy(key).orderBy(F.desc("month"))
    ranked = monthly.withColumn("_rn", F.row_number().over(order)).filter("_rn <= 6")
    return (
        ranked.groupBy(key)
        .agg(
            F.sum(F.when(F.col("_rn") <= 3, F.col("orders")).otherwise(0)).alias("last3"),
            F.sum(F.when(F.col("_rn") > 3, F.col("orders")).otherwise(0)).alias("prev3"),
            F.max("_rn").alias("months"),
        )
        .filter(F.col("months") >= min_months)
        .drop("months")
    )


def churn_score(facts: DataFrame) -> DataFrame:
    """Score 0-100 with reasons.

    Needs orders, paid, canceled, last3, prev3, this_month, has_integration and
    stage (latest assistant stage, may be null).
    """
    last3, prev3 = F.col("last3"), F.col("prev3")
    steady = prev3 > 5
    rules = [
        (steady & (last3 < prev3 * 0.5), 30, "orders down >50%"),
        (steady & (last3 >= prev3 * 0.5) & (last3 < prev3 * 0.7), 15, "orders down >30%"),
        ((F.col("orders") > 0) & (F.col("this_month") == 0), 25, "no orders this month"),
        ((F.col("orders") > 10) & (F.col("canceled") > F.col("paid") * 0.3), 15, "many cancellations"),
        (~F.col("has_integration"), 10, "no integration"),
        (F.coalesce(F.col("stage") == "Churn", F.lit(False)), 30, "assistant: churn"),
        (F.coalesce(F.col("stage") == "Parado", F.lit(False)), 20, "assistant: stopped"),
    ]
    score = sum((F.when(c, points).otherwise(0) for c, points, _ in rules), F.lit(0))
    reasons = F.array_join(F.array_compact(F.array(*[F.when(c, text) for c, _, text in rules])), "; ")
    out = facts.withColumn("score", F.least(score, F.lit(100))).withColumn("reasons", reasons)
    risk = F.when(F.col("score") >= 60, "high").when(F.col("score") >= 30, "medium").otherwise("low")
    return out.withColumn("risk", risk)


def churn_facts(monthly: DataFrame, domains: DataFrame, as_of: dt.date) -> DataFrame:
    """Inputs of the score per domain from the monthly order table."""
    totals = [F.sum(c).alias(c) for c in ("orders", "paid", "canceled")]
    per = monthly.groupBy("domain_id").agg(*quarter_sums(as_of), *totals)
    joined = domains.join(per, "domain_id", "left")
    counts = ["orders", "paid", "canceled", "last3", "prev3", "this_month"]
    keep = [c for c in domains.columns if c not in counts]
    return joined.select(*keep, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts])
