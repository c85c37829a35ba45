"""Registered queries: every job over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import dates, money, text
from .plans import billing, churn, cohorts, crm, freight, groups, kpi, mart, orders, panel, quality, receivables
from .session import cut_lineage, scratch_path
from .sources import bucketed, checked, files, readers, schemas, sinks
from .sources.edge import plain
from .sources.samples import AS_OF_ORDERS, Samples, blank
from .streaming import incremental

MAX_TOTAL = 400_000  # the test orders go up to 499,978
START = dt.date(1995, 3, 1)
CHURN_START = dt.date(1997, 1, 1)
TRIALS = ["BUILDING"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(job: Callable[[Samples], DataFrame]) -> Callable[[Samples], DataFrame]:
    """Register a job that takes the sample tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(job(Samples(spark, folder)))

    run.__doc__ = job.__doc__
    QUERIES[job.__name__] = run
    return job


# --- orders -----------------------------------------------------------------


@query
def monthly_domain_kpis(s: Samples) -> DataFrame:
    return orders.monthly_domain_kpis(s.orders(), max_total=MAX_TOTAL)


@query
def monthly_global_and_domain_rollup(s: Samples) -> DataFrame:
    rollup = orders.kpi_rollup(monthly_domain_kpis(s))
    return rollup.withColumns(
        {"domain_id": F.coalesce("domain_id", F.lit(-1)), "month": F.coalesce(dates.month_key(F.col("month")), F.lit("all"))}
    )


@query
def payment_split_by_month(s: Samples) -> DataFrame:
    return orders.payment_split(s.orders(), max_total=MAX_TOTAL)


@query
def payment_family_totals(s: Samples) -> DataFrame:
    return orders.family_totals(s.orders())


@query
def order_report_by_company(s: Samples) -> DataFrame:
    return orders.order_report(s.orders(), max_ticket=300_000)


@query
def order_union_multiset(s: Samples) -> DataFrame:
    rows = orders.order_union(s.history("orders"), s.history("quotes"), s.history("anterior"))
    return rows.select("record_id", "company_id", "day", "value", "code")


@query
def orders_per_brand(s: Samples) -> DataFrame:
    """Orders and quotes of each company by status letter."""
    registry = s.companies().select("company_id", F.col("domain_id").cast("string").alias("domain_id"))
    return orders.brand_counts(orders.orders_per_brand(*[s.brand_history(x) for x in ("orders", "quotes", "anterior")], registry))


@query
def owned_receivables(s: Samples) -> DataFrame:
    registry = s.companies().select("company_id", F.col("domain_id").cast("string").alias("domain_id"))
    rows = s.receivables().groupBy("company_id", "domain_id").agg(F.count("*").alias("lines"), F.sum("gross").alias("gross"))
    return orders.owned_records(rows, registry).groupBy("owner_id").agg(F.sum("lines").alias("lines"), F.sum("gross").alias("gross"))


@query
def local_month_shift(s: Samples) -> DataFrame:
    rows = s.raw("events").select("ts", money.money(F.col("value")).alias("value"))
    return orders.local_month_shift(rows, "ts")


@query
def three_month_average(s: Samples) -> DataFrame:
    return orders.three_month_average(s.orders(), AS_OF_ORDERS)


@query
def three_month_average_card_first(s: Samples) -> DataFrame:
    return orders.three_month_average(s.orders(), AS_OF_ORDERS, keep_pix_only=False)


@query
def order_totals_filtered(s: Samples) -> DataFrame:
    rows = orders.filtered_orders(s.orders(), {"payment_method": "PIX"}, "1", ("customer_doc", "order_id"))
    return orders.kpi_totals(rows)


@query
def company_last_orders(s: Samples) -> DataFrame:
    return orders.company_lookup(s.orders())


@query
def system_total_differences(s: Samples) -> DataFrame:
    """Order totals against line totals per domain."""
    ours = s.orders().groupBy("domain_id").agg(F.sum("total").alias("value"))
    lines = s.receivables().groupBy("order_id").agg(F.sum("gross").alias("gross"))
    theirs = s.orders().join(lines, "order_id").groupBy("domain_id").agg(F.sum("gross").alias("value"))
    return orders.totals_difference(ours, theirs)


@query
def drop_down_values(s: Samples) -> DataFrame:
    return orders.distinct_values(s.orders(), ["payment_method", "payment_status", "order_status", "delivery_provider"])


@query
def order_letters(s: Samples) -> DataFrame:
    from .functions.classify import order_letter

    letter = order_letter(F.col("payment_status"), F.col("order_status"), F.col("is_canceled"))
    return s.orders().groupBy(letter.alias("letter"), "payment_method").agg(F.count("*").alias("orders"))


# --- cohorts ----------------------------------------------------------------


@query
def first_full_month_value(s: Samples) -> DataFrame:
    return cohorts.first_full_month(s.orders(), AS_OF_ORDERS, START, MAX_TOTAL)


@query
def nth_order_club(s: Samples) -> DataFrame:
    return cohorts.month_club(s.orders(), dt.date(1998, 1, 1), dt.date(2001, 1, 1), 3, MAX_TOTAL)


@query
def club_months_reached(s: Samples) -> DataFrame:
    return cohorts.club_months(nth_order_club(s))


@query
def new_payment_cohort(s: Samples) -> DataFrame:
    return cohorts.new_payment_customers(s.orders(), s.companies(), START, MAX_TOTAL)


@query
def cohort_after_first_month(s: Samples) -> DataFrame:
    return cohorts.finished_first_month(new_payment_cohort(s), dt.date(1995, 5, 1))


@query
def domain_headquarters(s: Samples) -> DataFrame:
    return cohorts.with_row_number(s.companies()).select("company_id", "domain_id", "row_num")


# --- churn ------------------------------------------------------------------


def _plans(s: Samples) -> DataFrame:
    return churn.last_paid_plans(s.invoices(), s.billing_domains(), s.customer_bridge())


@query
def plan_churn_detail(s: Samples) -> DataFrame:
    return churn.plan_churn(_plans(s), AS_OF_ORDERS, CHURN_START).select(
        "domain_id", "plan", "last_paid", "churn_month", "total_churn", "angel_name"
    )


@query
def plan_churn_pivot(s: Samples) -> DataFrame:
    return churn.plan_churn_pivot(plan_churn_detail(s))


@query
def plan_churn_total(s: Samples) -> DataFrame:
    return churn.total_churn(_plans(s), AS_OF_ORDERS, CHURN_START)


@query
def plan_churn_tiered(s: Samples) -> DataFrame:
    return churn.tiered_churn(_plans(s), AS_OF_ORDERS, CHURN_START)


@query
def payment_churn_value_lost(s: Samples) -> DataFrame:
    rows = s.orders()
    return churn.value_lost(churn.payment_churn(rows, AS_OF_ORDERS, CHURN_START), rows)


@query
def trailing_quarter_drop(s: Samples) -> DataFrame:
    return churn.trailing_quarters(monthly_domain_kpis(s), AS_OF_ORDERS)


@query
def observed_quarter_drop(s: Samples) -> DataFrame:
    return churn.observed_quarters(monthly_domain_kpis(s))


@query
def churn_score(s: Samples) -> DataFrame:
    stage = F.when(F.col("angel_id").cast("int") == 3, "Churn").when(F.col("angel_id").cast("int") == 4, "Parado")
    facts = s.domains().select(
        "domain_id", F.col("integration_id").isNotNull().alias("has_integration"), F.coalesce(stage, F.lit("")).alias("stage")
    )
    return churn.churn_score(churn.churn_facts(monthly_domain_kpis(s), facts, AS_OF_ORDERS))


# --- billing ----------------------------------------------------------------


@query
def nps_by_domain(s: Samples) -> DataFrame:
    return billing.nps_by_domain(s.nps_answers())


@query
def mrr_last_month(s: Samples) -> DataFrame:
    return billing.mrr_last_month(s.invoices(), s.customer_bridge(), AS_OF_ORDERS)


def _items(s: Samples) -> DataFrame:
    return billing.classified_items(billing.invoice_items(s.invoice_lines()), s.customer_bridge())


@query
def invoice_item_revenue(s: Samples) -> DataFrame:
    return billing.revenue_by_month(_items(s))


@query
def invoice_item_revenue_by_domain(s: Samples) -> DataFrame:
    return billing.revenue_by_domain(_items(s))


@query
def recurring_revenue_register(s: Samples) -> DataFrame:
    """Revenue by domain with headquarters, partner and owner."""
    return billing.revenue_with_register(invoice_item_revenue_by_domain(s), _register(s))


@query
def invoice_item_revenue_by_domain_month(s: Samples) -> DataFrame:
    return billing.revenue_by_domain_month(_items(s))


def _unique(s: Samples) -> DataFrame:
    return billing.unique_invoices(s.invoices())


@query
def invoice_status_buckets(s: Samples) -> DataFrame:
    return billing.status_buckets(_unique(s), "customer_id")


@query
def invoice_current(s: Samples) -> DataFrame:
    return billing.current_invoice(_unique(s), "customer_id")


@query
def invoice_last_twelve(s: Samples) -> DataFrame:
    return billing.latest_invoices(_unique(s), "customer_id").select("customer_id", "position", "invoice_id", "status", "total_cents")


@query
def latest_subscription_per_domain(s: Samples) -> DataFrame:
    """Subscriptions are invoice plans; paid ones are active."""
    rows = s.invoices().select(
        "customer_id", F.concat_ws("/", "invoice_id", "item_id").alias("subscription_id"), "plan_name",
        F.col("status").isin("paid", "externally_paid").alias("active"), F.col("due_at").alias("updated_at"),
    ).dropDuplicates()
    return billing.latest_subscription(rows, "customer_id")


@query
def last_paid_invoice(s: Samples) -> DataFrame:
    return billing.last_paid_invoice(s.invoices(), "customer_id")


@query
def recurrence_totals(s: Samples) -> DataFrame:
    rows = _unique(s).withColumn("has_automatic", F.col("plan_name") == "Plano Pro")
    return billing.recurrence_totals(rows)


@query
def domain_kpi_table(s: Samples) -> DataFrame:
    """Domains with NPS, last month's revenue and three-month averages."""
    settings = s.companies().select(
        "domain_id", (F.col("status") == 1).alias("enabled"), F.col("company_name").isNotNull().alias("card_enabled"), F.lit(False).alias("pix_enabled")
    )
    domains = kpi.kpi_domains(s.domains(), settings, s.angels(), s.integrations(), TRIALS).fillna("", ["integration_name"])
    averages = orders.three_month_average(s.orders(), AS_OF_ORDERS).withColumn("domain_id", text.clean_domain_id(F.col("domain_id")))
    return kpi.kpi_table(domains, nps_by_domain(s).select("domain_id", "nps"), mrr_last_month(s), averages)


# --- receivables ------------------------------------------------------------


def _lines(s: Samples) -> DataFrame:
    known = groups.active_domains(s.domains(), TRIALS).select("domain_id")
    return receivables.receivable_lines(s.receivables(), s.order_instalments(), s.settings(), known, provider="PAY")


@query
def receivable_tree(s: Samples) -> DataFrame:
    return receivables.receivable_orders(_lines(s))


@query
def payment_schedule(s: Samples) -> DataFrame:
    return receivables.payment_schedule(_lines(s))


@query
def payment_schedule_by_day(s: Samples) -> DataFrame:
    return receivables.schedule_by_day(payment_schedule(s))


def _workspace_defaults(s: Samples) -> DataFrame:
    rows = s.purchases().select("workspace_id", F.to_date("created").alias("order_date"), F.col("anticipation").alias("anticipates"))
    return receivables.anticipation_default(rows, dt.date(2001, 11, 4), ratio=0.5)


@query
def anticipation_ratio(s: Samples) -> DataFrame:
    return _workspace_defaults(s)


@query
def purchase_merge_latest(s: Samples) -> DataFrame:
    """Paid purchases are the fresh pull, created ones the refreshed, all the previous."""
    rows = s.purchases().select("transaction_id", "workspace_id", "status", "amount", "anticipation", "updated")
    fresh, refreshed = rows.filter("status = 'paid'"), rows.filter("status = 'created'")
    return receivables.merge_purchases(fresh, refreshed, rows.withColumn("status", F.lit("old")), _workspace_defaults(s))


@query
def purchase_history_merged(s: Samples) -> DataFrame:
    """The same merge where the previous state is a table bucketed by transaction, and so is the next."""
    path = scratch_path(s.spark, "history")
    table = "purchases_" + path.rsplit("-", 1)[1]
    rows = s.purchases().select("transaction_id", "workspace_id", "status", "amount", "anticipation", "updated")
    buckets = bucketed.buckets_for(rows.count())
    bucketed.write(rows.withColumn("status", F.lit("old")), f"{table}_1", f"{path}/1", "transaction_id", buckets)
    s.spark.sql(f"DROP TABLE {table}_1")  # as after a restart: the files name themselves again
    history = bucketed.attach(s.spark, f"{table}_1", f"{path}/1", "transaction_id", buckets)
    fresh, refreshed = rows.filter("status = 'paid'"), rows.filter("status = 'created'")
    merged = receivables.merge_into_history(fresh, refreshed, history, cut_lineage(_workspace_defaults(s)), buckets)
    bucketed.write(merged, f"{table}_2", f"{path}/2", "transaction_id", buckets, dealt=True)
    return s.spark.read.parquet(f"{path}/2")


@query
def purchases_missing_now(s: Samples) -> DataFrame:
    rows = s.purchases().select("transaction_id", "order_id", "status")
    return receivables.missing_now(rows, rows.filter("status = 'paid'"))


@query
def duplicate_payments(s: Samples) -> DataFrame:
    rows = receivables.valid_purchases(s.purchases())
    return receivables.duplicate_payments(rows, receivables.duplicate_orders(rows))


@query
def duplicate_payment_orders(s: Samples) -> DataFrame:
    return receivables.duplicate_orders(receivables.valid_purchases(s.purchases()))


@query
def duplicate_payment_totals(s: Samples) -> DataFrame:
    return receivables.duplicate_totals(receivables.valid_purchases(s.purchases()))


@query
def cancellation_report(s: Samples) -> DataFrame:
    return receivables.cancellations(s.purchases(), s.orders())


@query
def purchase_tag_ids(s: Samples) -> DataFrame:
    return receivables.purchase_rows(s.purchases())


@query
def instalment_rows(s: Samples) -> DataFrame:
    return receivables.instalment_rows(s.purchases())


@query
def purchase_order_lookup(s: Samples) -> DataFrame:
    """Paid lines know their order by transaction, orders that stand by tag."""
    by_tx = s.receivables().filter("rec_status = 'paid'").join(s.orders().select("order_id", "order_number"), "order_id").select(
        F.col("rec_id").alias("transaction_id"), "order_number"
    )
    by_order = s.orders().filter("not is_canceled").select("order_id", "order_number")
    out = receivables.purchase_order_data(s.purchases(), by_tx, by_order, _workspace_defaults(s))
    return out.withColumn("order_number", F.coalesce("order_number", F.lit(-1)))


@query
def workspace_balances(s: Samples) -> DataFrame:
    rows = s.raw("supplier").select(
        F.col("s_nationkey").cast("string").alias("workspace_id"), F.when(F.col("s_acctbal") > 0, money.money(F.col("s_acctbal"))).alias("balance")
    ).groupBy("workspace_id").agg(F.sum("balance").alias("balance"))
    return receivables.balance_rollup(rows, "7")


# --- freight ----------------------------------------------------------------

HALF = (dt.date(1999, 3, 1), dt.date(1999, 3, 15))


@query
def freight_order_list(s: Samples) -> DataFrame:
    return freight.freight_orders(s.orders(), s.freight_close())


def _reconciled(s: Samples) -> DataFrame:
    return freight.reconcile(freight.postings(s.freight_close()), freight_order_list(s), *HALF)


@query
def freight_reconciliation(s: Samples) -> DataFrame:
    """Sheet rows posted in one half month against orders made in it."""
    text_of = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("is_canceled", "has_label")}
    return _reconciled(s).withColumns(text_of)


@query
def freight_reconciliation_summary(s: Samples) -> DataFrame:
    return freight.reconcile_summary(_reconciled(s))


@query
def freight_audits(s: Samples) -> DataFrame:
    """Findings over the whole period."""
    whole = freight.reconcile(freight.postings(s.freight_close()), freight_order_list(s), dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    return freight.reconcile_audits(whole)


@query
def freight_charge(s: Samples) -> DataFrame:
    return freight.freight_charge(freight.postings(s.freight_close()))


@query
def freight_half_months(s: Samples) -> DataFrame:
    return freight.half_month_totals(s.freight_close())


@query
def freight_sheet_reapplied(s: Samples) -> DataFrame:
    sheet = freight.postings(s.freight_close().filter("operator <> 'N'"))
    rows = freight.freight_orders(s.orders(), s.freight_close().filter("operator = 'N'"))
    return freight.reapply_sheet(rows, sheet).select(
        "order_id", "posting", "day", "order_status", "margin", "final", "posting_source"
    )


@query
def freight_two_sources(s: Samples) -> DataFrame:
    month = F.trunc("created_at", "MM").alias("month")
    first = s.orders().select("company_id", month, F.col("quoted").alias("value"))
    second = s.receivables().select("company_id", F.trunc("due_at", "MM").alias("month"), F.col("fee").alias("value"))
    return orders.two_source_months(first, second)


@query
def client_inferred_brands(s: Samples) -> DataFrame:
    return freight.client_brands(s.orders())


# --- meetings, surveys and the assistant -------------------------------------


@query
def deal_last_meeting_asof(s: Samples) -> DataFrame:
    return crm.deal_meetings(s.deals(), s.meetings()).select(
        "deal_id", "company_id", F.coalesce("match.meeting_id", F.lit(-1)).alias("meeting_id"),
        F.coalesce("match.owner_rank", F.lit(-1)).alias("owner_rank"),
    )


@query
def weekly_matrix_zero_filled(s: Samples) -> DataFrame:
    return crm.weekly_matrix(s.meetings(), crm.deal_meetings(s.deals(), s.meetings()))


@query
def meeting_deal_conversion(s: Samples) -> DataFrame:
    return crm.conversion(weekly_matrix_zero_filled(s))


@query
def closed_meetings_weekly(s: Samples) -> DataFrame:
    return crm.closed_meetings(s.meetings())


@query
def csat_note_lines(s: Samples) -> DataFrame:
    return crm.csat_lines(s.csat_notes())


@query
def average_of_weekly_averages(s: Samples) -> DataFrame:
    score = F.expr("cast(floor(value) as int) % 11").cast("double")
    rows = s.raw("events").select(F.trunc("ts", "MM").alias("month"), dates.week_start(F.col("ts")).alias("week"), score.alias("value"))
    out = crm.average_of_weeks(rows)
    return out.withColumn("average", F.round(F.col("average").cast("decimal(18,8)"), 4))


@query
def ai_panel_monthly(s: Samples) -> DataFrame:
    return crm.assistant_months(s.ai_orders(), s.ai_interactions())


@query
def ai_panel_weekly(s: Samples) -> DataFrame:
    return crm.assistant_weeks(s.ai_interactions())


@query
def ai_sales_by_type(s: Samples) -> DataFrame:
    return crm.sales_by_type(s.ai_orders())


@query
def event_counts_weekly(s: Samples) -> DataFrame:
    return crm.event_weeks(s.ai_events())


# --- domain panel -------------------------------------------------------------


@query
def feature_flags_month(s: Samples) -> DataFrame:
    return panel.panel_months(s.domain_month())


@query
def feature_flags_domain(s: Samples) -> DataFrame:
    return panel.domain_panel(s.domain_month(), s.orders())


# --- registers, groups and matching -------------------------------------------


def _register(s: Samples) -> DataFrame:
    live = groups.active_domains(s.domains(), TRIALS)
    return groups.company_register(live, s.companies(), s.angels(), s.partners(), s.integrations())


@query
def active_domains_enriched(s: Samples) -> DataFrame:
    return _register(s)


@query
def active_domains_strict(s: Samples) -> DataFrame:
    return groups.active_domains(s.domains(), TRIALS, keep_null_partner=False).select("domain_id", "domain_name", "partner_id")


@query
def register_counts(s: Samples) -> DataFrame:
    late = orders.since(s.orders(), dt.date(2001, 1, 1)).withColumn("domain_id", text.clean_domain_id(F.col("domain_id")))
    return groups.register_counts(_register(s), late)


@query
def inactive_duplicate_removal(s: Samples) -> DataFrame:
    late = s.orders().groupBy("company_id").agg(F.count("*").alias("orders"))
    doc = F.concat(F.substring("tax_document", 1, 8), F.lit("000100"))
    rows = s.companies().join(late, "company_id", "left").select(
        "company_id", doc.alias("tax_document"), F.coalesce("orders", F.lit(0)).alias("orders")
    )
    return groups.drop_idle_copies(rows)


def _groups(s: Samples) -> DataFrame:
    counts = s.orders().groupBy("company_id").agg(F.count("*").alias("orders"))
    rows = s.companies().join(counts, "company_id", "left").withColumn("name", F.col("social_name"))
    return groups.company_groups(rows)


@query
def company_groups(s: Samples) -> DataFrame:
    return _groups(s)


@query
def links_clicks_canonical(s: Samples) -> DataFrame:
    return groups.canonical_activity(s.links(), s.clicks(), _groups(s))


@query
def canonical_companies(s: Samples) -> DataFrame:
    counts = s.orders().groupBy("company_id").agg(F.count("*").alias("orders"))
    return groups.canonical_by_orders(s.companies().join(counts, "company_id", "left"))


@query
def normalise_names(s: Samples) -> DataFrame:
    return s.raw("conversations").select(
        "conv_id", "turn", text.normalise_name(F.col("text")).alias("name"), text.light_normalise(F.col("text")).alias("light"),
        text.compare_key(F.col("text")).alias("key"),
    )


@query
def plan_main_lines(s: Samples) -> DataFrame:
    return groups.plan_per_tax_id(s.plan_lines())


@query
def tiered_plan_match(s: Samples) -> DataFrame:
    return groups.match_plans(s.named_companies(), groups.plan_per_tax_id(s.plan_lines()))


@query
def tiered_invoice_match(s: Samples) -> DataFrame:
    """Invoices by the domains of large parts, and by brand names cut short."""
    part = s.raw("part")
    by_domain = part.filter("p_size > 40").select(F.col("p_partkey").alias("domain_id"))
    brand = F.expr("case when p_size < 10 then p_name when p_size < 30 then concat(p_name, ' ', substring(lower(p_type), 1, 3)) else concat(p_name, ' ', p_type, ' ', p_brand) end")
    return groups.match_invoices(s.named_companies(), by_domain, part.select(brand.alias("brand")))


@query
def tiered_panel_match(s: Samples) -> DataFrame:
    config = F.when(F.col("domain_id") >= 10, F.expr("concat('Churn - ', split_part(name, ' ', 1), ' ', split_part(name, ' ', 2))"))
    companies = s.named_companies().withColumn("config_name", config)
    panels = s.raw("part").select(
        F.expr("case when p_size > 45 then concat(p_name, ' ', p_type) when p_size > 40 then p_name else split_part(p_name, ' ', 2) end").alias("panel")
    )
    return groups.match_panels(companies, panels)


@query
def fuzzy_ticket_match(s: Samples) -> DataFrame:
    return groups.match_tickets(s.tickets(), s.named_companies())


@query
def survey_brand_match(s: Samples) -> DataFrame:
    brands = s.raw("part").select(F.expr("concat(p_name, case when p_size > 25 then ' ec' else '' end)").alias("brand")).distinct()
    return groups.survey_brands(brands, s.named_companies())


@query
def survey_user_match(s: Samples) -> DataFrame:
    """Phones built from keys; answers carry the country code."""
    users = s.raw("customer").select(
        F.col("c_custkey").alias("user_id"), F.expr("c_custkey div 3").alias("domain_id"),
        F.expr("concat('(11) 9', lpad(cast(c_custkey div 2 as string), 4, '0'), '-', lpad(cast(c_nationkey as string), 4, '0'))").alias("phone"),
    )
    answers = s.raw("customer").select(
        F.col("c_custkey").alias("answer_id"),
        F.expr("concat('55119', lpad(cast(c_custkey as string), 4, '0'), lpad(cast(c_nationkey as string), 4, '0'))").alias("phone"),
    )
    out = groups.survey_users(answers, users)
    return out.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("user_id", "domain_id")})


# --- mart and quality -----------------------------------------------------------


def _months(s: Samples) -> DataFrame:
    month = F.trunc("created_at", "MM").alias("month")
    shared = s.links().groupBy(F.col("company_id").cast("bigint").alias("domain_id"), month).agg(
        F.count("*").alias("links"), F.lit(0).cast("long").alias("clicks")
    )
    clicked = s.clicks().groupBy(F.col("company_id").cast("bigint").alias("domain_id"), month).agg(
        F.lit(0).cast("long").alias("links"), F.sum("shared_links").alias("clicks")
    )
    activity = shared.unionByName(clicked).groupBy("domain_id", "month").agg(F.sum("links").alias("links"), F.sum("clicks").alias("clicks"))
    return mart.month_table(orders.merchant_months(s.orders(), max_total=MAX_TOTAL), activity)


@query
def month_table(s: Samples) -> DataFrame:
    return _months(s)


@query
def global_month_series(s: Samples) -> DataFrame:
    return mart.month_series(_months(s))


def _mart_inputs(s: Samples) -> dict:
    """What the mart takes beside the monthly orders; what is computed from the large tables is written, so that several marts read it."""
    register = cut_lineage(_register(s))
    named = register.select("company_id", "domain_id", F.col("trade_name").alias("name"))
    match = cut_lineage(groups.match_invoices(named, s.customer_bridge().select("domain_id"), s.raw("part").select(F.col("p_name").alias("brand"))))
    invoices = cut_lineage(mart.company_invoices(match, billing.invoice_states(_unique(s), s.customer_bridge()), "domain_id"))
    inactive = F.col("status") == 2
    plans = s.companies().select("company_id", F.col("social_name").alias("plan"), F.lit(77).cast("decimal(18,2)").alias("total"))
    controls = s.companies().select("company_id", F.when(inactive, F.lit(99)).cast("decimal(18,2)").alias("manual_fee"))
    tickets = s.companies().select("company_id", F.when(inactive, "Parado").otherwise("Fila").alias("stage"))
    activity = links_clicks_canonical(s).groupBy(F.col("hq_id").alias("company_id")).agg(F.sum("links").alias("links"), F.sum("clicks").alias("clicks"))
    return {
        "register": register, "invoices": invoices, "freight": cut_lineage(freight_charge(s)), "plans": plans, "controls": controls, "tickets": tickets,
        "as_of": AS_OF_ORDERS, "extras": [cut_lineage(activity)],
    }


def _built(rows: DataFrame) -> DataFrame:
    return rows.fillna(0, ["links", "clicks"]).fillna("", ["bill_status"])


def _mart(s: Samples) -> DataFrame:
    return _built(mart.company_mart(months=orders.merchant_months(s.orders(), max_total=MAX_TOTAL), **_mart_inputs(s)))


MART_COLUMNS = [
    "company_id", "domain_id", "name", "is_hq", "orders", "paid", "canceled", "value", "pix_value", "card_orders", "last3", "prev3",
    "bill_paid", "bills", "bill_status", "links", "clicks", "freight_cost", "fee", "has_integration", "has_payment", "score", "risk", "reasons",
]


@query
def company_mart(s: Samples) -> DataFrame:
    return _mart(s).select(*MART_COLUMNS)


@query
def mart_refreshed(s: Samples) -> DataFrame:
    """The mart after one order in a hundred is new: only companies that the new orders reach are computed again."""
    whole = s.orders()
    is_new = F.col("order_number") % 100 == 0
    inputs = _mart_inputs(s)
    months = cut_lineage(orders.merchant_months(whole.filter(~is_new), max_total=MAX_TOTAL))
    before = cut_lineage(_built(mart.company_mart(months=months, **inputs)))
    more = orders.merchant_months(whole.filter(is_new), max_total=MAX_TOTAL)
    domains = more.select("domain_id").distinct()
    # The columns that `_built` fills are filled again in the part that is new.
    after = mart.refreshed_mart(before, months=mart.add_months(months, more), domains=domains, companies=domains.select(F.lit("").alias("company_id")).limit(0), **inputs)
    return _built(after).select(*MART_COLUMNS)


@query
def company_siblings(s: Samples) -> DataFrame:
    return mart.siblings(_register(s))


@query
def order_quality(s: Samples) -> DataFrame:
    return quality.order_quality(s.orders())


@query
def unmatched_receivables(s: Samples) -> DataFrame:
    return quality.unmatched(s.receivables(), s.orders().filter("is_paid"), "order_id")


@query
def table_profile(s: Samples) -> DataFrame:
    return quality.exact_profile(s.raw("documents").select("doc_id", "text", "lang", "source", "n_chars"))


@query
def profile_of_days(s: Samples) -> DataFrame:
    """A profile of all orders from sketches stored for each month; whether the estimates lie within their bound of the exact counts."""
    path = scratch_path(s.spark, "sketches")
    rows = s.orders().select("order_id", "company_id", "domain_id", "customer_doc", "total", "paid_at", F.trunc("created_at", "MM").alias("day"))
    quality.day_sketches(rows, "day").write.partitionBy("day").parquet(path)
    found = quality.sketched_profile(s.spark.read.parquet(path))
    columns = [c for c in rows.columns if c != "day"]
    exact = rows.agg(*[F.countDistinct(c).alias(c) for c in columns]).unpivot([], columns, "column", "exact")
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.ceil(F.col("exact") * quality.ERROR)
    return found.join(exact, "column").select("column", "rows", "filled", near.alias("near"))


@query
def weekly_counts_streamed(s: Samples) -> DataFrame:
    """Weekly event counts of a stream that lands in two parts, the second with a third of the first again; the query restarts between them."""
    root = scratch_path(s.spark, "stream")
    rows = s.raw("events").select("event_id", F.col("user_id").alias("brand"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("event"))
    schema = rows.schema
    for part, when in enumerate((F.col("event_id") % 2 == 0, (F.col("event_id") % 2 == 1) | (F.col("event_id") % 3 == 0))):
        rows.filter(when).repartition(2).write.parquet(f"{root}/landed/{part}")
        stream = s.spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
        incremental.keep_weekly_events(stream, f"{root}/weeks", f"{root}/checkpoint", "60 days").awaitTermination()
    return sinks.read_current(s.spark, f"{root}/weeks").select("brand", "event", "week", "n")


@query
def value_counts(s: Samples) -> DataFrame:
    return quality.value_counts(s.raw("documents"), "source")


# --- column rules, sheets and exports ---------------------------------------------


@query
def money_texts(s: Samples) -> DataFrame:
    """Line values written in four ways and read back."""
    whole, part = "cast(floor(l_extendedprice) as bigint)", "lpad(cast(cast(l_quantity as int) as string), 2, '0')"
    grouped = f"translate(format_number({whole}, 0), ',', '.')"
    text_of = (
        f"case l_linenumber when 1 then concat('R$ ', {grouped}, ',', {part}) when 2 then concat({whole}, '.', {part}, ' BRL')"
        f" when 3 then concat({whole}, ',', {part}) when 4 then concat({whole}, '.', {part}) when 5 then 'a combinar' else concat(' ', {grouped}, ',', {part}, ' ') end"
    )
    rows = s.raw("lineitem").select("l_linenumber", F.expr(text_of).alias("text"))
    return rows.groupBy("l_linenumber").agg(F.count(money.money_br(F.col("text"))).alias("read"), F.sum(money.money_br(F.col("text"))).alias("value"))


@query
def date_texts(s: Samples) -> DataFrame:
    """Order days written as ISO, dd/mm/yyyy, dd/mm/yy, sheet serial and epoch milliseconds."""
    text_of = (
        "case o_orderpriority when '1-URGENT' then date_format(o_orderdate, 'yyyy-MM-dd') when '2-HIGH' then date_format(o_orderdate, 'dd/MM/yyyy')"
        " when '3-MEDIUM' then date_format(o_orderdate, 'dd/MM/yyyy') when '4-NOT SPECIFIED' then cast(datediff(o_orderdate, date'1899-12-30') as string)"
        " else cast(unix_millis(cast(o_orderdate as timestamp)) as string) end"
    )
    rows = s.raw("orders").select("o_orderpriority", dates.parse_day(F.expr(text_of)).alias("day"))
    return rows.groupBy("o_orderpriority", "day").agg(F.count("*").alias("orders"))


@query
def status_labels(s: Samples) -> DataFrame:
    """Codes with a label, others as they are."""
    labels = s.spark.createDataFrame([("F", "Concluído"), ("O", "Fila")], "code string, label string")
    rows = s.raw("orders").groupBy(F.col("o_orderstatus").alias("stage")).agg(F.count("*").alias("orders"))
    return groups.labelled(rows, "stage", labels)


@query
def register_overlay(s: Samples) -> DataFrame:
    """Empty names filled from a second source, whose status always wins."""
    from .operators.joins import overlay

    base = s.companies().select("company_id", "company_name", F.col("status").cast("string").alias("status"))
    other = s.companies().select(
        "company_id", F.col("social_name").alias("company_name"), F.when(F.col("domain_id") < 100, "9").otherwise("").alias("status")
    )
    return overlay(base, other, "company_id", fill=["company_name"], force=["status"])


@query
def values_from_previous(s: Samples) -> DataFrame:
    """Missing names taken from the previous run."""
    new = s.companies().select("company_id", "company_name")
    return quality.or_previous(new, s.companies().select("company_id", F.lower("social_name").alias("company_name")), "company_id", ["company_name"])


@query
def mart_patched(s: Samples) -> DataFrame:
    """Links and clicks written over a table that lacks them."""
    base = s.companies().select("company_id", "domain_id", F.lit(0).cast("long").alias("links"))
    patch = s.links().groupBy("company_id").agg(F.count("*").alias("links"))
    return mart.patch_columns(base, patch, "company_id", ["links"])


@query
def monthly_fee_precedence(s: Samples) -> DataFrame:
    acct = money.money(F.col("c_acctbal"))
    rows = s.raw("customer").select(
        F.col("c_custkey"), F.when(F.col("c_nationkey") < 5, acct).alias("manual_fee"), (acct - 3000).alias("billed_total"),
        F.col("c_nationkey").cast("decimal(18,2)").alias("plan_value"),
    )
    return mart.fee_precedence(rows).select("c_custkey", F.coalesce("monthly_fee", F.lit(0)).alias("monthly_fee"))


@query
def invoices_waiting(s: Samples) -> DataFrame:
    rows = _unique(s).withColumn("has_automatic", F.col("plan_name") == "Plano Pro")
    return billing.invoices_of_class(rows, "waiting").select("invoice_id", "due_at", "total_cents")


@query
def payment_key_register(s: Samples) -> DataFrame:
    """Keys by part name; the part with the largest key is the company."""
    keys = s.raw("part").groupBy(F.upper("p_name").alias("brand")).agg(
        F.min(F.format_string("%011d", F.col("p_partkey"))).alias("payment_key")
    ).withColumn("payment_key", text.payment_key(F.col("payment_key")))
    companies = s.raw("part").select(F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("company_id"), F.col("p_size").alias("domain_id"))
    return receivables.payment_key_register(keys, companies)


@query
def payment_key_lookup(s: Samples) -> DataFrame:
    """Keys by tax id for some companies, by name for the rest."""
    rows = s.companies().select("company_id", F.col("tax_document").alias("tax_id"), "social_name")
    by_tax = s.companies().filter("status = 2").groupBy(F.col("tax_document").alias("tax_id")).agg(F.concat(F.lit("tax-"), F.min("company_id")).alias("payment_key"))
    by_name = s.companies().filter("company_name is not null").groupBy(text.light_normalise(F.col("company_name")).alias("name_key")).agg(
        F.concat(F.lit("name-"), F.min("company_id")).alias("payment_key")
    )
    return receivables.keyed_by_tax_or_name(rows, by_tax, by_name, text.light_normalise(F.col("social_name")))


@query
def csat_form_answers(s: Samples) -> DataFrame:
    forms = s.raw("part").select(
        F.expr("case when p_size = 1 then 'Teste' when p_size = 2 then ' ' else p_brand end").alias("brand"),
        F.expr("case when p_size < 30 then concat('nota ', p_size div 5, ',5 de 10') else 'sem nota' end").alias("score_text"),
        F.expr("case when p_size < 45 then cast(p_size as string) end").alias("second_text"),
        F.expr("1700000000000 + p_partkey * 3600000").alias("submitted_ms"),
    )
    return crm.csat_answers(forms, ["teste"])


@query
def nps_survey_rows(s: Samples) -> DataFrame:
    answers = s.raw("customer").select(
        F.col("c_name").alias("name"), F.expr("case when c_nationkey = 3 then ' ' else concat(' ', c_mktsegment) end").alias("comment"),
        F.expr("case when c_nationkey = 4 then 'sem dominio' when c_nationkey > 12 then concat(c_custkey, '.0') else cast(c_custkey as string) end").alias("domain"),
        F.when(F.col("c_acctbal") > 0, (F.col("c_nationkey") % 11).cast("int")).alias("score"),
        F.lit(None).cast("date").alias("filled_on"),
    )
    rows = crm.nps_rows(answers).drop("filled_on")
    return rows.withColumns({"domain_id": F.coalesce("domain_id", F.lit(-1)), "comment": F.coalesce("comment", F.lit("-"))})


@query
def manual_postings(s: Samples) -> DataFrame:
    """Postings without an order: those of the new sheet, then old ones it lacks."""
    rows = s.raw("lineitem").select(
        F.expr("case when l_quantity > 25 then concat('c', l_orderkey) else '' end").alias("internal_code"),
        F.to_date("l_shipdate").alias("posted_on"), F.col("l_suppkey").cast("string").alias("invoice_no"),
        F.col("l_quantity").cast("int").alias("posting"), "l_returnflag",
    )
    new = rows.filter("l_returnflag = 'A'").drop("l_returnflag")
    return freight.manual_postings(new, rows.filter("l_returnflag <> 'A'").drop("l_returnflag"))


@query
def sheet_total_row(s: Samples) -> DataFrame:
    """The total row among the rows of a sheet."""
    rows = s.freight_close().select("volume_code", F.col("volume_code").alias("order_number"), "posting_text")
    total = s.raw("lineitem").agg(F.concat(F.lit("R$ "), F.sum(F.col("l_quantity").cast("int")).cast("string"), F.lit(",00")).alias("posting_text"))
    total = total.select(F.lit("").alias("volume_code"), F.lit(None).cast("string").alias("order_number"), "posting_text")
    return freight.sheet_total(rows.unionByName(total))


@query
def latest_sheet_lines(s: Samples) -> DataFrame:
    """Plan lines of the newest of several monthly sheets, named in three ways."""
    from .sources.readers import latest_sheet

    name = F.expr(
        "case when p_size = 50 then 'Planos 07-2024' when p_size > 40 then 'Planos 06-2024' when p_size > 20 then concat('Planos 0', p_size % 5 + 1, '2024') else 'Planos 1223' end"
    )
    return latest_sheet(s.raw("part").select("p_partkey", "p_name", name.alias("sheet")))


@query
def plan_fallback_source(s: Samples) -> DataFrame:
    """Plans of a rich source by tax id, the poorer source for the rest."""
    from .sources.readers import with_fallback

    main = groups.plan_per_tax_id(s.plan_lines()).filter("lines = 1").select("tax_id", "plan", "total")
    poorer = groups.plan_per_tax_id(s.plan_lines()).select("tax_id", "plan")
    return with_fallback(main, poorer, "tax_id").withColumn("total", F.coalesce("total", F.lit(0)))


@query
def export_chunk_map(s: Samples) -> DataFrame:
    from .sources.sinks import chunk_map

    return chunk_map(s.orders().groupBy("company_id").agg(F.count("*").alias("orders")))


@query
def month_vectors(s: Samples) -> DataFrame:
    """Export vectors with all values in hundredths, as one text."""
    rows = mart.month_vectors(_months(s))
    cents = F.transform("vector", lambda v: F.round(v * 100).cast("long").cast("string"))
    return rows.select("domain_id", "month", F.array_join(cents, ",").alias("vector"))


@query
def panel_vectors(s: Samples) -> DataFrame:
    rows = panel.month_vector(s.domain_month())
    cents = F.transform("vector", lambda v: F.round(v * 100).cast("long").cast("string"))
    return rows.select("domain_id", "month", F.array_join(cents, ",").alias("vector"))


@query
def domain_freight_audit(s: Samples) -> DataFrame:
    """Freight orders of the domain with most postings against the sheet."""
    sheet = freight.postings(s.freight_close())
    busiest = sheet.groupBy("domain_id").agg(F.count("*").alias("n")).agg(F.min(F.struct((-F.col("n")).alias("n"), "domain_id"))["domain_id"])
    found = freight.domain_audit(sheet, freight_order_list(s), busiest.scalar(), dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    return found.select("domain_id", "order_number", "sheet_posting", "system_posting", "outcome")


@query
def panel_stats_kept(s: Samples) -> DataFrame:
    """Larger measures of two runs of the assistant panel."""
    rows = s.ai_orders()
    new = rows.filter("ts >= timestamp'2024-01-15'").groupBy("brand").agg(F.count("*").alias("orders"), F.sum("total").alias("sales"))
    old = rows.filter("ts < timestamp'2024-01-15'").groupBy("brand").agg(F.count("*").alias("orders"), F.sum("total").alias("sales"))
    return crm.keep_larger(new, old, "brand", ["orders", "sales"])


@query
def people_of_two_sources(s: Samples) -> DataFrame:
    return crm.people((s.raw("nation"), "n_name"), (s.raw("customer"), "c_mktsegment"))


@query
def local_days(s: Samples) -> DataFrame:
    """Events per local day, month label and business day."""
    local = F.to_date(dates.to_local(F.col("ts")))
    rows = s.raw("events").groupBy(local.alias("day")).agg(F.count("*").alias("events"))
    return rows.select("day", "events", dates.month_label(F.col("day")).alias("label"), dates.next_business_day(F.col("day")).alias("business_day"))


@query
def years_scanned(s: Samples) -> DataFrame:
    """Month totals of two years out of one scan."""
    from .sources.readers import years_of

    rows = years_of(s.orders(), "created_at", [1999, 2000])
    return rows.groupBy(F.trunc("created_at", "MM").alias("month")).agg(F.count("*").alias("orders"), F.sum("total").alias("value"))


@query
def assistant_last_months(s: Samples) -> DataFrame:
    """Latest three months of each merchant's monthly table."""
    return crm.last_months(monthly_domain_kpis(s), "domain_id", 3).select("domain_id", "month", "orders")


@query
def risk_counts(s: Samples) -> DataFrame:
    return mart.risk_counts(churn_score(s))


@query
def weekly_event_maps(s: Samples) -> DataFrame:
    """Event counts per week as one text per brand."""
    rows = crm.event_map(crm.event_weeks(s.ai_events()))
    parts = F.transform(F.map_entries("events"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.select("brand", "week", F.array_join(parts, ",").alias("events"))


@query
def club_month_maps(s: Samples) -> DataFrame:
    """Month maps of the club, orders per month as one text."""
    rows = cohorts.month_map(cohorts.month_club(s.orders(), dt.date(1998, 1, 1), dt.date(2001, 1, 1), 3, MAX_TOTAL))
    parts = F.transform(F.map_entries("months"), lambda e: F.concat_ws("=", e["key"], e["value"]["orders"].cast("string")))
    return rows.select("domain_id", F.array_join(parts, ",").alias("months"))


# --- variants and reports -------------------------------------------------------------


@query
def activity_rollup(s: Samples) -> DataFrame:
    rows = groups.activity_rollup(links_clicks_canonical(s))
    return rows.select(F.coalesce("hq_id", F.lit("all")).alias("hq_id"), F.coalesce(dates.month_key(F.col("month")), F.lit("all")).alias("month"), "links", "clicks")


@query
def latest_tickets(s: Samples) -> DataFrame:
    """Events as tickets, the user as the company."""
    rows = s.raw("events").select(
        F.col("event_id").alias("ticket_id"), F.col("user_id").alias("company_id"), F.to_date("ts").alias("modified"), F.col("event_type").alias("stage")
    )
    return groups.latest_tickets(rows)


@query
def group_heads(s: Samples) -> DataFrame:
    """Groups whose marked headquarters is inactive fall back to the next company."""
    return groups.group_heads(cohorts.with_row_number(s.companies()).withColumn("is_hq", F.col("row_num") == 1).filter("status = 1"))


@query
def active_brands(s: Samples) -> DataFrame:
    from .functions.classify import company_status

    rows = s.companies().select(
        "company_id", F.when(F.col("company_name").isNotNull(), company_status(F.col("status"))).alias("status_text"), F.when(F.col("domain_id") < 50, "Ativa").alias("metric_status")
    )
    return mart.active_brand(rows).select("company_id", "active_brand")


@query
def active_brands_by_cards(s: Samples) -> DataFrame:
    return mart.active_by_cards(payment_split_by_month(s).groupBy("domain_id").agg(F.sum("card_orders").alias("card_orders")), 8)


@query
def company_freight(s: Samples) -> DataFrame:
    rows = s.receivables().select("company_id", F.trunc("due_at", "MM").alias("month"), F.when(F.col("fee") > 3000, F.col("fee")).otherwise(0).alias("value"))
    out = freight.company_freight(rows)
    return out.withColumn("month", F.coalesce(dates.month_key(F.col("month")), F.lit("all")))


@query
def freight_measures(s: Samples) -> DataFrame:
    return freight.freight_measures(freight.freight_orders(s.orders(), s.freight_close()))


@query
def freight_field_differences(s: Samples) -> DataFrame:
    """Names and places written differently on both sides."""
    sheet = freight.postings(s.freight_close()).select(
        "domain_id", "order_number", "posting", F.concat(F.lit("CLIENTE Nº "), F.col("domain_id")).alias("client"),
        F.when(F.col("operator") == "N", "São Paulo").otherwise("Rio").alias("city"), F.lit("SP - x").alias("state"),
    )
    system = s.orders().select(
        text.clean_domain_id(F.col("domain_id")).alias("domain_id"), "order_number", "is_canceled",
        F.concat(F.when(F.col("is_paid"), "Cliente n. ").otherwise("Cliente nº "), F.col("domain_id")).alias("client"), F.lit("SAO-PAULO").alias("city"), F.lit("sp").alias("state"),
        F.when(F.col("is_paid"), F.col("quoted")).alias("posting"),
    )
    return freight.field_differences(sheet, system)


@query
def payment_provider_totals(s: Samples) -> DataFrame:
    return orders.provider_totals(s.orders().withColumn("provider", F.col("delivery_provider")), ["Jadlog", "Total Express"])


@query
def payment_churn_value_lost_same_month(s: Samples) -> DataFrame:
    rows = s.orders()
    return churn.value_lost(churn.payment_churn(rows, AS_OF_ORDERS, CHURN_START), rows, same_month=True).select("domain_id", "value_lost", "note")


@query
def largest_orders(s: Samples) -> DataFrame:
    return orders.sorted_rows(s.orders().select("order_id", "total"), "total", n=20)


@query
def configured_assistants(s: Samples) -> DataFrame:
    rows = s.raw("customer").select(
        F.col("c_custkey").cast("string").alias("company_id"), F.when(F.col("c_nationkey") > 2, F.when(F.col("c_nationkey") > 5, F.col("c_name")).otherwise("")).alias("url"),
        F.when(F.col("c_mktsegment") == "BUILDING", "1").when(F.col("c_mktsegment") == "MACHINERY", " Sim").otherwise("0").alias("retail"),
    )
    return crm.configured(rows, ["retail"])


# --- payment churn of active domains -----------------------------------------


def _active_churn(s: Samples) -> DataFrame:
    found = churn.payment_churn(s.orders(), AS_OF_ORDERS, CHURN_START)
    return churn.active_payment_churn(found, groups.active_domains(s.domains(), TRIALS), s.angels())


@query
def payment_churn_active(s: Samples) -> DataFrame:
    """Active domains that stopped paying, with owner and lost value."""
    rows = _active_churn(s)
    lost = churn.value_lost(rows, s.orders()).select("domain_id", "value_lost")
    return rows.select("domain_id", "domain_name", "owner", "last_payment", "last_order", "payment_orders", "churn_month").join(lost, "domain_id")


@query
def payment_churn_pivot(s: Samples) -> DataFrame:
    return churn.payment_churn_pivot(_active_churn(s))


@query
def payment_churn_history(s: Samples) -> DataFrame:
    return churn.payment_history(_active_churn(s), s.orders())


@query
def sheet_snapshot_merge(s: Samples) -> DataFrame:
    """A new half-month sheet over the earlier one of the same half month."""
    old = freight.postings(s.freight_close().filter("operator <> 'A'")).select("domain_id", "order_number", "posting", "operator")
    new = freight.postings(s.freight_close().filter("operator = 'A'")).select("domain_id", "order_number", "posting", "operator")
    return freight.merge_sheet_snapshots(new, old)


# --- readers and sinks: written to the shared folder and read back -------------


@query
def csv_read_back(s: Samples) -> DataFrame:
    """Notes with line feeds and quotes through a CSV with a byte-order mark."""
    path = scratch_path(s.spark, "csv")
    notes = s.csat_notes().withColumn("note", F.concat(F.lit('"'), F.col("note"), F.lit('"; x')))
    sinks.write_csv(notes, path)
    back = readers.read_csv(s.spark, path, multi_line=True, sep=";")
    back = back.toDF(*[c.lstrip("\ufeff") for c in back.columns])
    return back.select(F.col("note_id").cast("bigint").alias("note_id"), "month", "note")


@query
def csv_typed_read_back(s: Samples) -> DataFrame:
    """Orders through a CSV with a schema."""
    path = scratch_path(s.spark, "csv")
    rows = s.orders().select("order_id", "order_number", "total", "is_paid")
    sinks.write_csv(rows, path, sep=",", bom=False)
    return readers.read_csv(s.spark, path, "order_id string, order_number bigint, total decimal(18,2), is_paid boolean")


@query
def json_read_back(s: Samples) -> DataFrame:
    path = scratch_path(s.spark, "json")
    sinks.write_json(s.settings().select("company_id", "company_label", "fee_enabled"), path)
    return s.spark.read.schema("company_id string, company_label string, fee_enabled boolean").json(path)


@query
def purchase_documents(s: Samples) -> DataFrame:
    """Nested purchase documents, one to a line, as flat purchases."""
    path = scratch_path(s.spark, "purchases")
    rows = s.purchases()
    instalment = F.transform("installments", lambda i: F.struct(i["amount"].alias("amount"), F.date_format(i["due"], "yyyy-MM-dd'T'HH:mm:ssXXX").alias("due")))
    body = F.struct(
        F.col("transaction_id").alias("purchaseId"), "status", F.col("amount").alias("amount"), F.date_format("created", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created"),
        F.col("tags").alias("tags"), instalment.alias("installments"),
    )
    sinks.write_json(rows.select(F.col("workspace_id").alias("workspaceId"), F.col("order_id").alias("orderId"), F.col("anticipation").alias("anticipation"), body.alias("purchase")), path)
    flat = readers.flatten_purchases(readers.read_purchases(s.spark, path))
    return flat.select("purchase_id", "workspace_id", "order_id", "purchase_status", "amount_cents", "anticipation", F.to_date("created").alias("created_on"), "tags")


@query
def instalment_documents(s: Samples) -> DataFrame:
    """Instalments of the nested documents, numbered by due day."""
    path = scratch_path(s.spark, "instalments")
    instalment = F.transform(F.reverse("installments"), lambda i: F.struct(i["amount"].alias("amount"), F.date_format(i["due"], "yyyy-MM-dd'T'15:00:00XXX").alias("due")))
    sinks.write_json(s.purchases().select(F.struct(F.col("transaction_id").alias("purchaseId"), instalment.alias("installments")).alias("purchase")), path)
    flat = readers.flatten_instalments(readers.read_purchases(s.spark, path))
    return flat.groupBy("installment_number").agg(F.count("*").alias("n"), F.sum("amount_cents").alias("cents"), F.min(F.to_date("due")).alias("first_due"))


@query
def datasets_read_back(s: Samples) -> DataFrame:
    """One folder per provider, one of them unreadable, with the report on skipped folders."""
    root = scratch_path(s.spark, "datasets")
    s.orders().select("order_id", "total", "delivery_provider").write.partitionBy("delivery_provider").parquet(f"{root}/by_provider")
    found = readers.folders(s.spark, f"{root}/by_provider")
    for name in found:
        s.spark.read.parquet(f"{root}/by_provider/{name}").write.parquet(f"{root}/sets/{name.split('=')[1]}")
    s.spark.createDataFrame([("no table",)], "value string").write.text(f"{root}/sets/broken")
    rows, report = checked.read_datasets(s.spark, f"{root}/sets", "order_id string, total decimal(18,2)")
    totals = rows.groupBy("brand").agg(F.sum("total").alias("total"))
    return report.select("brand", "rows", F.col("error").isNotNull().alias("skipped")).join(totals, "brand", "left")


@query
def datasets_with_damaged_pages(s: Samples) -> DataFrame:
    """One folder per provider; the data pages of one are cut out of its files, whose footers stay readable."""
    root = scratch_path(s.spark, "datasets")
    rows = s.orders().select("order_id", "total", "delivery_provider")
    for name in sorted(r.delivery_provider for r in rows.select("delivery_provider").distinct().collect()):
        rows.filter(F.col("delivery_provider") == name).select("order_id", "total").write.option("compression", "gzip").parquet(f"{root}/{name}")
    damaged = f"{root}/Jadlog"
    for file in files.names(s.spark, damaged):
        if file.startswith("part-"):
            blank(s.spark, f"{damaged}/{file}", 0.2, 0.3)
    found, report = checked.read_datasets(s.spark, root, "order_id string, total decimal(18,2)")
    totals = found.groupBy("brand").agg(F.count("*").alias("orders"), F.sum("total").alias("total"))
    return report.select("brand", "rows", F.col("error").like("part-%could be decoded").alias("damaged")).join(totals, "brand", "left")


@query
def checked_purchase_documents(s: Samples) -> DataFrame:
    """Purchase documents, of which those of every hundredth order are damaged in one of three ways: good ones with their amount, bad ones with the reason."""
    path, out = scratch_path(s.spark, "purchases"), scratch_path(s.spark, "checked")
    rows = s.purchases().select("transaction_id", "order_id", "amount", F.expr("cast(split_part(transaction_id, '-', 2) as int) % 3").alias("kind"))
    rows = rows.withColumn("kind", F.when(F.col("order_id").cast("long") % 100 == 0, F.col("kind")).otherwise(3))
    amount = F.when(F.col("kind") == 1, F.lit("x")).otherwise(F.col("amount").cast("string"))
    document = F.to_json(F.struct(F.col("transaction_id").alias("transactionId"), F.struct(F.col("transaction_id").alias("purchaseId"), amount.alias("amount")).alias("purchase")))
    other = F.to_json(F.struct(F.col("transaction_id").alias("transactionId"), F.lit(5).alias("purchase")))
    line = F.when(F.col("kind") == 0, F.left(document, F.length(document) - 12)).when(F.col("kind") == 2, other).otherwise(document)
    rows.select(line.alias("value")).write.text(path)
    good, bad = checked.quarantined(checked.read_purchases(s.spark, path), out)
    named = bad.select(F.regexp_extract("record", '"transactionId":"([^"]*)"', 1).alias("transaction_id"), F.lit(None).cast("long").alias("amount_cents"), "reason")
    flat = readers.flatten_purchases(good).select("transaction_id", "amount_cents", F.lit(None).cast("string").alias("reason"))
    return flat.unionByName(named)


@query
def checked_csv_orders(s: Samples) -> DataFrame:
    """Orders through CSV, every hundredth line damaged in one of three ways: good lines with their total, bad ones with the reason."""
    path = scratch_path(s.spark, "csv")
    number = F.col("order_number")
    kind = F.when(number % 100 == 0, F.floor(number / 100) % 3).otherwise(3)
    fields = F.concat_ws(
        ",", "order_id", "order_number", F.when(kind == 0, F.lit("x")).otherwise(F.col("total").cast("string")),
        F.when(kind == 1, F.lit("perhaps")).otherwise(F.col("is_paid").cast("string")), F.when(kind == 2, F.lit("more")),
    )
    s.orders().select(fields.alias("value")).write.text(path)
    header = s.spark.createDataFrame([("order_id,order_number,total,is_paid",)], "value string")
    header.coalesce(1).write.text(f"{path}-header")
    parts = [f"{path}/{n}" for n in files.names(s.spark, path) if n.startswith("part-")]
    heads = [f"{path}-header/{n}" for n in files.names(s.spark, f"{path}-header") if n.startswith("part-")]
    files.join_files(s.spark, [*heads, *parts], f"{path}-all/orders.csv")
    good, bad = checked.split_bad(checked.read_csv(s.spark, f"{path}-all", "order_id string, order_number bigint, total decimal(18,2), is_paid boolean"))
    named = bad.select(F.split_part("record", F.lit(","), F.lit(1)).alias("order_id"), F.lit(None).cast("decimal(18,2)").alias("total"), "reason")
    return good.select("order_id", "total", F.lit(None).cast("string").alias("reason")).unionByName(named)


@query
def catalog_scan(s: Samples) -> DataFrame:
    """A catalog table with pushed columns and rows, where it exists."""
    name = "orders_" + scratch_path(s.spark, "t").rsplit("-", 1)[1]
    s.orders().createOrReplaceTempView(name)
    missing = readers.read_if_exists(s.spark, name + "_none")
    rows = readers.read_table(s.spark, name, ["order_id", "total"], F.col("is_paid"))
    return rows if missing is None and readers.read_if_exists(s.spark, name) is not None else rows.limit(0)


@query
def model_columns(s: Samples) -> DataFrame:
    """Columns named 'Table[Column]' cut to their name, then projected by alias."""
    rows = s.domains().select(F.col("domain_id").alias("Domains[Id]"), F.col("domain_name").alias("[Domain Name]"), F.col("modules").alias("modules"))
    return readers.project(readers.bare_names(rows), {"domain_id": "Id", "name": "Domain Name"})


@query
def text_fallbacks(s: Samples) -> DataFrame:
    """Fallback chains, client names, month names and JSON texts."""
    rows = s.raw("customer")
    number = F.col("c_nationkey") % 12
    month = F.element_at(F.array(*[F.lit(m) for m in ("Janeiro", "fevereiro", "Março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "Dezembro")]), number + 1)
    return rows.select(
        "c_custkey",
        text.first_truthy(F.when(F.col("c_nationkey") > 10, "").otherwise(F.lit(None)), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), F.col("c_name")).alias("name"),
        text.client_before_equals(F.concat("c_name", F.lit(" = "), F.col("c_mktsegment"))).alias("client"),
        dates.month_from_name(month, F.lit(2024)).alias("month"),
        text.json_text(F.array(F.col("c_name"), F.col("c_mktsegment")), 20).alias("tags"),
    )


@query
def stamped_rows(s: Samples) -> DataFrame:
    """Constant source and load time, in the columns a typed table allows."""
    rows = sinks.stamped(s.partners(), "register", dt.datetime(2024, 1, 2, 3, 4, 5))
    renamed = schemas.harmonise(rows.withColumnRenamed("partner_name", "Parceiro"), {"partner_id": ["id", "partner_id"], "partner": ["Nome", "Parceiro"], "source": ["source"], "city": ["Cidade"]})
    return schemas.conform(renamed, "partner_id string, partner string, source string, rank int").withColumn("rank", F.coalesce("rank", F.lit(0)))


@query
def overwritten_table(s: Samples) -> DataFrame:
    """A table replaced by another schema."""
    path = scratch_path(s.spark, "table")
    sinks.overwrite(s.partners(), path)
    sinks.overwrite(s.angels(), path)
    return s.spark.read.parquet(path)


@query
def snapshot_days(s: Samples) -> DataFrame:
    """Snapshots of two days, one written twice."""
    path = scratch_path(s.spark, "snapshots")
    for day, rows in ((1, s.angels()), (2, s.partners()), (1, s.integrations())):
        sinks.append_snapshot(rows.select(F.element_at(F.array(*rows.columns), 1).alias("id")), path, dt.date(2024, 1, day))
    return s.spark.read.parquet(path).groupBy(F.col("snapshot_date").cast("date").alias("snapshot_date")).agg(F.count("*").alias("rows"))


@query
def overwritten_orders(s: Samples) -> DataFrame:
    """All receivables replaced by all orders, with another schema."""
    path = scratch_path(s.spark, "table")
    sinks.overwrite(s.receivables().select("rec_id", "gross"), path)
    sinks.overwrite(s.orders().select("order_id", "company_id", "order_status", "total"), path)
    return s.spark.read.parquet(path)


@query
def snapshot_orders(s: Samples) -> DataFrame:
    """All orders as one snapshot for each status; the first day is written twice, and the second time counts."""
    path = scratch_path(s.spark, "snapshots")
    rows = s.orders().select("order_id", "order_status", "total")
    for day, status in ((1, "WAITING"), (2, "WAITING"), (3, "CANCELED"), (1, "DELIVERED")):
        sinks.append_snapshot(rows.where(F.col("order_status") == status), path, dt.date(2024, 1, day))
    return s.spark.read.parquet(path).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query
def merged_state(s: Samples) -> DataFrame:
    """Last status of each company after three batches, the last of them late."""
    root = scratch_path(s.spark, "state")
    rows = s.orders().select("company_id", "created_at", "order_id", "order_status")
    newest = F.struct("created_at", "order_id").alias("at")
    for low, high in ((1992, 1996), (1999, 2002), (1996, 1999)):
        batch = rows.filter((F.year("created_at") >= low) & (F.year("created_at") < high)).select("company_id", newest, "order_status")
        sinks.merge_current(batch, root, "company_id", "at", forward=True, buckets=8)
    sinks.drop_versions(s.spark, root, 2)
    return sinks.read_current(s.spark, root).select("company_id", F.col("at.order_id").alias("order_id"), "order_status")


@query
def merged_state_buckets(s: Samples) -> DataFrame:
    """The last state of each order after five batches of a bucketed table, of which each touches its own part of the keys, some of them again."""
    root = scratch_path(s.spark, "state")
    rows = s.orders().select("order_id", "company_id", "order_status", "total", F.lit(0).alias("batch"))
    sinks.merge_current(rows, root, "order_id", "batch", buckets=16)
    for batch, (modulus, status) in enumerate(((2, "SENT"), (3, "RETURNED"), (7, "CLOSED"), (1000, "LOST")), 1):
        changed = rows.filter(F.col("order_id").cast("long") % modulus == 0)
        sinks.merge_current(changed.withColumns({"order_status": F.lit(status), "batch": F.lit(batch)}), root, "order_id", "batch", forward=True)
    late = rows.filter(F.col("order_id").cast("long") % 5 == 0).withColumn("order_status", F.lit("LATE"))  # as old as the first batch
    sinks.merge_current(late.withColumn("batch", F.lit(-1)), root, "order_id", "batch", forward=True)
    sinks.drop_versions(s.spark, root, 1)
    return sinks.read_current(s.spark, root)


@query
def published_after_audit(s: Samples) -> DataFrame:
    """The published orders after five audited writes, of which the guards refuse three; and what each write said."""
    root = scratch_path(s.spark, "audited")
    rows = s.orders().select("order_id", "company_id", "created_at", "payment_status", "total")
    floors = {"orders": 0.5}
    cases = [
        ("whole", rows.withColumn("payment_status", F.coalesce("payment_status", F.lit("UNKNOWN")))),
        ("empty", rows.filter("false")),
        ("without status", rows.withColumn("payment_status", F.lit(""))),
        ("shrunken", rows.filter(F.col("order_id").cast("long") % 4 == 0)),
        ("half", rows.filter((F.col("order_id").cast("long") % 4 != 0) & (F.col("order_id").cast("long") % 9 != 0))),
    ]
    said = []
    for name, frame in cases:
        try:
            version, warnings = sinks.publish_audited(
                frame, root, quality.order_measures(), lambda now, before: quality.check_orders(now) + quality.check_regression(now, before, floors)
            )
            said.append((name, version, len(warnings)))
        except quality.QualityError:
            said.append((name, None, 0))
    published = sinks.read_current(s.spark, root).groupBy("payment_status").agg(F.count("*").alias("orders"), F.sum("total").alias("total"))
    outcomes = s.spark.createDataFrame(said, "write string, version string, warnings int")
    kept = published.agg(F.sum("orders").alias("orders"), F.sum("total").alias("total")).withColumn("write", F.lit("half"))
    rows = outcomes.unionByName(kept, allowMissingColumns=True)
    return rows.groupBy("write").agg(*[F.max(c).alias(c) for c in rows.columns if c != "write"])


@query
def replaced_keys(s: Samples) -> DataFrame:
    """All lines of a supplier replaced by its lines of the second batch."""
    root = scratch_path(s.spark, "lines")
    rows = s.receivables().select("company_id", "rec_id", "gross", "rec_status")
    sinks.replace_keys(rows.filter("rec_status = 'paid'"), root, "company_id", buckets=8)
    sinks.replace_keys(rows.filter("rec_status <> 'paid' and cast(company_id as bigint) % 2 = 0"), root, "company_id")
    return sinks.read_current(s.spark, root).groupBy("company_id", "rec_status").agg(F.count("*").alias("lines"), F.sum("gross").alias("gross"))


@query
def guard_outcomes(s: Samples) -> DataFrame:
    """What the guards say of whole, empty, status-less and shrunken inputs."""
    rows = s.orders()
    mart = rows.groupBy("company_id").agg(F.sum("total").alias("value"), F.count("*").alias("orders"))
    half = mart.filter("cast(company_id as bigint) % 2 = 0")
    cases = [
        ("orders", lambda: quality.guard_orders(rows)),
        ("orders empty", lambda: quality.guard_orders(rows.limit(0))),
        ("orders without status", lambda: quality.guard_orders(rows.withColumn("payment_status", F.lit("")))),
        ("mart", lambda: quality.guard_regression(mart, mart)),
        ("mart shrunken", lambda: quality.guard_regression(half, mart)),
        ("rows", lambda: quality.guard_row_loss(mart, half)),
        ("rows lost", lambda: quality.guard_row_loss(half, mart)),
    ]
    out = []
    for name, guard in cases:
        try:
            out.append((name, True, len(guard() or [])))
        except quality.QualityError:
            out.append((name, False, 0))
    return s.spark.createDataFrame(out, "guard string, passed boolean, warnings int")


@query
def numbered_without_dates(s: Samples) -> DataFrame:
    """Positions of companies of which some have no creation time and some no domain."""
    rows = s.companies().withColumns({
        "created_at": F.when(F.col("status") == 1, F.col("created_at")),
        "domain_id": F.when(F.col("company_id").cast("long") % 50 != 0, F.col("domain_id")),
    })
    return cohorts.with_row_number(rows).select("company_id", "domain_id", "row_num")
