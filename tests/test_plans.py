"""Business rules on hand-made rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import billing, churn, cohorts, crm, freight, groups, mart, orders, quality, receivables

AS_OF = dt.date(2024, 6, 15)


def order_frame(spark, rows):
    """(domain, day text, total, method) rows; other columns get defaults."""
    df = spark.createDataFrame(
        [(d, t, None if v is None else Decimal(str(v)), m) for d, t, v, m in rows],
        "domain_id string, at string, total decimal(18,2), payment_method string",
    )
    return df.select(
        "domain_id", F.to_timestamp("at").alias("created_at"), "total", "payment_method",
        F.lit(True).alias("is_paid"), F.lit(False).alias("is_canceled"), F.lit(True).alias("is_closed"),
        F.col("total").alias("transaction_value"),
    )


def test_clean_orders_edges(spark):
    rows = [("1", "2024-01-01", v, "PIX") for v in (None, 0, -1, "49999.99", 50000, 10)]
    rows += [(d, "2024-01-01", 10, "PIX") for d in (None, "abc", "123.0")] + [("1", None, 10, "PIX")]
    got = orders.clean_orders(order_frame(spark, rows)).collect()
    assert sorted((r["domain_id"], float(r["total"])) for r in got) == [(1, 10.0), (1, 49999.99), (123, 10.0)]


def test_month_edges_by_zone(spark):
    rows = [("1", t, 10, "PIX") for t in ("2024-02-01 00:30:00", "2024-02-01 02:59:00", "2024-02-01 03:00:00")]
    frame = order_frame(spark, rows)
    utc = {str(r["month"]): r["orders"] for r in orders.monthly_domain_kpis(frame).collect()}
    local = {str(r["month"]): r["orders"] for r in orders.monthly_domain_kpis(frame, zone="America/Sao_Paulo").collect()}
    assert utc == {"2024-02-01": 3} and local == {"2024-01-01": 2, "2024-02-01": 1}
    shift = orders.local_month_shift(frame.withColumn("value", F.col("total")), "created_at").orderBy("month").collect()
    assert [(r["utc_rows"], r["local_rows"], r["moved_out"], r["moved_in"]) for r in shift] == [(0, 2, 0, 2), (3, 1, 2, 0)]


def test_ticket_outlier_zeroes_value(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), Decimal(900)), ("a", dt.datetime(2024, 2, 1), Decimal(10)), ("b", dt.datetime(2024, 1, 1), Decimal(100))],
        "company_id string, created_at timestamp, total decimal(18,2)",
    )
    whole = {(r["company_id"], r["month"].month): r["value"] for r in orders.order_report(df, 400).collect()}
    assert whole == {("a", 1): 0, ("a", 2): 0, ("b", 1): 100}
    months = {(r["company_id"], r["month"].month): r["value"] for r in orders.order_report(df, 500).collect()}
    assert months == {("a", 1): 0, ("a", 2): 10, ("b", 1): 100}


def test_pix_only_domains(spark):
    frame = order_frame(spark, [("1", "2024-04-02", 30, "PIX"), ("2", "2024-05-02", 60, "CREDIT_CARD"), ("2", "2024-06-01", 999, "PIX")])
    both = {r["domain_id"]: (r["card_avg"], r["pix_avg"]) for r in orders.three_month_average(frame, AS_OF).collect()}
    assert both == {"1": (None, 10.0), "2": (20.0, None)}
    card = {r["domain_id"]: r["pix_avg"] for r in orders.three_month_average(frame, AS_OF, keep_pix_only=False).collect()}
    assert card == {"1": None, "2": None}


def test_first_full_month(spark):
    rows = [("1", "2024-03-20", 5, "PIX"), ("1", "2024-04-02", 7, "PIX"), ("2", "2024-03-01", 5, "PIX"), ("3", "2024-05-01", 5, "PIX"), ("3", "2024-06-01", 5, "PIX")]
    got = cohorts.first_full_month(order_frame(spark, rows), AS_OF).collect()
    # Domain 2 has no order in the month after, domain 3's month is not over.
    assert [(r["domain_id"], str(r["month"]), r["value"]) for r in got] == [(1, "2024-04-01", 7)]


def test_club_date(spark):
    rows = [("1", f"2024-01-{d:02d}", 1, "PIX") for d in range(1, 6)] + [("1", "2024-02-01", 1, "PIX"), ("2", "2024-01-01", 1, "PIX")]
    got = cohorts.month_club(order_frame(spark, rows), dt.date(2024, 1, 1), dt.date(2025, 1, 1), 4).collect()
    assert [(r["domain_id"], str(r["reached_at"])[:10], r["orders"], r["lifetime_orders"]) for r in got] == [(1, "2024-01-04", 5, 6)]


def test_headquarters_tie_by_id(spark):
    df = spark.createDataFrame(
        [(1, "b", dt.datetime(2020, 1, 1)), (1, "a", dt.datetime(2020, 1, 1)), (1, "c", dt.datetime(2019, 1, 1))],
        "domain_id bigint, company_id string, created_at timestamp",
    )
    assert cohorts.headquarters(df).first()["company_id"] == "c"
    assert {r["company_id"]: r["row_num"] for r in cohorts.with_row_number(df).collect()} == {"c": 1, "a": 2, "b": 3}
    known, none = df.first()["created_at"], None
    rows = spark.createDataFrame([("a", 1, known), ("b", 1, none), ("c", 2, none), ("d", None, known)], "company_id string, domain_id long, created_at timestamp")
    assert {r["company_id"]: r["row_num"] for r in cohorts.with_row_number(rows).collect()} == {"b": 1, "a": 2, "c": 1, "d": 1}


def plans(spark, rows):
    return spark.createDataFrame(rows, "domain_id bigint, plan string, last_paid date, domain_name string, angel_name string")


def plan_rows(domain, **paid):
    names = {"basic": "Plano Básico", "pro": "Plano Pro", "addon": "Filial Atacado", "essential": "Plano Essencial"}
    return [(domain, names[k], dt.date.fromisoformat(v) if v else None, f"d{domain}", "x") for k, v in paid.items()]


def test_churn_levels(spark):
    old, new = "2024-01-10", "2024-06-01"
    rows = (
        plan_rows(1, basic=old, pro=new)  # upgrade
        + plan_rows(2, basic=old, essential=new)  # lateral
        + plan_rows(3, pro=old, basic=new)  # downgrade
        + plan_rows(4, pro=old, addon=new)  # only the add-on is left
        + plan_rows(5, addon=old, basic=new)  # lost the add-on
        + plan_rows(6, basic=old, pro=old)  # all stopped
        + plan_rows(7, basic=new, pro=None)  # never paid one
        + plan_rows(8, basic="2023-10-01")  # outside the window
    )
    got = {r["domain_id"]: r["kind"] for r in churn.tiered_churn(plans(spark, rows), AS_OF, dt.date(2024, 1, 1)).collect()}
    assert got == {3: "partial", 4: "total", 5: "partial", 6: "total"}
    total = {r["domain_id"]: r["plans"] for r in churn.total_churn(plans(spark, rows), AS_OF, dt.date(2024, 1, 1)).collect()}
    assert total == {6: "Plano Básico | Plano Pro"}
    detail = churn.plan_churn(plans(spark, rows), AS_OF, dt.date(2024, 1, 1))
    assert {(r["domain_id"], r["total_churn"], str(r["churn_month"])) for r in detail.collect()} == {
        (d, d == 6, "2024-02-01") for d in (1, 2, 3, 4, 5, 6)
    }


def test_cutoff_is_open_or_closed(spark):
    rows = plans(spark, plan_rows(1, basic="2024-03-10"))
    assert churn.plan_churn(rows, AS_OF, dt.date(2024, 1, 1)).count() == 0
    assert churn.plan_churn(rows, AS_OF, dt.date(2024, 1, 1), inclusive=True).count() == 1


def test_payment_churn_and_value(spark):
    def domain(d, *pays, last="2024-06-01"):
        return [(d, t, v, m) for t, v, m in pays] + [(d, last, 1, "BOLETO")]

    rows = (
        domain("1", ("2024-02-01", 5, "PIX"), ("2024-03-02", 7, "CREDIT_CARD"), ("2024-04-03", 9, "PIX"))
        + domain("2", ("2024-01-01", 5, "PIX"), ("2024-01-02", 6, "PIX"), ("2024-04-03", 9, "PIX"))
        + domain("3", ("2024-04-01", 5, "PIX"), ("2024-04-02", 7, "PIX"), ("2024-04-03", 9, "PIX"))
        + domain("4", ("2024-04-01", 5, "PIX"), ("2024-04-03", 9, "PIX"))  # too few
        + domain("5", ("2024-03-01", 5, "PIX"), ("2024-03-02", 5, "PIX"), ("2024-03-03", 9, "PIX"), last="2024-03-03")  # stopped all
    )
    frame = order_frame(spark, rows)
    got = churn.value_lost(churn.payment_churn(frame, AS_OF, dt.date(2024, 1, 1)), frame).collect()
    assert {r["domain_id"]: (float(r["value_lost"]), r["note"]) for r in got} == {
        "1": (7.0, "previous month"), "2": (11.0, "earlier month"), "3": (0.0, "none"),
    }


@pytest.mark.parametrize(
    "facts,score,risk",
    [
        ((20, 20, 0, 3, 10, 1, True, None), 30, "medium"),
        ((20, 20, 0, 6, 10, 1, True, None), 15, "low"),
        ((20, 20, 0, 7, 10, 1, True, None), 0, "low"),
        ((20, 20, 0, 0, 5, 1, True, None), 0, "low"),
        ((11, 10, 4, 0, 9, 0, False, "Churn"), 100, "high"),
        ((0, 0, 0, 0, 0, 0, False, "Parado"), 30, "medium"),
    ],
)
def test_churn_score(spark, facts, score, risk):
    names = "orders int, paid int, canceled int, last3 int, prev3 int, this_month int, has_integration boolean, stage string"
    row = churn.churn_score(spark.createDataFrame([facts], names)).first()
    assert (row["score"], row["risk"]) == (score, risk)


def test_anticipation_default(spark):
    day = dt.date
    rows = (
        [("a", day(2024, 6, 10), True)] * 3 + [("a", day(2024, 1, 1), False)] * 9  # recent orders decide
        + [("b", day(2024, 6, 10), False)] * 2 + [("b", day(2024, 1, 1), True)] * 8  # too few recent ones
        + [("c", day(2024, 6, 10), True)] * 2  # too few at all
    )
    df = spark.createDataFrame(rows, "workspace_id string, order_date date, anticipates boolean")
    got = {r["workspace_id"]: r["anticipates_default"] for r in receivables.anticipation_default(df, AS_OF).collect()}
    assert got == {"a": True, "b": True}


def test_flag_is_raised_never_lowered(spark):
    schema = "transaction_id string, workspace_id string, anticipation boolean, updated int, v string"
    fresh = spark.createDataFrame([("t1", "w", False, 1, "new")], schema)
    refreshed = spark.createDataFrame([("t1", "w", True, 1, "mid"), ("t2", "x", True, 1, "mid")], schema)
    old = spark.createDataFrame([("t2", "x", False, 1, "old"), ("t3", "x", False, 1, "old")], schema)
    defaults = spark.createDataFrame([("w", True), ("x", False)], "workspace_id string, anticipates_default boolean")
    got = {r["transaction_id"]: (r["v"], r["anticipation"]) for r in receivables.merge_purchases(fresh, refreshed, old, defaults).collect()}
    assert got == {"t1": ("new", True), "t2": ("mid", True), "t3": ("old", False)}


def test_receivables_schedule(spark):
    """Anticipation pays on the business day after the customer paid on a Friday."""
    stamp = "2024-03-01 15:00:00"  # a Friday
    orders_df = spark.createDataFrame(
        [("o1", 1, "d", "A", "1", Decimal(10)), ("o2", 2, "d", "B", "1", Decimal(20)), ("o3", 3, "d", "B", "1", Decimal(30))],
        "order_id string, order_number bigint, customer_doc string, company_id string, domain_id string, total decimal(18,2)",
    ).select("*", F.to_timestamp(F.lit(stamp)).alias("created_at"), F.lit("PIX").alias("payment_method"), F.to_timestamp(F.lit(stamp)).alias("paid_at"))
    own = spark.createDataFrame(
        [("o1", "x", Decimal(9)), ("o2", "y", Decimal(9)), ("o3", "own", Decimal(27)), ("o4", "zero", Decimal(0))], "order_id string, rec_id string, net decimal(18,2)"
    ).select("*", F.lit(1).alias("installment"), F.to_timestamp(F.lit("2024-05-02 12:00:00")).alias("due_at"), F.lit(None).cast("timestamp").alias("rec_paid_at"),
             F.lit("created").alias("rec_status"), F.lit(30).cast("decimal(18,2)").alias("gross"), F.lit(3).cast("decimal(18,2)").alias("fee"), F.lit(0).cast("decimal(18,2)").alias("anticipation"))
    fourth = orders_df.filter("order_id = 'o3'").withColumns({"order_id": F.lit("o4"), "order_number": F.lit(4).cast("long")})
    orders_df = orders_df.unionByName(fourth).join(own, "order_id").withColumn("provider", F.lit("PAY"))
    rec = spark.createDataFrame(
        [("o1", "A", "1", "r1", 1, Decimal(5)), ("o2", "B", "1", "r2", 1, Decimal(8)), ("o2", "B", "1", "r3", 2, Decimal(0))],
        "order_id string, company_id string, domain_id string, rec_id string, installment int, net decimal(18,2)",
    ).select(
        "*", F.to_timestamp(F.lit("2024-04-01 12:00:00")).alias("due_at"), F.lit(None).cast("timestamp").alias("rec_paid_at"),
        F.to_timestamp(F.lit(stamp)).alias("paid_at"), F.lit("created").alias("rec_status"), F.col("net").alias("gross"), F.lit(0).cast("decimal(18,2)").alias("fee"), F.lit(0).cast("decimal(18,2)").alias("anticipation"),
    )
    settings = spark.createDataFrame([("A", Decimal(1), False), ("B", Decimal(0), False)], "company_id string, anticipation_d1 decimal(18,2), fee_enabled boolean")
    lines = receivables.receivable_lines(rec, orders_df, settings)
    got = {r["rec_id"]: r["pay_on"] for r in receivables.payment_schedule(lines).collect()}
    # Zero lines are dropped, also the one of an order row; the order without instalments shows its own.
    assert got == {"r1": dt.date(2024, 3, 4), "r2": dt.date(2024, 4, 1), "own": dt.date(2024, 5, 2)}
    per_order = {r["order_id"]: (r["instalments"], r["anticipates"], r["next_due"]) for r in receivables.receivable_orders(lines).collect()}
    assert per_order == {"o1": (1, True, dt.date(2024, 4, 1)), "o2": (1, False, dt.date(2024, 4, 1)), "o3": (1, False, dt.date(2024, 5, 2))}
    assert {r["order_id"]: (r["net"], r["fee"]) for r in lines.filter("order_id = 'o3'").collect()} == {"o3": (Decimal(27), Decimal(3))}
    elsewhere = receivables.receivable_lines(rec.withColumn("provider", F.lit("OTHER")), orders_df, settings, provider="PAY")
    assert {r["rec_id"] for r in elsewhere.collect()} == {"x", "y", "own"}


def test_duplicates(spark):
    part = "array<struct<amount:bigint>>"
    rows = [
        ("a", "o1", "paid", 100, 1, [(100,)]), ("b", "o1", "confirmed", 50, 0, [(50,)]), ("c", "o1", "voided", 9, 2, [(9,)]),
        ("d", "o2", "paid", 0, 0, [(5,)]), ("e", "o2", "paid", 7, 0, [(0,)]), ("f", "o2", "paid", 7, 0, [(7,)]), ("g", "", "paid", 7, 0, [(7,)]),
    ]
    df = spark.createDataFrame(rows, f"transaction_id string, order_id string, status string, amount bigint, created int, installments {part}").withColumn("brand", F.lit("x"))
    valid = receivables.valid_purchases(df)
    dup = receivables.duplicate_orders(valid)
    assert {(r["transaction_id"], r["is_first"]) for r in receivables.duplicate_payments(valid, dup).collect()} == {("a", False), ("b", True)}
    totals = receivables.duplicate_totals(valid).first()
    assert tuple(totals) == (2, 1, 2, Decimal("1.50"))
    assert receivables.valid_purchases(df, ["x"]).count() == 0


def freight_frames(spark):
    sheet = spark.createDataFrame(
        [(1, 1, 10.0, "ENTREGUE", "2024-03-02"), (1, 2, 20.0, "ENTREGUE", "2024-03-03"), (1, 3, 30.0, "ENTREGUE", "2024-03-04"), (1, 9, 9.0, "X", "2024-03-20"), (1, 8, 8.0, "X", "2024-03-03")],
        "domain_id bigint, order_number bigint, posting double, sheet_status string, posted_on string",
    )
    system = spark.createDataFrame(
        [(1, 1, "2024-03-02", False, "SENT", 11.0, 10.0, True), (1, 2, "2024-03-03", True, "WAITING", 40.0, 25.0, False),
         (1, 4, "2024-03-03", False, "SENT", 5.0, None, True), (1, 5, "2024-03-03", False, "SEPARATED", 5.0, None, True),
         (1, 6, "2024-03-09", False, "SENT", 5.0, None, True), (1, 8, "2024-02-01", False, "SENT", 5.0, None, True)],
        "domain_id bigint, order_number bigint, day string, is_canceled boolean, order_status string, quoted double, posting double, has_label boolean",
    )
    money = "decimal(18,2)"
    return (
        sheet.withColumns({"posting": F.col("posting").cast(money), "posted_on": F.to_date("posted_on")}),
        system.withColumns({"posting": F.col("posting").cast(money), "quoted": F.col("quoted").cast(money), "day": F.to_date("day")}),
    )


def test_reconciliation(spark):
    sheet, system = freight_frames(spark)
    rows = freight.reconcile(sheet, system, dt.date(2024, 3, 1), dt.date(2024, 3, 15))
    got = {r["order_number"]: (r["outcome"], r["differences"]) for r in rows.collect()}
    # Order 6 lies after the covered days, order 8 exists on another day, order 9 is another half month.
    assert got == {1: ("ok", ""), 2: ("different", "canceled,posting"), 3: ("only_sheet", ""), 4: ("only_system", ""), 5: ("ignored", ""), 8: ("ok", "")}
    counts = {r["outcome"]: r["orders"] for r in freight.reconcile_summary(rows).collect()}
    assert counts["ok"] + counts["different"] + counts["only_sheet"] == 4


def test_reapplied_sheet(spark):
    sheet, system = freight_frames(spark)
    base = system.withColumns({"margin": F.lit(1).cast("decimal(18,2)"), "final": F.lit(2).cast("decimal(18,2)")})
    got = {r["order_number"]: r for r in freight.reapply_sheet(base, sheet).collect()}
    assert (got[2]["posting"], got[2]["margin"], got[2]["final"], got[2]["posting_source"]) == (Decimal("20.00"), Decimal("20.00"), Decimal("40.00"), "sheet")
    assert (got[4]["margin"], got[4]["posting_source"]) == (Decimal("1.00"), "")


def test_manual_postings_and_total(spark):
    schema = "internal_code string, posted_on string, invoice_no string, posting int"
    new = spark.createDataFrame([("c1", "d", "n", 1), ("", "d", "n", 2)], schema)
    old = spark.createDataFrame([("c1", "x", "n", 9), ("", "d", "n", 2), ("", "d", "n", 3), ("", "d", "n", 3)], schema)
    assert sorted(r["posting"] for r in freight.manual_postings(new, old).collect()) == [1, 2, 3]
    rows = spark.createDataFrame([("1_2", "2", "900,00"), ("", "", "50,00"), ("", None, "R$ 1.234,50")], "volume_code string, order_number string, posting_text string")
    assert freight.sheet_total(rows).first()[0] == Decimal("1234.50")


def test_invoice_states_equal_both_operators(spark):
    rng = random.Random(4)
    states, days = ["paid", "externally_paid", "pending", "expired", "canceled", None], [None, *[dt.datetime(2024, 1, d) for d in (1, 2, 3)]]
    rows = [(f"i{n:03}", rng.choice("abcdefg"), rng.choice(states), rng.choice(days), rng.choice([None, 5, 70]), rng.choice(["", None, "x", "y"])) for n in range(90)]
    rows += [("i900", "h", "canceled", None, 1, "z"), ("i901", None, "paid", days[1], 1, "z")]
    bills = spark.createDataFrame(rows, "invoice_id string, customer_id string, status string, due_at timestamp, total_cents bigint, plan_name string")
    bridge = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "c"), (3, "d"), (3, "d"), (4, "e"), (5, "f"), (6, "g"), (7, "h"), (8, "none"), (9, None)], "domain_id int, customer_id string")
    joined = bills.join(bridge, "customer_id")
    want = billing.status_buckets(joined, "domain_id").join(billing.current_invoice(joined, "domain_id"), "domain_id")
    got = billing.invoice_states(bills, bridge)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [customer_id") == 1 and "Window" not in plan


def test_invoice_choices(spark):
    schema = "customer_id string, invoice_id string, status string, due_at int, total_cents bigint"
    df = spark.createDataFrame([("a", "1", "canceled", 9, 5), ("a", "2", "paid", 3, 6), ("b", "3", "canceled", 1, 7), ("b", "4", "canceled", 2, 8)], schema)
    assert {r["customer_id"]: r["invoice_id"] for r in billing.current_invoice(df, "customer_id").collect()} == {"a": "2", "b": "4"}
    subs = spark.createDataFrame([("a", "s1", False, 9), ("a", "s2", True, 1), ("a", "s3", True, None)], "k string, subscription_id string, active boolean, updated_at int")
    assert billing.latest_subscription(subs, "k").first()["subscription_id"] == "s2"


def test_bridge_rows_do_not_double(spark):
    items = spark.createDataFrame([("i", "c", dt.datetime(2024, 1, 1), 1000, 2, "Plano Pro")], "invoice_id string, customer_id string, created_at timestamp, item_price_cents bigint, item_quantity int, item_text string")
    bridge = spark.createDataFrame([(1, "c"), (1, "c")], "domain_id bigint, customer_id string")
    got = billing.revenue_by_month(billing.classified_items(items, bridge)).first()
    assert (got["total"], got["invoices"]) == (Decimal("20.00"), 1)


def test_csat_lines(spark):
    df = spark.createDataFrame([(1, "2025-01", "9 - Loja A (bom)\n8,5 – Loja B\nsem nota\n10 — C (x) y")], "note_id int, month string, note string")
    got = [(r["score"], r["brand"], r["remark"]) for r in crm.csat_lines(df).collect()]
    assert got == [(9.0, "Loja A", "bom"), (8.5, "Loja B", ""), (10.0, "C (x) y", "")]


def test_deals_around_meetings(spark):
    at = lambda t: dt.datetime.fromisoformat(t)
    meetings = spark.createDataFrame(
        [(1, 0, "c", at("2024-01-02 10:00:00")), (2, 1, "c", at("2024-01-09 10:00:00")), (3, 0, "c", at("2024-01-09 10:00:00"))],
        "meeting_id int, owner_rank int, company_id string, start_at timestamp",
    )
    deals = spark.createDataFrame(
        [(1, "c", at("2024-01-01 00:00:00")), (2, "c", at("2024-01-02 10:00:00")), (3, "c", at("2024-02-01 00:00:00")), (4, None, at("2024-02-01 00:00:00"))],
        "deal_id int, company_id string, close_at timestamp",
    )
    matched = crm.deal_meetings(deals, meetings)
    assert {r["deal_id"]: r["match"]["meeting_id"] if r["match"] else None for r in matched.collect()} == {1: None, 2: 1, 3: 3, 4: None}
    matrix = {(r["owner_rank"], str(r["week"])): (r["meetings"], r["deals"]) for r in crm.weekly_matrix(meetings, matched).collect()}
    assert matrix == {(0, "2024-01-01"): (1, 1), (0, "2024-01-08"): (1, 1), (1, "2024-01-01"): (0, 0), (1, "2024-01-08"): (1, 0)}


def test_group_headquarters(spark):
    rows = [
        ("a", "11111111000200", 1, "Loja Grande Filial", 50), ("b", "11111111000100", 1, "Loja", 1),  # the only 0001
        ("c", "22222222000100", 2, "X", 1), ("d", "33333333000100", 2, "Y", 9),  # two roots: most orders
        ("e", "44444444000200", 4, "Longer name", 3), ("f", "44444444000300", 5, "Name", 3),  # shorter name
        ("g", "555", 6, "Alone", 0),
    ]
    df = spark.createDataFrame(rows, "company_id string, tax_document string, domain_id int, name string, orders int")
    got = {r["company_id"]: (r["hq_id"], r["size"]) for r in groups.company_groups(df).collect()}
    assert got == {"a": ("b", 2), "b": ("b", 2), "c": ("d", 2), "d": ("d", 2), "e": ("f", 2), "f": ("f", 2), "g": ("g", 1)}


def test_idle_copies(spark):
    df = spark.createDataFrame([("a", "1.1", 0), ("b", "11", 5), ("c", "", 0), ("d", None, 0), ("e", "2", 0)], "company_id string, tax_document string, orders int")
    assert {r["company_id"] for r in groups.drop_idle_copies(df).collect()} == {"b", "c", "d", "e"}


def test_active_domains(spark):
    df = spark.createDataFrame([(1, "Loja", "vendas", None), (2, "TESTE x", "vendas", "p"), (3, "Loja", "portal", "p"), (4, "Loja", "a,vendas", "trial"), (5, "Loja", "vendas", "p")], "domain_id int, domain_name string, modules string, partner_id string")
    assert {r["domain_id"] for r in groups.active_domains(df, ["trial"]).collect()} == {1, 5}
    assert {r["domain_id"] for r in groups.active_domains(df, ["trial"], keep_null_partner=False).collect()} == {5}


def test_main_plan_line(spark):
    lines = spark.createDataFrame([("t", "Integração", 1), ("t", "Pro", 2), ("u", "Pacote X", 1), ("", "Pro", 1)], "tax_id string, plan string, line_no int")
    assert {r["tax_id"]: (r["plan"], r["lines"]) for r in groups.plan_per_tax_id(lines).collect()} == {"t": ("Pro", 2), "u": ("Pacote X", 1)}


def test_guards(spark):
    def frame(n, blank):
        return spark.range(n).select(F.when(F.col("id") < blank, "").otherwise("PAID").alias("payment_status"), F.lit(dt.datetime(2024, 1, 1)).alias("created_at"))

    with pytest.raises(quality.QualityError):
        quality.guard_orders(frame(0, 0))
    with pytest.raises(quality.QualityError):
        quality.guard_orders(frame(10, 7))
    assert quality.guard_orders(frame(10, 3)) and not quality.guard_orders(frame(10, 2))

    def size(n, value):
        return spark.range(n).select(F.lit(value).alias("value"), F.lit(1).alias("orders"))

    quality.guard_regression(size(80, 10), size(100, 10))
    for worse in (size(79, 99), size(100, 4)):
        with pytest.raises(quality.QualityError):
            quality.guard_regression(worse, size(100, 10))
    quality.guard_row_loss(spark.range(90), spark.range(100))
    with pytest.raises(quality.QualityError):
        quality.guard_row_loss(spark.range(89), spark.range(100))


def test_previous_values_and_profile(spark):
    new = spark.createDataFrame([(1, ""), (2, "x")], "id int, s string")
    old = spark.createDataFrame([(1, "o"), (2, "o")], "id int, s string")
    assert {r["id"]: r["s"] for r in quality.or_previous(new, old, "id", ["s"]).collect()} == {1: "o", 2: "x"}
    assert quality.or_previous_table(new.limit(0), old).count() == 2
    assert {r["column"]: (r["rows"], r["filled"], r["distinct"]) for r in quality.profile(old).collect()} == {"id": (2, 2, 2), "s": (2, 2, 1)}
    assert quality.unmatched(new, old.filter("id = 1"), "id").first()["rows"] == 1


def test_series_and_patch(spark):
    base = spark.createDataFrame([("a", 1, 2)], "k string, x int, y int")
    patch = spark.createDataFrame([("a", 9, None)], "k string, x int, y int")
    assert tuple(mart.patch_columns(base, patch, "k", ["x", "y"]).first()) == ("a", 9, 2)


def test_repeated_bridge_rows_match_once(spark):
    companies = spark.createDataFrame([("c1", 7, "Alfa")], "company_id string, domain_id long, name string")
    bridge = spark.createDataFrame([(7, "x"), (7, "y")], "domain_id long, customer_id string")
    brands = spark.createDataFrame([("Alfa",)], "brand string")
    assert [tuple(r) for r in groups.match_invoices(companies, bridge, brands).collect()] == [("c1", "domain", "7")]


def test_invoice_items_keep_customers_apart(spark):
    day = dt.datetime(2024, 1, 5)
    rows = [("i", "1", "A", "paid", 100), ("i", "1", "B", "paid", 200), ("i", "1", "A", "paid", 100), ("i", None, "A", "paid", 5), ("j", "1", "A", "externally_paid", 7)]
    df = spark.createDataFrame(rows, "invoice_id string, item_id string, customer_id string, status string, item_price_cents long").select(
        "*", F.lit(day).alias("created_at"), F.lit(1).alias("item_quantity"), F.lit("Assinatura").alias("item_text")
    )
    assert {(r.invoice_id, r.customer_id, r.item_price_cents) for r in billing.invoice_items(df).collect()} == {("i", "A", 100), ("i", "B", 200)}


def test_only_named_orders_stand_for_older_records(spark):
    schema = "record_id string, company_id string, day string, value decimal(18,2), order_number string, customer_name string"
    newer = spark.createDataFrame([("o1", "c", "2024-01-01", Decimal(5), "1", None), ("o2", "c", "2024-01-01", Decimal(7), "", None), ("o3", "c", None, Decimal(9), None, "Ana")], schema)
    older = spark.createDataFrame([("q1", "c", "2024-01-01", Decimal(5), None, None), ("q2", "c", "2024-01-01", Decimal(7), None, None), ("q3", "c", None, Decimal(9), None, None)], schema)
    assert {r.record_id for r in orders.order_union(newer, older, older.limit(0)).collect()} == {"o1", "o2", "o3", "q2"}
