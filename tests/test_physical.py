"""Physical plans: no Python rows, no cross joins, pushed filters, split hot keys."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyhouse.catalog import QUERIES
from tallyhouse.operators.matching import containing, index_rows, word_scored
from tallyhouse.operators.skew import hot_join
from tallyhouse.plans import cohorts, freight, orders, receivables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def plans_before_checkpoints(spark, plans):
    """Keep the plan of every frame that is checkpointed: what a query shows at its end starts at the last one."""
    frame = type(spark.range(1))
    checkpoint = frame.checkpoint

    def recorded(df, *args, **kwargs):
        plans.append(plan_of(df))
        return checkpoint(df, *args, **kwargs)

    frame.checkpoint = recorded
    try:
        yield
    finally:
        frame.checkpoint = checkpoint


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(spark, name):
    plans = []
    with plans_before_checkpoints(spark, plans):
        plans.append(plan_of(QUERIES[name](spark, FOLDER)))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert not [plan for plan in plans if operator in plan]


def test_plans_before_checkpoints_are_seen(spark):
    plans = []
    with plans_before_checkpoints(spark, plans):
        QUERIES["company_groups"](spark, FOLDER)
    assert len(plans) > 1


@pytest.mark.parametrize("name", ["nth_order_club", "company_last_orders", "invoice_current", "client_inferred_brands", "latest_subscription_per_domain"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.rindex("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan[partial:].split("\n")[0]
    # Plans print from the result down to the scan.
    assert plan.index("Exchange hashpartitioning") < partial or exchange < partial


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from tallyhouse.sources.schemas import ORDERS

    path = str(tmp_path / "orders")
    spark.createDataFrame([], ORDERS).write.parquet(path)
    frame = spark.read.schema(ORDERS).parquet(path)
    plan = orders.payment_split(frame)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThan(total,0.00)" in pushed and "LessThan(total,50000.00)" in pushed
    columns = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert {c.split(":")[0] for c in columns.split(",") if ":" in c} == {"domain_id", "created_at", "total", "payment_method"}


def test_kpi_reports_shuffle_once(spark):
    for name in ("monthly_domain_kpis", "payment_split_by_month", "three_month_average", "duplicate_payment_orders"):
        assert plan_of(QUERIES[name](spark, FOLDER)).count("Exchange hashpartitioning") == 1


def hot_rows(spark, n=60_000):
    """A third of the rows hold one order."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string")
    return spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), key.alias("order_id"), F.lit("paid").alias("status"), F.lit(100).cast("long").alias("amount"),
        F.timestamp_seconds("id").alias("created"), F.array(F.struct(F.lit(100).cast("long").alias("amount"))).alias("installments"), F.lit("b").alias("brand"),
    )


def test_hot_order_is_spread_over_the_join(spark):
    """No task gets much more than its share, though one order holds a third of the rows."""
    fixed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    with settings(spark, **fixed):
        rows = receivables.valid_purchases(hot_rows(spark))
        out = receivables.duplicate_payments(rows, receivables.duplicate_orders(rows))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        firsts = out.filter("is_first").count()
    assert sum(sizes) == 20_000 and firsts == 1
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16


def test_hot_domain_month_ships_few_rows(spark):
    """The N-th order of a hot domain needs N rows per task, not all of them."""
    df = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("domain_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("created_at"), F.lit(10).cast("decimal(18,2)").alias("total"), F.lit("PIX").alias("payment_method"),
    )
    import datetime as dt

    club = cohorts.month_club(df, dt.date(2024, 1, 1), dt.date(2025, 1, 1), 80).collect()
    assert [(r["domain_id"], r["orders"], str(r["reached_at"])) for r in club] == [(1, 16668, "2024-01-01 00:03:54")]


def test_hot_word_needs_no_pairs(spark):
    """One word in every name: the hot word's pairs are never built."""
    names = spark.range(2_000).select(F.concat(F.lit("loja n"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"), F.lpad(F.col("id").cast("string"), 6, "0").alias("pick"))
    asked = spark.range(1_000).select(F.concat(F.lit("loja q"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"))
    rows = word_scored(asked, names, hot=100).collect()
    assert len(rows) == 1_000 and {(r["pick"], r["score"]) for r in rows} == {("000000", 2)}


def test_hot_client_keeps_five_brands(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("customer_doc"), (F.col("id") % 50).cast("string").alias("domain_id")
    )
    rows = freight.client_brands(df)
    assert rows.filter("doc = '1'").count() == 5


def join_rows(df):
    """Rows that each join and generator of a frame's last job put out."""
    df.collect()
    found = []

    def walk(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if "QueryStage" in name:
            return walk(plan.plan())
        rows = plan.metrics().get("numOutputRows")
        if rows.isDefined() and ("Join" in name or name == "Generate"):
            found.append((name, rows.get().value()))
        for k in range(plan.children().size()):
            walk(plan.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_short_word_before_many_long_ones_makes_no_pairs(spark):
    """300 asked names share a word that 3,000 offered words start with: 900,000 pairs of names."""
    asked = spark.range(300).select(F.format_string("abc zz%04d", "id").alias("name"))
    offered = spark.range(3000).select(F.format_string("abc%04d yy%04d", "id", "id").alias("name"), F.format_string("%04d", "id").alias("pick"))
    out = word_scored(asked, offered, accept=1)
    rows = join_rows(out)
    assert sum(n for _, n in rows) < 20_000
    assert {(r.pick, r.score) for r in out.collect()} == {("0000", 1)} and out.count() == 300


def test_containment_sends_few_pieces(spark):
    """Long names: what reaches a join is a small multiple of the names, not all their substrings."""
    wide = spark.range(4000).select(F.format_string("comercio de roupas numero %06d ltda", F.col("id") * 7).alias("name"), F.col("id").alias("pick"))
    narrow = spark.range(1000).select(F.format_string("numero %06d", F.col("id") * 7).alias("name")).unionByName(spark.createDataFrame([("roupas",), ("de",)], "name string"))
    rare, whole = index_rows(narrow, wide)
    assert rare.count() == 1000 and whole.count() == 8000  # two names that every wide name holds
    found = containing(narrow, wide, common=100)
    assert {r.name: r.pick for r in found.collect()} == {f"numero {7 * k:06d}": k for k in range(1000)} | {"roupas": 0, "de": 0}
    assert sum(n for name, n in join_rows(found) if "Join" in name) < 12 * 5000


@pytest.mark.parametrize("same", ["hour", "instant"])
def test_a_key_with_all_rows_spreads_over_the_asof_join(spark, monkeypatch, same):
    """One company whose meetings and deals all fall into one hour, or whose deals fall into one instant."""
    from tallyhouse.operators import asof, ranking

    seen = []
    monkeypatch.setattr(asof, "ranged", lambda *a: seen.append(ranking.ranged(*a)) or seen[-1])
    at = F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") % 3000 if same == "hour" else F.lit(10)))
    left = spark.range(20_000).select(F.lit("k").alias("k"), at.alias("ts"), F.col("id").alias("did"))
    right = spark.range(40).select(F.lit("k").alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 5).alias("start"), F.col("id").alias("mid"))
    with settings(spark, **{"spark.sql.shuffle.partitions": "8"}):
        rows = asof.asof_join(left, right, "k", "ts", "start", ["mid"]).select("did", "match.mid").collect()
        sizes = [r["count"] for r in seen[0].groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    assert {r.did: r.mid for r in rows} == {k: min(39, (k % 3000 if same == "hour" else 10) // 5) for k in range(20_000)}


def test_a_key_with_all_rows_spreads_over_the_numbering(spark, monkeypatch):
    from tallyhouse.operators import ranking

    seen, ranged = [], ranking.ranged
    monkeypatch.setattr(ranking, "ranged", lambda *a: seen.append(ranged(*a)) or seen[-1])
    df = spark.range(20_000).select(F.when(F.col("id") % 50 != 0, F.lit("k")).alias("k"), F.timestamp_seconds(F.lit(7)).alias("at"), "id")
    with settings(spark, **{"spark.sql.shuffle.partitions": "8"}):
        rows = ranking.numbered(df, ["k"], [F.col("at"), F.col("id")]).collect()
        sizes = [r["count"] for r in seen[0].groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    hot = {r.id: r.rn for r in rows if r.k}
    assert [hot[i] for i in sorted(hot)] == list(range(1, 19_601)) and sorted(r.rn for r in rows if not r.k) == list(range(1, 401))


def test_a_repeated_key_on_the_right_stops_the_join(spark):
    from tallyhouse.operators.skew import hot_join

    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 4), (None, 5)], "k string, w int")
    with pytest.raises(Exception, match=r"repeats a key of \(k\): b"):
        hot_join(left, right, ["k"]).collect()
    assert sorted((r.v, r.w) for r in hot_join(left, right.filter("w <> 2"), ["k"]).collect() if r.w) == [(1, 1), (2, 1)]
    assert sorted(r.v for r in hot_join(left, right, ["k"], "left_semi").collect()) == [1, 2]  # no row twice
    assert [r.v for r in hot_join(left, right, ["k"], "left_anti").collect()] == [3]


def test_order_look_up_shuffles_only_what_it_uses(spark, tmp_path):
    rows = [(f"t{i}", f"w{i % 3}" if i % 5 else None, i % 2 == 0, [f"order_{i % 7}"], "x" * 50) for i in range(40)]
    path = str(tmp_path / "p")
    spark.createDataFrame(rows, "transaction_id string, workspace_id string, anticipation boolean, tags array<string>, body string").write.parquet(path)
    by_tx = spark.createDataFrame([("t1", 100), ("t1", 90), ("t2", 80)], "transaction_id string, order_number long")
    by_order = spark.createDataFrame([("1", 1), ("3", 3), ("3", 4)], "order_id string, order_number long")
    workspaces = spark.createDataFrame([("w1", True), ("w2", False)], "workspace_id string, anticipates_default boolean")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = receivables.purchase_order_data(spark.read.parquet(path), by_tx, by_order, workspaces)
        plan, got = plan_of(out), {r[0]: tuple(r)[1:] for r in out.collect()}
    assert "body" not in plan and not re.search(r"hashpartitioning\(workspace_id#\d+, _slice", plan)
    number = {i: {1: 90, 2: 80}.get(i, {1: 1, 3: 4}.get(i % 7)) for i in range(40)}
    found = {i: "transaction" if i in (1, 2) else "tag" if i % 7 in (1, 3) else "none" for i in range(40)}
    assert got == {f"t{i}": (number[i], found[i], i % 2 == 0 or (i % 3 == 1 and i % 5 != 0)) for i in range(40)}
    with pytest.raises(Exception, match="the right side repeats a key"):
        receivables.purchase_order_data(spark.read.parquet(path), by_tx, by_order, workspaces.unionByName(workspaces)).collect()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_few_right_rows_leave_the_left_side_in_place(spark, how):
    left = spark.createDataFrame([(k, i) for i, k in enumerate("aabbc")] + [(None, 9)], "k string, v int").repartition(2)
    right = spark.createDataFrame([("a", 1), ("c", None), (None, 3)], "k string, w int")
    wide, narrow = hot_join(left, right, ["k"], how), hot_join(left, right, ["k"], how, few=2)
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect())) and wide.columns == narrow.columns
    assert "_slice" not in plan_of(narrow) and "_slice" in plan_of(hot_join(left, right, ["k"], how, few=1))
