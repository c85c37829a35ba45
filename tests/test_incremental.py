"""Work that follows a change: bucketed history, mart refresh, sketches and stateful counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse import catalog
from tallyhouse.plans import mart, orders, quality, receivables
from tallyhouse.sources import bucketed, files, sinks
from tallyhouse.sources.samples import Samples
from tallyhouse.streaming import incremental

FOLDER = "/root/testdata/sf0.001"
PURCHASE = "transaction_id string, workspace_id string, status string, amount long, anticipation boolean, updated int"


def purchases(spark, rows):
    return spark.createDataFrame(rows, PURCHASE)


def test_history_is_neither_shuffled_nor_sorted(spark, tmp_path):
    rng = random.Random(1)
    old = [(f"t{i}", f"w{i % 3}", "old", i, i % 2 == 0, 1) for i in range(500)]
    fresh = [(f"t{i}", f"w{i % 3}", "paid", -i, False, rng.randrange(5)) for i in (*range(0, 50), *range(900, 930), 3)]
    refreshed = [(f"t{i}", "w1", "created", 7, None, 9) for i in (3, 60, 61, 2000)]
    defaults = spark.createDataFrame([("w1", True), ("w2", False)], "workspace_id string, anticipates_default boolean")
    bucketed.write(purchases(spark, old), "history_a", str(tmp_path / "a"), "transaction_id", 6)
    out = receivables.merge_into_history(purchases(spark, fresh), purchases(spark, refreshed), spark.table("history_a"), defaults, 6)
    want = receivables.merge_purchases(purchases(spark, fresh), purchases(spark, refreshed), purchases(spark, old), defaults)
    got = {r.transaction_id: r for r in out.collect()}
    assert got == {r.transaction_id: r for r in want.select(*out.columns).collect()} and len(got) == 531
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 6 out of 6" in plan and "Bucketed: true" in plan
    # From the stored scan up to the join there is no exchange and no sort.
    lines = plan[plan.index("SortMergeJoin") :].split("Initial Plan")[0].split("\n")[1:]
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    assert not any("Exchange" in line or "Sort " in line for line in lines[:scan])
    bucketed.write(out, "history_b", str(tmp_path / "b"), "transaction_id", 6, dealt=True)
    assert len([f for f in (tmp_path / "b").iterdir() if f.name.startswith("part-")]) == 6  # the result lies in buckets again
    spark.sql("DROP TABLE history_b")
    again = bucketed.attach(spark, "history_b", str(tmp_path / "b"), "transaction_id", 6)
    assert receivables.merge_into_history(purchases(spark, []), purchases(spark, []), again, defaults, 6).count() == 531
    for name in ("history_a", "history_b"):
        spark.sql(f"DROP TABLE {name}")


def test_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    assert [bucketed.buckets_for(n) for n in (0, 16_000_000, 16_000_001, 216_000_000)] == [16, 16, 17, 216]
    monkeypatch.setattr(bucketed, "ROWS", 100)
    made = []
    write = bucketed.write
    monkeypatch.setattr(bucketed, "write", lambda df, table, path, *rest, **more: (made.append(path), write(df, table, path, *rest, **more)))
    rows = Samples(spark, FOLDER).purchases().count()
    assert catalog.purchase_history_merged(Samples(spark, FOLDER)).count() == rows
    assert len(made) == 2 and all(len([n for n in files.names(spark, path) if n.startswith("part-")]) == -(-rows // 100) for path in made)


def test_large_tables_are_read_once_for_both_marts(spark):
    inputs = catalog._mart_inputs(Samples(spark, FOLDER))
    for frame in (inputs["invoices"], inputs["freight"], inputs["extras"][0]):
        assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()


def test_affected_companies(spark):
    register = spark.createDataFrame(
        [("a", 1, "11"), ("b", 1, "22"), ("c", 2, "2.2"), ("d", 2, None), ("e", 3, ""), ("f", 4, ""), ("g", 5, "55"), ("h", 6, "5-5")], "company_id string, domain_id int, tax_document string"
    )

    def hit(domains, companies):
        found = mart.affected_companies(register, spark.createDataFrame([(d,) for d in domains], "domain_id int"), spark.createDataFrame([(c,) for c in companies], "company_id string"))
        return "".join(sorted(r.company_id for r in found.collect()))

    assert hit([1], []) == "abc" and hit([3], []) == "e" and hit([], ["h"]) == "gh" and hit([2, 2], ["d"]) == "bcd" and hit([], []) == ""


def test_refresh_equals_the_full_build_and_works_on_less(spark):
    s = Samples(spark, FOLDER)
    inputs = catalog._mart_inputs(s)
    is_new = F.col("order_number") % 100 == 0
    base = orders.merchant_months(s.orders().filter(~is_new), max_total=catalog.MAX_TOTAL)
    more = orders.merchant_months(s.orders().filter(is_new), max_total=catalog.MAX_TOTAL)
    domains = more.select("domain_id").distinct()
    nobody = domains.select(F.lit("").alias("company_id")).limit(0)
    before = catalog._built(mart.company_mart(months=base, **inputs))
    after = catalog._built(mart.refreshed_mart(before, months=mart.add_months(base, more), domains=domains, companies=nobody, **inputs))
    full = catalog._built(mart.company_mart(months=orders.merchant_months(s.orders(), max_total=catalog.MAX_TOTAL), **inputs))
    columns = catalog.MART_COLUMNS
    assert sorted(map(str, after.select(columns).collect())) == sorted(map(str, full.select(columns).collect()))
    touched = mart.affected_companies(inputs["register"], domains, nobody).count()
    assert 0 < touched < full.count() / 2


def test_months_are_added(spark):
    def months(rows):
        return spark.createDataFrame([(d, m, *[v] * len(mart.ORDER_MEASURES)) for d, m, v in rows], "domain_id int, month string, " + ", ".join(f"{c} long" for c in mart.ORDER_MEASURES))

    got = mart.add_months(months([(1, "a", 1), (2, "a", 5)]), months([(1, "a", 2), (1, "b", 3)])).collect()
    assert {(r.domain_id, r.month): r.orders for r in got} == {(1, "a"): 3, (2, "a"): 5, (1, "b"): 3}


def test_side_by_side(spark):
    a = spark.createDataFrame([("x", 1), ("y", None)], "k string, a int")
    b = spark.createDataFrame([("y", "q", 2), ("z", "r", 3)], "k string, b string, c int")
    assert {tuple(r) for r in mart.side_by_side([a, b], "k").collect()} == {("x", 1, None, None), ("y", None, "q", 2), ("z", None, "r", 3)}
    with pytest.raises(Exception, match="k repeats: x"):
        mart.side_by_side([a.unionByName(a), b], "k").collect()


def test_sketches_of_days(spark):
    df = spark.range(60_000).select((F.col("id") % 6).cast("string").alias("day"), (F.col("id") % 9000).alias("a"), F.when(F.col("id") % 5 != 0, F.md5(F.col("id").cast("string"))).alias("b"), F.lit(None).cast("string").alias("c"))
    sketches = quality.day_sketches(df, "day")
    assert sketches.count() == 6 * 3 and "Generate" not in sketches.groupBy("day").count()._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1]
    assert sketches.select(F.max(F.length("sketch"))).first()[0] < 10_000
    found = {r.column: r for r in quality.sketched_profile(sketches).collect()}
    assert {c: (r.rows, r.filled) for c, r in found.items()} == {"a": (60_000, 60_000), "b": (60_000, 48_000), "c": (60_000, 0)}
    for column, exact in (("a", 9000), ("b", 48_000), ("c", 0)):
        assert abs(found[column].distinct - exact) <= exact * quality.ERROR
    two = quality.sketched_profile(sketches.filter("day in ('0', '1')"))
    assert {r.column: r.rows for r in two.collect()}["a"] == 20_000


EVENT = "event_id int, brand string, event string, ts timestamp"


def at(day, hour=12):
    return dt.datetime(2024, 1, day, hour)


def weeks(spark, root):
    return {(r.brand, r.event, str(r.week)): r.n for r in sinks.read_current(spark, root).collect()}


def test_weekly_counts_go_on_after_a_restart(spark, tmp_path):
    landed, root, checkpoint = (str(tmp_path / n) for n in ("in", "weeks", "checkpoint"))

    def land(rows):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(landed)
        incremental.keep_weekly_events(stream, root, checkpoint, "10 days", buckets=2).awaitTermination()

    land([(1, "x", "click", at(1)), (2, "x", "click", at(3)), (3, "y", "view", at(2))])
    assert weeks(spark, root) == {("x", "click", "2024-01-01"): 2, ("y", "view", "2024-01-01"): 1}
    # A new query from the checkpoint: repeated ingests count once, late rows inside the bound count.
    land([(2, "x", "click", at(3)), (1, "x", "click", at(1)), (4, "x", "click", at(9))])
    land([(5, "x", "click", at(4)), (3, "y", "view", at(2))])
    assert weeks(spark, root) == {("x", "click", "2024-01-01"): 3, ("y", "view", "2024-01-01"): 1, ("x", "click", "2024-01-08"): 1}
    land([(6, "x", "click", at(31))])
    land([(7, "x", "click", at(2))])  # later than ten days: left out
    assert weeks(spark, root)[("x", "click", "2024-01-01")] == 3 and weeks(spark, root)[("x", "click", "2024-01-29")] == 1
    land([])  # nothing new
    assert sum(weeks(spark, root).values()) == 6
