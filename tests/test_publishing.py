"""What failing and competing writers leave behind."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import quality
from tallyhouse.sources import files, sinks, state


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k string, at int, v int")


def part_files(root):
    return {os.path.join(d, n) for d, _, found in os.walk(root) for n in found if n.startswith("part-")}


def failing(spark, n=1000):
    """A frame whose last rows raise while it is written."""
    return spark.range(n).repartition(4).withColumn("v", F.when(F.col("id") > n - 3, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.lit(1)))


@pytest.mark.parametrize("write", [sinks.overwrite, sinks.write_csv, sinks.write_json, lambda df, path: sinks.write_csv(df, path, single=True)])
def test_a_failing_write_leaves_the_old_folder(spark, tmp_path, write):
    path = str(tmp_path / "t")
    write(spark.range(3).selectExpr("id", "1 v"), path)
    before = {p: os.path.getmtime(p) for p in part_files(path)}
    with pytest.raises(Exception, match="broken row"):
        write(failing(spark), path)
    assert {p: os.path.getmtime(p) for p in part_files(path)} == before and os.listdir(tmp_path) == ["t"]
    write(spark.range(5).selectExpr("id", "1 v"), path)
    assert os.listdir(tmp_path) == ["t"] and len(part_files(path)) > 0


def test_a_table_can_be_overwritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(4), path)
    sinks.overwrite(spark.read.parquet(path).filter("id > 1"), path)
    assert spark.read.parquet(path).count() == 2


def test_failing_chunks_leave_records_and_map(spark, tmp_path):
    path = str(tmp_path / "x")
    counts = spark.range(120).selectExpr("lpad(cast(id as string), 3, '0') company_id", "id orders")
    lines = spark.range(5000).selectExpr("lpad(cast(id % 120 as string), 3, '0') company_id", "id line").repartition(8)
    chunks = sinks.chunk_map(counts, 50)
    sinks.write_chunks(lines, chunks, path)
    # One file set for each chunk, though eight tasks held rows of every chunk.
    assert sorted(len(os.listdir(d)) for d in (tmp_path / "x" / "records").glob("chunk=*")) == [2, 2, 2]  # a part and its checksum
    broken = lines.withColumn("line", F.when(F.col("line") == 7, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("line")))
    with pytest.raises(Exception, match="broken row"):
        sinks.write_chunks(broken, sinks.chunk_map(counts, 10), path)
    assert spark.read.json(path + "/records").count() == 5000 and spark.read.parquet(path + "/chunk_map").agg(F.max("chunk")).first()[0] == 2


def test_a_single_file_keeps_order_and_one_header(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_csv(spark.range(1000).selectExpr("id `a;b`", "id * 2 c").repartitionByRange(6, "a;b"), path, single=True)
    assert [n for n in os.listdir(path) if not n.startswith(".")] == ["part-all.csv"]
    lines = (tmp_path / "c" / "part-all.csv").read_text(encoding="utf-8").split("\n")
    assert lines[0] == '"\ufeffa;b";c' and lines[1:] == [f"{k};{2 * k}" for k in range(1000)] + [""]


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    root = str(tmp_path / "s")
    sinks.merge_current(rows(spark, [(f"k{i}", 1, i) for i in range(400)]), root, "k", "at", buckets=32)
    first = state.manifest(spark, root)
    names = part_files(root)
    sinks.merge_current(rows(spark, [("k5", 2, 50), ("new", 2, 60)]), root, "k", "at")
    second = state.manifest(spark, root)
    changed = {b for b in second["folders"] if second["folders"][b] != first["folders"].get(b)}
    assert 1 <= len(changed) <= 2 and len(first["folders"]) == 32
    assert names <= part_files(root)  # nothing was rewritten in place
    kept = {f for b, f in second["folders"].items() if b not in changed}
    assert kept == {f for b, f in first["folders"].items() if b not in changed}
    got = {r.k: r.v for r in sinks.read_current(spark, root).collect()}
    assert got == {f"k{i}": i for i in range(400)} | {"k5": 50, "new": 60}
    assert {r.v for r in state.read_keys(spark, root, ["k5", "k7", "none"]).collect()} == {50, 7}
    assert state.read(spark, root, "v000000001").count() == 400  # readers of the old version see the old rows
    assert sinks.drop_versions(spark, root, keep=1) == ["v000000001"]
    assert sinks.read_current(spark, root).count() == 401 and len(part_files(root)) < len(names) + 2


@pytest.mark.parametrize("theirs,again", [("k5", True), ("far", False)])
def test_of_two_writers_one_goes_on_from_the_other(spark, tmp_path, monkeypatch, theirs, again):
    """Another writer publishes between this one's reading and its publishing."""
    root = str(tmp_path / "s")
    sinks.merge_current(rows(spark, [("k5", 1, 1), ("far", 1, 1), *[(f"x{i}", 1, 1) for i in range(50)]]), root, "k", "at", buckets=64)
    publish, merges, once = files.write_text_new, [], []

    def late(session, path, text):
        if not once:
            once.append(1)
            monkeypatch.setattr(files, "write_text_new", publish)
            sinks.merge_current(rows(spark, [(theirs, 5, 55), ("both", 5, 1)]), root, "k", "at", forward=True)
            monkeypatch.setattr(files, "write_text_new", late)
        return publish(session, path, text)

    combine = state._write_buckets
    monkeypatch.setattr(state, "_write_buckets", lambda *a: merges.append(a[3]) or combine(*a))
    monkeypatch.setattr(files, "write_text_new", late)
    assert sinks.merge_current(rows(spark, [("k5", 3, 33), ("mine", 3, 3)]), root, "k", "at", forward=True) == "v000000003"
    ours = [m for m in merges if "/data/" in m and m.split("/data/")[1].split("-")[0] == merges[0].rsplit("/", 1)[1]]
    assert len(ours) == (2 if again else 1)  # merged again only where the other commit touched the same bucket
    got = {r.k: r.v for r in sinks.read_current(spark, root).collect() if not r.k.startswith("x")}
    want = {"k5": 33, "far": 1, "mine": 3, "both": 1} | ({"k5": 55} if again else {"far": 55})
    assert got == want and sinks.read_current(spark, root).count() == 54


def test_versions_of_two_writers_stay_apart(spark, tmp_path, monkeypatch):
    root, move = str(tmp_path / "t"), files.move_new
    sinks.write_version(spark.range(1), root)

    def late(session, source, target):
        monkeypatch.setattr(files, "move_new", move)
        sinks.write_version(spark.range(2), root)
        return move(session, source, target)

    monkeypatch.setattr(files, "move_new", late)
    assert sinks.write_version(spark.range(3), root) == "v000000003"
    assert [spark.read.parquet(f"{root}/v00000000{k}").count() for k in (1, 2, 3)] == [1, 2, 3]


def test_failing_and_unordered_merges(spark, tmp_path):
    root = str(tmp_path / "s")
    sinks.merge_current(rows(spark, [("a", 1, 1), (None, 1, 2)]), root, "k")
    before = part_files(root)
    with pytest.raises(Exception, match="k repeats in the batch: a"):
        sinks.merge_current(rows(spark, [("a", 1, 1), ("a", 1, 2)]), root, "k")
    assert part_files(root) == before and state.versions(spark, root) == ["v000000001"]
    with pytest.raises(ValueError):
        sinks.merge_current(rows(spark, [("a", 1, 1)]), root, "at")
    sinks.merge_current(rows(spark, [(None, 2, 9), ("b", 1, 1)]), root, "k")
    assert {tuple(r) for r in sinks.read_current(spark, root).collect()} == {("a", 1, 1), (None, 2, 9), ("b", 1, 1)}
    sinks.merge_current(rows(spark, []), root, "k")  # an empty batch
    assert sinks.read_current(spark, root).count() == 3


def test_new_columns(spark, tmp_path):
    root = str(tmp_path / "s")
    sinks.merge_current(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), root, "k")
    sinks.merge_current(spark.createDataFrame([("b", "x")], "k string, w string"), root, "k")
    sinks.merge_current(spark.createDataFrame([("c", 5)], "k string, v int"), root, "k")
    got = {r.k: (r.v, r.w) for r in sinks.read_current(spark, root).collect()}
    assert got == {"a": (1, None), "b": (None, "x"), "c": (5, None)}


def test_replaced_keys_touch_their_buckets_only(spark, tmp_path):
    root = str(tmp_path / "s")
    sinks.replace_keys(rows(spark, [(f"k{i % 40}", i, i) for i in range(200)]), root, "k", buckets=16)
    before = state.manifest(spark, root)["folders"]
    sinks.replace_keys(rows(spark, [("k3", 0, -1), ("k3", 0, -2)]), root, "k")
    after = state.manifest(spark, root)["folders"]
    assert sum(after[b] != before[b] for b in after) == 1
    assert sorted(r.v for r in sinks.read_current(spark, root).filter("k = 'k3'").collect()) == [-2, -1]
    assert sinks.read_current(spark, root).count() == 200 - 5 + 2


def counting(spark, tmp_path, n=100):
    """A frame that leaves a file for each run of each of its two partitions."""
    folder = tmp_path / "runs"
    folder.mkdir(exist_ok=True)

    def run(batches):
        import uuid

        for batch in batches:
            (folder / uuid.uuid4().hex).touch()
            yield batch

    day = dt.datetime(2024, 1, 1)
    base = spark.range(0, n, 1, 2).select(F.col("id").cast("string").alias("order_id"), F.lit(day).alias("created_at"), F.lit("PAID").alias("payment_status"), F.lit(2).cast("decimal(18,2)").alias("total"))
    return base.mapInPandas(run, base.schema), folder


def test_audit_runs_the_plan_once(spark, tmp_path):
    root = str(tmp_path / "t")
    measures = quality.order_measures() | {"value": F.sum("total")}

    def audit(now, before):
        return quality.check_orders(now) + quality.check_regression(now, before, {"orders": 0.8, "value": 0.5})

    frame, runs = counting(spark, tmp_path)
    assert sinks.publish_audited(frame, root, measures, audit) == ("v000000001", [])
    assert len(list(runs.iterdir())) == 2
    assert sinks.facts_of(spark, root) == {"orders": 100, "months": 1, "without_status": 0, "value": "200.00"}
    smaller, _ = counting(spark, tmp_path, 70)
    with pytest.raises(quality.QualityError, match="orders fell from 100 to 70"):
        sinks.publish_audited(smaller, root, measures, audit)
    assert len(list(runs.iterdir())) == 4  # what it is compared with was not read again
    assert sinks.read_current(spark, root).count() == 100 and sorted(os.listdir(root)) == ["v000000001"]
    with pytest.raises(quality.QualityError):
        sinks.publish_audited(smaller.limit(0), root, measures, audit)
    warned = counting(spark, tmp_path, 90)[0].withColumn("payment_status", F.when(F.col("order_id").cast("int") % 2 == 0, "PAID"))
    name, warnings = sinks.publish_audited(warned, root, measures, audit)
    assert name == "v000000002" and len(warnings) == 1 and sinks.read_current(spark, root).count() == 90


def test_audit_of_a_failing_write(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(Exception, match="broken row"):
        sinks.publish_audited(failing(spark), root, quality.row_measures(), quality.check_row_loss)
    assert os.listdir(root) == []
    assert sinks.publish_audited(spark.range(20), root, quality.row_measures(), quality.check_row_loss)[0] == "v000000001"
    with pytest.raises(quality.QualityError):
        sinks.publish_audited(spark.range(17), root, quality.row_measures(), quality.check_row_loss)
