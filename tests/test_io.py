"""Readers, sinks and the incremental writers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from tallyhouse.sources import checked, readers, schemas, sinks
from tallyhouse.streaming import incremental


def test_csv_quotes_blank_lines_and_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,value,note\n"Loja ""Um""", 10 ,x\n\n"a,b",,\nshort\n', encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [('Loja "Um"', "10", "x"), ("a,b", "", ""), ("short", "", "")]
    assert readers.read_csv(spark, str(tmp_path / "a.csv"), limit=1).count() == 1


def test_csv_newline_inside_quotes(spark, tmp_path):
    (tmp_path / "n.csv").write_text('id,text\n1,"a\nb"\n2,c\n', encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "n.csv"), multi_line=True).collect()
    assert [r["text"] for r in rows] == ["a\nb", "c"]


def test_csv_schema(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id;v\n1;2.50\n", encoding="utf-8")
    schema = T.StructType.fromDDL("id int, v decimal(18,2)")
    assert readers.read_csv(spark, str(tmp_path / "s.csv"), schema, sep=";").first()["v"] == pytest.approx(2.5)


def test_names_and_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["T[A]", "[B]", "c"])
    assert readers.bare_names(df).columns == ["A", "B", "c"]
    assert readers.project(df, {"x": "T[A]"}).columns == ["x"]


def test_aliases_and_conform(spark):
    df = spark.createDataFrame([("", "b", "1")], ["Integração", "Integracao", "n"])
    out = schemas.harmonise(df, {"integration": ["Integração", "Integracao"], "other": ["Outro"]}).first()
    assert (out["integration"], out["other"]) == ("b", None)
    fixed = schemas.conform(df, T.StructType.fromDDL("n int, m string"))
    assert fixed.dtypes == [("n", "int"), ("m", "string")] and fixed.first()["n"] == 1


def purchase(pid, order, **fields):
    body = {"purchaseId": pid, "status": "paid", "amount": 1000, "created": "2024-03-01T01:30:00+00:00", "tags": ["order_1"]}
    return {"workspaceId": "w", "transactionId": f"t{pid}", "orderId": order, "orderDate": "2024-02-29", "purchase": body | fields}


def test_nested_purchases(spark, tmp_path):
    parts = [{"id": "i2", "due": "2024-05-01T03:00:00+00:00", "amount": 400}, {"id": "i1", "due": "2024-04-01T03:00:00+00:00", "amount": 600}]
    docs = [purchase("p1", "1", installments=parts), purchase("p2", "2", amount=None, tags=None)]
    (tmp_path / "p.json").write_text(json.dumps(docs))
    read = readers.read_purchases(spark, str(tmp_path / "p.json"), arrays=True)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(d) for d in [*docs, purchase("p3", "3")]))
    by_line = readers.read_purchases(spark, str(tmp_path / "lines.json"))
    assert sorted(r.purchase.purchaseId for r in by_line.collect()) == ["p1", "p2", "p3"]
    flat = {r["purchase_id"]: r for r in readers.flatten_purchases(read).collect()}
    # 01:30 UTC is the evening before in the local zone.
    assert str(flat["p1"]["created"])[:10] == "2024-02-29" and flat["p1"]["order_date"] == dt.date(2024, 2, 29)
    assert flat["p1"]["api_created"] == flat["p1"]["created"]
    assert (flat["p2"]["amount_cents"], flat["p2"]["tags"], flat["p2"]["anticipation"]) == (0, "[]", False)
    lines = readers.flatten_instalments(read).orderBy("installment_number").collect()
    assert [(r["installment_id"], r["installment_number"], r["amount_cents"], str(r["due"])[:10]) for r in lines] == [
        ("i1", 1, 600, "2024-04-01"), ("i2", 2, 400, "2024-05-01"),
    ]


def test_one_folder_per_brand(spark, tmp_path):
    for brand in ("Loja Um", "loja-dois"):
        spark.range(2).write.parquet(str(tmp_path / "sets" / brand))
    (tmp_path / "sets" / "broken").mkdir()
    (tmp_path / "sets" / "broken" / "x.parquet").write_text("no parquet")
    got, report = checked.read_datasets(spark, str(tmp_path / "sets"), T.StructType.fromDDL("id bigint"))
    assert {(r["brand"], r["count"]) for r in got.groupBy("brand").count().collect()} == {("Loja Um", 2), ("loja-dois", 2)}
    assert {r.brand: (r.rows, r.error is None) for r in report.collect()} == {"Loja Um": (2, True), "loja-dois": (2, True), "broken": (None, False)}


def test_latest_sheet_and_fallback(spark):
    lines = spark.createDataFrame([("A 01-2025", 1), ("A 122024", 2), ("B 0125", 3)], "sheet string, v int")
    assert sorted(r["v"] for r in readers.latest_sheet(lines).collect()) == [1, 3]
    main = spark.createDataFrame([("a", 1, 5)], "k string, v int, w int")
    poor = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    assert {tuple(r) for r in readers.with_fallback(main, poor, "k").collect()} == {("a", 1, 5), ("b", 2, None)}


def test_missing_table_is_none(spark):
    assert readers.read_if_exists(spark, "no_such_table") is None


def test_merge_keeps_one_row_per_key(spark, tmp_path):
    root = str(tmp_path / "current")
    first = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, at int, v int")
    assert sinks.read_current(spark, root) is None
    assert sinks.merge_current(first, root, "k", "at") == "v000000001"
    second = spark.createDataFrame([("b", 2, 5), ("b", 3, 6), ("c", 1, 7)], "k string, at int, v int")
    assert sinks.merge_current(second, root, "k", "at") == "v000000002"
    assert {tuple(r) for r in sinks.read_current(spark, root).collect()} == {("a", 1, 1), ("b", 3, 6), ("c", 1, 7)}
    late = spark.createDataFrame([("b", 2, 9), ("c", 1, 8), ("d", 1, 1)], "k string, at int, v int")
    sinks.merge_current(late, root, "k", "at", forward=True)
    assert {tuple(r) for r in sinks.read_current(spark, root).collect()} == {("a", 1, 1), ("b", 3, 6), ("c", 1, 8), ("d", 1, 1)}
    assert sinks.drop_versions(spark, root, keep=1) == ["v000000001", "v000000002"]
    assert sinks.read_current(spark, root).count() == 4


def test_replace_keys_keeps_several_rows(spark, tmp_path):
    root = str(tmp_path / "r")
    sinks.replace_keys(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int"), root, "k")
    sinks.replace_keys(spark.createDataFrame([("a", 9), ("a", 8)], "k string, v int"), root, "k")
    assert sorted(r["v"] for r in sinks.read_current(spark, root).collect()) == [3, 8, 9]


def test_snapshots_by_day_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "s")
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 2)):
        sinks.append_snapshot(spark.range(3), path, day)
    counts = spark.read.parquet(path).groupBy("snapshot_date").count().orderBy("snapshot_date").collect()
    assert [r["count"] for r in counts] == [3, 3]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("São", 1.5)], "a string, b double")
    sinks.write_csv(df, str(tmp_path / "c"), single=True)
    text = next((tmp_path / "c").glob("part*.csv")).read_bytes()
    assert text.startswith("\ufeffa;b".encode()) and "São;1.5".encode() in text
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().asDict() == {"a": "São", "b": 1.5}
    sinks.overwrite(df, str(tmp_path / "o"))
    sinks.overwrite(df.drop("b"), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).columns == ["a"]


def test_json_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "JSON_ROWS", 3000)
    df = spark.range(10_000).selectExpr("cast(id as string) purchaseId", "concat('tag_', id % 7) orderNumber", "array(id, id + 1) installments").coalesce(1)
    sinks.write_json(df, str(tmp_path / "j"))
    parts = list((tmp_path / "j").glob("part-*"))
    assert len(parts) == 4 and all(p.name.endswith(".json.gz") for p in parts)
    assert sum(p.stat().st_size for p in parts) * 4 < df.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert sorted(map(str, spark.read.schema(df.schema).json(str(tmp_path / "j")).collect())) == sorted(map(str, df.collect()))


def test_chunks_of_companies(spark, tmp_path):
    counts = spark.range(120).selectExpr("lpad(cast(id as string), 3, '0') company_id", "id % 3 orders")
    chunks = sinks.chunk_map(counts, 50)
    order = sorted(((-r["orders"], r["company_id"]) for r in counts.collect()))
    want = {c: i // 50 for i, (_, c) in enumerate(order)}
    assert {r["company_id"]: r["chunk"] for r in chunks.collect()} == want
    sinks.write_chunks(counts, chunks, str(tmp_path / "x"))
    assert sorted(p.name for p in (tmp_path / "x" / "records").glob("chunk=*")) == ["chunk=0", "chunk=1", "chunk=2"]


def test_streams_keep_state_and_snapshots(spark, tmp_path):
    schema = "k string, at int, v int"
    landed, root = str(tmp_path / "in"), str(tmp_path / "current")
    for rows in ([("a", 1, 1), ("b", 1, 1)], [("b", 2, 2), ("a", 0, 9)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        incremental.keep_current(stream, root, "k", "at", str(tmp_path / "cp1")).awaitTermination()
        incremental.keep_snapshots(stream, str(tmp_path / "snap"), str(tmp_path / "cp2"), dt.date(2024, 1, 1)).awaitTermination()
    assert {tuple(r) for r in sinks.read_current(spark, root).collect()} == {("a", 1, 1), ("b", 2, 2)}
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 4


def test_weekly_stream_equals_batch(spark, tmp_path):
    rows = [("x", "click", dt.datetime(2024, 1, d, 12)) for d in (1, 3, 7, 8, 9, 31)]
    spark.createDataFrame(rows, "brand string, event string, ts timestamp").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("brand string, event string, ts timestamp").parquet(str(tmp_path / "e"))
    counts = incremental.weekly_events(stream).writeStream.format("memory").queryName("weeks").outputMode("complete").start()
    counts.processAllAvailable()
    counts.stop()
    got = {str(r["week"]): r["n"] for r in spark.table("weeks").collect()}
    assert got == {"2024-01-01": 3, "2024-01-08": 2, "2024-01-29": 1}
