"""Damaged lines and files are reported, and nothing is lost."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from tallyhouse.sources import checked, readers
from tallyhouse.sources.samples import blank

CSV = "a int, b decimal(18,2), c string"


def csv(spark, tmp_path, text, schema=CSV, **more):
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    return checked.split_bad(checked.read_csv(spark, str(tmp_path / "in.csv"), schema, **more))


def test_csv_lines(spark, tmp_path):
    good, bad = csv(spark, tmp_path, 'a,b,c\n1,2.50,x\nx,3,y\n4,5,6,7\n5\n6,"1,5",z\n7, 3 ,"q""r"\n8,,\n\n9,1,a,\n9x,1x,é\n')
    assert {(r.a, None if r.b is None else float(r.b), r.c) for r in good.collect()} == {(1, 2.5, "x"), (5, None, None), (7, 3.0, 'q"r'), (8, None, None), (9, 1.0, "a")}
    assert {(r.record, r.reason) for r in bad.collect()} == {
        ("x,3,y", "a: x is no int"), ("4,5,6,7", "more than 3 fields"), ('6,"1,5",z', "b: 1,5 is no decimal(18,2)"), ("9x,1x,é", "a: 9x is no int; b: 1x is no decimal(18,2)"),
    }
    assert all(r.file.endswith("in.csv") for r in bad.collect())
    # Whatever columns a reader takes, lines stay good or bad.
    assert good.select("c").count() == 5 and bad.select("reason").count() == 4 and good.count() == 5


def test_csv_line_feeds_and_separator(spark, tmp_path):
    good, bad = csv(spark, tmp_path, 'a;b\n1;"x\ny"\nz;"p\nq"\n3;ok;more\n', "a int, b string", multi_line=True, sep=";")
    assert [tuple(r) for r in good.collect()] == [(1, "x\ny")]
    assert sorted(r.reason for r in bad.collect()) == ["a: z is no int", "more than 2 fields"]


def test_csv_of_texts_only(spark, tmp_path):
    good, bad = csv(spark, tmp_path, "a,b\nx\ny,1,2\n,\n", "a string, b string")
    assert {tuple(r) for r in good.collect()} == {("x", None), (None, None)} and [r.record for r in bad.collect()] == ["y,1,2"]


DOCUMENTS = [
    ('{"workspaceId":"w","orderNumber":"12","purchase":{"purchaseId":"p1","amount":100,"installments":[{"amount":"5"},{"amount":"y"}]}}', "purchase.installments.amount: y is no value"),
    ('{"workspaceId":"w","orderNumber":12,"purchase":{"purchaseId":"p2","amount":"x"}}', "purchase.amount: x is no value"),
    ('{"workspaceId":"w","purchase":{"purchaseId":"p3","amount":1', "no JSON"),
    ('{"workspaceId":"w","purchase":{"purchaseId":"p3","amo', "no JSON"),
    ('{"purchase":5,"orderId":"7"}', "another structure"),
    ("{}", "without purchase.purchaseId"),
    ("[1]", "another structure"),
    ("gibberish", "no JSON"),
    ('{"anticipation":true,"purchase":{"purchaseId":"p4","amount":"12","fee":12.7,"installments":[{"amount":3.0,"isProtected":false}],"tags":["a"],"metadata":{"a":"b"}}}', None),
    ('{"purchase":{"purchaseId":"p5","amount":null},"unknown":{"x":1}}', None),
]


def test_purchase_lines(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n\n".join(d for d, _ in DOCUMENTS))
    rows = checked.read_purchases(spark, str(tmp_path / "p.json"))
    for good, bad in (checked.split_bad(rows), checked.quarantined(rows, str(tmp_path / "out"))):
        assert good.schema == readers.PURCHASE_DOCUMENT
        assert {r.purchase.purchaseId: (r.purchase.amount, r.purchase.fee) for r in good.collect()} == {"p4": (12, 12), "p5": (None, None)}
        assert sorted(r.reason for r in bad.collect()) == sorted(reason for _, reason in DOCUMENTS if reason)
        assert all(any(json.dumps(r.record)[1:20] in json.dumps(d) for d, _ in DOCUMENTS) for r in bad.collect())
    instalments = readers.flatten_instalments(checked.split_bad(rows)[0]).collect()
    assert [(r.purchase_id, r.amount_cents, r.is_protected) for r in instalments] == [("p4", 3, False)]


def test_purchase_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"purchase": {"purchaseId": "a"}}, {"purchase": {}}]))
    (tmp_path / "b.json").write_text('[{"purchase": {"purchaseId": "b"}},')
    good, bad = checked.split_bad(checked.read_purchases(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")], arrays=True))
    assert [r.purchase.purchaseId for r in good.collect()][0] == "a"
    assert {r.reason for r in bad.collect()} >= {"without purchase.purchaseId", "no JSON"}


def test_quarantine_runs_the_plan_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.csv").write_text("a,b,c\n1,1,x\ny,1,x\n")
    runs = tmp_path / "runs"
    runs.mkdir()

    def seen(batches):
        import uuid

        (runs / uuid.uuid4().hex).touch()
        yield from batches

    rows = checked.read_csv(spark, str(tmp_path / "in"), CSV)
    good, bad = checked.quarantined(rows.mapInArrow(seen, rows.schema), str(tmp_path / "out"))
    assert good.count() == 1 and bad.count() == 1 and len(list(runs.iterdir())) == 1


def damaged_sets(spark, tmp_path, folders=("um", "Loja Dois", "três")):
    for name in folders:
        spark.range(50_000).selectExpr("id", "cast(rand(3) as string) v", "map('a', id) m").repartition(2).write.parquet(str(tmp_path / "sets" / name))
    return str(tmp_path / "sets"), T.StructType.fromDDL("id long, v string, m map<string, long>")


def test_damaged_pages_are_found_before_the_read(spark, tmp_path):
    root, schema = damaged_sets(spark, tmp_path)
    broken = sorted((tmp_path / "sets" / "Loja Dois").glob("part-*"))[1]
    blank(spark, str(broken), 0.4, 0.5)
    (tmp_path / "sets" / "vazia").mkdir()
    spark.createDataFrame([], schema).write.parquet(f"{root}/sem linhas")
    (tmp_path / "sets" / "texto").mkdir()
    (tmp_path / "sets" / "texto" / "x.parquet").write_text("no parquet")
    assert spark.read.schema(schema).parquet(f"{root}/Loja Dois").count() == 50_000  # footers alone look whole
    rows, report = checked.read_datasets(spark, root, schema)
    got = {r.brand: (r.rows, r.error) for r in report.collect()}
    assert got["um"] == got["três"] == (50_000, None) and got["vazia"] == got["sem linhas"] == (0, None) and got["texto"] == (None, "x.parquet: no readable footer")
    assert got["Loja Dois"][0] is None and got["Loja Dois"][1].startswith(broken.name) and got["Loja Dois"][1].endswith("of 25000 rows could be decoded")
    assert {(r.brand, r["count"]) for r in rows.groupBy("brand").count().collect()} == {("um", 50_000), ("três", 50_000)}
    assert rows.agg(F.count("v"), F.count("m")).first()[0] == 100_000


def test_flipped_bytes_are_found_by_checksums(spark, tmp_path):
    """Bytes that still decode, in an uncompressed file."""
    folder = tmp_path / "sets" / "um"
    spark.range(20_000).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(str(folder))
    file = next(folder.glob("part-*"))
    blank(spark, str(file), 0.4, 0.41)
    report = checked.read_datasets(spark, str(tmp_path / "sets"), "id long")[1].first()
    assert report.rows is None and "could be decoded" in report.error


@pytest.mark.parametrize("folders", [3, 25])
def test_one_job_for_all_folders(spark, tmp_path, folders):
    for k in range(folders):
        spark.range(10).coalesce(1).write.parquet(str(tmp_path / "sets" / f"b{k}"))
    context = spark.sparkContext
    context.setJobGroup(f"scan-{folders}", "scan")
    report = checked.read_datasets(spark, str(tmp_path / "sets"), "id long")[1]
    jobs = context.statusTracker().getJobIdsForGroup(f"scan-{folders}")
    context.setJobGroup("", "")
    assert len(jobs) <= 6  # shuffles are jobs of their own under adaptive execution; folders are not
    assert report.agg(F.sum("rows")).first()[0] == folders * 10


def test_no_datasets(spark, tmp_path):
    rows, report = checked.read_datasets(spark, str(tmp_path), "id long")
    assert rows.count() == 0 and report.count() == 0 and rows.columns == ["id", "brand"]
