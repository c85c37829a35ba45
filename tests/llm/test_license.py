"""License scan against plain Python and its SQL."""

import random
import re

import duckdb
import pytest

from tallyhouse.llm import license_scan
from tallyhouse.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NOTICE = dict((label, text) for label, text in reversed(license_scan.NOTICES))
LONG = next(t for label, t in license_scan.NOTICES if label == "mit" and len(t.split()) > 10)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w = words(text)
    return sorted((i, label) for label, phrase in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())


def texts():
    rng = random.Random(1)
    loose = sorted({w for _, t in license_scan.PHRASES + license_scan.NOTICES for w in t.split()} | {"été", "漢字", "x"})
    fixed = [
        None, "", " \n--", "MIT", "The MIT License.", "mit-license MIT\tLICENSE mit license", "İMIT license Mit Licenſe", "general public license general public license",
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "Licensed under the Apache License, Version 2.0.", "permit license mit licenses",
        LONG, LONG.replace("free of charge", "free of any charge at all"), LONG.replace("software ", "library ", 1), LONG[:60], "x " * 30 + LONG + " y" * 20 + " GNU General Public License",
        "mit license " * 40, ("under the " * 500) + "MIT license", "Released under the MIT License. " + LONG, "dual licensed under the MIT license or apache license version 2 0",
        "one " * 40_000 + "apache license",
    ]
    return fixed + [" ".join(rng.choice(loose) for _ in range(rng.choice([5, 80, 600]))) for _ in range(120)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(k * 3, t) for k, t in enumerate(texts())]
    rows += [rows[5], rows[5], (rows[5][0], "another apache license"), (None, "MIT license"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.selectExpr("*", "1 as template", "2 as word", "3 as place", "'x' as label", "4 as digest", "5 as n_words", "6 as gram", "7 as at")


def test_base_places_against_plain_python(frame):
    found = {(r.doc_id, r.n_words, r.n_base): r for r in license_scan.scanned(frame).collect()}
    rows = {(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()}
    assert len(found) == len({(i, t or "") for i, t in rows})
    for i, text in rows:
        places = base(text)
        r = found[i, len(words(text)), len(places)]
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert r.score == 1 if places else True


def test_notices(spark):
    def labels(text):
        r = license_scan.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        return r.labels, round(r.score, 2)

    assert labels("Licensed under CC BY-NC 4.0.") == ("cc-by-nc", 1)  # its sibling without nc does not name it
    assert labels("Licensed under CC BY 4.0.") == ("cc-by", 1)
    assert labels("Zap. " * 9 + LONG.replace("free of charge", "free of any charge") + " quux" * 9) == ("mit", 1)  # an insertion moves the diagonal
    assert labels(LONG.replace("hereby ", "")) == ("mit", round((len(LONG.split()) - 1) / len(LONG.split()), 2))
    assert labels(" ".join(LONG.split()[:10])) == ("", 0)  # too little of it
    assert labels(" x x x x ".join(LONG.split())) == ("", 0)
    assert labels("under the terms of the gnu lesser general public license as published by the free software foundation") == ("gpl,lgpl", 1)
    with pytest.raises(ValueError):
        license_scan.scanned(spark.createDataFrame([(1, "a")], "doc_id long, text string"), phrases=[("x", "word")])


def test_sql(spark, frame, tmp_path):
    path = str(tmp_path / "documents.parquet")
    frame.select("doc_id", "text").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    found = QUERIES["op13_license_scan"](spark, str(tmp_path))
    theirs = con.execute(license_scan.SQL)
    assert found.columns == [c[0] for c in theirs.description]
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, theirs.fetchall()))


def test_no_python_on_the_main_path(spark, frame):
    plan = license_scan.hits(frame, license_scan._numbered(license_scan.PHRASES, license_scan.NOTICES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange hashpartitioning" not in plan


def test_no_documents(spark, none):
    assert license_scan.scanned(none).count() == 0
