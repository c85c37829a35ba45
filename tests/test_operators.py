"""Operators against plain Python on small random inputs, hot keys included."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import skew
from tallyhouse.operators.asof import asof_join
from tallyhouse.operators.components import linked_groups
from tallyhouse.operators.joins import attach_to_headquarters, fallback_key, newest_by_key, overlay, summed_union
from tallyhouse.operators.matching import containing, prefixing, word_scored
from tallyhouse.operators.multiset import surplus
from tallyhouse.operators.ranking import globally_numbered, nth, numbered, top_n


def hot_keys(rng, n):
    """A third of the rows hold one key."""
    return [0 if rng.random() < 0.34 else rng.randrange(1, 8) for _ in range(n)]


def test_numbered_is_row_number(spark):
    rng = random.Random(1)
    data = [(k, rng.randrange(50), i) for i, k in enumerate(hot_keys(rng, 500))]
    df = spark.createDataFrame(data, "k int, v int, id int")
    got = {r["id"]: r["rn"] for r in numbered(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    groups = defaultdict(list)
    for k, v, i in data:
        groups[k].append((v, i))
    want = {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)}
    assert got == want


def test_numbered_without_keys(spark):
    df = spark.range(200).withColumn("v", F.col("id") % 13)
    rows = numbered(df, [], [F.col("v"), F.col("id")]).collect()
    want = sorted((r["v"], r["id"]) for r in rows)
    assert [(r["v"], r["id"]) for r in sorted(rows, key=lambda r: r["rn"])] == want
    assert sorted(r["rn"] for r in rows) == list(range(1, 201))


def test_global_numbers(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 3)
    rows = globally_numbered(df.repartition(5), [F.desc("v"), F.col("id")]).collect()
    want = sorted(((-r["v"], r["id"]) for r in rows))
    assert [(-r["v"], r["id"]) for r in sorted(rows, key=lambda r: r["rn"])] == want


def test_top_rows(spark):
    df = spark.createDataFrame([(k, v) for k in "ab" for v in range(10)], "k string, v int")
    assert sorted(r["v"] for r in top_n(df, ["k"], [F.desc("v")], 2).filter("k='a'").collect()) == [8, 9]
    assert [r["v"] for r in nth(df, ["k"], [F.col("v")], 3).orderBy("k").collect()] == [2, 2]
    assert nth(df, ["k"], [F.col("v")], 11).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("counted", [False, True])
@pytest.mark.parametrize("share", [2, 1000])
def test_hot_join_equals_join(spark, monkeypatch, how, counted, share):
    """With few keys hot, with all keys hot, with null keys and keys without a partner."""
    monkeypatch.setattr(skew, "SHARE", share)
    rng = random.Random(2)
    keys = [None if rng.random() < 0.1 else k for k in hot_keys(rng, 300)]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, id int")
    right = spark.createDataFrame([(k, f"n{k}", keys.count(k)) for k in (0, 2, 4, 99)], "k int, name string, n long")
    got = skew.hot_join(left, right, ["k"], how, "n" if counted else None)
    want = left.join(right, "k", how).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def slow_surplus(newer, older):
    stock = Counter(newer)
    kept = Counter()
    for source in older:
        for key in source:
            if stock[key]:
                stock[key] -= 1
            else:
                kept[key] += 1
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_multiset_pairing(spark, seed):
    rng = random.Random(seed)

    def source(n):
        return [(0, 0) if rng.random() < 0.34 else (rng.randrange(4), rng.randrange(3)) for _ in range(n)]

    newer, one, two = source(60), source(40), source(50)
    frames = [
        spark.createDataFrame([(a, b, f"{name}{i}") for i, (a, b) in enumerate(rows)], "a int, b int, rec string")
        for name, rows in (("n", newer), ("o", one), ("t", two))
    ]
    left = surplus(frames[0], frames[1:], ["a", "b"], "rec").collect()
    assert Counter((r["a"], r["b"]) for r in left) == slow_surplus(newer, [one, two])
    assert len({r["rec"] for r in left}) == len(left)
    # The second source is used up before the third.
    by_source = slow_surplus(newer, [one])
    assert Counter((r["a"], r["b"]) for r in left if r["rec"][0] == "o") == by_source


def test_multiset_three_equal_orders_two_quotes_two_old(spark):
    def frame(name, n):
        return spark.createDataFrame([("c", 1, f"{name}{i}") for i in range(n)], "a string, b int, rec string")

    left = [r["rec"] for r in surplus(frame("n", 3), [frame("q", 2), frame("o", 2)], ["a", "b"], "rec").collect()]
    assert len(left) == 1 and left[0].startswith("o")


def test_multiset_null_keys_never_pair(spark):
    newer = spark.createDataFrame([(None, 1, "n")], "a string, b int, rec string")
    older = spark.createDataFrame([(None, 1, "o")], "a string, b int, rec string")
    assert surplus(newer, [older], ["a", "b"], "rec").count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_asof_join(spark, seed):
    rng = random.Random(seed)
    meet = [(k, rng.randrange(400), rng.randrange(3), i) for i, k in enumerate(hot_keys(rng, 120))]
    deals = [(k if rng.random() > 0.05 else None, rng.randrange(400), i) for i, k in enumerate(hot_keys(rng, 90))]

    def at(df):
        return df.withColumn("ts", F.timestamp_seconds(F.col("t") * 600))

    right = at(spark.createDataFrame(meet, "k int, t int, owner int, mid int")).drop("t").withColumnRenamed("ts", "start")
    left = at(spark.createDataFrame(deals, "k int, t int, did int"))
    got = {r["did"]: r["match"]["mid"] if r["match"] else None for r in asof_join(left, right, "k", "ts", "start", ["owner", "mid"]).collect()}
    want = {}
    for k, t, did in deals:
        earlier = [(-mt, o, mid) for mk, mt, o, mid in meet if mk == k and mt <= t]
        want[did] = min(earlier)[2] if earlier else None
    assert got == want


def slow_groups(rows, limits):
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for col, limit in limits:
        members = defaultdict(list)
        for r in rows:
            if r[col] is not None:
                members[r[col]].append(r[0])
        for ids in members.values():
            if 1 < len(ids) <= limit:
                for other in ids[1:]:
                    a, b = find(ids[0]), find(other)
                    parent[max(a, b)] = min(a, b)
    return {r[0]: find(r[0]) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_groups_match_union_find(spark, seed):
    rng = random.Random(seed)
    rows = [(f"{i:03d}", rng.choice([None, *range(40)]), 0 if rng.random() < 0.34 else rng.randrange(60)) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, root int, dom int")
    got = {r["id"]: r["group_id"] for r in linked_groups(df, "id", {"root": 4, "dom": 5}).collect()}
    assert got == slow_groups(rows, [(1, 4), (2, 5)])


def test_long_chain_takes_few_rounds(spark):
    """A chain of 300 companies, each sharing one key with the next."""
    df = spark.range(300).selectExpr("lpad(cast(id as string), 4, '0') id", "id div 2 root", "(id + 1) div 2 dom")
    got = linked_groups(df, "id", {"root": 20, "dom": 15}, max_rounds=14)
    assert [r["group_id"] for r in got.select("group_id").distinct().collect()] == ["0000"]


NAMES = ["loja", "azul", "mar", "maria", "marina", "sol", "solar", "flor", "florida", "rio"]


def random_names(rng, n):
    return sorted({" ".join(rng.choice(NAMES) if rng.random() > 0.3 else "loja" for _ in range(rng.randrange(1, 4))) for _ in range(n)})


def frames(spark, asked, offered):
    a = spark.createDataFrame([(n,) for n in asked], "name string")
    o = spark.createDataFrame([(n, f"id{i:03d}") for i, n in enumerate(offered)], "name string, pick string")
    return a, o


def points(a, b):
    total = 0
    for x in a.split():
        for y in b.split():
            if len(x) >= 3 and len(y) >= 3:
                total += 2 if x == y else 1 if x.startswith(y) or y.startswith(x) else 0
    return total


@pytest.mark.parametrize("hot", [0, 2, 1000])
@pytest.mark.parametrize("seed", range(3))
def test_word_scores(spark, seed, hot):
    """Exact whatever counts as a hot word, with one word in a third of the names."""
    rng = random.Random(seed)
    asked, offered = random_names(rng, 25), random_names(rng, 40)
    got = {r["name"]: (r["pick"], r["score"]) for r in word_scored(*frames(spark, asked, offered), hot=hot).collect()}
    want = {}
    for a in asked:
        best = min(((-points(a, o), f"id{i:03d}") for i, o in enumerate(offered)), default=None)
        if best and -best[0] >= 2:
            want[a] = (best[1], -best[0])
    assert got == want


def test_containing_and_prefixing(spark):
    rng = random.Random(5)
    asked, offered = random_names(rng, 25), random_names(rng, 30)
    a, o = frames(spark, asked, offered)
    cases = [
        (containing(a, o), lambda x, y: x in y or y in x),
        (containing(a, o, common=3), lambda x, y: x in y or y in x),
        (containing(a, o, common=0), lambda x, y: x in y or y in x),
        (containing(a, o, min_len=5), lambda x, y: len(x) >= 5 and len(y) >= 5 and (x in y or y in x)),
        (prefixing(a, o, 4), lambda x, y: len(y) >= 4 and (x.startswith(y) or y.startswith(x))),
    ]
    for frame, fits in cases:
        want = {}
        for x in asked:
            hits = [(-min(len(x), len(y)), f"id{i:03d}") for i, y in enumerate(offered) if fits(x, y)]
            if hits:
                want[x] = min(hits)[1]
        assert {r["name"]: r["pick"] for r in frame.collect()} == want


def test_overlay_fills_and_forces(spark):
    base = spark.createDataFrame([(1, "", "a"), (2, "x", "a"), (3, None, "a")], "id int, name string, status string")
    other = spark.createDataFrame([(1, "n1", "b"), (2, "n2", ""), (3, None, "c")], "id int, name string, status string")
    got = overlay(base, other, "id", fill=["name"], force=["status"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "n1", "b"), (2, "x", "a"), (3, None, "c")]


def test_fallback_key(spark):
    registry = spark.createDataFrame([("c1", 1), ("c2", 1), ("c3", 3)], "company string, domain int")
    rows = spark.createDataFrame([(1, "c2", 9), (2, "zz", 1), (3, None, 3), (4, "zz", 9)], "id int, company string, domain int")
    got = fallback_key(rows, "company", "domain", registry, "owner").orderBy("id").collect()
    assert [(r["id"], r["owner"]) for r in got] == [(1, "c2"), (2, "c1"), (3, "c3")]


def test_headquarters_get_the_totals(spark):
    companies = spark.createDataFrame([("a", 1, True), ("b", 1, False), ("c", 2, True)], "id string, dom int, is_hq boolean")
    totals = spark.createDataFrame([(1, 10), (3, 5)], "dom int, n int")
    got = {r["id"]: r["n"] for r in attach_to_headquarters(companies, totals, "dom", ["n"]).collect()}
    assert got == {"a": 10, "b": 0, "c": 0}


def test_small_joins(spark):
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    two = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    assert {r["k"]: r["v"] for r in summed_union([one, two], ["k"], ["v"]).collect()} == {"a": 3, "b": 3}
    assert {r["k"]: r["v"] for r in newest_by_key([one, two], "k").collect()} == {"a": 1, "b": 3}
