"""Hard negatives and whitening against plain recomputations."""

import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from tallyhouse.llm import hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=3, n=260, d=12, labels=4):
    """Clustered vectors with copies, ties, repeated rows and rows that take no part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(d)] for _ in range(labels)]
    rows = []
    for k in range(n):
        label = 0 if k % 3 == 0 else rng.randrange(labels)  # one label holds a third
        v = [float(np.float32(c + rng.gauss(0, 0.2))) for c in centres[label]]
        if k % 10 == 7:
            v = list(rows[-1][1])
        rows.append((k * 5, v, label))
    rows += [rows[20], rows[41], (rows[40][0], rows[9][1], 1), (-100, rows[3][1], 2), (300, [0.0] * d, 1)]
    odd = [(None, rows[1][1], 1), (7001, rows[1][1], None), (7002, None, 1), (7003, [], 1), (7004, [1.0] * (d - 1), 1)]
    odd += [(7005 + k, [x] + [0.5] * (d - 1), 1) for k, x in enumerate([None, math.nan, math.inf, -math.inf, 1e30])]
    return rows, odd


def frame(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return df.selectExpr("*", "1 as anchor", "2 as score", "'x' as list", "3 as rank", "4 as n", "5 as i", "6 as whitened", "7 as at")


def brute_negatives(rows, positives=5, negatives=10):
    whole = [(i, tuple(math.floor(256 * x) for x in v), c) for i, v, c in rows]
    out = []
    for i, q, c in set(a for a in whole if a[0] % 100 == 0):
        scored = sorted(((sum(x * y for x, y in zip(q, v)), j, k) for j, v, k in whole if j != i), key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2] == c][:positives]:
            inside = [s for s in scored if s[2] != c and 30 * p <= 100 * s[0] <= 90 * p][:negatives]
            out += [(i, j, r, n, p, s) for r, (s, n, _) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("at_once", [20_000, 3])
def test_hard_negatives_against_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "STEP", 3)
    rows, odd = vectors()
    found = hard_negatives.mined(frame(spark, rows + odd), at_once=at_once)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == brute_negatives(rows)


def test_hard_negatives_in_whole_numbers_and_doubles(spark):
    """Large components leave the range of floats, then that of doubles."""
    rows, _ = vectors(seed=5, n=80)
    for factor in (1e3, 4e5):
        large = [(i, [max(-(2.0**19) + 1, min(2.0**19 - 1, float(np.float32(x * factor)))) for x in v], c) for i, v, c in rows]
        assert sorted(tuple(r) for r in hard_negatives.mined(frame(spark, large)).collect()) == brute_negatives(large)


def test_bitmap_shrinks_and_keeps_the_best():
    """The scan reads late dimensions for few rows, and never loses a row of the answer."""
    rng = np.random.default_rng(2)
    data = rng.integers(-100, 100, size=(4000, 64))
    data[:, 16:] //= 20
    block = hard_negatives.Block(np.arange(4000), np.zeros(4000, dtype=int), data, 100)
    sizes = []

    def keep(partial, least, most):
        sizes.append(len(partial))
        return partial + most >= np.partition(partial, len(partial) - 5)[len(partial) - 5] + least

    at, scores = hard_negatives.vertical_scan(data[0], block, 0, 4000, np.ones(4000, dtype=bool), keep)
    exact = data @ data[0]
    assert set(np.argsort(-exact, kind="stable")[:5]) <= set(block.ids[at].tolist())
    assert (scores == exact[block.ids[at]]).all() and sizes[0] == 4000 and sizes[-1] < 400


def test_no_hard_negatives(spark):
    _, odd = vectors(n=50)
    assert hard_negatives.mined(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives.mined(frame(spark, odd)).count() == 0
    assert hard_negatives.mined(frame(spark, [(100, [1.0, 0.0], 1), (101, [1.0, 0.0], 1)])).count() == 0  # no other label
    assert hard_negatives.mined(frame(spark, [(100, [1.0, 0.0], 1), (101, [-1.0, 0.0], 1), (102, [0.5, 0.0], 2)])).count() == 0  # an empty window
    zero = hard_negatives.mined(frame(spark, [(100, [1.0, 0.0], 1), (101, [0.0, 1.0], 1), (102, [0.0, 2.0], 2)])).collect()
    assert [tuple(r) for r in zero] == [(100, 101, 1, 102, 0, 0)]


def test_hard_negatives_sql(spark, tmp_path):
    rows, odd = vectors()
    rows = list({i: (i, v, c) for i, v, c in rows}.values())  # the SQL takes vec_id as a key
    path = str(tmp_path / "embeddings.parquet")
    odd = [r for r in odd if r[0] not in (7003, 7004, 7009)]
    frame(spark, rows + odd).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select vec_id, embedding, label from '{path}/*.parquet'")
    from tallyhouse.llm.queries import QUERIES

    found = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, str(tmp_path)).collect())
    assert found and found == sorted(con.execute(hard_negatives.SQL).fetchall())


# Whitening


def determinant_polynomial(m):
    """Coefficients of det(x - m), constant first, by traces of powers."""
    d = len(m)
    a = [[Fraction(v) for v in row] for row in m]
    out, step = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        step = [[step[i][j] + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        step = [[sum(a[i][l] * step[l][j] for l in range(d)) for j in range(d)] for i in range(d)]
        out.append(-sum(step[i][i] for i in range(d)) / k)
    return [int(c) for c in reversed(out)]


def gram(seed, d, rank, size):
    rng = random.Random(seed)
    x = [[rng.randint(-size, size) for _ in range(d)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in x) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("m", [gram(1, 7, 9, 1000), gram(2, 6, 3, 10**9), [[5]], [[0, 0], [0, 0]], [[3 if i == j else 0 for j in range(5)] for i in range(5)], gram(3, 9, 12, 2)])
def test_polynomial(spark, m):
    assert whitening.polynomial(spark, m) == determinant_polynomial(m)


def test_primes():
    found = whitening.primes(400)
    assert len(set(found)) == len(found) and math.prod(found) > 1 << 400 and found[0] == 2**31 - 1
    assert all(all(p % q for q in range(2, 2000)) for p in found)


@pytest.mark.parametrize("roots", [[9, 7, 4, 1], [5, 5, 5, 2], [3, 3, 0, 0], [10**12, 10**12 - 1, 1], [8, 4, 2, 1], [1]])
def test_roots(roots):
    c = [1]
    for r in roots:
        c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
    for a in range(12):
        assert whitening.roots_above(c, a) == sum(r > a for r in roots)
    found, bits = whitening.largest_roots(c, 8, sum(roots))
    assert found == [r << bits for r in sorted(roots, reverse=True) if r]


def test_roots_that_are_no_whole_numbers():
    m = np.array(gram(4, 8, 10, 300))
    found, bits = whitening.largest_roots(determinant_polynomial(m.tolist()), 8, int(np.trace(m)))
    assert np.allclose([r / 2**bits for r in found], np.linalg.eigvalsh(m.astype(float))[::-1], rtol=1e-9)


def test_whitening_against_doubles(spark):
    rows, odd = vectors(n=300)
    kept = rows + odd[:2]  # rows without id or label are vectors as well
    out = whitening.whitened(frame(spark, rows + odd)).toPandas()
    x = np.floor(1024 * np.array([v for _, v, _ in kept], dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    assert len(out) == n * 8 and set(out["n"]) == {n} and out["identity_error"].nunique() == 1 and out["identity_error"].max() < 1e-9
    explained = out.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, values / np.trace(centred.T @ centred / n), rtol=1e-9)
    want = centred @ axes / np.sqrt(values)
    for component in range(1, 9):
        part = out[out["component"] == component]
        got = sorted(part["whitened"])
        theirs = want[:, component - 1]
        assert min(np.abs(np.sort(s * theirs) - got).max() for s in (1, -1)) < 1e-9
    exact = sorted(sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, sums)) for r in x)
    assert sorted(out[out["component"] == 1]["deviation"]) == exact


def test_whitening_with_equal_and_missing_components(spark):
    """Equal variances stay orthogonal; directions without variance are left out."""
    rows = [(k, [float(s) if i == j else 0.0 for i in range(6)], 1) for k, (j, s) in enumerate((j, s) for j in range(4) for s in (1, -1))]
    out = whitening.whitened(frame(spark, rows)).toPandas()
    assert sorted(set(out["component"])) == [1, 2, 3, 4] and np.allclose(out["explained"], 0.25) and out["identity_error"].max() < 1e-9
    two = whitening.whitened(frame(spark, rows[:2])).toPandas()
    assert set(two["component"]) == {1} and np.allclose(sorted(two["whitened"]), [-1, 1])


def test_whitening_of_large_entries(spark):
    """Sums beyond 64 bits stay exact; a deviation that does not fit is null."""
    rows = [(k, [float(np.float32(8e9 * math.sin(k + i))) for i in range(3)], 1) for k in range(50)]
    out = whitening.whitened(frame(spark, rows)).toPandas()
    assert set(out["component"]) == {1, 2, 3} - ({3} if out["component"].max() == 2 else set()) and out["deviation"].isna().all() and out["identity_error"].max() < 1e-4


def test_whitening_of_nothing(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitened(frame(spark, vectors()[1][2:4])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [0.5, 0.5], 1)] * 3)).count() == 0
