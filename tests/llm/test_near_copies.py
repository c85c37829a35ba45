"""Jaccard join, suffix deduplication, decontamination, components and SimHash against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from near_copies_brute import components_of, pairs_of, roots, shingle_set, without_repeats

from tallyhouse.llm import common, decontamination, jaccard_join, simhash, suffix_dedup
from tallyhouse.llm.components import components

@pytest.mark.parametrize("percent", [80, 60])
def test_jaccard_components(docs, rows, percent):
    _, want = components_of(rows, percent)
    got = jaccard_join.joined(docs, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {doc: len(shingle_set(text)) for doc, text in rows}


def test_jaccard_large_groups_and_tiles(spark, monkeypatch):
    """One group of near copies, and many texts that share a passage without being alike."""
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(80)]
    rows = []
    for k in range(60):
        copy = list(base)
        copy[rng.randrange(80)] = f"x{k}"
        rows.append((k, " ".join(copy)))
    for k in range(60, 120):
        own = [f"y{k}-{j}" for j in range(rng.choice([2, 6, 30]))]
        rows.append((k, " ".join(base[:30] + own)))
    _, want = components_of(rows)
    got = jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_jaccard_repeated_and_empty(twice, none):
    assert jaccard_join.joined(none).count() == 0
    got = jaccard_join.joined(twice).collect()
    assert len(got) == sum(r.doc_id is not None for r in twice.collect())
    kept = jaccard_join.one_of_each(twice).collect()
    _, want = components_of([tuple(r) for r in twice.collect()])
    assert {r.doc_id for r in kept if r.doc_id is not None} == {d for d, c in want.items() if d == c} and len(set(kept)) == len(kept)


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64)) for _ in range(60)]
    sets += [np.sort(np.concatenate([s[:38], rng.integers(0, 2**63, int(rng.integers(0, 6)), dtype=np.uint64)])) for s in sets[:40]]
    sets += [np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)) for _ in range(20)]
    sets += [np.sort(np.concatenate([s[:3800], rng.integers(0, 2**63, 300, dtype=np.uint64)])) for s in sets[-20:]]
    vectors = [jaccard_join.count_vector(s) for s in sets]
    points = np.stack([jaccard_join.folded(v, jaccard_join.GROUPS) for v in vectors])
    assert (points.sum(axis=1) == [len(s) for s in sets]).all()
    tree = jaccard_join.RTree(points)
    for k, s in enumerate(sets):
        assert {j for j, t in enumerate(sets) if jaccard_join.similar(s, t, 80)} <= set(tree.near(points[k], 80).tolist())
    pairs = set(jaccard_join.near_pairs(list(range(len(sets))), [2] * len(sets), vectors, 80))
    true = {(j, k) for k, s in enumerate(sets) for j, t in enumerate(sets[:k]) if jaccard_join.similar(s, t, 80)}
    assert len(true) > 40 and true <= pairs and len(pairs) < 4 * len(true)  # most others are left out by their counts


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1400)] + [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == roots(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def dedup(frame):
    got = suffix_dedup.deduplicated(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted([tuple(r) for r in got], key=str)


@pytest.mark.parametrize("crowd", [4000, 3])
def test_repeats_are_removed(docs, rows, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    assert dedup(docs) == without_repeats(rows)


def test_repeats_in_repeated_and_empty_tables(twice, none):
    assert dedup(none) == []
    assert dedup(twice) == without_repeats([tuple(r) for r in twice.collect()])


def test_repeats_at_every_cut(spark):
    """Strings of 199 to 201 shared bytes, several bytes to a character, and overlaps inside one text."""
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghij ñ漢") for _ in range(n))
    shared = [noise(300).encode()[:n].decode("utf-8", "ignore") for n in (199, 200, 201, 230, 300)]
    rows = [(k, noise(rng.randint(0, 80)) + s + noise(rng.randint(0, 80))) for k, s in enumerate(shared * 2)]
    rows += [(50, "xyz" * 90), (51, "x" * 400), (52, shared[4] + shared[4])]
    assert dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == without_repeats(rows)


def test_suffix_order():
    rng = np.random.default_rng(0)
    for _ in range(300):
        data = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 90))).astype(np.uint8)
        raw = data.tobytes()
        assert suffix_dedup.suffix_order(data, 100).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


@pytest.mark.parametrize("limit", [500_000, 0])
def test_contained_items(spark, docs, rows, none, limit):
    rng = random.Random(7)
    long = rows[-1][1].split(" ")
    items = [(k, " ".join(long[at : at + n])) for k, (at, n) in enumerate([(10, 40), (9000, 15), (100, 7), (20, 5)])]
    for k, swap in enumerate([1, 2, 6, 12]):
        body = long[2000 * (k + 1) : 2000 * (k + 1) + 60]
        for at in rng.sample(range(60), swap):
            body[at] = "changed"
        items.append((20 + k, " ".join(body)))
    items += [(40, "ONE Two"), (41, "two"), (42, ""), (43, None), (None, "one two"), (44, "never seen anywhere at all"), (0, items[1][1]), (0, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as hash", "3 as size")
    got = decontamination.contained(docs, bench, broadcast_limit=limit).collect()
    assert {(r.doc_id, r.item_id): (r.containment, r.n_shingles, r.n_shared) for r in got} == pairs_of(rows, items)
    left = decontamination.clean(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in pairs_of(rows, items)}
    assert decontamination.contained(none, bench).count() == 0
    assert decontamination.contained(docs, bench.limit(0)).count() == 0


def test_contained_plan_is_native(spark, docs):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    plan = decontamination.contained(docs.select("doc_id", "text"), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_repeated_rows_count_as_one_document(spark, twice):
    bench = spark.createDataFrame([(1, "another text under this id another")], "item_id long, text string")
    rows = [tuple(r) for r in twice.collect()]
    got = {(r.doc_id, r.item_id) for r in decontamination.contained(twice, bench).collect()}
    assert got == set(pairs_of(rows, [(1, "another text under this id another")]))


def test_fingerprints(docs, rows):
    got = {r.doc_id: r for r in simhash.edit_report(docs).collect()}
    texts = [(d, t or "") for d, t in sorted(rows, reverse=True)]
    prints = dict(zip([d for d, _ in texts], simhash.fingerprints([t for _, t in texts]).tolist()))
    assert set(got) == set(prints)
    for k, (doc, text) in enumerate(texts):
        then = texts[(k + 1) % len(texts)]
        n = len(text) // 3
        changed = text[: len(text) - n] + then[1][:n]
        r, other = got[doc], int(simhash.fingerprints([changed])[0])
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (prints[doc], other)
        assert r.near_edited == 1 - (prints[doc] ^ other).bit_count() / 64
        assert r.near_next == 1 - (prints[doc] ^ prints[then[0]]).bit_count() / 64
    long = [r for r in got.values() if r.n_chars > 800]
    assert sum(r.near_edited for r in long) / len(long) > 0.65


def test_fingerprints_of_one_row_repeats_and_none(spark, twice, none):
    assert simhash.edit_report(none).count() == 0
    one = simhash.edit_report(spark.createDataFrame([(5, "alone here")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"alone halo").hexdigest() and one[0].near_next == 1
    by_text = {}
    rows = [tuple(r) for r in twice.collect()]
    got = simhash.edit_report(twice).collect()
    assert len(got) == len(rows)
    for doc, text in rows:
        by_text.setdefault(text or "", set()).update(r.fingerprint for r in got if r.doc_id == doc and r.n_chars == len(text or ""))
    assert all(len(v) == 1 for v in by_text.values())


def test_votes_by_hand():
    text = "a b a b c"
    prints = [int(simhash.fingerprints([t])[0]) for t in ("a b", "b a", "b c")]
    votes = [sum(w * (1 if p >> k & 1 else -1) for p, w in zip(prints, (2, 1, 1))) for k in range(64)]
    assert int(simhash.fingerprints([text])[0]) == sum(1 << k for k, v in enumerate(votes) if v > 0)


def test_all_fingerprints_within_a_radius(spark):
    rng = random.Random(11)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in list(values[:25]):
        for bits in range(1, 6):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in [*signed, None, signed[0]]], "fingerprint long")
    for radius in (1, 3):
        got = {(r.query, r.found, r.distance) for r in simhash.within_radius(frame.limit(30), frame, radius).collect()}
        asked = {r.fingerprint for r in frame.limit(30).collect()} - {None}
        want = {(a, b, ((a ^ b) & (2**64 - 1)).bit_count()) for a in asked for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
        assert got == want


def near_by_brute_force(report, asked):
    prints = [int(r.fingerprint, 16) for r in report]
    return {
        (r.doc_id, p): sum((p ^ q).bit_count() <= 3 for q in prints) - 1 if r.doc_id is not None and asked(r.doc_id) else None for r, p in zip(report, prints)
    }


@pytest.mark.parametrize("broadcast", [True, False])
def test_near_documents_of_a_whole_table(spark, docs, twice, none, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(simhash, "small", lambda df: df)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for frame in (docs, twice, given):
        report = simhash.edit_report(frame)
        got = simhash.near_counts(report, F.col("doc_id") % 5 == 0).collect()
        assert {(r.doc_id, int(r.fingerprint, 16)): r.near_docs for r in got} == near_by_brute_force(report.collect(), lambda d: d % 5 == 0)
        assert len(got) == frame.count()
    assert simhash.near_counts(simhash.edit_report(none), F.col("doc_id") % 5 == 0).count() == 0


def test_near_documents_under_one_hot_key(spark):
    # All values share their upper blocks, so most tables have one key for all rows.
    rng = random.Random(5)
    prints = [rng.getrandbits(64) >> 44 for _ in range(1500)]
    frame = spark.createDataFrame([(k, f"{p:016x}", "x") for k, p in enumerate(prints)], "doc_id long, fingerprint string, near string")
    got = simhash.near_counts(frame, F.col("doc_id") % 20 == 0).collect()
    assert {(r.doc_id, int(r.fingerprint, 16)): r.near_docs for r in got} == near_by_brute_force(frame.collect(), lambda d: d % 20 == 0)


def test_a_unit_is_the_same_however_it_is_read(docs, twice):
    for frame in (docs, twice):
        size = common.text_bytes(frame)
        read = []
        for parts in (1, 5):
            placed = common.with_units(frame.select("doc_id", "text").repartition(parts), 3 * common.UNIT + size)
            slices = {}
            for unit in {r.unit for r in placed.select("unit").distinct().collect()}:
                s = common.unit_slice(placed.where(F.col("unit") == unit).toArrow())
                slices[unit] = s.batch.column("doc_id").to_pylist(), s.data.tobytes(), s.offsets.tolist()
            read.append(slices)
        assert read[0] == read[1] and sum(len(ids) for ids, _, _ in read[0].values()) == frame.count()
        assert len(read[0]) > 1


def test_a_shared_passage_makes_no_candidates(spark, monkeypatch):
    """300 items and 400 documents share 14 words: no pair of them is counted, and real containment is found."""
    rng = random.Random(3)
    passage = " ".join(f"common{k}" for k in range(14))

    def own(n):
        return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))

    items = [(k, f"{own(20)} {passage} {own(20)}") for k in range(300)]
    docs = [(k, f"{own(100)} {passage} {own(50)}") for k in range(400)] + [(1000 + k, f"{own(30)} {items[k][1]} {own(30)}") for k in range(5)]
    seen, write = {}, decontamination.written
    monkeypatch.setattr(decontamination, "written", lambda df, name: seen.setdefault(name, write(df, name)) if name == "candidates" else write(df, name))
    found = decontamination.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.containment) for r in found.collect()) == [(1000 + k, k, 1.0) for k in range(5)]
    assert seen["candidates"].count() <= 10


def test_tiles_meet_all_pairs_of_near_sizes(spark):
    """Each pair of a block with different labels and near sizes meets in one tile, in some order of sides; few others do."""
    rng = random.Random(4)
    members = [(b, k, rng.choice([1, 2, 5, 20, 21, 24, 25, 26, 30, 100, 400]) + rng.randrange(3), rng.choice([-1, -1, -1, k % 5])) for b in range(3) for k in range(150)]
    monkey = jaccard_join.TILE
    jaccard_join.TILE = 8
    try:
        rows = jaccard_join._tiles(spark.createDataFrame(members, "block long, member long, size long, label long"), 80).collect()
    finally:
        jaccard_join.TILE = monkey
    tiles = {}
    for r in rows:
        tiles.setdefault((r.block, r.kind, r.i, r.j), []).append(r)
    met = {}
    for (block, *_), tile in tiles.items():
        assert len([r for r in tile if r.side == 0]) < 40
        for a in tile:
            for b in tile:
                if a.member < b.member and (a.side != b.side or a.side == 2) and a.label != b.label:
                    met[block, a.member, b.member] = met.get((block, a.member, b.member), 0) + 1
    assert set(met.values()) == {1}
    want = {(b, k, m) for b, k, s, x in members for c, m, t, y in members if b == c and k < m and x != y and 100 * min(s, t) >= 80 * max(s, t)}
    assert want <= set(met) and len(met) < 3 * len(want)


def test_tiles_travel_light_and_are_read_one_after_another(spark):
    """Count vectors take a byte for three shingles at most; tiles of any size come out of one stream, cut where the key changes, as brute force has it."""
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 2**63, 600, dtype=np.uint64) * np.uint64(2)) for _ in range(30)]
    sets = base + [np.unique(np.concatenate([s[:570], rng.integers(0, 2**63, 20, dtype=np.uint64)])) for s in base]
    counts = [jaccard_join.packed_counts(jaccard_join.count_vector(s)) for s in sets]
    assert all(3 * len(c) <= len(s) for c, s in zip(counts, sets))
    tiles = [(block, m, m % 7, 2) for block in range(40) for m in rng.permutation(60)[: 2 + block].tolist()]
    rows = spark.createDataFrame(tiles, "block long, member long, label long, side int").repartition(3)
    vectors = spark.createDataFrame(list(enumerate(map(bytearray, counts))), "member long, counts binary")
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # tiles span batches
    try:
        pairs = jaccard_join._candidates(rows, ["block"], vectors, 80)
        plan = pairs._jdf.queryExecution().toString()
        got = {(r.a, r.b) for r in pairs.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    met = {(a, b) for x, a, p, _ in tiles for y, b, q, _ in tiles if x == y and a < b and p != q}
    true = {(a, b) for a, b in met if jaccard_join.similar(sets[a], sets[b], 80)}
    assert len(true) > 5 and true <= got <= met and len(got) < 2 * len(true)
    assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan


def test_sorting_suffixes_holds_the_strings_of_one_first_byte():
    """30,000 sort keys of 2,000 bytes would be 60 MB at once; the order is that of plain sorting."""
    import tracemalloc

    data = np.random.default_rng(9).integers(97, 123, 60_000).astype(np.uint8)
    tracemalloc.start()
    order = suffix_dedup.suffix_order(data, 2000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    raw = data.tobytes()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i : i + 2000])
    assert most < 20e6
