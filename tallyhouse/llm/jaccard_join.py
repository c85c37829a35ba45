"""N-gram Jaccard join by count vectors in packed R-trees.

A document's set is its distinct shingles of five words. The shingles of a set are
hashed into groups; the counts are a point, and the sum over groups of the smaller
count bounds the overlap of two sets from above. An R-tree packs the points
of a block in order of size and coordinates; pairs of nodes, and then of points,
whose bound is below what the wanted similarity needs are left out, and the
surviving pairs are verified on the sets themselves.

Which sets meet in a block: two similar sets share a shingle among the first
`n - ceil(0.8 n) + 1` of each in any common order. The order used puts shingles that
many units repeat last, by a count over all documents; it decides how large blocks
are, not what is found. Equal sets are one class from the start and travel once a unit.

1. Each shared prefix shingle is a block. Every member is compared with the block's
   smallest member, and where it stays apart with the member that shares most: linear
   work however large the block. The links found are merged.
2. Blocks whose members are by now in one component are done. The others are compared
   in tiles of bounded size, without pairs already in one component and without pairs
   whose sizes are too far apart.
In both, R-trees over the count vectors of a tile name the pairs; only for those do
the sets themselves travel.

Defined cases: a null text, or one without words, has an empty set and is linked with
nothing; a text of fewer than five words is one shingle of all its words; repeated
rows and equal sets share a component; rows without doc_id are left out; other
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import (
    SLICE, U64, Slice, batch_of, buckets, cuts, drop_scratch, free_shuffles, mix, packed_ints, packed_keys, packed_sorted, scratch_mark, shingles, small, units,
    unpacked, unpacked_ints, unpacked_sorted, words, written, written_small,
)
from .components import components

GROUPS = 64  # of the tree; larger sets have more, folded to these there
FINE = 512  # groups beyond which a set has half as many
NODE = 16  # points of a leaf
TILE = 128  # sets on one side of a tile
UNIT = 2 << 20  # bytes of text whose sets are in memory at a time
DROPPED = U64(16)  # low bits that travelling sets leave out: 48 are kept, and five bytes a shingle instead of eight
FREQUENT = 200_000  # shingles that are put last; only an order


def sets_of(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Row and shingle of each distinct shingle, by row, in no order within a row."""
    row, _, _, word = words(s)
    row, found = shingles(row, word)
    pair = mix(found + row.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(pair)
    new = np.ones(len(row), dtype=bool)
    new[1:] = pair[order][1:] != pair[order][:-1]
    kept = np.sort(order[new])
    return row[kept], found[kept]


def _identity(row: np.ndarray, found: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes and two 64-bit sums that identify each row's set."""
    bounds = np.searchsorted(row, np.arange(rows + 1))
    one, two = np.zeros(len(found) + 1, dtype=U64), np.zeros(len(found) + 1, dtype=U64)
    np.cumsum(mix(found + U64(0x51)), out=one[1:])
    np.cumsum(mix(found ^ U64(0xA5A5A5A5A5A5A5A5)), out=two[1:])
    return np.diff(bounds), mix(one[bounds[1:]] - one[bounds[:-1]]), two[bounds[1:]] - two[bounds[:-1]]


def _described(docs: DataFrame, n: int) -> DataFrame:
    """Two kinds of rows from one reading: documents (doc_id, size and identity (a, b) of the set; no bucket), and shingles that repeat in a unit."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("size", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in units(batches, budget=UNIT):
            row, found = sets_of(s)
            size, a, b = _identity(row, found, len(s))
            none = [None] * len(s)
            yield batch_of(schema, s.batch.column("doc_id"), size, a.view(np.int64), b.view(np.int64), none, none, none)
            found = np.sort(found)
            head = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, dtype=np.int64)
            count = np.diff(np.append(head, len(found)))
            many = count > 1
            keys, count = found[head[many]], count[many]
            at = cuts(keys, n)
            rows = [k for k in range(n) if at[k] < at[k + 1]]
            none = [None] * len(rows)
            parts = [[pack(v[at[k] : at[k + 1]]) for k in rows] for v, pack in ((keys, packed_sorted), (count, packed_ints))]
            yield batch_of(schema, none, none, none, none, rows, *parts)

    return docs.mapInArrow(run, "doc_id long, size long, a long, b long, bucket int, keys binary, counts binary")


def _frequent(repeats: DataFrame) -> np.ndarray:
    """Shingles that most often repeat inside units, most frequent last; counted over all documents."""
    out = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])

    def total(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpacked_sorted(x) for x in table.column("keys").to_pylist()])
        counts = np.concatenate([unpacked_ints(x) for x in table.column("counts").to_pylist()])
        value, place = np.unique(keys, return_inverse=True)
        return pa.Table.from_arrays([pa.array(value.view(np.int64)), pa.array(np.bincount(place, weights=counts).astype(np.int64))], schema=out)

    counted = repeats.select("bucket", "keys", "counts").groupBy("bucket").applyInArrow(total, "shingle long, n long")
    top = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).collect()
    return np.array([r.shingle for r in reversed(top)], dtype=np.int64).view(U64)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    return size - (-(-size * percent // 100)) + 1


def _prefixes(s: Slice, last: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix shingles of the distinct sets of a unit, with the sizes and identities of their sets."""
    row, found = sets_of(s)
    size, a, _ = _identity(row, found, len(s))
    place = found >> U64(1)
    if len(last):
        at = np.minimum(np.searchsorted(last, found), len(last) - 1)
        late = np.flatnonzero(last[at] == found)
        place[late] = (U64(1) << U64(63)) + rank[at[late]].astype(U64)
    filled = np.flatnonzero(size > 0)
    bounds = np.searchsorted(row, np.arange(len(s) + 1))
    kept = [np.zeros(0, dtype=np.int64)]
    for k in filled[np.unique(a[filled], return_index=True)[1]].tolist():
        i, j, n = int(bounds[k]), int(bounds[k + 1]), int(prefix_length(size[k], percent))
        kept.append(i + np.argpartition(place[i:j], n - 1)[:n])
    keep = np.concatenate(kept)
    return found[keep], size[row[keep]], a[row[keep]]


def _blocks(docs: DataFrame, n: int, last: np.ndarray, percent: int) -> DataFrame:
    """Rows (block, member, size, pivot, the pivot's size, number and mark of all members) of prefix shingles shared by several sets."""
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("members", pa.binary())])
    out = pa.schema([("block", pa.int64()), ("member", pa.int64()), ("size", pa.int64()), ("pivot", pa.int64()), ("other", pa.int64()), ("members", pa.int64()), ("mark", pa.int64())])
    by = np.argsort(last)
    last, rank = last[by], by

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in units(batches, budget=UNIT):
            keys, size, member = _prefixes(s, last, rank, percent)
            order = np.argsort(keys, kind="stable")
            keys, size, member = keys[order], size[order], member[order]
            at = cuts(keys, n)
            rows = [k for k in range(n) if at[k] < at[k + 1]]
            parts = [[pack(v[at[k] : at[k + 1]]) for k in rows] for v, pack in ((keys, packed_sorted), (size, packed_ints), (member, packed_keys))]
            yield batch_of(schema, rows, *parts)

    def shared(table: pa.Table) -> pa.Table:
        keys, size, member = (
            np.concatenate([read(x) for x in table.column(c).to_pylist()]) for c, read in (("keys", unpacked_sorted), ("sizes", unpacked_ints), ("members", unpacked))
        )
        value, count = np.unique(keys, return_counts=True)
        often = value[count > 1]
        at = np.searchsorted(often, keys)
        hit = often[np.minimum(at, len(often) - 1)] == keys if len(often) else np.zeros(len(keys), dtype=bool)
        keys, member, size = keys[hit], member[hit], size[hit]
        order = np.lexsort((member, keys))
        keys, member, size = keys[order], member[order], size[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (member[1:] != member[:-1])
        keys, member, size = keys[new], member[new], size[new]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(head, len(keys)))
        head, count = head[count > 1], count[count > 1]
        # Blocks with the same members ask the same question.
        sums = np.concatenate([[U64(0)], np.cumsum(mix(member))]).astype(U64)
        mark, pick = np.unique(sums[head + count] - sums[head], return_index=True)
        head, count = head[pick], count[pick]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        where = np.repeat(head, count) + inner
        as_long = lambda v: np.ascontiguousarray(v).view(np.int64)
        return pa.Table.from_arrays(
            [
                as_long(np.repeat(keys[head], count)), as_long(member[where]), size[where].astype(np.int64), as_long(np.repeat(member[head], count)),
                np.repeat(size[head], count).astype(np.int64), np.repeat(count, count), as_long(np.repeat(mark, count)),
            ],
            schema=out,
        )

    sent = docs.select("doc_id", "text").mapInArrow(run, "bucket int, keys binary, sizes binary, members binary")
    return sent.groupBy("bucket").applyInArrow(shared, "block long, member long, size long, pivot long, other long, members long, mark long")


def groups_of(size: int) -> int:
    """Groups for a set: a power of two, one or two to a shingle; half of that above FINE groups, where the bound varies less.
    Fewer could not tell a similarity of 0.75 from one of 0.8."""
    full = max(GROUPS, 1 << max(0, (size - 1).bit_length()))
    return max(min(full, FINE), full // 2)


def count_vector(shingle_set: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by group; groups are ranges of the hash, so that neighbours can be folded."""
    n = groups_of(len(shingle_set))
    return np.bincount((shingle_set >> U64(64 - (n.bit_length() - 1))).astype(np.int64), minlength=n)


def packed_counts(vector: np.ndarray) -> bytes:
    """Counts by their Huffman code: most are 0, 1 or 2, and a vector travels once a tile."""
    coder = zlib.compressobj(level=1, wbits=-15, strategy=zlib.Z_HUFFMAN_ONLY)
    return coder.compress(packed_ints(vector)) + coder.flush()


def unpacked_counts(raw: bytes) -> np.ndarray:
    return unpacked_ints(zlib.decompress(raw, wbits=-15)).astype(np.int64)


def folded(vector: np.ndarray, n: int) -> np.ndarray:
    return vector if len(vector) == n else vector.reshape(n, -1).sum(axis=1)


def may_reach(bound, sizes, percent: int):
    """Whether an overlap of `bound` allows Jaccard >= percent / 100 for sets whose sizes add up to `sizes`."""
    return bound * (100 + percent) >= percent * sizes


class RTree:
    """Packed R-tree over count vectors: levels of (smallest, largest coordinates, smallest size), NODE children a node."""

    def __init__(self, points: np.ndarray):
        sizes = points.sum(axis=1)
        self.order = np.lexsort((*points.T[::-1], sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > 1:
            high, small, large = self.levels[-1]
            at = np.arange(0, len(high), NODE)
            self.levels.append((np.maximum.reduceat(high, at, axis=0), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)))

    def near(self, point: np.ndarray, percent: int) -> np.ndarray:
        """Places, in the given order of points, whose overlap with `point` may reach the similarity."""
        size = int(point.sum())
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            high, small, large = (v[at] for v in self.levels[level])
            bound = np.minimum(high, point).sum(axis=1)
            fits = may_reach(bound, size + small, percent) & (100 * large >= percent * size) & (100 * size >= percent * small)
            at = at[fits]
            if level:
                at = (at[:, None] * NODE + np.arange(NODE)).ravel()
                at = at[at < len(self.levels[level - 1][0])]
        return self.order[at]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have at least `percent` % Jaccard similarity."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def near_pairs(labels: list[int], sides: list[int], vectors: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Places of pairs whose counts allow the similarity. Sides: 0 and 1 are compared with each other, 2 with all; equal labels are not."""
    points = np.stack([folded(v, GROUPS) for v in vectors])
    tree, sizes, pairs = RTree(points), points.sum(axis=1), []
    label, side, length = np.array(labels), np.array(sides), np.array([len(v) for v in vectors])
    finer: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # vectors of at least n groups, folded to n, and their places there

    def fine(n: int) -> tuple[np.ndarray, np.ndarray]:
        if n not in finer:
            having = length >= n
            finer[n] = np.stack([folded(vectors[i], n) for i in np.flatnonzero(having).tolist()]), np.cumsum(having) - 1
        return finer[n]

    for k in np.flatnonzero(side != 1).tolist():
        others = tree.near(points[k], percent)
        others = others[(label[others] != label[k]) & ((side[others] != side[k]) | ((side[k] == 2) & (others > k)))]
        groups = np.minimum(length[others], length[k])
        for n in np.unique(groups).tolist():
            some = others[groups == n]
            if n > GROUPS:
                all_, at = fine(n)
                bound = np.minimum(all_[at[some]], all_[at[k]]).sum(axis=1)
                some = some[may_reach(bound, sizes[k] + sizes[some], percent)]
            pairs += [(k, other) for other in some.tolist()]
    return pairs


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _candidates(tiles: DataFrame, keys: list[str], sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of the rows (keys, member, label, side) of each tile that the count vectors let through."""

    def found(rows: list[tuple]) -> list[tuple[int, int]]:
        members, labels, sides, counts = zip(*rows)
        if len(set(labels)) < 2:
            return []
        pairs = near_pairs(labels, sides, [unpacked_counts(c) for c in counts], percent)
        return [(min(members[i], members[j]), max(members[i], members[j])) for i, j in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, []
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in (*keys, "member", "label", "side", "counts")]
            for name, row in zip(zip(*columns[: len(keys)]), zip(*columns[len(keys) :])):
                if name != tile:
                    pairs += found(rows) if rows else []
                    tile, rows = name, []
                rows.append(row)
            yield batch_of(_PAIR, [x for x, _ in pairs], [y for _, y in pairs])
        if rows:
            pairs = found(rows)
            yield batch_of(_PAIR, [x for x, _ in pairs], [y for _, y in pairs])

    # Most tiles are tiny, so they are read one after another instead of being sent to a worker one by one.
    rows = tiles.join(sets.select("member", "counts"), "member").select(*keys, "member", "label", "side", "counts")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar. A set and up to about TILE others meet in one place."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["a", "member", "shingles"]).to_pylist()
        head = next(unpacked_sorted(r["shingles"]) for r in rows if r["member"] == r["a"])
        found = [r["member"] for r in rows if r["member"] != r["a"] and similar(unpacked_sorted(r["shingles"]), head, percent)]
        return pa.Table.from_arrays([pa.array([rows[0]["a"]] * len(found), pa.int64()), pa.array(found, pa.int64())], schema=_PAIR)

    counted = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "pair-counts")
    pairs = pairs.join(counted, "a").select("a", F.pmod(F.xxhash64("b"), "tiles").cast("int").alias("tile"), F.col("b").alias("member"))
    heads = pairs.select("a", "tile").distinct().withColumn("member", F.col("a"))
    rows = written(pairs.unionByName(heads), "pair-tiles")
    asked = sets.select("member", "shingles").join(small(rows.select("member").distinct()), "member", "left_semi")
    return rows.join(asked, "member").groupBy("a", "tile").applyInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(member, sorted shingles, counts by group) of the documents named in `wanted` (doc_id, member)."""
    schema = pa.schema([("member", pa.int64()), ("shingles", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in units(batches, budget=SLICE):
            row, found = sets_of(s)
            at = np.searchsorted(row, np.arange(len(s) + 1)).tolist()
            name = _identity(row, found, len(s))[1].view(np.int64).tolist()
            # Rows may share a doc_id: only the text that has the wanted set counts.
            kept = [(m, np.sort(found[i:j])) for m, k, i, j in zip(s.batch.column("member").to_pylist(), name, at, at[1:]) if m == k]
            sets = [x for _, x in kept]
            yield batch_of(schema, [m for m, _ in kept], [packed_sorted(x >> DROPPED) for x in sets], [packed_counts(count_vector(x)) for x in sets])

    texts = docs.select("doc_id", "text").join(small(wanted), "doc_id").select("member", "text")
    return texts.mapInArrow(run, "member long, shingles binary, counts binary")


def _against(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the counts let through among (pivot, member, members), in tiles of a pivot and some TILE members."""
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    dealt = pairs.select("pivot", "member", tiles.alias("tiles")).select(
        "pivot", "tiles", F.pmod(F.xxhash64("member"), "tiles").cast("int").alias("tile"), "member", F.lit(1).alias("side")
    )
    heads = dealt.select("pivot", "tiles", "tile").distinct().select("pivot", "tiles", "tile", F.col("pivot").alias("member"), F.lit(0).alias("side"))
    rows = dealt.unionByName(heads).withColumn("label", F.col("member"))
    return _candidates(rows, ["pivot", "tiles", "tile"], sets, percent)


def _labels(links: DataFrame) -> DataFrame:
    return written(components(links), "labels").select(F.col("node").alias("member"), "label")


def _apart(met: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs (pivot, member) of different components."""
    of_pivot = label.select(F.col("member").alias("pivot"), F.col("label").alias("pivot_label"))
    both = met.join(label, "member", "left").join(of_pivot, "pivot", "left")
    return both.where(F.coalesce("label", "member") != F.coalesce("pivot_label", "pivot")).select("pivot", "member")


def _tiles(blocks: DataFrame, percent: int) -> DataFrame:
    """Rows (block, kind, i, j, member, label, side) of tiles that bring those members of a block together that differ in label and may be similar by size.

    Sizes fall into classes whose bounds grow by the largest ratio of similar sets, so a
    member meets its own class and the next one only. In a class the members of the block's most frequent
    label (main) and the others are dealt to parts: others meet all of both classes, main members meet others.
    """
    width = math.log(100 / percent) if percent < 100 else 1e-9
    sized = blocks.withColumn("class", F.floor(F.log(F.col("size").cast("double")) / F.lit(width)).cast("int"))
    counts = blocks.groupBy("block", "label").agg(F.count("*").alias("n"))
    main = written(counts.groupBy("block").agg(F.max_by("label", F.struct("n", "label")).alias("main")), "block-mains")
    rows = sized.join(main, "block").withColumn("is_main", F.col("label") == F.col("main"))
    parts = lambda n: F.ceil(n / TILE).cast("int")
    per = rows.groupBy("block", "class").agg(parts(F.count_if("is_main")).alias("m"), parts(F.count_if(~F.col("is_main"))).alias("o"))
    along = Window.partitionBy("block").orderBy("class")  # classes of one block: as many as the logarithm of the largest size

    def beside(step: int, c: str) -> Column:
        found = F.lead if step > 0 else F.lag
        return F.coalesce(F.when(found("class").over(along) == F.col("class") + step, found(c).over(along)), F.lit(0))

    per = per.select("block", "class", "m", "o", beside(1, "m").alias("m_up"), beside(1, "o").alias("o_up"), beside(-1, "m").alias("m_down"), beside(-1, "o").alias("o_down"))
    per = written(per, "block-parts")
    rows = rows.join(per, ["block", "class"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("member"), F.when(F.col("is_main"), F.col("m")).otherwise(F.col("o"))).cast("int"))

    def met(kind: int, shift: int, others: str, first: bool) -> Column:
        """Tiles of the own part with each of the others' parts; the own part is the first side or the second."""
        own, at = F.col("own"), (F.col("class") + shift) * 8 + kind
        each = F.transform(F.sequence(F.lit(0), F.col(others) - 1), lambda k: F.struct(
            at.alias("kind"), (own if first else k).alias("i"), (k if first else own).alias("j"), F.lit(0 if first else 1).alias("side")
        ))
        return F.when(F.col(others) > 0, each).otherwise(F.array().cast("array<struct<kind: int, i: int, j: int, side: int>>"))

    among = F.transform(F.sequence(F.lit(0), F.col("o") - 1), lambda k: F.struct(
        (F.col("class") * 8).alias("kind"), F.least("own", k).alias("i"), F.greatest("own", k).alias("j"),
        F.when(F.col("own") == k, 2).when(F.col("own") > k, 1).otherwise(0).alias("side"),
    ))
    of_main = F.concat(met(1, 0, "o", True), met(2, 0, "o_up", True), met(3, -1, "o_down", False))
    of_others = F.concat(among, met(1, 0, "m", False), met(2, -1, "m_down", False), met(3, 0, "m_up", True), met(4, 0, "o_up", True), met(4, -1, "o_down", False))
    return rows.select("block", "member", "label", F.explode(F.when(F.col("is_main"), of_main).otherwise(of_others)).alias("t")).select("block", "t.*", "member", "label")


def joined(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per document of `docs` (doc_id, text): doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    n = buckets(docs.sparkSession)
    spark = docs.sparkSession
    read = written_small(_described(docs, n), "sets")
    known = read.where("bucket is null").select("doc_id", "size", "a", "b")
    # A set's class: its smallest document. Its name on the way is the first half of its identity.
    classes = known.where("size > 0").groupBy("a", "b").agg(F.min("doc_id").alias("doc_id"))
    named = written(classes.groupBy("a").agg(F.min("doc_id").alias("doc_id")).select(F.col("a").alias("member"), "doc_id"), "classes")
    begun = scratch_mark()
    blocks = written_small(_blocks(docs, n, _frequent(read.where("bucket is not null")), percent), "all-blocks")
    # Blocks with the same members, wherever their shingles were gathered, are one.
    one = written(blocks.groupBy("mark", "members").agg(F.min("block").alias("block")).select("block"), "one-of-equal")
    ended = scratch_mark()
    blocks = written_small(blocks.join(one, "block", "left_semi").drop("mark"), "blocks")
    drop_scratch(spark, begun, ended)
    free_shuffles(spark)

    fits = "100 * least(size, other) >= {0} * greatest(size, other)".format(percent)
    first = blocks.where("member <> pivot").where(fits).groupBy("pivot", "member").agg(F.max("members").alias("members"))
    first = written(first, "first-pairs")
    needed = first.select("member").union(first.select("pivot")).union(blocks.where("members > 2").select("member")).distinct()
    sets = written_small(_sets(docs, written(named.join(needed, "member"), "wanted")), "shingles")
    free_shuffles(spark)

    # Every member against the smallest of its block.
    pairs = written(_against(first, sets, percent), "pairs")
    found = written(_verified(pairs, sets, percent), "links")
    free_shuffles(spark)
    label = _labels(found)

    # Those that are still apart, against the member of theirs that shares most: copies gather around what they were copied from.
    large = blocks.where("members > 2")
    met = written(large.where("member <> pivot").select("pivot", "member").distinct(), "met")
    apart = written(_apart(met, label), "apart")
    shared = blocks.groupBy("member").agg(F.sum("members").alias("shared"))
    hubs = met.join(apart.select("pivot").distinct(), "pivot", "left_semi").join(shared, "member").groupBy("pivot").agg(
        F.max_by("member", F.struct("shared", "member")).alias("hub"), F.count("*").alias("members")
    )
    ends = apart.unionByName(apart.select("pivot", F.col("pivot").alias("member")).distinct())
    second = ends.join(written(hubs, "hubs"), "pivot").where("member <> hub").groupBy(F.col("hub").alias("pivot"), "member").agg(F.max("members").alias("members"))
    second = _against(written(second, "second-pairs"), sets, percent).join(pairs, ["a", "b"], "left_anti")
    second = written(second, "hub-pairs")
    pairs = written(pairs.unionByName(second), "both-pairs")
    found = written(found.unionByName(_verified(second, sets, percent)), "both-links")
    free_shuffles(spark)
    label = _labels(found)

    # Blocks that still hold several components, whole: some member is not with its pivot.
    apart = written(_apart(met, label), "still-apart")
    several = written(large.join(apart, ["pivot", "member"], "left_semi").select("block").distinct(), "several")
    open_ = large.join(several, "block", "left_semi").join(label, "member", "left")
    open_ = written(open_.select("block", "member", "size", F.coalesce("label", "member").alias("label")), "open-blocks")
    rest = _tiles(open_, percent)
    # Pairs that were verified before are not verified again.
    more = written(_candidates(rest, ["block", "kind", "i", "j"], sets, percent), "more-pairs").join(pairs, ["a", "b"], "left_anti")
    free_shuffles(spark)
    links = written(found.unionByName(_verified(written(more, "new-pairs"), sets, percent)), "all-links")
    free_shuffles(spark)

    # Names back to documents: equal sets and links between sets.
    first_of = named.select(F.col("member").alias("a"), F.col("doc_id").alias("x"))
    second_of = named.select(F.col("member").alias("b"), F.col("doc_id").alias("y"))
    between = links.join(first_of, "a").join(second_of, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = components(between).select(F.col("node").alias("class_id"), "label")
    rows = known.join(named.select(F.col("member").alias("a"), F.col("doc_id").alias("class_id")), "a", "left").join(merged, "class_id", "left")
    component = F.when(F.col("size") > 0, F.coalesce("label", "class_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Rows of `docs` (all columns) without near copies: of each component the smallest doc_id stays.

    Rows that share a doc_id are one document; of equal texts among them one stays.
    Rows without doc_id or words stay.
    """
    found = joined(docs, percent)
    kept = F.max((F.col("doc_id") == F.col("component_id")).cast("int"))
    ids = written(found.groupBy("doc_id").agg(kept.alias("kept"), F.count("*").alias("rows")), "kept-ids")
    stay = docs.join(small(ids.where("kept = 0").select("doc_id")), "doc_id", "left_anti")
    repeated = ids.where("kept = 1 and rows > 1").select("doc_id")
    if repeated.isEmpty():
        return stay.select(*docs.columns)
    once = stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS src, doc_id AS dst FROM documents UNION SELECT src, b FROM reach JOIN links ON a = dst
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT src AS doc_id, min(dst) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""
