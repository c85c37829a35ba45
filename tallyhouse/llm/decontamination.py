"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

A test item is its distinct shingles of five words (an item of fewer words is one
shingle of all its words). Items are partitioned by size, in powers of two, and
each partition has its own sketch length: `size - ceil(0.8 size) + 1` for the partition's
largest size. A sketch holds that many of the item's shingles, those of fewest items first and
of smallest hash among these. A document that holds 80 % of an item's shingles misses at
most `size - ceil(0.8 size)` of them, in the sketch too: one that holds fewer of the sketch than
its length less that is no candidate, and no containing document is lost. Documents, long and unsketched, probe
the sketches with all their shingles; candidates are read again, and the
shared shingles are counted exactly, as words. So a passage that many items and documents
share, and that is a small part of each item, makes no candidates.

Sketches, items and ids of documents are broadcast only where their counted rows
are below `broadcast_limit`; beyond it Spark joins them by shuffle.

Defined cases: null or empty texts and items hold no shingle and match nothing; an
item text that repeats under an item_id counts once, different texts under one
item_id are searched apart and the best one is reported; rows that share a doc_id
count as one document; rows without doc_id are not reported; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_ROWS, small, written

SHINGLE = 5
BROADCAST_BYTES = 64 << 20  # of shingle texts
PATTERN = r"([^\x20\x09-\x0D]+)"


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(PATTERN), F.lit(1))


def _hashes(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words."""
    runs = F.sequence(F.lit(0), F.size(words) - size)
    return F.when(F.size(words) >= size, F.transform(runs, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])))


def _texts(words: Column, size: Column | int) -> Column:
    """The runs themselves, distinct."""
    runs = F.sequence(F.lit(1), F.size(words) - F.lit(size) + 1)
    return F.array_distinct(F.transform(runs, lambda i: F.array_join(F.slice(words, i, F.lit(size)), " ")))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def needed(size: Column) -> Column:
    """Shared shingles that make 80 % of `size`."""
    return F.ceil(size * 8 / 10).cast("long")


def item_sketches(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items (item, item_id, words, width, size) and their sketches (item, hash; least: how many of them a candidate holds)."""
    read = items.where("item_id is not null").select("item_id", _words("text").alias("words")).distinct().where(F.size("words") > 0)
    read = read.withColumns({"item": F.xxhash64("item_id", "words"), "width": F.least(F.lit(SHINGLE), F.size("words"))})
    by_width = [
        read.where(F.col("width") == n).withColumn("hashes", F.array_distinct(_hashes(_word_hashes(F.col("words")), n)))
        for n in range(1, SHINGLE + 1)
    ]
    whole = reduce(DataFrame.unionByName, by_width).withColumn("size", F.size("hashes"))
    largest = (F.pow(F.lit(2), F.floor(F.log2("size")) + 1) - 1).cast("long")  # of the item's size partition
    length = F.least(largest - needed(largest) + 1, F.col("size")).cast("int")
    each = whole.select("item", "size", length.alias("length"), F.explode("hashes").alias("hash"))
    held = each.join(each.groupBy("hash").agg(F.count("*").alias("items")), "hash")
    gathered = held.groupBy("item", "size", "length").agg(F.sort_array(F.collect_list(F.struct("items", "hash"))).alias("all"))  # shingles of one item
    least = F.col("length") - (F.col("size") - needed(F.col("size")))
    sketches = gathered.select("item", least.cast("int").alias("least"), F.explode(F.slice(F.transform("all", lambda s: s["hash"]), F.lit(1), F.col("length"))).alias("hash"))
    return whole.drop("hashes"), sketches


def contained(docs: DataFrame, items: DataFrame, broadcast_limit: int = BROADCAST_ROWS) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_shared, containment) with at least 80 % of the item's shingles in the document."""
    whole, sketches = (written(df, "items") for df in item_sketches(items))
    widths = sorted(r.width for r in whole.select("width").distinct().collect())  # at most five numbers
    if not widths:
        none = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"
        return docs.sparkSession.createDataFrame([], none)
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    probes = docs.select("doc_id", _word_hashes(_words("text")).alias("words"))
    probes = reduce(DataFrame.unionByName, [probes.select("doc_id", F.explode(F.array_distinct(_hashes(F.col("words"), n))).alias("hash")) for n in widths])
    hits = probes.join(small(sketches.select("item", "least", "hash").distinct(), broadcast_limit), "hash")
    # Rows that share a doc_id are one document: at worst they make a candidate more.
    candidates = hits.groupBy("doc_id", "item", "least").agg(F.count("*").alias("n")).where(F.col("n") >= F.col("least")).select("doc_id", "item")
    candidates = written(candidates, "candidates")

    runs = whole.select("item", "item_id", "size", "width", F.explode(_texts(F.col("words"), F.col("width"))).alias("run"))
    held = docs.join(small(candidates.select("doc_id").distinct(), broadcast_limit), "doc_id", "left_semi").select("doc_id", _words("text").alias("words"))
    held = reduce(
        DataFrame.unionByName, [held.where(F.size("words") >= n).select("doc_id", F.lit(n).alias("width"), F.explode(_texts(F.col("words"), n)).alias("run")) for n in widths]
    )
    room = runs.agg(F.coalesce(F.sum(F.octet_length("run")), F.lit(0)).alias("bytes")).first()["bytes"]
    runs = small(runs, broadcast_limit) if room <= BROADCAST_BYTES else runs
    shared = held.join(runs, ["width", "run"]).select("doc_id", "item", "item_id", "size", "run").distinct()
    counted = shared.groupBy("doc_id", "item", "item_id", "size").agg(F.count("*").alias("n_shared"))
    exact = counted.where(F.col("n_shared") >= needed(F.col("size"))).join(candidates, ["doc_id", "item"], "left_semi")
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("size")).alias("containment"), "size", "n_shared")).alias("best"))
    return best.select(
        "doc_id", "item_id", F.col("best.size").cast("long").alias("n_shingles"), F.col("best.n_shared").alias("n_shared"), F.col("best.containment").alias("containment")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that contain an item; rows without doc_id stay."""
    found = written(contained(docs, items).select("doc_id").distinct(), "contaminated")
    return docs.join(small(found), "doc_id", "left_anti").select(*docs.columns)


SQL = r"""
WITH items AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), sized AS (
  SELECT item_id, w, least(5, len(w)) AS k FROM items WHERE len(w) > 0
), item_runs AS (
  SELECT DISTINCT item_id, w, k, array_to_string(w[i:i + k - 1], ' ') AS run FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY item_id, w) AS size FROM item_runs
), docs AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), doc_runs AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS run
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM sized) AS widths WHERE len(w) >= k)
), shared AS (
  SELECT doc_id, item_id, c.w, size, count(*) AS n FROM doc_runs JOIN counted c USING (k, run) GROUP BY ALL
), best AS (
  SELECT doc_id, item_id, max({'containment': n / size, 'size': size, 'n': n}) AS best FROM shared WHERE 10 * n >= 8 * size GROUP BY ALL
)
SELECT doc_id, item_id, best.size AS n_shingles, best.n AS n_shared, best.containment AS containment FROM best
"""
