"""Name matching by equi-joins on keys cut from the names.

A name inside another is asked by its rarest piece of GRAM letters, which few names hold;
names whose pieces are all frequent are asked as a whole. Either way what is cut from the
other side passes a table of fixed size first (counts or bits by hash), so only pieces that somebody
asks for are shuffled. The word score looks for the best offer through rare
words, and through sets of frequent ones; see `word_scored`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .skew import hot_join


def _substrings(c: Column, n: Column) -> Column:
    """Distinct substrings of length `n`."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(c, i, n)))


def _head(c: Column, n: Column) -> Column:
    """The start of length `n`."""
    return F.array(F.left(c, n))


def _pieces(names: DataFrame, others: DataFrame, cut) -> DataFrame:
    """Pieces of `names` as column `piece`, of the lengths that occur in `others`:
    a piece of any other length equals no name there."""
    lengths = others.agg(F.collect_set(F.length("name"))).scalar()
    sized = names.withColumn("_n", F.explode(lengths)).filter(F.col("_n") <= F.length("name"))
    return sized.withColumn("piece", F.explode(cut(F.col("name"), F.col("_n")))).drop("_n")


def prefixes(c: Column, min_len: int = 1) -> Column:
    cuts = F.transform(F.sequence(F.lit(min_len), F.length(c)), lambda n: F.left(c, n))
    return F.when(F.length(c) >= min_len, cuts)


GRAM = 4  # letters of an index piece
SLOTS = 1 << 16  # hash slots of the counts of pieces
BITS = 1 << 20  # hash bits of whole names
COMMON = 1000  # names that hold a piece, beyond which it is no way to find a few


def _slot(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")


def rarest_pieces(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    """Rows of `narrow` with the piece that fewest names of `wide` hold, and how many (at most; by slots).

    Names that hold a piece no wide name has are left out. Counts travel as one number for each of SLOTS slots.
    """
    held = wide.select(F.explode(_substrings(F.col("name"), F.lit(GRAM))).alias("gram")).groupBy(_slot(F.col("gram")).alias("slot")).agg(F.count("*").alias("n"))
    cut = narrow.filter(F.length("name") >= GRAM).select("*", F.explode(_substrings(F.col("name"), F.lit(GRAM))).alias("gram"))
    counted = cut.withColumn("slot", _slot(F.col("gram"))).join(F.broadcast(held), "slot", "left")
    found = counted.groupBy(*narrow.columns).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    return found.select(*narrow.columns, "r.n", "r.gram").filter("n > 0")


def _among(pieces: DataFrame, names: DataFrame) -> DataFrame:
    """Pieces whose bit is set by a name: a few of the others stay, none that is a name goes."""
    bit = F.pmod(F.xxhash64("name"), F.lit(BITS))
    words = names.groupBy(F.floor(bit / 64).cast("int").alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("_bits"))
    mine = F.pmod(F.xxhash64("piece"), F.lit(BITS))
    placed = pieces.withColumns({"_word": F.floor(mine / 64).cast("int"), "_bit": (mine % 64).cast("int")})
    return placed.join(F.broadcast(words), "_word").filter(F.getbit("_bits", F.col("_bit")) == 1).drop("_word", "_bit", "_bits")


def index_rows(narrow: DataFrame, wide: DataFrame, common: int = COMMON) -> tuple[DataFrame, DataFrame | None]:
    """Rows of `wide` with each row of `narrow` whose name theirs contains, as `piece`: those found by a rare piece, and those of names without one.

    Nothing for the latter if every name has a rare piece.
    """
    others = [c for c in narrow.columns if c != "name"]
    rarest = cut_lineage(rarest_pieces(narrow, wide))
    rare = rarest.filter(F.col("n") <= common).select(F.col("name").alias("piece"), *others, "gram")
    asked_slots = rare.select(_slot(F.col("gram")).alias("slot")).distinct()
    postings = wide.withColumn("gram", F.explode(_substrings(F.col("name"), F.lit(GRAM)))).withColumn("slot", _slot(F.col("gram")))
    postings = postings.join(F.broadcast(asked_slots), "slot", "left_semi").drop("slot")
    by_rare = postings.join(rare, "gram").filter(F.contains("name", "piece")).drop("gram")
    short = narrow.filter(F.length("name") < GRAM)
    frequent = rarest.filter(F.col("n") > common).select(*narrow.columns).unionByName(short)
    if frequent.isEmpty():
        return by_rare, None
    # Both sides come straight out of a shuffle, so Spark splits a piece that very many names hold.
    whole = _among(_pieces(wide, frequent, _substrings), frequent)
    return by_rare, whole.join(frequent.withColumnRenamed("name", "piece"), "piece")


def held_names(narrow: DataFrame, wide: DataFrame, common: int = COMMON) -> DataFrame:
    """Rows of `wide` with each row of `narrow` whose name theirs contains, as `piece`."""
    by_rare, whole = index_rows(narrow, wide, common)
    return by_rare if whole is None else by_rare.unionByName(whole)


def containing(asked: DataFrame, offered: DataFrame, min_len: int = 1, longest: bool = True, common: int = COMMON) -> DataFrame:
    """(name, pick) for asked names that contain, or lie inside, an offered name.

    Both frames hold unique non-empty `name`; `offered.pick` is a struct whose
    smallest value wins, after the longest overlap if `longest`.
    """
    wide = offered.select("name", "pick").filter(F.length("name") >= min_len)
    narrow = asked.select("name").filter(F.length("name") >= min_len)
    # Offers around the asked name: the overlap is the whole asked name.
    around = held_names(narrow, wide, common).select(F.col("piece").alias("name"), F.length("piece").alias("overlap"), "pick")
    # Offers within the asked name; short ones occur in most names.
    within = held_names(wide, narrow, common).select("name", F.length("piece").alias("overlap"), "pick")
    return _best_overlap(around.unionByName(within), longest)


def _best_overlap(found: DataFrame, longest: bool) -> DataFrame:
    order = F.struct((-F.col("overlap")).alias("o"), "pick") if longest else F.struct("pick")
    return found.groupBy("name").agg(F.min_by("pick", order).alias("pick"))


def prefixing(asked: DataFrame, offered: DataFrame, min_offered: int) -> DataFrame:
    """(name, pick) where one name starts with the other; longest overlap wins."""
    wide, narrow = offered.filter(F.length("name") >= min_offered), asked.select("name").filter(F.length("name") >= 1)
    heads = _pieces(wide, narrow, _head).groupBy(F.col("piece").alias("name")).agg(F.min("pick").alias("pick"))
    around = narrow.join(heads, "name").select("name", F.length("name").alias("overlap"), "pick")
    offer = wide.select(F.col("name").alias("piece"), "pick")
    within = hot_join(_pieces(narrow, wide, _head), offer, ["piece"], "inner").select("name", F.length("piece").alias("overlap"), "pick")
    return _best_overlap(around.unionByName(within), True)


def tiers(asked: DataFrame, steps: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Columns `pick` and `tier` from the first step that matches.

    A step is (tier label, asked column, frame with that column unique + pick).
    """
    out = asked
    for i, (_, key, frame) in enumerate(steps):
        out = hot_join(out, frame.select(key, F.col("pick").alias(f"_p{i}")), [key], counted=asked)
    hits = [F.col(f"_p{i}") for i in range(len(steps))]
    label = F.coalesce(*[F.when(h.isNotNull(), F.lit(steps[i][0])) for i, h in enumerate(hits)])
    return (
        out.withColumn("pick", F.coalesce(*hits))
        .withColumn("tier", label)
        .drop(*[f"_p{i}" for i in range(len(steps))])
    )


def _words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: F.length(w) >= 3)


def _points(asked: Column, offered: Column) -> Column:
    """2 per equal pair of words, 1 per pair where one starts the other."""

    def one(a: Column) -> Column:
        per_word = F.transform(
            offered,
            lambda b: F.when(a == b, 2).when(b.startswith(a) | a.startswith(b), 1).otherwise(0),
        )
        return F.aggregate(per_word, F.lit(0), lambda s, x: s + x)

    return F.aggregate(F.transform(asked, one), F.lit(0), lambda s, x: s + x)


SUBSETS = 8  # frequent keys of a name whose subsets are all listed; beyond it they are paired


def _look_ups(names: DataFrame) -> DataFrame:
    """What an asked name looks up: (name, key, weight). '=w' is an offered word w, '<p' an offered word that goes on after p."""

    def ways(w: Column) -> Column:
        shorter = F.transform(prefixes(F.left(w, F.length(w) - 1), 3), lambda p: F.struct(F.concat(F.lit("="), p).alias("key"), F.lit(1).alias("weight")))
        own = F.array(F.struct(F.concat(F.lit("="), w).alias("key"), F.lit(2).alias("weight")), F.struct(F.concat(F.lit("<"), w).alias("key"), F.lit(1).alias("weight")))
        return F.concat(own, F.coalesce(shorter, F.expr("array()")))

    return names.select("name", F.explode(F.flatten(F.transform("aw", ways))).alias("l")).select("name", "l.key", "l.weight")


def _carried(names: DataFrame) -> DataFrame:
    """What an offered name can be looked up by: (offer_name, key, times)."""

    def ways(w: Column) -> Column:
        starts = F.transform(prefixes(F.left(w, F.length(w) - 1), 3), lambda p: F.concat(F.lit("<"), p))
        return F.concat(F.array(F.concat(F.lit("="), w)), F.coalesce(starts, F.expr("cast(array() as array<string>)")))

    return names.select(F.col("name").alias("offer_name"), F.explode(F.flatten(F.transform("ow", ways))).alias("key"))


def _subsets(tokens: Column) -> Column:
    """All non-empty subsets of a short sorted array."""
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), F.size(tokens)) - 1).cast("int"))
    return F.transform(masks, lambda m: F.filter(tokens, lambda t, i: F.getbit(m, i) == 1))


def word_scored(asked: DataFrame, offered: DataFrame, accept: int = 2, hot: int = 50) -> DataFrame:
    """(name, pick, score): offer with most word points, smallest pick on ties.

    Points come by keys: an asked word looks up equal words, words it starts and
    words that start it. A key of at most `hot` offers leads to those offers, which are
    scored in full. Frequent keys are never joined on: an offer stands under every
    subset of the frequent keys that it carries, with the smallest pick of each subset, and an
    asked name looks up the subsets of its own. The subset with most points
    that exists is what the best such offer shares, so no pair of names is made and the maximum is exact. Names with
    more than SUBSETS frequent keys (a key counts as often as it occurs) meet key by key instead.
    """
    asked = asked.withColumn("aw", _words(F.col("name"))).filter(F.size("aw") > 0)
    offered = offered.withColumn("ow", _words(F.col("name"))).filter(F.size("ow") > 0)
    carried = _carried(offered)
    ways = _among(_look_ups(asked).withColumnRenamed("key", "piece"), carried.select(F.col("key").alias("name")))
    looked = cut_lineage(ways.groupBy("name", F.col("piece").alias("key")).agg(F.sum("weight").alias("weight")))
    wanted = looked.select(F.col("key").alias("name")).distinct()
    offers = _among(carried.withColumnRenamed("key", "piece"), wanted).groupBy("offer_name", F.col("piece").alias("key")).agg(F.count("*").cast("int").alias("times"))
    offers = cut_lineage(offers)
    counts = cut_lineage(offers.groupBy("key").agg(F.count("*").alias("n"), F.max("times").alias("most")))

    # Offers reached through a rare key, scored on their whole names.
    rare = looked.join(counts.filter(F.col("n") <= hot), "key").select("name", "key")
    reached = offers.join(rare, "key").select("name", "offer_name").distinct()
    whole = reached.join(asked.select("name", "aw"), "name").join(offered.select(F.col("name").alias("offer_name"), "pick", "ow"), "offer_name")
    by_rare = whole.select("name", "pick", _points(F.col("aw"), F.col("ow")).alias("score"))

    found = [by_rare]
    frequent = counts.filter(F.col("n") > hot)
    if not frequent.isEmpty():
        found += _by_frequent_keys(looked, offers, frequent, offered.select(F.col("name").alias("offer_name"), "pick"))
    best = F.min(F.struct((-F.col("score")).alias("s"), "pick")).alias("best")
    scored = reduce(DataFrame.unionByName, found).filter(F.col("score") >= accept).groupBy("name").agg(best)
    return scored.select("name", F.col("best.pick").alias("pick"), (-F.col("best.s")).alias("score"))


def _by_frequent_keys(looked: DataFrame, offers: DataFrame, frequent: DataFrame, picks: DataFrame) -> list[DataFrame]:
    """(name, pick, score) by frequent keys only. A token is a key and how often, so that a second occurrence counts again."""

    def tokens(times: str) -> Column:
        return F.transform(F.sequence(F.lit(1), F.col(times)), lambda k: F.concat(F.col("key"), F.lit("#"), k.cast("string")))

    mine = looked.join(frequent.select("key", "most"), "key").select("name", F.explode(tokens("most")).alias("token"), "weight")
    theirs = hot_join(offers, frequent.select("key", "n"), ["key"], "inner", "n", unique=True).select("offer_name", F.explode(tokens("times")).alias("token"))
    asks = cut_lineage(mine.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("token", "weight"))).alias("t")))
    sets = theirs.groupBy("offer_name").agg(F.sort_array(F.collect_list("token")).alias("t")).join(picks, "offer_name")
    sets = cut_lineage(sets.groupBy("t").agg(F.min("pick").alias("pick")))
    few = F.size("t") <= SUBSETS
    under = sets.filter(few).select(F.explode(_subsets(F.col("t"))).alias("subset"), "pick").groupBy("subset").agg(F.min("pick").alias("pick"))
    over = asks.filter(few).select("name", F.explode(_subsets(F.col("t"))).alias("s")).select(
        "name", F.transform("s", lambda x: x["token"]).alias("subset"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["weight"]).alias("score")
    )
    out = [over.join(under, "subset").select("name", "pick", F.col("score").cast("int").alias("score"))]
    if not asks.filter(~few).isEmpty() or not sets.filter(~few).isEmpty():
        # Very many frequent keys: key by key, summed.
        long_sets = sets.withColumn("_long", ~few).select("t", "pick", "_long", F.explode("t").alias("token"))
        long_asks = asks.withColumn("_long_ask", ~few).select("name", "_long_ask", F.inline("t"))
        met = long_asks.filter("_long_ask").join(long_sets, "token").unionByName(long_asks.filter("not _long_ask").join(long_sets.filter("_long"), "token"))
        out.append(met.groupBy("name", "t", "pick").agg(F.sum("weight").cast("int").alias("score")).select("name", "pick", "score"))
    return out
