"""Benchmark decontamination by SimHash windows; DataFrame functions only.

A benchmark item leaks into a document if some window of the document, as many words long as the item, has a weighted
similarity of ``PERCENT`` hundredths or more with it, over shingles of ``K`` words.  A shingle weighs its number of characters, and
repeated shingles count as often as they stand: sum of the smaller weights over sum of the larger ones.

1. Open the windows.  A window that is similar enough shares ``PERCENT`` hundredths of the item's weight at least, in whatever
   order.  The rolling shingle hashes of all documents are joined to those of the items, and a running sum over the hits of an
   item in a document tells for every start how much weight its window can share.  All starts that reach the share are opened.
2. Fingerprint.  Windows and items get a 64-bit SimHash, cut into ``RADIUS + 1`` blocks.  Two fingerprints at most ``RADIUS``
   bits apart agree in one block at least, so joining on (item, block, value) finds all of them.
3. Verify.  Pairs within the radius are compared exactly.

Two texts of similarity 0.8 differ in 10 of 64 bits on average (standard deviation 3), so a radius of 23 keeps them.

Nothing is collected but the word counts of items shorter than a shingle, of which there are at most ``K - 1``.  No broadcast
is forced: Spark broadcasts the items while they are below its size limit and sorts beyond it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import alnum_words, grams, parked

K = 5
#: Least similarity, in hundredths.
PERCENT = 80
RADIUS = 23
BITS = 64


def _shingles(words: Column, k: int) -> Column:
    """(hash, weight) of each run of ``k`` words; a shorter text is one run."""
    def shingle(i: Column) -> Column:
        run = F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])  # words beyond the end are null and left out
        return F.struct(F.xxhash64(run).alias("h"), F.length(run).cast("long").alias("w"))

    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - k)), shingle)


def _places(words: DataFrame, n: int) -> DataFrame:
    """``row, n_doc, p, gram``: the hashes of ``grams``, a row each; taken after the rows are unfolded, where Spark compiles them."""
    at = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n))
    runs = words.select("row", "words", F.explode(at).alias("p"))
    return runs.select("row", F.size("words").alias("n_doc"), "p", F.xxhash64(*[F.get("words", F.col("p") + j) for j in range(n)]).alias("gram"))


def _simhash(shingles: Column) -> Column:
    """Bit ``b`` is set where the shingles that have it outweigh the others."""
    def bit(b: Column) -> Column:
        lead = F.aggregate(shingles, F.lit(0).cast("long"), lambda a, x: a + F.when(F.getbit(x["h"], b) == 1, x["w"]).otherwise(-x["w"]))
        return F.when(lead > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))


def _blocks(fingerprint: str, radius: int) -> list[Column]:
    """The fingerprint cut into ``radius + 1`` pieces."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [F.shiftrightunsigned(F.col(fingerprint), a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")) for a, b in zip(cuts, cuts[1:])]


def _by_block(df: DataFrame, fingerprint: str, radius: int) -> DataFrame:
    return df.select("*", F.posexplode(F.array(*_blocks(fingerprint, radius))).alias("block", "value"))


def _once(df: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """``kept`` and new columns, each worked out once a row: Spark copies an expression into what reads it, but not one it unfolds."""
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda a, x: a + x["w"])


def _open_windows(words: DataFrame, asked: DataFrame, k: int, percent: int) -> DataFrame:
    """``row, item, n_item, start, held, total``: the item-sized windows whose hits may weigh enough.

    ``held`` is the weight of a window's shingles that the item has too, ``total`` the weight of the item.
    """
    lengths = [r[0] for r in asked.where(F.col("n_item") < k).select("n_item").distinct().collect()] + [k]
    opened = []
    for n in lengths:
        own = asked.where((F.col("n_item") >= k) if n == k else (F.col("n_item") == n))
        own = own.select("item", "n_item", F.posexplode(_shingles(F.col("item_words"), n)).alias("q", "of"), grams(F.col("item_words"), n).alias("grams"))
        own = own.select("item", "n_item", F.col("of.w").alias("w"), F.get("grams", F.col("q")).alias("gram"))
        own = own.groupBy("item", "n_item", "gram").agg(F.first("w").alias("w"), F.count("*").alias("times"))
        totals = own.groupBy("item").agg(F.sum(F.col("w") * F.col("times")).alias("total"))
        own = own.join(totals, "item")
        hits = _places(words, n).join(own, "gram").withColumn("n_hits", F.col("n_item") - n + 1)  # places for hits in a window
        opened.append(hits.select("row", "item", "n_item", "n_doc", "total", "n_hits", "gram", "w", "times", "p"))
    key = ["row", "item", "n_item", "n_doc", "total", "n_hits"]
    # Repeated rows hit the same places.
    hits = reduce(DataFrame.unionByName, opened).groupBy(*key, "gram", "w", "times").agg(F.collect_set("p").alias("ps"))
    most = F.sum(F.col("w") * F.least(F.size("ps"), F.col("times")))
    hits = hits.groupBy(*key).agg(most.alias("most"), F.collect_list(F.struct("ps", "w")).alias("hits"))
    hits = hits.where(100 * F.col("most") >= percent * F.col("total")).select(*key, F.inline("hits")).select(*key, "w", F.explode("ps").alias("p"))
    # A hit is in the windows from p - n_hits + 1 to p.
    edges = hits.select(*key, F.inline(F.array(
        F.struct((F.col("p") - F.col("n_hits") + 1).alias("at"), F.col("w").alias("step")),
        F.struct((F.col("p") + 1).alias("at"), (-F.col("w")).alias("step")),
    )))
    by_start = Window.partitionBy(*key).orderBy("at")
    edges = edges.select(*key, F.greatest(F.lit(0), "at").alias("first"), F.sum("step").over(by_start).alias("held"), F.lead("at").over(by_start).alias("next"))
    # No window leaves the document; a shorter document is one window.
    last = F.least(F.col("next") - 1, F.greatest(F.lit(0), F.col("n_doc") - F.col("n_item")))
    edges = edges.withColumn("last", last).where((F.col("first") <= F.col("last")) & (F.col("held") > 0) & (100 * F.col("held") >= percent * F.col("total")))
    return edges.select("row", "item", "n_item", F.explode(F.sequence("first", "last")).alias("start"), "held", "total")


def _similarity(pairs: DataFrame) -> DataFrame:
    """``shared`` and ``whole`` weight of each (row, item, start), counted shingle by shingle."""
    key = ["row", "item", "start"]
    # Both sides are unfolded from one row; a union would work out all windows twice.
    sides = pairs.select(*key, F.inline(F.array(
        F.struct(F.col("shingles").alias("side"), F.lit(1).alias("a"), F.lit(0).alias("b")),
        F.struct(F.col("item_shingles").alias("side"), F.lit(0).alias("a"), F.lit(1).alias("b")),
    )))
    counted = sides.select(*key, "a", "b", F.inline("side")).groupBy(*key, "h", "w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return counted.groupBy(*key).agg(
        F.sum(F.least("a", "b") * F.col("w")).alias("shared"), F.sum(F.greatest("a", "b") * F.col("w")).alias("whole")
    )


def matches(docs: DataFrame, items: DataFrame, percent: int = PERCENT, k: int = K, radius: int = RADIUS) -> DataFrame:
    """``row, item_id, start, n_words, similarity``: every window of a document that is similar enough to an item.

    ``row`` is the hash of ``doc_id`` and ``text``, see ``row_of``.  Null and empty texts on either side match nothing.  Items
    that repeat both columns count once.  Only ``doc_id``, ``text`` and ``item_id`` are read, whatever other columns there are.
    """
    asked = items.select("item_id", alnum_words(F.coalesce("text", F.lit(""))).alias("item_words")).where(F.size("item_words") > 0)
    asked = asked.select("*", F.xxhash64("item_id", "item_words").alias("item"), F.size("item_words").alias("n_item")).dropDuplicates(["item"])
    text = docs.select(row_of().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    opened = _open_windows(text.select("row", alnum_words(F.col("text")).alias("words")), asked, k, percent)

    # The windows of a document travel as one row, so that its text is joined once; by sorting at any size, as there may be
    # as many windows as a broadcast cannot hold.
    marks = parked(opened.groupBy("row").agg(F.collect_list(F.struct("item", "start", "n_item", "held", "total")).alias("marks")), "marks")
    opened_text = text.join(marks.hint("merge"), "row").select("row", "marks", alnum_words(F.col("text")).alias("words"))
    windows = opened_text.select("row", F.col("words").alias("all_words"), F.inline("marks"))
    window = ["row", "item", "start", "held", "total"]
    windows = _once(windows, window, words=F.slice("all_words", F.col("start") + 1, F.col("n_item")))
    windows = _once(windows, window, shingles=_shingles(F.col("words"), k))
    # Shared weight is at most ``held``, and the whole is both sides without what they share.
    both = _weight(F.col("shingles")) + F.col("total")
    windows = windows.where((100 + percent) * F.col("held") >= percent * both).select("row", "item", "start", "shingles")
    windows = windows.select("*", _simhash(F.col("shingles")).alias("print"))
    asked = asked.select("item", "item_id", "n_item", _shingles(F.col("item_words"), k).alias("item_shingles"))
    asked = asked.select("*", _simhash(F.col("item_shingles")).alias("item_print"))
    pairs = _by_block(windows, "print", radius).join(_by_block(asked, "item_print", radius), ["item", "block", "value"])
    # A pair that agrees in several blocks is taken at the first of them.
    agree = [a == b for a, b in zip(_blocks("print", radius), _blocks("item_print", radius))]
    first = F.coalesce(*[F.when(same, i) for i, same in enumerate(agree)])
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    pairs = pairs.where((F.col("block") == first) & near)
    similar = _similarity(pairs).where(100 * F.col("shared") >= percent * F.col("whole"))
    names = asked.select("item", "item_id", "n_item")
    return similar.join(names, "item").select(
        "row", "item_id", "start", F.col("n_item").alias("n_words"), (F.col("shared") / F.col("whole")).alias("similarity")
    )


def row_of() -> Column:
    """Tells documents apart: rows that repeat both ``doc_id`` and ``text`` are one document."""
    return F.xxhash64("doc_id", "text")


def report(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_items, items, similarity, contaminated``.

    ``items`` are the ids of the leaked items, sorted and joined by commas; ``similarity`` is the largest, 0 without a leak.
    Empty tables on either side leave every document clean.
    """
    found = matches(docs, items, **options).groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("ids"), F.max("similarity").alias("similarity")
    )
    return docs.select("doc_id", row_of().alias("row")).join(found, "row", "left").select(
        "doc_id", F.greatest(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("")).alias("items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"), F.col("ids").isNotNull().alias("contaminated"),
    )


def remove(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """The documents without a leaked item, all columns unchanged."""
    leaked = matches(docs, items, **options).select("row").distinct()
    key = "__row_of_document"
    return docs.withColumn(key, row_of()).join(leaked.withColumnRenamed("row", key), key, "left_anti").drop(key)
