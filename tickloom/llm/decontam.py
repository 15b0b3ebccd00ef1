"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are runs of letters and digits, lower case; shingles are five words (all words of a shorter item).
An item of ``m`` shingles is held against every window of ``m`` shingles of every text; a text with fewer is one window.

1. Windows.  Two multisets of ``m`` shingles with similarity 0.8 have 8/9 of them in common, so only
   windows with that many shingles of items of this length are kept; no other can pass step 4.  A text of
   ``n < m`` shingles needs 4/9 of ``m + n``.
2. SimHash.  64 bits of every window and every item, each shingle counted as often as it occurs.
3. Blocks.  Fingerprints within ``RADIUS`` agree up to ``RADIUS // 8`` bits in one of eight blocks: items are
   listed under all near values of each block, and windows look theirs up.  All pairs within the radius
   are found; a similarity of 0.8 gives 9.7 differing bits on average, 23 is 4.6 deviations above.
4. Check.  The weighted shingle similarity (sum of minima over sum of maxima of counts) of each pair.

Texts are known by a 64-bit hash until the end, so copies are worked on once.  DataFrame functions only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import sieve, store

SHINGLE = 5
RADIUS, BLOCKS, BLOCK_BITS = 23, 8, 8
#: Sides of a join are broadcast up to so many rows of a few numbers each (counted), and shuffled beyond.
BROADCAST_ROWS = 500_000


def word_hashes(text: str) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: str, n: int) -> Column:
    """Hashes of all runs of ``n`` words, in order; none for fewer words."""
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(n)]))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<long>"))


def simhash(bag: str) -> Column:
    """Bit b is set if more shingles have it than have not."""
    def bit(b: Column) -> Column:
        ones = F.size(F.filter(F.col(bag), lambda x: F.call_function("getbit", x, b) == 1))
        return F.when(2 * ones > F.size(bag), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda all_, b: all_.bitwiseOR(bit(b)))


def blocks(fingerprint: str) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, i * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("value"))
                     for i in range(BLOCKS)])


def near_masks(radius: int = RADIUS) -> list[int]:
    """All changes of a block by the bits that one of the blocks can differ in at most."""
    return [sum(1 << b for b in bits) for k in range(radius // BLOCKS + 1) for bits in itertools.combinations(range(BLOCK_BITS), k)]


def common_weight(a: str, b: str) -> Column:
    """Sum of the smaller counts of the shingles of two bags."""
    count = lambda bag, x: F.size(F.filter(F.col(bag), lambda y: y == x))
    return F.aggregate(F.array_distinct(F.array_intersect(a, b)), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Stored table of text hash ``row``, item_id, start (shingle), matched, n_shingles, n_window (shingles of the window): the best
    window of each item, the first of equals."""
    items = benchmark.filter("item_id is not null").select("item_id", word_hashes("text").alias("w")).filter(F.size("w") > 0) \
        .select("item_id", "w", F.least(F.size("w"), F.lit(SHINGLE)).alias("k"))
    items = store(items, "items")
    found = [_matches(docs, items.filter(F.col("k") == k), k) for k in sorted(r["k"] for r in items.select("k").distinct().collect())]  # 1 to 5
    # made by Spark: rows of a Python list would start Python workers of their own in every executor
    out = docs.sparkSession.range(0).select(F.col("id").alias("row"), F.col("id").alias("item_id"), *[F.lit(0).alias(c) for c in ("start", "matched", "n_shingles", "n_window")])
    for f in found:
        out = out.unionByName(f)
    best = out.groupBy("row", "item_id").agg(F.max(F.struct("matched", (-F.col("start")).alias("late"), "n_shingles", "n_window")).alias("best"))
    return store(best.select("row", "item_id", (-F.col("best.late")).alias("start"), "best.matched", "best.n_shingles", "best.n_window"), "matches")


def _matches(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    items = store(items.select("item_id", shingles("w", k).alias("bag")).withColumn("m", F.size("bag")).withColumn("print", simhash("bag")), "items")

    # 1. positions of shingles that items have, by the length of the item
    wanted = _small(store(items.select("m", F.explode("bag").alias("s")).distinct(), "item-shingles"))
    rows = docs.select(F.xxhash64("text").alias("row"), word_hashes("text").alias("w"))
    # counted ahead of the explode, which would else carry the words through every row
    rows = rows.select("row", "w", (F.size("w") - (k - 1)).alias("n"))
    hits = rows.select("row", "n", F.posexplode(shingles("w", k)).alias("at", "s")).join(wanted, "s")
    # shingles of a window: a text that is shorter than the item is one window, at 0
    runs = hits.groupBy("row", "m", F.least("m", "n").alias("wide")).agg(F.array_sort(F.collect_set("at")).alias("at")) \
        .withColumn("least", F.expr("(4 * (m + wide) + 8) div 9"))
    # ``i``: the first such position in a window; the window may begin before it, but not at the one before
    first = F.filter(F.sequence(F.lit(0), F.size("at") - 1), lambda i: F.get(F.col("at"), (i + F.col("least") - 1).cast("int")) - F.get("at", i) < F.col("wide"))
    begin = F.greatest(F.lit(0), F.get("at", F.col("i")) - (F.col("wide") - F.col("least")).cast("int"), F.coalesce(F.get("at", F.col("i") - 1) + 1, F.lit(0)))
    windows = runs.withColumn("i", F.explode(first)).select("row", "m", "wide", F.explode(F.sequence(begin, F.get("at", F.col("i")))).alias("start"))
    windows = store(windows, "windows")

    # 2. the windows of the few texts that have any; the sieve is of fixed size, the join decides
    texts = sieve(docs.select(F.xxhash64("text").alias("row"), "text"), "row", windows.select("row").distinct())
    texts = texts.groupBy("row").agg(F.first("text").alias("text")).withColumn("w", word_hashes("text")).select("row", shingles("w", k).alias("all"))
    seen = windows.join(texts, "row").filter("start + wide <= size(all)") \
        .select("row", "m", "start", F.slice("all", F.col("start") + 1, F.col("wide")).alias("seen")).withColumn("seen_print", simhash("seen"))
    seen = store(seen, "fingerprints")

    # 3. the look-up by blocks
    near = F.array(*[F.lit(x) for x in near_masks()])
    listed = items.select("item_id", "m", "print", "bag", F.inline(blocks("print"))).withColumn("mask", F.explode(near)) \
        .select("item_id", "m", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    listed = _small(store(listed, "blocks"))
    pairs = seen.select("row", "m", "start", F.inline(blocks("seen_print"))).join(listed, ["m", "block", "value"]).select("row", "m", "start", "item_id").distinct()
    pairs = pairs.join(seen, ["row", "m", "start"]).join(_small(items), ["item_id", "m"]) \
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("seen_print"))) <= RADIUS)

    # 4. the exact similarity
    return pairs.withColumn("matched", common_weight("seen", "bag")).filter("10 * matched >= 8 * (m + size(seen) - matched)") \
        .select("row", "item_id", "start", "matched", F.col("m").alias("n_shingles"), F.size("seen").alias("n_window"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, matched, n_shingles, similarity): every document with a window like an item.

    Null, empty and wordless texts match nothing, nor do such items or items without an id; an empty side
    gives no rows.  A document is listed once per item with its best window (the first of equals), repeated rows as
    often as they occur, null ids as null.
    """
    found = matches(docs, benchmark)
    return docs.select("doc_id", F.xxhash64("text").alias("row")).join(found, "row") \
        .select("doc_id", "item_id", "start", "matched", "n_shingles", (F.col("matched") / (F.col("n_shingles") + F.col("n_window") - F.col("matched"))).alias("similarity"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, in which no window is like an item."""
    found = store(matches(docs, benchmark).select("row").distinct(), "contaminated")
    return docs.join(found, F.xxhash64(docs["text"]) == found["row"], "left_anti")
