"""Join of documents whose sets of word n-grams are similar (Jaccard), by PartEnum signatures.

Sets of about equal size form a band.  If two sets of a band reach the similarity, they differ in at
most ``k`` elements.  The domain of elements is cut into partitions by hash, each of these into
``PARTS`` parts, and for every partition the subsets of ``PARTS - 1`` parts are enumerated: a signature is
the hash of a set's elements in such a subset.  With ``k`` differences in ``(k + 1) / 2`` partitions some
partition holds one at most, and one of its subsets avoids it: both sets then share that signature.
There are some more parts than that, so linked sets share a number of signatures known from their size (``need``).
A set that shares fewer with all others together links with none and leaves before any comparison: passages that
many documents have give their sets common signatures, but too few.

Candidates.  No pairs are made within a signature.  Its smallest set is the representative, and every
other set is compared with that one only.  A pair of others can matter only if one of the two fails
the comparison; then their differences to the representative must overlap in a number of elements
that the lengths give, and a join on short prefixes of those differences, rare elements first, finds
all such pairs.  Before it, every set is compared with one such partner, and pairs that are connected by then are left out.
Every other candidate is compared exactly, so the links found connect exactly what all links connect.

Sets are hashed: two different n-grams count as one if their 64-bit hashes agree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import Words, bloom, chunks, components, flagged, in_bloom, mix, ragged, run_hashes, sieve, signed, store

PARTS = 2
#: Parts beyond those that differences can touch.  More of them part links from shared passages better and cost as many signatures.
MORE = 0.2
_HALF = np.uint64(0xFFFFFFFF)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bands(percent: int, largest: int) -> np.ndarray:
    """Upper ends of the size bands: sets that reach the similarity lie in one band or in two that follow each other."""
    ends, size = [], 1
    while size <= largest:
        end = max(size, size * 100 // percent)
        ends.append(end)
        size = end + 1
    return np.array(ends or [1], np.int64)


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-grams of every text, and bounds by text.  Letters A-Z count as a-z.

    Fewer than ``n`` words make one n-gram of all words; no words make an empty set.
    """
    words = Words(column, lower=True)
    grams, bounds = words.runs(n)
    few = np.diff(words.bounds)
    short = np.flatnonzero((few > 0) & (few < n))
    owner = np.repeat(np.arange(len(few)), np.diff(bounds))
    if len(short):
        grams = np.concatenate([grams, run_hashes(words.hashes, words.bounds[short], words.bounds[short + 1])])
        owner = np.concatenate([owner, short])
    # by text, then by hash
    order = np.argsort(grams)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(few) <= 1 << 16 else np.int64), kind="stable")]
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[fresh], owner[fresh]
    return grams, np.searchsorted(owner, np.arange(len(few) + 1))


def _partitions(ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Elements in which two sets of a band may differ, and the number of partitions, by band.

    ``k`` differences touch ``k`` parts at most.  ``k + 1`` parts would do; some more are taken, about as many as
    are empty by chance and a part of ``MORE`` besides, which linked sets share on top.  A set with no more empty parts than that signs only for the others: at least one
    of the untouched parts is not empty.  A set with more signs for its empty parts too.
    """
    differ = 2 * (100 - percent) * ends // (100 + percent)
    empty = (differ + 1) * np.exp(-ends / (differ + 1.0))
    spare = np.ceil(empty + 3 * np.sqrt(empty) + MORE * differ).astype(np.int64)
    return differ, (differ + spare + PARTS) // PARTS


def signatures(grams: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """PartEnum signatures of every set, their bounds by set, and how many at least it shares with any set it links with.

    Sets that differ in d elements have the same elements in all cells but d.  Those cells are signatures, as far as they are not empty.
    A set signs for two bands, and a pair meets in one.  The lowest bit of a signature is that of its band's number, and ``need``
    has a row for either bit.
    """
    sizes = np.diff(bounds)
    ends = bands(percent, int(sizes.max(initial=1)) * 2 + 2)
    band = np.searchsorted(ends, sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    sigs, owners, need = [], [], np.ones((2, len(sizes)), np.int64)
    apart, along = 100 - percent, 100 + percent
    for step in (0, 1):  # a set signs for its own band and for the one above
        at = band + step
        differ, partitions = _partitions(ends, percent)
        differ, partitions = differ[at], partitions[at]
        salt = mix((at + 1).astype(np.uint64) * _GOLD)
        h = mix(grams ^ np.repeat(salt, sizes))
        # multiply-shift of the upper half: a number below ``partitions``; the lower half picks the part
        spot = ((h >> np.uint64(32)) * np.repeat(partitions, sizes).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(partitions)]) * PARTS
        cell = offsets[owner] + spot * PARTS + (h & np.uint64(PARTS - 1)).astype(np.int64)
        # the elements of a cell add up to its hash, whatever their order; halves of 32 bits stay exact as doubles
        value, cells = mix(h + _GOLD), int(offsets[-1])
        low = np.bincount(cell, (value & _HALF).astype(np.float64), cells).astype(np.uint64)
        high = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), cells).astype(np.uint64)
        total = low + (high << np.uint64(32))
        who = np.repeat(np.arange(len(sizes)), partitions * PARTS)
        # two parts: leaving one out keeps the other
        bit = (at & 1).astype(np.uint64)
        sig = mix(total + mix((np.arange(cells) - offsets[who]).astype(np.uint64) + salt[who])) & ~np.uint64(1) | bit[who]
        empty = np.bincount(cell, minlength=cells) == 0
        spare = partitions * PARTS - differ - 1
        holes = np.bincount(who[empty], minlength=len(sizes))
        many = holes > spare
        # the largest partner of a set bounds the elements they may differ in
        most = apart * (sizes + np.minimum(ends[at], sizes * 100 // percent)) // along
        need[at & 1, np.arange(len(sizes))] = np.where(differ == 0, 1, np.maximum(1, partitions * PARTS - np.minimum(most, differ) - holes))
        whole = differ == 0
        keep = (~whole & (sizes > 0))[who] & (~empty | many[who])
        sigs.append(sig[keep])
        owners.append(who[keep])
        # no difference allowed: the set signs as a whole
        single = np.flatnonzero(whole & (sizes > 0))
        sigs.append(mix(_reduce(total, offsets)[single] ^ salt[single]) & ~np.uint64(1) | bit[single])
        owners.append(single)
    sig, who = np.concatenate(sigs), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return sig[order], np.searchsorted(who[order], np.arange(len(sizes) + 1)), need


def _reduce(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each slice; empty slices give 0."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 80, links: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when their n-gram sets reach ``percent`` (100 * common >= percent * all), and
    ``component_id`` is the smallest doc_id reachable by links, the document's own included.  Null, empty
    and blank texts have no n-grams and link with nothing.  Rows that share a doc_id are one document
    for links; rows without an id keep a null component.
    """
    nodes = _nodes(docs, n, percent)
    # copies of a set belong to its smallest document
    firsts = _firsts(nodes)
    copies = nodes.filter("n_shingles > 0").select("doc_id", "h1", "h2").join(firsts, ["h1", "h2"]).filter("doc_id <> first")
    copies = store(copies.select("doc_id", "h1", "h2", F.xxhash64("doc_id", "h1", "h2").alias("_k"), "first").distinct(), "copies")
    edges = _links(docs, nodes, copies, n, percent)
    copies = copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    reach = components(edges.union(copies))
    return nodes.select("doc_id", "n_shingles").join(reach, F.col("doc_id") == F.col("node"), "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, that have the smallest id of their component; rows without an id stay."""
    rest = similar_documents(docs, n, percent).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(store(rest, "near-copies"), "doc_id", "left_anti").select(*docs.columns)


def _nodes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Stored table of doc_id, n_shingles, two hashes of the set, signatures."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            grams, bounds = shingle_sets(part.column("text"), n)
            sigs, cuts, need = signatures(grams, bounds, percent)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(signed(_reduce(mix(grams), bounds))),
                 pa.array(signed(_reduce(mix(grams * _GOLD + np.uint64(7)), bounds))), ragged(signed(sigs), cuts, pa.int64()), *map(pa.array, need.astype(np.int32))],
                ["doc_id", "n_shingles", "h1", "h2", "sigs", "need0", "need1"])

    return store(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, sigs array<long>, need0 int, need1 int"), "sets")


def _firsts(nodes: DataFrame) -> DataFrame:
    """Stored, so that a join with it has an exchange right below and a set with very many copies can be split."""
    found = nodes.filter("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return store(found.filter("n > 1").select("h1", "h2", "first"), "firsts")


def _signs(own: DataFrame) -> DataFrame:
    """One row per set and signature, by signature; ``odd`` tells the band.

    There are many more of these rows than of any others, and counting them sorts and hashes at once, so they are cut finer.
    """
    n = 4 * int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return own.select("doc_id", F.explode("sigs").alias("sig")).repartition(n, "sig")


def _odd() -> Column:
    return F.col("sig").bitwiseAND(1)


def _shared_enough(own: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored table of the sets, with the signatures of one band, that share as many signatures with others as a link takes."""
    # both uses read doc_id and sig, so that they share one exchange
    shared = rows.groupBy("sig").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("sig")
    counts = rows.join(shared, "sig").groupBy("doc_id", _odd().alias("odd")).agg(F.count(F.lit(1)).alias("n"))
    enough = counts.join(own.select("doc_id", "need0", "need1"), "doc_id").filter("n >= if(odd = 0, need0, need1)")
    enough = enough.groupBy("doc_id").agg(F.collect_set("odd").alias("_odd"))
    # stored, so that the signatures of the other sets need not move to a join
    enough = store(enough.withColumn("_h", F.xxhash64("doc_id")), "enough")
    kept = sieve(own.withColumn("_h", F.xxhash64("doc_id")), "_h", enough).drop("_h").join(enough.drop("_h"), "doc_id")
    sigs = F.filter("sigs", lambda s: F.array_contains("_odd", s.bitwiseAND(1)))
    return store(kept.select("doc_id", "need0", "need1", sigs.alias("sigs")), "sharing")


def _links(docs: DataFrame, nodes: DataFrame, copies: DataFrame, n: int, percent: int) -> DataFrame:
    """Stored table of verified links (a, b) between the first documents of different sets."""
    sets = nodes.filter("n_shingles > 0 and doc_id is not null")
    # most sets are certainly no copies and need no join to show it
    copies, held = copies.select("doc_id", "h1", "h2", "_k"), ["doc_id", "sigs", "need0", "need1"]
    marked = flagged(sets.withColumn("_k", F.xxhash64("doc_id", "h1", "h2")), "_k", copies, "_maybe")
    own = marked.filter("not _maybe").select(*held).union(
        marked.filter("_maybe").join(copies.drop("_k"), ["doc_id", "h1", "h2"], "left_anti").select(*held))
    # one exchange serves both uses; a signature has one row per different set, and a set has many signatures
    own = _shared_enough(own, _signs(own))
    signs = _signs(own)
    shared = signs.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("most"), (F.count(F.lit(1)) > 2).alias("crowd")) \
        .filter("rep < most").select("sig", "rep", "crowd")
    # linked sets share ``need`` signatures: a pair alone in all it has as a star must have as many, or it meets in a crowd of a third.
    # They share one, so two members need a look at each other only if a signature has both of them and the representative
    pairs = signs.join(shared, "sig").filter("doc_id <> rep").groupBy("doc_id", "rep", _odd().alias("odd")) \
        .agg(F.max("crowd").alias("crowd"), F.count(F.lit(1)).alias("n"))
    pairs = pairs.join(own.select("doc_id", "need0", "need1"), "doc_id").withColumn("_near", F.expr("n >= if(odd = 0, need0, need1)"))
    stars = store(pairs.groupBy("doc_id", "rep").agg(F.max("crowd").alias("crowd"), F.max("_near").alias("near")).filter("crowd or near")
                  .select("doc_id", "rep", "crowd"), "stars")

    # sets of the documents that occur, from their texts; the filter has a fixed size and the join is exact
    members = stars.select("doc_id").union(stars.select("rep")).distinct()
    members = store(members.select("doc_id", F.xxhash64("doc_id").alias("_h")), "members")
    sets = _sets(docs, members, n)
    near = store(_compare(stars.withColumnRenamed("doc_id", "a").withColumnRenamed("rep", "b"), sets, percent, True), "stars-compared")
    linked = near.filter("linked").select("a", "b")

    # pairs of two documents of one star: common elements in the prefixes of their differences, rare elements first
    crowded = near.filter("crowd")
    open_ = crowded.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("linked")).alias("u")).filter("n > 1 and u > 0").select("b")
    apart = store(crowded.join(open_, "b", "left_semi")
                  .select("a", "b", "linked", "wide", "strict", "f", F.size("difference").alias("d"), F.explode("difference").alias("h")), "differences")
    often = apart.groupBy("b", "h").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("b", "a").orderBy("n", "h"))
    prefix = apart.join(often, ["b", "h"]).withColumn("at", rank).filter("at <= wide")
    prefix = store(prefix.select("b", "h", F.col("a").alias("x"), "linked", (F.col("at") <= F.col("strict")).alias("near"), "f", (F.col("d") - F.col("at")).alias("left")), "prefixes")
    # behind their first common element two differences can have no more in common than the shorter rest
    enough = f"{2 * (100 + percent)} * (1 + least(left, y_left)) >= f + y_f"

    # first every set is held against one other of its star, so that most of a group is connected and its pairs need no look
    picked = store(_picked(prefix.filter("not linked and near"), enough), "picked")
    picked = _compare(picked, sets, percent, False).filter("linked").select("a", "b")
    linked = store(linked.union(picked), "first-links")
    known = components(linked)
    prefix = prefix.join(known, F.col("x") == F.col("node"), "left").withColumn("c", F.coalesce("component", "x")).drop("node", "component")
    prefix = store(prefix, "placed-prefixes")
    # an element whose sets are all connected leads to nothing new
    several = prefix.groupBy("b", "h").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least < most").select("b", "h")
    prefix = store(prefix.join(several, ["b", "h"]), "open-prefixes")
    other = prefix.select("b", "h", F.col("x").alias("y"), F.col("linked").alias("y_linked"), F.col("near").alias("y_near"), F.col("f").alias("y_f"), F.col("left").alias("y_left"), F.col("c").alias("y_c"))
    failed = prefix.filter("not linked")
    both = failed.filter("near").join(other.filter("not y_linked and y_near"), ["b", "h"]).filter(f"x < y and c <> y_c and {enough}")
    mixed = failed.join(other.filter("y_linked"), ["b", "h"]).filter(f"c <> y_c and {enough}").select("x", "y")
    rest = both.select("x", "y").union(mixed.select(F.least("x", "y"), F.greatest("x", "y"))).distinct()
    rest = store(rest.select(F.col("x").alias("a"), F.col("y").alias("b"), F.lit(False).alias("crowd")), "rest")
    more = _compare(rest, sets, percent, False).filter("linked").select("a", "b")
    return store(linked.union(more), "links")


def _picked(prefix: DataFrame, enough: str) -> DataFrame:
    """Pairs (a, b), one a set and star at most: of the smallest sets of its elements, the one it shares most of them with."""
    first = prefix.groupBy("b", "h").agg(F.min(F.struct("x", "f", "left")).alias("y"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select("b", "h", F.col("y.x").alias("y"), F.col("y.f").alias("y_f"), F.col("y.left").alias("y_left"))
    pairs = prefix.join(first, ["b", "h"]).filter(f"x <> y and {enough}").groupBy("b", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    best = pairs.groupBy("b", "x").agg(F.max(F.struct("n", "y")).alias("best"))
    return best.select(F.col("x").alias("a"), F.col("best.y").alias("b"), F.lit(False).alias("crowd")).distinct()


def _sets(docs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """Stored table of doc_id and its set (sorted little-endian 64-bit hashes) for the members."""
    words = bloom(members, F.col("_h"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_bloom(words, batch.column("h").to_numpy(zero_copy_only=False))
            for part in chunks([batch.filter(pa.array(hit))]):
                grams, bounds = shingle_sets(part.column("text"), n)
                raw, cuts = grams.astype("<u8").tobytes(), (bounds * 8).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], ["doc_id", "set"])

    some = docs.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "doc_id long, set binary")
    return store(some.join(members.select("doc_id"), "doc_id", "left_semi"), "set-hashes")


def _compare(pairs: DataFrame, sets: DataFrame, percent: int, prefixes: bool) -> DataFrame:
    """Adds ``linked`` to pairs (a, b) and, for stars in a ``crowd``, a's ``difference`` to b and how many of its rarest elements matter:
    ``wide`` of them for links with linked members, ``strict`` for those with members that are not linked.

    With D the elements that are in one of a and b only, 100 * common >= percent * all says F(a) + F(b) <= 0
    for F(b) = -q|b| and F(a) = Q|D| - q|a|, where q = 100 - percent and Q = 100 + percent.  For two members
    x, y of the star of b with overlap o of their differences the same reads F(x) + F(y) <= 2Q * o.
    """
    low, high = 100 - percent, 100 + percent

    def one(a: bytes, b: bytes, crowd: bool) -> tuple[bool, int, int, int, np.ndarray]:
        x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        spot = np.minimum(np.searchsorted(y, x), len(y) - 1)
        common = y[spot] == x
        d = len(x) + len(y) - 2 * int(common.sum())
        linked = low * (len(x) + len(y)) >= high * d
        if not crowd:
            return linked, 0, 0, 0, x[:0]
        inside = np.zeros(len(y), bool)
        inside[spot[common]] = True
        f = high * d - low * len(x)
        # overlap needed with a member that is not linked to b; and, if this one is not, with one that is.  Sets with
        # an overlap of ``o`` share one of the first d - o + 1 elements in any common order
        need = max(1, -(-(f + low * len(y) + 1) // (2 * high)))
        wide = need if linked else max(1, -(-(f - low * len(y)) // 200))
        return linked, max(0, d - wide + 1), max(0, d - need + 1), f, np.concatenate([x[~common], y[~inside]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(a.as_buffer(), b.as_buffer(), c) for a, b, c in zip(batch.column("x"), batch.column("y"), batch.column("crowd").to_pylist(), strict=True)]
            linked, wide, strict, fs, values = zip(*got, strict=True) if got else ((), (), (), (), ())
            out = [batch.column("a"), batch.column("b"), batch.column("crowd"), pa.array(linked, pa.bool_())]
            if prefixes:
                cuts = np.concatenate([[0], np.cumsum([len(v) for v in values])])
                out += [pa.array(wide, pa.int32()), pa.array(strict, pa.int32()), pa.array(fs, pa.int64()), ragged(signed(np.concatenate([*values, np.zeros(0, np.uint64)])), cuts, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["a", "b", "crowd", "linked", "wide", "strict", "f", "difference"][:len(out)])

    with_sets = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b") \
        .join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a").select("a", "b", "crowd", "x", "y")
    return with_sets.mapInArrow(run, "a long, b long, crowd boolean, linked boolean" + ", wide int, strict int, f long, difference array<long>" * prefixes)
