"""Removal of passages that repeat: every window of words that an earlier document also has.

Equal windows have equal minimizers (the smallest hash of the n-grams inside), so consecutive windows with
the same minimizer form a segment, and segments go to shards by minimizer.  A minimizer that only one
document has cannot repeat and is dropped first.  Shards get every different segment once, with the smallest
document that has it.  Each shard builds an FM-index over its segments and streams them through backward search; the
intervals of ``window`` words tell the smallest document that has the window.  What this says of a segment is joined
back to its copies, so no task holds the rows of a text with many copies.  A minimizer whose different segments would
fill a shard is split: its windows go to shards one by one.

Words are 48-bit hashes in the index, 64-bit in the minimizers; equal windows are always found, and two
different ones count as equal only if hashes collide in both.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.common import Words, bloom, chunks, in_bloom, joined_words, mix, run_hashes, signed, store
from tickloom.llm.fmindex import FmIndex

WINDOW, GRAM = 50, 20
#: Windows of a segment; a longer run of one minimizer is cut, which changes no result.
RUN = 256
#: Words of a shard that its size aims at.
SHARD_WORDS = 600_000
#: A minimizer is split if its different segments alone fill a shard and are more than one in so many of all.
SPLIT_SHARE = 100_000

_SEGMENT = ["route", "content_hash", "doc_id", "row", "start", "windows", "content"]


def _segments(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first word in the text, windows, minimizer) of all segments of a batch."""
    grams, bounds = words.runs(gram)
    width = window - gram + 1
    low, span = grams, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:]) if len(low) > span else low[:0]
        span *= 2
    rest = width - span
    low = (np.minimum(low[:-rest], low[rest:]) if rest else low) if len(low) > rest else low[:0]
    count = np.maximum(np.diff(words.bounds) - window + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    key = low[bounds[owner] + first] if len(owner) else grams[:0]
    new = np.ones(len(owner), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    # cut long runs
    run_start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    new |= (np.arange(len(new)) - run_start) % RUN == 0
    at = np.flatnonzero(new)
    return owner[at], first[at], np.diff(np.append(at, len(owner))), key[at]


def repeated_minimizers(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Stored table (key, n, contents) of minimizers that two documents at least have: their segments, and how many differ."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = Words(part.column("text"))
            text, start, windows, key = _segments(words, window, gram)
            first = words.bounds[text] + start
            content = run_hashes(words.hashes, first, first + windows + window - 1)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(signed(content)), pa.array(ids[text])], ["key", "content", "doc_id"])

    rows = docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "key long, content long, doc_id long")
    counts = rows.groupBy("key", "content").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("contents"))
    return store(counts.filter("low < high").select("key", "n", "contents"), "minimizers")


def covered(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Stored table (doc_id, row, spans): word ranges [from, to) of windows that start in a document with a smaller id.

    ``row`` is the hash of the text: rows that share an id are judged one by one, and never by each other.
    """
    keys = repeated_minimizers(docs, window, gram)
    total = keys.agg(F.sum("n").alias("n")).first()["n"] or 0
    # by its rule this list never has more than SPLIT_SHARE keys
    most = max(shard_words // (window + 16), total // SPLIT_SHARE)
    split = np.sort(np.array([r["key"] for r in keys.filter(F.col("contents") > most).select("key").collect()], np.int64))
    # words of the different segments; a minimizer has half the n-grams of a window as windows, on average
    parted = F.col("contents") > most
    words = F.when(parted, (window - gram + 2) // 2 * window).otherwise(window + 16) * F.col("contents")
    size = keys.agg(F.sum(words).alias("n")).first()["n"] or 0
    maybe = bloom(keys, F.col("key"))

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for part in chunks(batches):
            words = Words(part.column("text"))
            text, start, windows, key = _segments(words, window, gram)
            found = in_bloom(maybe, key)
            text, start, windows, key = text[found], start[found], windows[found], key[found]
            if not len(key):
                continue
            hot = np.isin(signed(key), split)
            if hot.any():
                # every window of a split minimizer travels alone
                times = np.where(hot, windows, 1)
                inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                text, start, hot, key = np.repeat(text, times), np.repeat(start, times) + inside, np.repeat(hot, times), np.repeat(key, times)
                windows = np.where(hot, 1, np.repeat(windows, times))
            first = words.bounds[text] + start
            last = first + windows + window - 1
            content_hash = run_hashes(words.hashes, first, last)
            route = np.where(hot, mix(key ^ content_hash), key)
            packed = words.hashes.view("<u2").reshape(-1, 4)[:, :3].tobytes()
            contents = []
            if len(sent) > 200_000:
                sent.clear()
            for h, a, b in zip((route ^ mix(content_hash)).tolist(), (first * 6).tolist(), (last * 6).tolist(), strict=True):
                contents.append(None if h in sent else packed[a:b])  # the words once per task are enough
                sent.add(h)
            ids, rows = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(route)), pa.array(signed(content_hash)), pa.array(ids[text]), pa.array(rows[text]), pa.array(start.astype(np.int32)),
                 pa.array(windows.astype(np.int32)), pa.array(contents, pa.binary())], _SEGMENT)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search([b for b in batches if b.num_rows], window)

    source = docs.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("row"))
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // shard_words + 1)
    found = store(source.mapInArrow(segments, "route long, content_hash long, doc_id long, row long, start int, windows int, content binary"), "segments")
    different = found.groupBy("route", "content_hash") \
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.first("content", ignorenulls=True).alias("content"))
    judged = different.repartition(shards, "route").mapInArrow(search, "route long, content_hash long, low long, gone array<struct<first:int,last:int>>")
    judged = store(judged, "judged")
    # a segment is gone whole from all documents but its first, which loses what other segments have earlier; the join is
    # left to adaptive splitting
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("windows") + (window - 1)).alias("last")))
    gone = found.drop("content").join(judged, ["route", "content_hash"]).withColumn("gone", F.when(F.col("doc_id") > F.col("low"), whole).otherwise(F.col("gone")))
    spans = gone.select("doc_id", "row", "start", F.inline("gone")).groupBy("doc_id", "row") \
        .agg(F.collect_list(F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last"))).alias("spans"))
    return store(spans, "spans")


def _search(batches: list[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """One shard: index its segments (each is there once), search them all, and list the ranges that an earlier document
    has than the first of the segment; segments that no document loses anything of are left out."""
    if not batches:
        return
    column = lambda name: np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in batches])
    low, high = column("low"), column("high")
    contents = [b.column("content") for b in batches]
    sizes = np.concatenate([np.diff(np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, c.offset * 4)) for c in contents]).astype(np.int64) // 6
    raw = np.frombuffer(b"".join(v.as_buffer() for c in contents for v in c), "<u2").reshape(-1, 3).astype(np.int64)
    symbols = raw[:, 0] | raw[:, 1] << 16 | raw[:, 2] << 32
    index = FmIndex(symbols, np.concatenate([[0], np.cumsum(sizes)]), window)
    least, bounds = index.matching(low)

    windows = sizes - window + 1
    owner = np.repeat(np.arange(len(low)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    gone = least[bounds[owner] + inside] < low[owner]
    edge = np.ones(len(owner) + 1, bool)
    edge[1:-1] = owner[1:] != owner[:-1]
    begins = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])))
    ends = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False)))
    cuts = np.searchsorted(owner[begins], np.arange(len(low) + 1)).astype(np.int32)
    ranges = pa.StructArray.from_arrays(
        [pa.array(inside[begins].astype(np.int32)), pa.array((inside[ends] + window).astype(np.int32))], ["first", "last"])
    out = pa.RecordBatch.from_arrays(
        [pa.array(column("route")), pa.array(column("content_hash")), pa.array(low), pa.ListArray.from_arrays(pa.array(cuts), ranges)],
        ["route", "content_hash", "low", "gone"])
    yield out.filter(pa.array((low < high) | (np.diff(cuts) > 0)))


def without_repeats(docs: DataFrame, carry: list[str] = [], window: int = WINDOW, gram: int = GRAM,  # noqa: B006
                    shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: doc_id, kept, n_words, n_removed, and the columns of ``carry`` as they are.

    ``kept`` holds the words that no repeated window covers, one space between them.  Null, empty and short
    texts lose nothing; rows without an id neither lose words nor count as earlier; rows that share an id
    don't remove each other's words.  Every text is read whole.
    """
    spans = covered(docs, window, gram, shard_words)
    maybe = bloom(spans, F.col("row"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row"), F.struct(*carry, F.lit(0).alias("_")).alias("carried"))

    def picked(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
        return batch.filter(pa.array(in_bloom(maybe, batch.column("row").to_numpy(zero_copy_only=False)) == wanted))

    def losing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (part := picked(batch, True)).num_rows:
                yield part

    def untouched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from cut(picked(batch, False) for batch in batches)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = Words(part.column("text"))
            edges = np.zeros(len(words.starts) + 1, np.int64)
            if "spans" in part.schema.names:
                lists = part.column("spans").to_pylist()
                for i, spans in enumerate(lists):
                    for s in spans or ():
                        edges[words.bounds[i] + s["first"]] += 1
                        edges[words.bounds[i] + s["last"]] -= 1
            keep = np.cumsum(edges[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
            n = np.diff(words.bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), joined_words(words, keep), pa.array(n.astype(np.int64)), pa.array((n - np.diff(left)).astype(np.int64)),
                 part.column("carried")], ["doc_id", "kept", "n_words", "n_removed", "carried"])

    out = StructType().add("doc_id", "long").add("kept", "string").add("n_words", "long").add("n_removed", "long").add(rows.schema["carried"])
    # documents that certainly keep all their words don't move; the others meet their ranges, always by a shuffle: two Python
    # steps in one task would need two workers, which stay with the executor for the rest of the session
    still = rows.mapInArrow(untouched, out)
    moved = rows.mapInArrow(losing, rows.schema).join(spans.hint("merge"), ["doc_id", "row"], "left").mapInArrow(cut, out)
    result = still.unionByName(moved)
    return result.select("doc_id", "kept", "n_words", "n_removed", *[F.col(f"carried.`{c}`").alias(c) for c in carry])


def with_repeats_cut(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents, all columns: texts that lose words become what ``kept`` holds, the others stay as they are.

    ``n_chars`` follows the text.  A text that is a repeat from end to end becomes empty; its row stays.  Other columns may have
    any names.  Nulls, repeated rows and empty tables are as in ``without_repeats``.
    """
    # the columns travel as one, so their names meet none of this package's
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    left = without_repeats(whole, ["whole"], window, gram)
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept")).otherwise(F.col("whole.text")),
           "n_chars": F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col("whole.n_chars")) if "n_chars" in docs.columns else None}
    return left.select(*[(F.col(f"whole.`{c}`") if new.get(c) is None else new[c]).alias(c) for c in docs.columns])
