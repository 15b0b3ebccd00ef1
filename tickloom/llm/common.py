"""Reading, storing, word hashing and the order of rows, shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import cut_lineage as store  # noqa: F401  written to spark.checkpoint.dir and read back
from tickloom.session import shared_dir  # noqa: F401

#: Text bytes handled at once inside a task; a longer single text is handled alone.
CHUNK_BYTES = 1 << 20
#: Bytes of a batch between Spark and a Python worker (one row at least).  Both sides keep buffers of the largest batch they had.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Python workers of a session that was started elsewhere learn where this package lies, and its batches are
    bounded by bytes: 10,000 texts can be any size.  Shuffle files go when the query that made them ends, not when the driver
    happens to collect its garbage: operators store what later steps read.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- batches ---------------------------------------------------------------------------------


def chunks(batches: Iterable[pa.RecordBatch], text: int | str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(_offsets(batch.column(text)))
        part = np.cumsum(sizes) // limit
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array and the n + 1 offsets of the texts; null is an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    at = _offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column out of flat values and n + 1 bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def joined_words(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of every text, one space between them."""
    n = len(words.bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(words.bounds))[keep]
    starts, ends = words.starts[keep], words.ends[keep]
    edges = np.zeros(len(words.raw) + 1, np.int8)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    out = words.raw.copy()
    # a word that is followed by another kept one in its text has a blank behind it
    blank = ends[:-1][owner[:-1] == owner[1:]]
    mask[blank] = True
    out[blank] = 0x20
    at = np.concatenate([[0], np.cumsum(mask)])[words.at].astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(at.tobytes()), pa.py_buffer(out[mask].tobytes()))


# --- words -----------------------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SIGNS = _SPACE.copy()
_SIGNS[:128] = [not chr(c).isalnum() for c in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240611).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = -(-n // (CHUNK_BYTES // 4)) * (CHUNK_BYTES // 4)
        for name, base in (("up", int(_POWER)), ("down", pow(int(_POWER), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run ``values[start:end]``: one running sum of value * power**index for all."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts: byte ranges, 64-bit hashes, and n + 1 bounds by text.

    With ``punctuation``, ASCII punctuation parts words too.
    """

    def __init__(self, column: pa.Array, lower: bool = False, punctuation: bool = False):
        self.raw, self.at = text_bytes(column)
        self.raw_lower = raw = _LOWER[self.raw] if lower else self.raw
        inside = ~(_SIGNS if punctuation else _SPACE)[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.at] = True
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.bounds = np.searchsorted(self.starts, self.at)
        self.hashes = run_hashes(_BYTE[raw], self.starts, self.ends)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words inside a text, and their n + 1 bounds by text."""
        count = np.maximum(np.diff(self.bounds) - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(count)])
        first = np.repeat(self.bounds[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
        return run_hashes(self.hashes, first, first + n), bounds

    def text_hashes(self) -> np.ndarray:
        return run_hashes(_BYTE[self.raw], self.at[:-1], self.at[1:])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- a filter of fixed size ------------------------------------------------------------------

#: Bits of the filter: 4 MB however many keys it holds.  With more keys it lets more through; what it
#: stops is certainly not among the keys, so it only saves work and never decides.
BLOOM_BITS = 25


def bloom(keys: DataFrame, hashed: Column, bits: int = BLOOM_BITS) -> np.ndarray:
    """Bloom filter of 64-bit hashes, folded by Spark into at most 2**bits / 64 rows before it is fetched."""
    spots = keys.select(F.explode(F.array(*[F.shiftrightunsigned(hashed, s).bitwiseAND((1 << bits) - 1) for s in (0, 32)])).alias("spot"))
    folded = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
    got = folded.toPandas()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return words.view(np.uint64)


def in_bloom(words: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes may be among those of the filter."""
    h = hashed.view(np.uint64)
    mask = np.uint64(len(words) * 64 - 1)
    found = np.ones(len(h), bool)
    for s in (0, 32):
        spot = (h >> np.uint64(s)) & mask
        found &= (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def flagged(rows: DataFrame, hashed: str, keys: DataFrame, name: str, bits: int = 22) -> DataFrame:
    """Adds ``name``: whether the row's 64-bit hash may be among those of ``keys`` (same column), by DataFrame functions.

    A Bloom filter as a table of at most 2**bits / 64 rows, so its broadcast is bounded whatever the keys are.
    """
    spot = lambda s: F.shiftrightunsigned(hashed, s).bitwiseAND((1 << bits) - 1)
    spots = keys.select(F.explode(F.array(spot(0), spot(32))).alias("spot"))
    table = store(spots.groupBy(F.shiftright("spot", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("_bits")), "sieve")
    rows = rows.withColumn(name, F.lit(True))
    for s in (0, 32):
        hit = F.call_function("getbit", F.col("_bits"), spot(s).bitwiseAND(63).cast("int")) == 1
        rows = rows.join(F.broadcast(table), F.shiftright(spot(s), 6) == F.col("_word"), "left") \
            .withColumn(name, F.col(name) & F.coalesce(hit, F.lit(False))).drop("_word", "_bits")
    return rows


def sieve(rows: DataFrame, hashed: str, keys: DataFrame, bits: int = 22) -> DataFrame:
    """Rows whose 64-bit hash may be among those of ``keys`` (same column); an exact join follows."""
    return flagged(rows, hashed, keys, "_maybe", bits).filter("_maybe").drop("_maybe")


# --- connected components --------------------------------------------------------------------


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the links; only nodes with a link are listed.

    Each round gives the smallest label of labels next to a node to the node and to its old label, and halves
    the paths, so whole trees hang onto smaller ones and the rounds grow with the logarithm of a chain's length.
    Labels only fall, and the loop ends when none fell.  Aggregates fold before the shuffle, joins are
    left to adaptive splitting, and every round is two stored tables.
    """
    both = store(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))).filter("u <> v").distinct(), "links")
    labels = store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")), "labels")
    while True:
        # a label is itself a node: its label is known too
        up = labels.select(F.col("u").alias("l"), F.col("l").alias("up"))
        step = store(labels.join(up, "l").select("u", "l", "up"), "labels")
        near = both.join(step.select(F.col("u").alias("v"), "up"), "v").groupBy("u").agg(F.min("up").alias("near"))
        lower = step.join(near, "u").select("u", "l", F.least("up", "near").alias("new"))
        # ``old`` comes from a node's own row only
        told = lower.select(F.inline(F.array(F.struct("u", F.col("l").alias("old"), "new"), F.struct(F.col("l").alias("u"), F.lit(None).cast("long").alias("old"), "new"))))
        step = store(told.groupBy("u").agg(F.max("old").alias("old"), F.min("new").alias("l")), "labels")
        moved = step.filter("l <> old").limit(1).count()
        labels = step.select("u", "l")
        if not moved:
            return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))


# --- rows in order ---------------------------------------------------------------------------


def ordered_buckets(df: DataFrame, key: str, buckets: int | None = None) -> Column:
    """Bucket number of ``key`` such that buckets follow the order of the key and hold about as many rows.

    The cut points are approximate quantiles; their number is fixed by the shuffle width, not by the data.
    """
    n = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = df.agg(F.percentile_approx(F.col(key), [i / n for i in range(1, n)], 20 * n).alias("q")).first()
    cuts = sorted(set(row["q"] or []))
    if not cuts:
        return F.lit(0)
    # binary search: the largest number of cut points that are all at or below the key; null comes first
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    points = F.array(*[F.lit(c) for c in cuts])
    here = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.col(key) >= F.get(points, at + step - 1)), at + step).otherwise(at))
    return F.coalesce(here, F.lit(0))


def running(sizes: DataFrame, parts: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Exclusive running sum of a small table of group sizes."""
    w = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))
