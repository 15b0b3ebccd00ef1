"""Sharding along a Hilbert curve: rows near in several metadata dimensions land in the same shard.

Every dimension is quantised to a few levels, the cell of a row gives its place on the curve, rows
are put in order of (curve, row hash, doc_id) and the order is cut into runs, one per shard.  A file
written per run then covers a compact box, so that a reader can skip it by the minimum and maximum
of any of the dimensions.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import running

BITS = 3  # per dimension; four dimensions make 4,096 cells


def curve_index(cell: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the Hilbert curve.

    The cube is split in halves along every axis; the Gray code of the halves gives the digit, and
    the frame (a reflection and a rotation of the axes) is carried into the next level.
    """
    dims = len(cell)
    start, turn, index = 0, 0, 0
    for level in reversed(range(bits)):
        halves = sum(((x >> level) & 1) << i for i, x in enumerate(cell))
        seen = _rotate(halves ^ start, -(turn + 1), dims)
        digit = seen
        shift = 1
        while shift < dims:  # inverse Gray code
            digit ^= digit >> shift
            shift *= 2
        index = index << dims | digit
        entry = 0 if digit == 0 else _gray(2 * ((digit - 1) // 2))
        start ^= _rotate(entry, turn + 1, dims)
        low = digit if digit % 2 else digit - 1  # the axis along which the sub-cube is crossed
        turn = (turn + (0 if digit == 0 else _ones(low)) + 1) % dims
    return index


def _gray(x: int) -> int:
    return x ^ x >> 1


def _ones(x: int) -> int:
    """Number of one bits at the end."""
    return ((x ^ x + 1) >> 1).bit_length()


def _rotate(x: int, left: int, dims: int) -> int:
    left %= dims
    return (x << left | x >> dims - left) & (1 << dims) - 1


def hilbert(levels: list[Column], bits: int = BITS) -> Column:
    """Curve index of quantised columns: looked up in a table of all cells, built from the rule."""
    dims = len(levels)
    if dims * bits > 12:
        raise ValueError("at most 4,096 cells")
    side = (1 << bits) - 1
    cells = [curve_index(tuple(c >> bits * i & side for i in range(dims)), bits) for c in range(1 << dims * bits)]
    at = sum((F.least(F.greatest(level, F.lit(0)), F.lit(side)).cast("int") * (1 << bits * i) for i, level in enumerate(levels)), F.lit(0))
    return F.get(F.array(*[F.lit(c) for c in cells]), at)


def document_levels(df: DataFrame, bits: int = BITS) -> list[Column]:
    """Four dimensions of a document: id range, length (logarithmic), language, source; null counts as lowest."""
    n = 1 << bits
    span = df.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = float(span["low"] or 0), float(span["high"] or 0)
    ids = F.floor((F.coalesce(F.col("doc_id"), F.lit(int(low))).cast("double") - low) * n / (high - low + 1))
    length = F.floor(F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1) * n / 20)
    named = [F.pmod(F.crc32(F.coalesce(F.col(c), F.lit(""))), F.lit(n)) for c in ("lang", "source")]
    return [ids, length, *named]


def hilbert_shards(rows: DataFrame, curve: Column, shards: int, tie: list[str], buckets: int | None = None) -> DataFrame:
    """Adds ``shard``, ``slot`` (gapless from 0 in each shard) and ``curve``; sizes of shards differ by one row at most.

    Rows of one cell are dealt to hash buckets of ``tie`` and numbered there, so a cell with most of
    the rows is spread over all tasks; counts per bucket, then per cell, give the offsets.  The only
    single task sees one row per cell, 4,096 at most.  Equal rows take any order among themselves; an
    empty table gives an empty result; nulls in ``tie`` come first.
    """
    n = buckets or max(64, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("curve", curve).withColumn("_b", F.pmod(F.xxhash64(*tie), F.lit(n)))
    counts = rows.groupBy("curve", "_b").agg(F.count(F.lit(1)).alias("_n"))
    inner = running(counts, ["curve"], ["_b"], "_n", "_before").drop("_n")
    cells = counts.groupBy("curve").agg(F.sum("_n").alias("_n"))
    cells = running(cells, [], ["curve"], "_n", "_start").withColumn("_all", F.sum("_n").over(Window.partitionBy())).drop("_n")
    shard = F.expr(f"_rank * {shards} div _all")
    return (
        rows.join(inner, ["curve", "_b"]).withColumn("_in", F.row_number().over(Window.partitionBy("curve", "_b").orderBy(*tie)))
        .join(F.broadcast(cells), "curve")
        .withColumn("_rank", F.col("_start") + F.col("_before") + F.col("_in") - 1)
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_rank") - F.expr(f"(shard * _all + {shards - 1}) div {shards}"))
        .drop("_b", "_before", "_start", "_all", "_in", "_rank")
    )


def document_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Placement of every document by law ``rows``: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    Null text counts as no bytes.  Only these narrow columns are shuffled.
    """
    docs = docs.select("doc_id", "text", "lang", "source")
    curve = hilbert(document_levels(docs))
    narrow = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), curve.alias("_curve"))
    placed = hilbert_shards(narrow, F.col("_curve"), shards, ["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """Documents as Parquet, one folder per shard, rows in the order of the curve inside files of bounded size.

    ``doc_id`` and the text must name a row; equal rows are written as often as they occur.
    """
    placed = document_shards(docs, shards).select("doc_id", "text_crc32", "shard", "slot", "curve") \
        .withColumn("_copy", F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy("slot")))
    rows = docs.withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")))) \
        .withColumn("_copy", F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy(F.lit(1))))
    on = [rows[c].eqNullSafe(placed[c]) for c in ("doc_id", "text_crc32", "_copy")]
    joined = rows.join(placed, on).select(*[rows[c] for c in docs.columns], placed["shard"], placed["slot"], placed["curve"])
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").option("maxRecordsPerFile", 1_000_000).parquet(path)
