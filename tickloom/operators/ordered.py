"""Ordered series without one task per series.

A window partitioned by ticker alone puts all bars of a ticker into one task.  Here a series is
cut into blocks of equal length: every row gets its exact position in the series, the position
gives the block, and rows next to a block edge are copied into the neighbour so that each frame
finds the rows it needs.  Windows then run per (series, block), a few thousand rows at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def bar_bucket() -> Column:
    """Coarse time bucket of a bar: at most 366 daily or 44,640 one-minute bars per ticker."""
    start = F.col("window_start")
    return F.when(F.col("bar_interval") == "1d", F.date_trunc("year", start)) \
        .otherwise(F.date_trunc("month", start))


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    bucket: Column,
    position: str = "pos",
    total: str = "series_rows",
) -> DataFrame:
    """Add the 1-based position of each row in its series and the length of the series.

    ``bucket`` must not decrease along ``order_by``.  Rows are numbered inside (series, bucket),
    and the short list of bucket sizes gives the offset of each bucket.  No series is gathered:
    the widest group is one bucket.  The numbering and the join with the offsets share one
    exchange on (series, bucket).  Keys are compared as one struct, in which nulls are equal, so
    a null key is a series of its own and no row is lost.
    """
    series = F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_all"))
    rows = df.withColumn("_part", F.struct(series.alias("series"), bucket.alias("bucket")))

    # partial counts first, so what is shuffled is one row per (series, bucket)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_part.series")
    before = whole.orderBy("_part.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias(total),
    )

    inside = Window.partitionBy("_part").orderBy(*order_by)
    return (
        rows.withColumn("_in_bucket", F.row_number().over(inside))
        .join(offsets, "_part", "left")
        .withColumn(position, F.col("_offset") + F.col("_in_bucket"))
        .drop("_part", "_offset", "_in_bucket")
    )


def into_blocks(
    df: DataFrame,
    back: int = 0,
    ahead: int = 0,
    block_rows: int = BLOCK_ROWS,
    position: str = "pos",
) -> DataFrame:
    """Assign rows to blocks and copy edge rows into the neighbouring blocks.

    Each block sees ``back`` rows before its first and ``ahead`` rows after its last row.  Copies
    have ``in_block`` false and are dropped once the windows are computed.
    """
    if max(back, ahead) > block_rows:
        raise ValueError("a block must be at least as long as the rows it lends")
    at = F.pmod(F.col(position) - 1, F.lit(block_rows))
    home = F.expr(f"({position} - 1) div {block_rows}")
    targets = [home]
    if back:
        targets.append(F.when(at >= block_rows - back, home + 1))
    if ahead:
        targets.append(F.when((at < ahead) & (home > 0), home - 1))
    return (
        df.withColumn("_home", home)
        .withColumn("block", F.explode(F.array_compact(F.array(*targets))))
        .withColumn("in_block", F.col("block") == F.col("_home"))
        .drop("_home")
    )


def block_window(keys: Sequence[str], position: str = "pos") -> WindowSpec:
    """The one window spec that all indicators of a pass share: one exchange, one sort."""
    return Window.partitionBy(*keys, "block").orderBy(position)


def own_rows(df: DataFrame, *extra: str) -> DataFrame:
    """Drop the copied edge rows and the bookkeeping columns."""
    return df.filter("in_block").drop("block", "in_block", *extra)
