"""As-of join: each row with the last known value of its series, or the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import BLOCK_ROWS, block_window, with_positions
from tickloom.session import cut_lineage

DAY_US = 86_400_000_000


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str],
    forward: bool = False, exact: bool = True, bucket_us: int = DAY_US, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row of ``left`` with ``values`` of the row of ``right`` that has its keys and is nearest before it in time
    (after it with ``forward``); a row at the same time counts if ``exact``.

    Both sides are put into one order and cut into blocks; a value is carried through its block, and the last value of
    each block through the short list of blocks.  So neither a gap nor a hot series adds rows or gathers one in a task;
    ``bucket_us`` is the span of time whose rows of one series may be sorted together.  No row of ``left`` is lost or
    repeated.  Null keys and times match nothing.  Of rows of ``right`` with equal keys and time the one with the
    greatest values counts.
    """
    clash = [v for v in values if v in left.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    sign = -1 if forward else 1

    def ordered(df: DataFrame, time: str, side: int, row, value) -> DataFrame:
        at = F.unix_micros(F.col(time).cast("timestamp")) * sign
        return df.select(F.struct(*keys).alias("_k"), at.alias("_at"), F.lit(side).alias("_side"), row.alias("_row"), value.alias("_value"))

    row, value = F.struct(*left.columns), F.struct(*values)
    no_row = F.lit(None).cast(left.select(row.alias("s")).schema["s"].dataType)
    no_value = F.lit(None).cast(right.select(value.alias("s")).schema["s"].dataType)
    known = right.dropna("any", subset=[*keys, right_time])
    # among rows of one time a value comes before the rows that may see it
    rows = ordered(left, left_time, 1, row, no_value).union(ordered(known, right_time, 0 if exact else 2, no_row, value))
    placed = with_positions(rows, ["_k"], ["_at", "_side", "_value"], F.floor(F.col("_at") / bucket_us)) \
        .withColumn("block", F.expr(f"(pos - 1) div {block_rows}"))
    sofar = block_window(["_k"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = placed.withColumn("_seen", F.last("_value", ignorenulls=True).over(sofar))
    seen = cut_lineage(seen.select("_k", "_side", "_row", "_seen", "pos", "block"), "as-of")
    # the last row of a full block hands its value on to the next block
    ends = seen.filter(F.pmod("pos", F.lit(block_rows)) == 0).select("_k", (F.col("block") + 1).alias("block"), F.col("_seen").alias("_end"))
    carried = ends.withColumn("_end", F.last("_end", ignorenulls=True).over(
        Window.partitionBy("_k").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = seen.filter("_side = 1").join(carried, ["_k", "block"], "left").withColumn("_found", F.coalesce("_seen", "_end"))
    return found.select(*[F.col("_row")[c].alias(c) for c in left.columns], *[F.col("_found")[v].alias(v) for v in values])
