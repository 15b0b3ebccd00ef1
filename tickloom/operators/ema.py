"""Exponential moving average as a running sum.

``e[t] = a*x[t] + (1-a)*e[t-1]`` unrolls to ``sum(a * x[i] * r**(t-i))`` with ``r = 1-a``, that is
``r**t * sum(y[i] * r**-i)``: a running sum over a window, with no state and no Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.session import measured

#: Rows of history a block gets in front of its own.  What a longer history could still add to an
#: average is below r**1024 of the value (6e-35 for the longest span, 26), far under one bit of a
#: double; the 9-row average of the averages needs another 200 rows, which the margin covers.
#: A ratio of two averages has no such bound: both may decay alike.  It gets the true state of
#: all earlier rows, see ``decayed_before``.
WARMUP_ROWS = 1024


def check_span(span: int, block_rows: int, warmup: int) -> None:
    """Refuse block lengths for which a span's powers leave the range of a double, or a warm-up too short to be exact."""
    r = 1.0 - 2.0 / (span + 1)
    if r ** ((block_rows + warmup) // 2 + 1) < 1e-250:
        raise ValueError(f"blocks of {block_rows} rows are too long for a span of {span}")
    if r ** warmup > 1e-17 and block_rows > warmup:
        raise ValueError(f"a warm-up of {warmup} rows is too short for a span of {span}")


def ema(value: Column, span: int, over: WindowSpec, index: Column, seed: Column) -> Column:
    """EMA of ``value`` with ``a = 2/(span+1)``.

    ``seed`` marks the first non-null value of the window partition, which starts the average; rows
    before it give null, and nulls after it are not supported.  ``index`` counts the rows of the
    partition, centred near zero so that the powers stay within double range: blocks of 4096 rows
    plus the warm-up keep r**index above 1e-250 for every span from 9 up.
    """
    a = 2.0 / (span + 1)
    r = 1.0 - a
    running = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one power divides and multiplies, so its rounding error cancels however large the index is
    power = F.pow(F.lit(r), index)
    return F.sum(F.when(seed, value).otherwise(value * a) / power).over(running) * power


def seed_weight(span: int) -> Column:
    """The first move of a series, into its second row, starts the averages and counts ``1 / a`` times as much as a later one."""
    return F.when(F.col("pos") == 2, (span + 1) / 2).otherwise(1.0)


def log_add(a: Column, b: Column) -> Column:
    """``log(exp(a) + exp(b))``; null stands for the logarithm of zero."""
    high, low = F.greatest(a, b), F.least(a, b)
    return F.when(a.isNull() | b.isNull(), high).otherwise(high + F.log1p(F.exp(low - high)))


def log_decayed(value: Column, span: int, over: WindowSpec, index: Column) -> Column:
    """Logarithm of ``sum(value[i] * r**(t-i))`` over the rows of the partition so far; null while that is zero."""
    r = 1.0 - 2.0 / (span + 1)
    total = F.sum(value * F.pow(F.lit(r), -index)).over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.when(total > 0, F.log(total) + index * math.log(r))


def decayed_before(
    placed: DataFrame, keys: Sequence[str], span: int, block_rows: int, back: int, rises: str = "close",
) -> DataFrame:
    """(series, block, _up_before, _down_before): the logarithms, at the first row a block sees, of the decayed sums of all
    rises and falls of ``rises`` up to and into that row.

    ``placed`` has positions.  Rows fold into one line per stretch of ``block_rows`` rows; a prefix scan by doubling over
    these lines carries the state on, in logarithms, so that it never vanishes however long nothing moves.
    """
    r = 1.0 - 2.0 / (span + 1)
    if r ** block_rows < 1e-290:
        raise ValueError(f"blocks of {block_rows} rows are too long for a span of {span}")
    stretch = F.expr(f"(pos - 1 + {back}) div {block_rows}")
    rows = placed.select(F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_all")).alias("series"),
                         "pos", F.col(rises).alias("_x")).withColumn("stretch", stretch)
    w = Window.partitionBy("series", "stretch").orderBy("pos")
    age = (F.col("stretch") + 1) * block_rows - back - F.col("pos")
    moved = rows.withColumn("_d", (F.col("_x") - F.lag("_x").over(w)) * seed_weight(span))
    folded = moved.groupBy("series", "stretch").agg(
        F.sum(F.greatest(F.col("_d"), F.lit(0.0)) * F.pow(F.lit(r), age)).alias("up"),
        F.sum(F.greatest(-F.col("_d"), F.lit(0.0)) * F.pow(F.lit(r), age)).alias("down"),
        F.min_by("_x", "pos").alias("first"), F.max_by("_x", "pos").alias("last"), F.min("pos").alias("start"))
    line = Window.partitionBy("series").orderBy("stretch")
    step = F.col("first") - F.lag("last").over(line)  # the move into a stretch belongs to it
    weight = F.pow(F.lit(r), (F.col("stretch") + 1) * block_rows - back - F.col("start"))
    folded = folded.withColumn("_step", step * F.when(F.col("start") == 2, (span + 1) / 2).otherwise(1.0))
    up = F.coalesce("up", F.lit(0.0)) + F.coalesce(F.greatest(F.col("_step"), F.lit(0.0)) * weight, F.lit(0.0))
    down = F.coalesce("down", F.lit(0.0)) + F.coalesce(F.greatest(-F.col("_step"), F.lit(0.0)) * weight, F.lit(0.0))
    logs = {name: F.when(x > 0, F.log(x)) for name, x in (
        ("up", up), ("down", down), ("step_up", F.greatest(F.col("_step"), F.lit(0.0))), ("step_down", F.greatest(-F.col("_step"), F.lit(0.0))))}
    state = measured(folded.select("series", "stretch", *[x.alias(name) for name, x in logs.items()]), "decayed")
    longest = state.agg(F.max("stretch").alias("n")).first()["n"] or 0
    reach = 1
    while reach <= longest:
        fade = reach * block_rows * math.log(r)
        state = state.withColumns({c: log_add(F.col(c), F.lag(c, reach).over(line) + fade) for c in ("up", "down")})
        reach *= 2
    # what a block's first row has behind it: the state of the stretch before, and the move into that row
    return measured(state.select("series", F.col("stretch").alias("block"), *[
        log_add(F.lag(c).over(line) + math.log(r), F.col(f"step_{c}")).alias(f"_{c}_before") for c in ("up", "down")]), "decayed-before")
