"""Technical indicators over bars, all in one pass of block windows."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import ratio, rnd
from tickloom.operators.ema import (
    WARMUP_ROWS, check_span, decayed_before, ema, log_add, log_decayed, seed_weight,
)
from tickloom.operators.ordered import (
    BLOCK_ROWS, bar_bucket, block_window, into_blocks, own_rows, with_positions,
)
from tickloom.schemas import INDICATORS
from tickloom.session import cut_lineage, measured

SERIES = ("ticker", "bar_interval")
_FRAME_ROWS = 32  # the longest plain frame is 30 rows, plus the row before it
_NEED_EMA = {"ema_12", "ema_26", "macd", "macd_signal", "macd_histogram", "rsi_14"}


def add_indicators(
    bars: DataFrame,
    columns: Iterable[str] = tuple(INDICATORS),
    block_rows: int = BLOCK_ROWS,
    warmup: int = WARMUP_ROWS,
) -> DataFrame:
    """Add the named columns (of ``INDICATORS`` and ``is_outlier``) to clean bars.

    Bars must be unique per ticker, interval and start, with close and volume set, as ``clean_bars``
    leaves them.  They are read twice (bucket sizes, rows), so pass a stored table rather than a long
    computation.  Everything is built in two layers of window functions over one spec, and Catalyst
    drops what ``columns`` does not ask for.
    """
    placed = with_positions(bars, SERIES, ["window_start"], bar_bucket())
    return own_rows(_computed(placed, list(columns), block_rows, warmup)).select(*bars.columns, *columns)


def _computed(placed: DataFrame, wanted: list[str], block_rows: int, warmup: int, state: DataFrame | None = None) -> DataFrame:
    """Placed rows in blocks with all indicator columns.

    With ``state`` (one row per series, see ``continue_indicators``) ``placed`` begins with the tail of each known series.  Blocks that see its
    last row start their averages there with the stored values; what older moves leave of the RSI sums fades from it.
    """
    back = warmup if _NEED_EMA & set(wanted) else _FRAME_ROWS
    blocks = into_blocks(placed, back=back, block_rows=block_rows)
    if state is not None:
        blocks = blocks.withColumn("_series", _key()).join(measured(state.select(_key().alias("_series"), *[F.col(c).alias(f"_s_{c}") for c in _STATE]), "state"), "_series", "left")
    if back == warmup:
        for span in (9, 12, 26):
            check_span(span, block_rows, warmup)

    first = F.greatest(F.lit(0), F.col("block") * block_rows - back)
    blocks = blocks.withColumn("_row", F.col("pos") - first)
    index = F.col("_row") - (block_rows + back) // 2
    over = block_window(SERIES)

    close, volume = F.col("close"), F.col("volume").cast("double")
    week, month, last20 = (over.rowsBetween(-n, 0) for n in (6, 29, 19))
    earlier20 = over.rowsBetween(-20, -1)

    def has(rows: int) -> Column:
        """The series is long enough for a full frame; until then the average is NULL."""
        return F.col("pos") >= rows

    starts = F.col("_row") == 1
    carried = F.lit(False)
    if state is not None:
        carried = F.coalesce(first < F.col("_s_rows"), F.lit(False))
        starts = F.when(carried, F.col("pos") == F.col("_s_rows")).otherwise(starts)

    def since(value: Column, before: str) -> Column:
        """The value from the stored row on, where that stands for all rows before it."""
        if state is None:
            return value
        return F.when(~carried | (F.col("pos") > F.col("_s_rows")), value).when(F.col("pos") == F.col("_s_rows"), F.col(f"_s_{before}"))

    # layer 1: windows over close and volume.  Each function is its own column, so that none is
    # evaluated twice; rounding and null rules come after.
    layer1 = blocks.withColumns({
        "_previous": F.lag("close").over(over),
        "_avg7": F.avg(close).over(week), "_avg30": F.avg(close).over(month),
        "_avg20": F.avg(close).over(last20), "_std20": F.stddev_samp(close).over(last20),
        "_vol_avg20": F.avg(volume).over(last20), "_vol_std20": F.stddev_samp(volume).over(last20),
        "_mean": F.avg(close).over(earlier20), "_deviation": F.stddev_samp(close).over(earlier20),
        "_ema12": ema(since(close, "ema12"), 12, over, index, starts), "_ema26": ema(since(close, "ema26"), 26, over, index, starts),
    })

    # plain columns between the layers; every stage reads the rounded one before it
    delta = close - F.col("_previous")
    new = F.lit(True) if state is None else ~carried | (F.col("pos") > F.col("_s_rows"))
    far = F.abs(close - F.col("_mean")) > 3 * F.col("_deviation")
    rounded = layer1.withColumns({
        "_return": ratio(close, F.col("_previous")) - 1,
        "_gain": F.when(delta.isNotNull() & new, F.greatest(delta, F.lit(0.0))),
        "_loss": F.when(delta.isNotNull() & new, F.greatest(-delta, F.lit(0.0))),
        "sma_7": F.when(has(7), rnd(F.col("_avg7"), 4)),
        "sma_30": F.when(has(30), rnd(F.col("_avg30"), 4)),
        "ema_12": rnd(F.col("_ema12"), 4),
        "ema_26": rnd(F.col("_ema26"), 4),
        "bb_middle": F.when(has(20), rnd(F.col("_avg20"), 4)),
        "_score": F.when(has(20), ratio(volume - F.col("_vol_avg20"), F.col("_vol_std20"))),
        "is_outlier": F.coalesce((F.col("_deviation") > 0) & far, F.lit(False)),
    })
    between = rounded.withColumns({
        "daily_return_pct": rnd(F.col("_return") * 100, 4),
        "macd": rnd(F.col("ema_12") - F.col("ema_26"), 4),
        "bb_upper": rnd(F.col("bb_middle") + 2 * F.col("_std20"), 4),
        "bb_lower": rnd(F.col("bb_middle") - 2 * F.col("_std20"), 4),
        "volume_zscore": rnd(F.col("_score"), 4),
    })

    # layer 2: windows over layer 1
    layer2 = between.withColumns({
        "_ret_n7": F.count("_return").over(week), "_ret_std7": F.stddev_samp("_return").over(week),
        "_signal": ema(since(F.col("macd"), "signal"), 9, over, index, starts),
        "_up": log_decayed(F.col("_gain") * seed_weight(14), 14, over, index),
        "_down": log_decayed(F.col("_loss") * seed_weight(14), 14, over, index),
    })
    if "rsi_14" in wanted:
        # the averages are a common factor of these sums; what lies before a block's rows is added as it really is
        rows = placed if state is None else placed.filter("not _tail or _last")
        earlier = decayed_before(rows, SERIES, 14, block_rows, back)
        layer2 = layer2.withColumn("series", _key()).join(earlier, ["series", "block"], "left").drop("series")
        if state is not None:
            gap = (first + 1 - F.col("_s_rows")) * math.log(1.0 - 2.0 / 15)
            layer2 = layer2.withColumns({f"_{c}_before": log_add(F.col(f"_{c}_before"), F.col(f"_s_{c}") + gap) for c in ("up", "down")})
    else:
        layer2 = layer2.withColumns({"_up_before": F.lit(None).cast("double"), "_down_before": F.lit(None).cast("double")})
    fade = (F.col("_row") - 1) * math.log(1.0 - 2.0 / 15)
    layer2 = layer2.withColumns({f"_all_{c}": log_add(F.col(f"_{c}"), F.col(f"_{c}_before") + fade) for c in ("up", "down")})
    strength = F.exp(F.col("_all_up") - F.col("_all_down"))
    falls = F.col("_all_down").isNotNull()
    return layer2.withColumns({
        "volatility_7d": F.when(F.col("_ret_n7") == 7, rnd(F.col("_ret_std7"), 6)),
        "macd_signal": rnd(F.col("_signal"), 4),
        # NULL, not 100, while there has been no loss; without a gain the strength is zero
        "_rsi": F.when(falls, 100 - 100 / (1 + F.coalesce(strength, F.lit(0.0)))),
    }).withColumns({
        "rsi_14": rnd(F.col("_rsi"), 4),
        "macd_histogram": rnd(F.col("macd") - F.col("macd_signal"), 4),
    })


# --- one batch after the other ---------------------------------------------------------------

_STATE = ("rows", "last_start", "ema12", "ema26", "signal", "up", "down", "tail")
_TAIL = ("pos", "window_start", "close", "volume")


def _key() -> Column:
    return F.struct(*[F.col(k) for k in SERIES], F.lit(0).alias("_all"))


def split_late(bars: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars of series that only go on after what ``state`` has seen, and bars of series with a bar at or before its last one.

    The second lot cannot be continued: such a series is computed anew from its first bar.
    """
    seen = measured(state.select(_key().alias("_series"), F.col("last_start").alias("_last_start")), "seen")
    keyed = bars.withColumn("_series", _key())
    late = keyed.join(seen, "_series").filter(F.col("window_start") <= F.col("_last_start")).select("_series").distinct()
    late = measured(late, "late-series")
    return keyed.join(late, "_series", "left_anti").drop("_series"), keyed.join(late, "_series", "left_semi").drop("_series")


def continue_indicators(
    bars: DataFrame, state: DataFrame | None = None, columns: Iterable[str] = ("is_outlier", *INDICATORS),
    block_rows: int = BLOCK_ROWS, warmup: int = WARMUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Indicators of a batch of clean bars that follow those ``state`` stands for, and the state after them; both stored.

    Without ``state`` the batch is the beginning.  A state is one row per series: its length, the three averages, the logarithms of the decayed
    rises and falls, and its last ``33`` bars; a run reads the batch and that, not the history.  Bars must be later than
    the state's (see ``split_late``), unique per key and stored.  Series without bars in the batch keep their state; any
    split of a history into batches gives what one run over all of it gives.
    """
    names = list(dict.fromkeys([*columns, *_NEED_EMA]))
    placed = with_positions(bars, SERIES, ["window_start"], bar_bucket()).withColumns({"_tail": F.lit(False), "_last": F.lit(False)})
    if state is not None:
        seen = measured(state.select(_key().alias("_series"), F.col("rows").alias("_rows")), "seen")
        placed = placed.withColumn("_series", _key()).join(seen, "_series", "left").withColumn("pos", F.col("pos") + F.coalesce("_rows", F.lit(0))).drop("_series", "_rows")
        # only series of this batch need their tails
        tails = state.withColumn("_series", _key()).join(measured(bars.select(_key().alias("_series")).distinct(), "batch-series"), "_series", "left_semi") \
            .select(*SERIES, "rows", F.inline("tail")).withColumns({"_tail": F.lit(True), "_last": F.col("pos") == F.col("rows")}).drop("rows")
        placed = cut_lineage(placed.unionByName(tails, allowMissingColumns=True), "placed")
    done = _computed(placed, names, block_rows, warmup, state).filter("in_block and not _tail")
    raw = ["_ema12", "_ema26", "_signal", "_all_up", "_all_down"]
    stored = cut_lineage(done.select(*bars.columns, "pos", *names, *raw), "indicators")
    tail = F.slice(F.reverse(F.array_sort(F.col("_bars"))), 1, _FRAME_ROWS + 1)
    # the last rows of a series: per task a few, then a few of each; ranks are limits ahead of the shuffle
    rank = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("pos")))
    latest = stored.select(*SERIES, *_TAIL, *raw).withColumn("_rank", rank).filter(F.col("_rank") <= _FRAME_ROWS + 1)
    ends = latest.groupBy(*SERIES).agg(
        F.max("pos").alias("rows"), F.max("window_start").alias("last_start"),
        *[F.max_by(c, "pos").alias(n) for c, n in zip(raw, ("ema12", "ema26", "signal", "up", "down"))], F.collect_list(F.struct(*_TAIL)).alias("_bars"))
    if state is not None:
        old = state.select(*SERIES, *[F.col(c).alias(f"_s_{c}") for c in _STATE])
        on = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in SERIES]
        both = ends.alias("n").join(old.alias("o"), on[0] & on[1], "full")
        bars_ = F.concat(F.coalesce(F.col("_s_tail"), F.array().cast(state.schema["tail"].dataType)), F.coalesce(F.col("_bars"), F.array().cast(state.schema["tail"].dataType)))
        ends = both.select(
            *[F.when(F.col("rows").isNotNull(), F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in SERIES],
            *[F.when(F.col("rows").isNotNull(), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in _STATE[:-1]], bars_.alias("_bars"))
    return stored.select(*bars.columns, *columns), cut_lineage(ends.select(*SERIES, *_STATE[:-1], tail.alias("tail")), "series-state")


def flag_outliers(bars: DataFrame) -> DataFrame:
    """Close further than three deviations from the mean of up to 20 earlier rows."""
    return add_indicators(bars, ["is_outlier"])


def partial_sma(bars: DataFrame, rows: int = 10, name: str = "sma_10") -> DataFrame:
    """Moving average that starts with shorter frames instead of NULLs."""
    placed = with_positions(bars, SERIES, ["window_start"], bar_bucket())
    blocks = into_blocks(placed, back=rows - 1)
    frame = block_window(SERIES).rowsBetween(-(rows - 1), 0)
    averaged = blocks.withColumn("_mean", F.avg("close").over(frame)).withColumn(name, rnd(F.col("_mean"), 4))
    return own_rows(averaged, "pos", "series_rows", "_mean")
