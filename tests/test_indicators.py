import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import as_dicts, bars, plan
from tickloom.operators import indicators as I
from tickloom.operators.ordered import block_window, into_blocks, own_rows, with_positions
from tickloom.schemas import INDICATORS

LENGTHS = [1, 2, 6, 7, 8, 19, 20, 21, 30, 31, 90]


def walk(n, seed):
    rng = random.Random(seed)
    price, out = 100.0, []
    for _ in range(n):
        price = max(1.0, price + rng.gauss(0, 2))
        out.append((round(price, 2), rng.randrange(1, 1000)))
    return out


def expected(frame):
    """Plain pandas version of every indicator for one ticker."""
    close, volume = frame["close"], frame["volume"].astype(float)
    out = pd.DataFrame(index=frame.index)
    change = close.pct_change()
    out["daily_return_pct"] = (change * 100).round(4)
    for n in (7, 30):
        out[f"sma_{n}"] = close.rolling(n).mean().round(4)
    for n in (12, 26):
        out[f"ema_{n}"] = close.ewm(span=n, adjust=False).mean().round(4)
    out["macd"] = (out.ema_12 - out.ema_26).round(4)
    out["macd_signal"] = out.macd.ewm(span=9, adjust=False).mean().round(4)
    out["macd_histogram"] = (out.macd - out.macd_signal).round(4)
    step = close.diff()
    up = step.clip(lower=0).ewm(span=14, adjust=False).mean()
    down = (-step.clip(upper=0)).ewm(span=14, adjust=False).mean()
    out["rsi_14"] = (100 - 100 / (1 + up / down.where(down != 0))).round(4)
    out["bb_middle"] = close.rolling(20).mean().round(4)
    spread = 2 * close.rolling(20).std()
    out["bb_upper"], out["bb_lower"] = (out.bb_middle + spread).round(4), (out.bb_middle - spread).round(4)
    out["volatility_7d"] = change.rolling(7).std().round(6)
    deviation = volume.rolling(20).std()
    out["volume_zscore"] = ((volume - volume.rolling(20).mean()) / deviation.where(deviation != 0)).round(4)
    return out[INDICATORS]


@pytest.fixture(scope="module")
def series():
    data = {f"T{n}": walk(n, n) for n in LENGTHS}
    data["FLAT"] = [(float(10 + i % 3), 500) for i in range(40)]        # constant volume
    data["RISING"] = [float(10 + i) for i in range(40)]                 # no losses
    return data


def check(got, columns=INDICATORS):
    for ticker, frame in got.groupby("ticker"):
        frame = frame.sort_values("window_start").reset_index(drop=True)
        want = expected(frame)
        for name in columns:
            mine, theirs = frame[name].astype(float), want[name]
            assert (mine.isna() == theirs.isna()).all(), (ticker, name)
            # a rounding tie may fall either way
            tolerance = 1.5e-6 if name == "volatility_7d" else 1.5e-4
            assert (mine - theirs).abs().fillna(0).max() < tolerance, (ticker, name)


def test_all_indicators_match_pandas(spark, series):
    check(I.add_indicators(bars(spark, series)).toPandas())


@pytest.mark.parametrize("block_rows,warmup", [(700, 700), (1024, 1024), (1500, 1024)])
def test_indicators_do_not_depend_on_the_block_length(spark, block_rows, warmup):
    data = {"LONG": walk(3300, 5), "OTHER": walk(10, 6)}
    got = I.add_indicators(bars(spark, data), block_rows=block_rows, warmup=warmup).toPandas()
    assert len(got) == 3310
    check(got)


def test_previous_close_of_zero_gives_null_not_infinity(spark):
    rows = as_dicts(I.add_indicators(bars(spark, {"Z": [1.0, 0.0, 2.0, 3.0]}), ["daily_return_pct"]), "window_start")
    assert [r["daily_return_pct"] for r in rows] == [None, -100.0, None, 50.0]


def test_rsi_is_null_while_there_has_been_no_loss(spark):
    rows = as_dicts(I.add_indicators(bars(spark, {"R": [1.0, 2.0, 3.0, 2.5, 4.0]}), ["rsi_14"]), "window_start")
    assert [r["rsi_14"] is None for r in rows] == [True, True, True, False, False]


def flat(rows, then=()):
    return {"FLAT": walk(200, 9) + [50.0] * rows + list(then)}


def plain_rsi(closes):
    """The definition, with exact fractions of the two sums kept in one exponent."""
    up = down = 0.0
    out = []
    for i, (before, now) in enumerate(zip([None, *closes], closes)):
        if before is not None:
            weight = 7.5 if i == 1 else 1  # the first move starts the averages
            up, down = up * 13 / 15 + weight * max(now - before, 0), down * 13 / 15 + weight * max(before - now, 0)
            scale = max(up, down)
            if 0 < scale < 1e-100:
                up, down = up / scale, down / scale
        out.append(None if down == 0 else 100 - 100 / (1 + up / down))
    return out


@pytest.mark.parametrize("block_rows,warmup", [(700, 700), (1024, 1024), (4096, 1024)])
def test_rsi_keeps_its_ratio_through_a_long_halt(spark, block_rows, warmup):
    data = flat(6800)
    rows = as_dicts(I.add_indicators(bars(spark, data, "1m", dt.timedelta(minutes=1)), ["rsi_14"], block_rows=block_rows, warmup=warmup), "window_start")
    want = plain_rsi([v[0] if isinstance(v, tuple) else v for v in data["FLAT"]])
    assert len({r["rsi_14"] for r in rows[300:]}) == 1 and rows[-1]["rsi_14"] is not None
    assert all((a["rsi_14"] is None) == (b is None) and (b is None or abs(a["rsi_14"] - b) < 1e-4) for a, b in zip(rows, want))


def test_rsi_after_a_long_rise_is_100_whatever_the_blocks(spark):
    data = {"RISE": [5.0, 4.0] + [4.0 + i / 8 for i in range(1, 7000)]}
    for block_rows, warmup in [(2048, 1024), (4096, 1024)]:
        rows = as_dicts(I.add_indicators(bars(spark, data, "1m", dt.timedelta(minutes=1)), ["rsi_14"], block_rows=block_rows, warmup=warmup), "window_start")
        assert rows[0]["rsi_14"] is None and all(r["rsi_14"] == 100.0 for r in rows[400:])


def test_bars_of_a_null_series_get_indicators(spark):
    some = bars(spark, {"A": [1.0, 2.0, 1.5]})
    both = some.unionByName(some.withColumn("bar_interval", F.lit(None).cast("string")))
    rows = as_dicts(I.add_indicators(both, ["daily_return_pct", "rsi_14"]), "bar_interval", "window_start")
    assert [r["daily_return_pct"] for r in rows] == [None, 100.0, -25.0] * 2
    assert [r["rsi_14"] for r in rows[:3]] == [r["rsi_14"] for r in rows[3:]] and rows[2]["rsi_14"] is not None


def test_intervals_are_series_of_their_own(spark):
    both = bars(spark, {"A": [1.0, 2.0]}).unionByName(bars(spark, {"A": [10.0, 30.0]}, interval="1m"))
    rows = as_dicts(I.add_indicators(both, ["daily_return_pct"]), "bar_interval", "window_start")
    assert [r["daily_return_pct"] for r in rows] == [None, 100.0, None, 200.0]


def test_outlier_needs_a_spread_and_no_minimum_history(spark):
    rows = as_dicts(I.flag_outliers(bars(spark, {"O": [10.0, 10.0, 50.0, 10.0, 11.0, 500.0]})), "window_start")
    # row 3: the two rows before it have no spread; row 6 lies far outside
    assert [r["is_outlier"] for r in rows] == [False, False, False, False, False, True]


def test_partial_average_starts_at_once(spark):
    rows = as_dicts(I.partial_sma(bars(spark, {"A": [float(i) for i in range(1, 13)]})), "window_start")
    assert [r["sma_10"] for r in rows][:3] == [1.0, 1.5, 2.0] and rows[-1]["sma_10"] == 7.5


def test_positions_and_blocks_equal_plain_windows(spark):
    rng = random.Random(3)
    rows = [(k, d) for k in "abc" for d in rng.sample(range(20000), {"a": 1, "b": 50, "c": 300}[k])]
    df = spark.createDataFrame(rows, "k string, d int").withColumn("x", F.col("d") * 1.5)
    placed = with_positions(df, ["k"], ["d"], F.expr("d div 1000"))
    w = Window.partitionBy("k").orderBy("d")
    plain = df.withColumns({
        "pos": F.row_number().over(w).cast("long"),
        "series_rows": F.count("*").over(Window.partitionBy("k")),
        "past": F.sum("x").over(w.rowsBetween(-5, 0)), "next": F.lead("x").over(w)})
    over = block_window(["k"])
    blocked = own_rows(into_blocks(placed, back=5, ahead=1, block_rows=16).withColumns({
        "past": F.sum("x").over(over.rowsBetween(-5, 0)), "next": F.lead("x").over(over)}))
    assert as_dicts(blocked.select(*plain.columns), "k", "d") == as_dicts(plain, "k", "d")


def test_rows_with_a_null_key_are_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, d int")
    assert with_positions(df, ["k"], ["d"], F.lit(0)).count() == 3


def test_one_pass_one_exchange_and_no_python(spark, tmp_path):
    bars(spark, {"A": [1.0, 2.0]}).write.parquet(str(tmp_path / "bars"))
    text = plan(I.add_indicators(spark.read.parquet(str(tmp_path / "bars"))))
    assert "Python" not in text and "InPandas" not in text
    # rows move twice: into time buckets, then into blocks; the rest is one row per bucket
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum("block#" in line for line in wide) == 1
    assert not any("hashpartitioning(ticker" in line and "block#" not in line and "_bucket" not in line
                   and "bar_interval" not in line for line in wide)
    assert text.count("+- Window [") <= 4


def test_unused_indicators_are_not_computed(spark):
    text = plan(I.add_indicators(bars(spark, {"A": [1.0, 2.0]}), ["sma_7"]))
    assert "POWER" not in text and "stddev" not in text
