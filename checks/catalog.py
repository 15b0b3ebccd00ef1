"""The registered queries: each operator of the library on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import streams, views
from tickloom.functions.dates import calendar_columns, date_id, date_of_id
from tickloom.functions.numeric import rnd
from tickloom.operators import arma as AR
from tickloom.operators import asof as AO
from tickloom.operators import bars as B
from tickloom.operators import clean as C
from tickloom.operators import forecast as FC
from tickloom.operators import indicators as I
from tickloom.operators import metrics as M
from tickloom.operators import mlprep as ML
from tickloom.operators import quality as Q
from tickloom.operators import serving as SV
from tickloom.operators import star as S
from tickloom.operators import upsert as U
from tickloom.operators import validate as V
from tickloom.plans.training import as_scored, predict_next_close, prepare
from tickloom.schemas import BRONZE, FEATURES, INDICATORS, SILVER, TARGET
from tickloom.session import cut_lineage, shared_dir
from tickloom.sources import changes as CH
from tickloom.sources import feed as FD
from tickloom.sources import history as H
from tickloom.sources import lake as L

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TICKER = "BRAND#11"          # symbol of the single-ticker reports
EVENT_TICKER = "click"       # ticker of the live-feed reports

_STORED: dict[tuple[str, str, str], DataFrame] = {}


def register(name: str, fn: Query) -> None:
    """Dates leave a query as midnight timestamps, which every client reads alike."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = fn(spark, sf_dir)
        days = [f.name for f in frame.schema.fields if f.dataType.simpleString() == "date"]
        return frame.withColumns({c: F.col(c).cast("timestamp") for c in days}) if days else frame

    run.__name__, run.__doc__ = name, fn.__doc__
    QUERIES[name] = run


def query(fn: Query) -> Query:
    register(fn.__name__, fn)
    return fn


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A silver or gold table, written once per application and read from then on."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = cut_lineage(build(), name)
    return _STORED[key]


# ---- stored tables the reports read ------------------------------------------------------------

def bars_table(spark, sf):
    return stored(spark, sf, "bars", lambda: views.as_bars(views.daily_li(spark, sf)))


def silver_table(spark, sf):
    return stored(spark, sf, "silver", lambda: I.add_indicators(
        bars_table(spark, sf), ["is_outlier", *INDICATORS]))


def dim_ticker_table(spark, sf):
    return stored(spark, sf, "dim_ticker", lambda: S.dim_ticker(bars_table(spark, sf)))


def dim_date_table(spark, sf):
    return stored(spark, sf, "dim_date", lambda: S.dim_date(bars_table(spark, sf)))


def fact_table(spark, sf):
    return stored(spark, sf, "fact", lambda: S.fact_prices(
        silver_table(spark, sf), dim_ticker_table(spark, sf)))


def minute_bars_table(spark, sf):
    return stored(spark, sf, "minute_bars", lambda: B.ohlcv_bars(
        V.split_ticks(views.ticks(spark, sf))[0]).withColumn("bar_interval", F.lit("1m")))


def split_table(spark, sf):
    return stored(spark, sf, "split", lambda: prepare(fact_table(spark, sf)))


def scaled_table(spark, sf):
    return stored(spark, sf, "scaled", lambda: ML.scale_features(split_table(spark, sf), with_close=True))


def wide_forecasts(spark, sf):
    """Fact rows with a next close and three simple predictions side by side."""
    rows = FC.with_differences(fact_table(spark, sf), 1).filter(F.col(TARGET).isNotNull())
    return rows.select(
        "ticker_id", "date_id", F.col(TARGET).alias("actual"), F.col("close").alias("current_close"),
        F.col("close").alias("naive"), F.col("sma_7").alias("sma"),
        (F.col("close") + F.col("d1")).alias("momentum"),
    )


def long_forecasts(spark, sf):
    return M.forecast_overlay(wide_forecasts(spark, sf), ["naive", "sma", "momentum"],
                              ["ticker_id", "date_id", "actual", "current_close"])


def predictions_table(spark, sf):
    """Logged momentum predictions, made at 16:00 of their day."""
    def build():
        symbols = dim_ticker_table(spark, sf).select("ticker_id", F.col("symbol").alias("ticker"))
        made = wide_forecasts(spark, sf).filter("momentum is not null").join(symbols, "ticker_id")
        at = date_of_id(F.col("date_id")).cast("timestamp") + F.expr("interval 16 hours")
        answers = SV.prediction_rows(made.select(
            "ticker", at.alias("predicted_at"), F.col("momentum").alias("predicted"),
            "current_close"), "momentum")
        return SV.prediction_log(answers)

    return stored(spark, sf, "predictions", build)


def closes(spark, sf):
    return bars_table(spark, sf).select("ticker", "date", "close")


def filled_predictions(spark, sf):
    return stored(spark, sf, "filled", lambda: SV.fill_actuals(
        predictions_table(spark, sf), closes(spark, sf)))


# ---- sources and sinks -------------------------------------------------------------------------

@query
def parse_ticks(spark, sf):
    ticks = views.ticks(spark, sf)
    records = ticks.select(
        F.col("ticker").cast("binary").alias("key"),
        F.to_json(F.struct("ticker", "price", "volume", "timestamp_ms", "timestamp", "conditions", "source"))
        .cast("binary").alias("value"),
        F.timestamp_millis("timestamp_ms").alias("timestamp"), F.col("seq").alias("offset"))
    parsed = B.with_event_time(FD.parse_ticks(records))
    return parsed.select("kafka_key", "ticker", "price", "volume", "timestamp_ms", "timestamp",
                         F.element_at("conditions", 1).alias("condition"), "source", "seq", "event_time")


@query
def unwrap_feed(spark, sf):
    lines = views.feed_line(views.ticks(spark, sf))
    return FD.unwrap_feed(lines).select(
        "line", "element", "ticker", "price", "volume", "timestamp_ms", "timestamp",
        F.element_at("conditions", 1).alias("condition"), "source")


@query
def publish_payload(spark, sf):
    payload = FD.publish_payload(views.ticks(spark, sf))
    return payload.select("key", *[
        F.get_json_object("value", f"$.{c}").alias(c) for c in ("ticker", "timestamp_ms", "volume", "source")],
        F.get_json_object("value", "$.price").cast("double").alias("price"))


@query
def dead_letter(spark, sf):
    letters = FD.feed_dead_letters(views.feed_line(views.dirty_ticks(spark, sf)))
    return letters.select("original_message", "error_reason", "ticker")


@query
def feed_counts(spark, sf):
    return FD.feed_counts(views.feed_line(views.dirty_ticks(spark, sf)))


@query
def csv_roundtrip(spark, sf):
    path = shared_dir(spark, "history")
    H.write_history(views.daily(spark, sf).select(*H.DAILY_HISTORY.fieldNames()), path)
    return H.read_history(spark, f"{path}/csv", "csv").unionByName(
        H.read_history(spark, f"{path}/parquet"))


@query
def json_roundtrip(spark, sf):
    path = shared_dir(spark, "ticks-json")
    L.append_ticks(views.ticks(spark, sf), path)
    back = spark.read.schema("ticker string, price double, volume long, timestamp_ms long, seq long").json(path)
    return back


@query
def bronze_roundtrip(spark, sf):
    path = shared_dir(spark, "bronze")
    history = views.daily(spark, sf)
    bars = B.with_ingest_metadata(B.align_daily(history), "history", "batch-0", "1d")
    L.write_bars(bars, path)
    return L.read_bars(spark, path, BRONZE).drop("ingested_at")


@query
def silver_roundtrip(spark, sf):
    path = shared_dir(spark, "silver")
    bars = cut_lineage(views.as_bars(views.daily(spark, sf)), "bars")
    L.write_bars(I.add_indicators(bars, ["is_outlier", *INDICATORS]), path, mode="overwrite")
    return L.read_bars(spark, path, SILVER).select(
        "ticker", "date", "close", "volume", "is_outlier", "sma_7", "bb_middle", "daily_return_pct")


@query
def partition_pruned_scan(spark, sf):
    path = shared_dir(spark, "bronze")
    L.write_bars(views.as_bars(views.daily(spark, sf)).withColumn("ticker", F.upper("ticker")), path)
    return L.read_bars(spark, path, BRONZE, EVENT_TICKER).select("ticker", "date", "close", "volume")


@query
def preview_n(spark, sf):
    ticks = views.ticks(spark, sf)
    records = ticks.select(
        F.pmod(F.col("seq"), F.lit(3)).cast("int").alias("partition"), F.col("seq").alias("offset"),
        F.col("ticker").cast("binary").alias("key"), F.col("timestamp_ms").cast("string").cast("binary").alias("value"))
    return FD.preview(records, 100)


# ---- projections and checks --------------------------------------------------------------------

@query
def validate_ticks(spark, sf):
    valid, _ = V.split_ticks(views.dirty_ticks(spark, sf))
    return valid.select("ticker", "price", "volume", "timestamp_ms", "seq")


@query
def invalid_ticks(spark, sf):
    _, rejected = V.split_ticks(views.dirty_ticks(spark, sf))
    return rejected.select("ticker", F.when(~F.isnan("price"), F.col("price")).alias("price"),
                           F.coalesce(F.isnan("price"), F.lit(False)).alias("price_is_nan"),
                           "volume", "timestamp_ms", "seq")


@query
def ingest_counts(spark, sf):
    return V.ingest_counts(views.dirty_ticks(spark, sf), V.tick_is_valid())


@query
def validate_daily(spark, sf):
    """Daily history of the dirty ticks: some rows fail the price checks."""
    valid, rejected = V.split_daily(views.daily_dirty(spark, sf))
    keep = ["ticker", "date", "open", "high", "low", "close", "volume"]
    return valid.select(*keep, F.lit(True).alias("valid")).unionByName(
        rejected.select(*keep, F.lit(False).alias("valid")))


@query
def align_daily(spark, sf):
    return B.align_daily(views.daily_li(spark, sf))


@query
def normalise_history(spark, sf):
    vendor = views.daily_li(spark, sf).select(
        "ticker", F.col("date").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), F.col("close").alias("Close"),
        F.col("volume").cast("double").alias("Volume"), F.lit(0.0).alias("Dividends"))
    return H.normalise_history(vendor, None, "history", "America/New_York").drop("ingested_at")


@query
def bronze_meta(spark, sf):
    bars = B.with_ingest_metadata(B.align_daily(views.daily_li(spark, sf)), "history", "batch-0", "1d")
    return bars.select("ticker", "window_start", "window_end", "close", "volume", "bar_interval",
                       "source_api", "batch_id", "date", F.col("ingested_at").isNotNull().alias("stamped"))


@query
def date_parts(spark, sf):
    day = F.col("date")
    rows = bars_table(spark, sf).select("date").distinct()
    return rows.select(*calendar_columns(day), date_of_id(date_id(day)).alias("back"))


# ---- bars --------------------------------------------------------------------------------------

@query
def bars_1min(spark, sf):
    return B.ohlcv_bars(V.split_ticks(views.ticks(spark, sf))[0])


@query
def bars_daily(spark, sf):
    return B.roll_up(B.ohlcv_bars(V.split_ticks(views.ticks(spark, sf))[0])).drop("vwap")


@query
def vwap(spark, sf):
    return B.ohlcv_bars(V.split_ticks(views.ticks(spark, sf))[0], B.DAY_MS) \
        .select("ticker", "window_start", "volume", "vwap", "trade_count")


@query
def lambda_union(spark, sf):
    minute = B.with_ingest_metadata(B.ohlcv_bars(V.split_ticks(views.ticks(spark, sf))[0]),
                                    "feed_ws", "stream-0", "1m")
    daily = B.with_ingest_metadata(B.align_daily(views.daily(spark, sf)), "history", "batch-0", "1d")
    return B.merge_paths([minute, daily]).drop("ingested_at")


@query
def candles(spark, sf):
    return B.candles(minute_bars_table(spark, sf))


# ---- cleaning and indicators -------------------------------------------------------------------

def duplicated_bars(spark, sf):
    """Bars plus a second, later copy of every third day with another close."""
    bars = views.as_bars(views.daily_li(spark, sf))
    again = bars.filter(F.dayofmonth("date") % 3 == 0).withColumns({
        "close": F.col("close") + 1, "batch_id": F.lit("batch-1"),
        "ingested_at": F.col("ingested_at") + F.expr("interval 1 hour")})
    return bars.unionByName(again)


@query
def dedup_latest(spark, sf):
    return C.latest_per_key(duplicated_bars(spark, sf)).select(
        "ticker", "window_start", "close", "volume", "batch_id")


@query
def silver_clean(spark, sf):
    holes = duplicated_bars(spark, sf).withColumns({
        "volume": F.when(F.dayofmonth("date") != 7, F.col("volume")),
        "close": F.when(F.dayofmonth("date") != 11, F.col("close"))})
    return C.clean_bars(holes).select("ticker", "window_start", "close", "volume", "batch_id")


@query
def outlier_flag(spark, sf):
    return I.flag_outliers(bars_table(spark, sf)).select("ticker", "date", "close", "is_outlier")


def _indicator_query(name: str, columns: list[str]) -> None:
    def run(spark, sf):
        return I.add_indicators(bars_table(spark, sf), columns).select("ticker", "date", *columns)

    register(name, run)


_indicator_query("ind_return", ["daily_return_pct"])
_indicator_query("ind_sma", ["sma_7", "sma_30"])
_indicator_query("ind_ema", ["ema_12", "ema_26"])
_indicator_query("ind_macd", ["macd", "macd_signal", "macd_histogram"])
_indicator_query("ind_rsi", ["rsi_14"])
_indicator_query("ind_bollinger", ["bb_middle", "bb_upper", "bb_lower"])
_indicator_query("ind_volatility", ["volatility_7d"])
_indicator_query("ind_volume_z", ["volume_zscore"])


@query
def indicators_all(spark, sf):
    """From line items to all indicators; the bars are stored in between, as the silver job does."""
    bars = cut_lineage(views.as_bars(views.daily_li(spark, sf)), "bars")
    return I.add_indicators(bars, ["is_outlier", *INDICATORS]).select(
        "ticker", "date", "close", "volume", "is_outlier", *INDICATORS)


@query
def indicators_small_blocks(spark, sf):
    """The same in blocks shorter than the series, so that every state crosses block edges."""
    bars = cut_lineage(views.as_bars(views.daily_li(spark, sf)), "bars")
    return I.add_indicators(bars, ["is_outlier", *INDICATORS], block_rows=700, warmup=700).select(
        "ticker", "date", "close", "volume", "is_outlier", *INDICATORS)


@query
def indicators_in_batches(spark, sf):
    """Three runs, each with the state the one before left, in blocks shorter than the batches."""
    bars, state, parts = bars_table(spark, sf), None, []
    for begin, end in ((0, 1994), (1994, 1997), (1997, 9999)):
        batch = cut_lineage(bars.filter(F.year("window_start").between(begin, end - 1)), "batch")
        done, state = I.continue_indicators(batch, state, block_rows=700, warmup=700)
        parts.append(done)
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("ticker", "date", "close", "volume", "is_outlier", *INDICATORS)


@query
def quality_report(spark, sf):
    return Q.quality_report(silver_table(spark, sf))


@query
def quality_verdict(spark, sf):
    return Q.verdict(Q.quality_report(silver_table(spark, sf)))


# ---- star schema -------------------------------------------------------------------------------

@query
def dim_ticker(spark, sf):
    return S.dim_ticker(bars_table(spark, sf))


@query
def dim_ticker_grow(spark, sf):
    """A later run: brands above 20 are known, the others are new and get the next ids."""
    bars = bars_table(spark, sf)
    number = F.substring_index("ticker", "#", -1).try_cast("int")
    known = S.dim_ticker(bars.filter(number > 20))
    return S.dim_ticker(bars, known)


@query
def dim_date(spark, sf):
    return S.dim_date(bars_table(spark, sf))


@query
def dim_market_session(spark, sf):
    """Session rows with the ticks that fall into each."""
    sessions = S.dim_market_session(spark)
    seen = S.with_market_session(B.with_event_time(views.ticks(spark, sf)), sessions)
    counts = seen.groupBy("session_id").agg(F.count(F.lit(1)).alias("ticks"))
    return sessions.join(counts, "session_id", "left")


@query
def session_join(spark, sf):
    seen = S.with_market_session(B.with_event_time(views.ticks(spark, sf)), S.dim_market_session(spark))
    return seen.select("seq", "ticker", "session_id", "session_type")


@query
def fact_prices(spark, sf):
    return S.fact_prices(silver_table(spark, sf), dim_ticker_table(spark, sf))


@query
def star_join(spark, sf):
    rows = SV.star(fact_table(spark, sf), dim_date_table(spark, sf), dim_ticker_table(spark, sf))
    return rows.select("symbol", "date", "close", "volume", "sma_7", "rsi_14", TARGET)


@query
def load_counts(spark, sf):
    """Rows of each gold table after two identical loads."""
    tables = {
        "dim_ticker": (dim_ticker_table(spark, sf), ["symbol"]),
        "dim_date": (dim_date_table(spark, sf), ["date_id"]),
        "dim_market_session": (S.dim_market_session(spark), ["session_type"]),
        "fact_stock_prices": (fact_table(spark, sf), ["ticker_id", "date_id"]),
    }
    return SV.table_counts({name: U.upsert(df, df, keys) for name, (df, keys) in tables.items()})


@query
def table_counts(spark, sf):
    return SV.table_counts({
        "fact_stock_prices": fact_table(spark, sf), "dim_date": dim_date_table(spark, sf),
        "stock_prices_stream": minute_bars_table(spark, sf), "predictions": predictions_table(spark, sf)})


# ---- serving -----------------------------------------------------------------------------------

def _star(spark, sf):
    return SV.star(fact_table(spark, sf), dim_date_table(spark, sf), dim_ticker_table(spark, sf))


@query
def history(spark, sf):
    return SV.history(fact_table(spark, sf), dim_ticker_table(spark, sf), TICKER, 30)


@query
def latest_close(spark, sf):
    return SV.latest_close(fact_table(spark, sf))


@query
def live_monitor(spark, sf):
    return SV.latest_bars(minute_bars_table(spark, sf), 10)


@query
def bi_close_sma(spark, sf):
    return SV.close_with_averages(_star(spark, sf))


@query
def bi_volume(spark, sf):
    return SV.daily_volume(_star(spark, sf))


@query
def bi_rsi(spark, sf):
    return SV.rsi_zones(_star(spark, sf))


@query
def bi_prediction_history(spark, sf):
    return SV.prediction_history(filled_predictions(spark, sf))


@query
def bi_weekly_accuracy(spark, sf):
    return SV.weekly_accuracy(filled_predictions(spark, sf))


@query
def bi_live_60min(spark, sf):
    bars = minute_bars_table(spark, sf)
    return SV.last_minutes(bars, EVENT_TICKER, 60, bars.agg(F.max("window_start")).scalar())


@query
def bi_vwap_sma10(spark, sf):
    bars = minute_bars_table(spark, sf)
    return SV.vwap_with_sma10(bars, bars.agg(F.to_date(F.max("window_start"))).scalar())


@query
def sma10_partial(spark, sf):
    """The 10-bar average with partial frames over every minute bar."""
    return I.partial_sma(minute_bars_table(spark, sf)).select("ticker", "window_start", "close", "sma_10")


@query
def prediction_log(spark, sf):
    return SV.prediction_log(predictions_table(spark, sf))


@query
def prediction_actuals(spark, sf):
    return SV.fill_actuals(predictions_table(spark, sf), closes(spark, sf))


@query
def upsert_merge(spark, sf):
    """Bars of even days, upserted with all bars and the later copies of every third day."""
    everything = duplicated_bars(spark, sf).select("ticker", "window_start", "close", "volume", "batch_id")
    target = everything.filter("batch_id = 'batch-0'").filter(F.dayofmonth("window_start") % 2 == 0)
    merged = U.upsert(target, everything, ["ticker", "window_start"], ["batch_id"])
    return U.upsert(merged, everything, ["ticker", "window_start"], ["batch_id"])


@query
def upsert_merged_on_read(spark, sf):
    """All bars in three batches of changes, packed, then their later copies in a batch of its own."""
    rows, root, keys = duplicated_bars(spark, sf).select("ticker", "window_start", "close", "volume", "batch_id"), shared_dir(spark, "changes"), ["ticker", "window_start"]
    bars = rows.filter("batch_id = 'batch-0'")
    for i in range(3):
        CH.append_changes(bars.filter(F.dayofmonth("window_start") % 3 == i), root, "bars", keys, parts=3)
    CH.append_changes(rows.filter("batch_id = 'batch-1'"), root, "bars", keys, parts=3)
    return CH.read_merged(spark, root, "bars", keys)


@query
def upsert_do_nothing(spark, sf):
    keys = ["ticker", "window_start"]
    bars = duplicated_bars(spark, sf)
    target = bars.filter(F.dayofmonth("window_start") % 2 == 0).filter("batch_id = 'batch-0'").select(*keys)
    return U.upsert(target, bars.select(*keys), keys)


@query
def upsert_insert_only(spark, sf):
    """All bars and later copies come in: rows of new keys are added, existing rows stay as they are."""
    rows = duplicated_bars(spark, sf).select("ticker", "window_start", "close", "batch_id")
    target = rows.filter("batch_id = 'batch-0'").filter(F.dayofmonth("window_start") % 2 == 0)
    return U.insert_missing(target, rows, ["ticker", "window_start"])


# ---- streaming ---------------------------------------------------------------------------------

for _name in ("stream_bars_append", "stream_upsert", "stream_merge_on_read", "stream_dual_sink", "stream_dead_letter",
              "stream_late_drop", "stream_restart"):
    register(_name, getattr(streams, _name))


# ---- model preparation, forecasts, scores ------------------------------------------------------

@query
def ml_load(spark, sf):
    return ML.load_training_rows(fact_table(spark, sf)).select("ticker_id", "date_id", *FEATURES, TARGET)


@query
def ml_load_counts(spark, sf):
    return ML.load_counts(fact_table(spark, sf))


@query
def time_split(spark, sf):
    rows = ML.time_split(ML.load_training_rows(fact_table(spark, sf)))
    return rows.select("ticker_id", "date_id", "split")


@query
def scale_features(spark, sf):
    rows = ML.scale_features(split_table(spark, sf))
    return rows.select("ticker_id", "date_id", "split", *[rnd(F.col(c), 6).alias(c) for c in FEATURES])


@query
def lookback_sequences(spark, sf):
    """Length, first and last step of each sequence, and the mean of each feature over its steps, so that every value counts."""
    rows = ML.lookback_sequences(split_table(spark, sf))
    seq = F.col("sequence")
    return rows.select(
        "ticker_id", "date_id", TARGET, F.size(seq).alias("steps"), F.size(seq[0]).alias("features"),
        seq[0][3].alias("first_close"), seq[29][3].alias("last_close"),
        seq[0][4].alias("first_volume"), seq[29][18].alias("last_volume_zscore"),
        *[rnd(F.aggregate(F.transform(seq, lambda step: step[i]), F.lit(0.0), lambda a, x: a + x) / F.size(seq), 6).alias(f"mean_{c}") for i, c in enumerate(FEATURES)])


def _rounded(metrics):
    doubles = [f.name for f in metrics.schema.fields if f.dataType.simpleString() == "double"]
    return metrics.withColumns({c: rnd(F.col(c), 6) for c in doubles})


@query
def naive_forecast(spark, sf):
    test = split_table(spark, sf).filter("split = 'test'")
    return as_scored(FC.naive_forecast(test), "naive")


@query
def forecast_overlay(spark, sf):
    return long_forecasts(spark, sf).withColumn("predicted", rnd(F.col("predicted"), 6))


@query
def forecast_metrics(spark, sf):
    return _rounded(M.forecast_metrics(long_forecasts(spark, sf)))


@query
def metrics_common_rows(spark, sf):
    common = M.on_common_rows(long_forecasts(spark, sf), ["ticker_id", "date_id"])
    return _rounded(M.forecast_metrics(common))


@query
def model_comparison(spark, sf):
    return M.comparison_table(_rounded(M.forecast_metrics(long_forecasts(spark, sf))))


@query
def best_model(spark, sf):
    """Scores go through the comparison CSV and back, as the dashboard reads them."""
    path = shared_dir(spark, "comparison")
    _rounded(M.forecast_metrics(long_forecasts(spark, sf))).write.option("header", True).csv(path)
    schema = "model string, mae double, rmse double, mape_pct double, dir_accuracy_pct double, sharpe double, n_scored long"
    return M.best_model(spark.read.schema(schema).option("header", True).csv(path))


@query
def residual_stats(spark, sf):
    return _rounded(M.residual_stats(long_forecasts(spark, sf)))


@query
def residual_hist(spark, sf):
    return M.residual_histogram(long_forecasts(spark, sf))


@query
def ar_forecast(spark, sf):
    rows = split_table(spark, sf)
    phi = FC.fit_ar(rows.filter("split = 'train'"))
    return as_scored(FC.ar_forecast(rows.filter("split = 'test'"), phi), "ar")


@query
def predict_next(spark, sf):
    """Service forecast: fit on everything known, one answer per ticker."""
    return predict_next_close(fact_table(spark, sf), dim_ticker_table(spark, sf))


@query
def arma_forecast(spark, sf):
    """Autoregressive moving-average model refitted on all closes up to each row."""
    rows = AR.expanding_forecast(fact_table(spark, sf).select("ticker_id", "date_id", "close", TARGET))
    return as_scored(rows.filter(F.col(TARGET).isNotNull()), "arma")


@query
def arma_kept(spark, sf):
    """One model per ticker, kept from the training rows, carried over the test rows."""
    rows = fact_table(spark, sf).select("ticker_id", "date_id", "close", TARGET)
    train = split_table(spark, sf).filter("split = 'train'").select("ticker_id", "date_id")
    models = AR.expanding_models(rows.filter(F.col(TARGET).isNotNull())).join(train, ["ticker_id", "date_id"], "left_semi")
    return as_scored(AR.kept_forecast(rows, AR.kept_models(models)).filter(F.col(TARGET).isNotNull()), "arma-kept")


@query
def expanding_sums(spark, sf):
    """Sums of products (in millions) behind the models of each row, in blocks shorter than the series."""
    lags = [f"d{i}" for i in range(2, 4)]
    rows = AR.with_changes(fact_table(spark, sf).select("ticker_id", "date_id", "close"), 3, block_rows=300)
    sums = AR.running_sums(rows, ["ticker_id"], lags, "d1", through=True, block_rows=300)
    named = {"g11": F.col("gram")[0], "g12": F.col("gram")[1], "g22": F.col("gram")[2], "m1": F.col("moment")[0], "m2": F.col("moment")[1]}
    return sums.select("ticker_id", "date_id", "n", *[rnd(c / 1_000_000, 2).alias(k) for k, c in named.items()])


def _trees(spark, sf):
    key = (spark.sparkContext.applicationId, sf, "trees-model")
    if key not in _STORED:
        _STORED[key] = FC.fit_trees(scaled_table(spark, sf))
    return _STORED[key]


@query
def gbt_forecast(spark, sf):
    scaled = scaled_table(spark, sf)
    return as_scored(FC.tree_forecast(_trees(spark, sf), scaled.filter("split = 'test'")), "trees")


@query
def feature_importance(spark, sf):
    return FC.feature_importance(_trees(spark, sf), scaled_table(spark, sf))


# ---- rows against the last known state, lines that do not parse --------------------------------

@query
def tick_previous_close(spark, sf):
    """Each tick with the last daily close that was known at its time."""
    ticks = views.ticks(spark, sf).select("seq", "ticker", "price", F.timestamp_millis("timestamp_ms").alias("event_time"))
    known = views.daily(spark, sf).select("ticker", F.date_add(F.to_date("date"), 1).cast("timestamp").alias("known_at"), F.col("close").alias("previous_close"))
    return AO.asof_join(ticks, known, ["ticker"], "event_time", "known_at", ["previous_close"], block_rows=1000).drop("event_time")


@query
def history_rejects(spark, sf):
    """Good rows and rejects, by failed columns, of CSV files with damaged cells."""
    path = shared_dir(spark, "damaged-history")
    day = F.dayofmonth("date")
    # Which days get which damage.
    rows = views.daily_li(spark, sf).withColumns({
        "close": F.when(day.isin(3, 5), "n/a").otherwise(F.col("close").cast("string")),
        "volume": F.when(day.isin(5, 7), "12x").otherwise(F.col("volume").cast("string")),
        "date": F.when(day == 11, "11th").otherwise(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")),
    })
    rows.select(*H.DAILY_HISTORY.fieldNames()).write.option("header", True).csv(path)
    good, rejects = H.read_history_checked(spark, path)
    return rejects.groupBy("failed").agg(F.count(F.lit(1)).alias("rows")) \
        .union(good.groupBy(F.lit("none").alias("failed")).agg(F.count(F.lit(1)).alias("rows")))
