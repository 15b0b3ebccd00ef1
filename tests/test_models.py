"""Model preparation, forecasters, scores and serving queries."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import as_dicts, bars, plan
from tickloom.functions.dates import date_id
from tickloom.operators import forecast as FC
from tickloom.operators import metrics as M
from tickloom.operators import mlprep as ML
from tickloom.operators import serving as SV
from tickloom.operators import star as S
from tickloom.operators.indicators import add_indicators
from tickloom.plans.training import predict_next_close, train_and_compare, write_comparison
from tickloom.schemas import FEATURES, INDICATORS, TARGET


def walk(n, seed):
    rng, price, out = random.Random(seed), 100.0, []
    for _ in range(n):
        price = max(5.0, price + rng.gauss(0, 2))
        out.append((round(price, 2), rng.randrange(1, 1000)))
    return out


@pytest.fixture(scope="module")
def gold(spark):
    silver = add_indicators(bars(spark, {"AAA": walk(140, 1), "BBB": walk(90, 2)}), ["is_outlier", *INDICATORS])
    tickers = S.dim_ticker(silver).cache()
    return S.fact_prices(silver, tickers).cache(), S.dim_date(silver).cache(), tickers


# ---- preparation

def test_edges_without_target_or_features_are_dropped(gold):
    fact, _, _ = gold
    counts = as_dicts(ML.load_counts(fact))[0]
    assert counts == {"total_rows": 230, "null_target": 2, "null_features": 58, "kept_rows": 170}
    assert ML.load_training_rows(fact).count() == 170


def test_nan_and_infinity_do_not_pass(spark, gold):
    fact, _, _ = gold
    day = F.col("date_id") % 100
    odd = fact.withColumn("rsi_14", F.when(day == 1, float("nan")).when(day == 2, float("inf")).otherwise(F.col("rsi_14")))
    kept = ML.load_training_rows(odd)
    assert kept.filter(day <= 2).count() == 0 and kept.count() > 100
    assert ML.nan_to_null(odd).filter("isnan(rsi_14)").count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 20, 33])
def test_split_sizes_are_floors_in_time_order(spark, n):
    rows = spark.range(n).select(F.lit(1).alias("ticker_id"), (20240000 + F.col("id")).cast("int").alias("date_id"))
    labels = [r["split"] for r in as_dicts(ML.time_split(rows), "date_id")]
    a, b = int(n * 0.70), int(n * (0.70 + 0.15))
    assert labels == ["train"] * a + ["validation"] * (b - a) + ["test"] * (n - b)


def test_scaling_uses_training_rows_and_population_deviation(gold):
    fact, _, _ = gold
    split = ML.time_split(ML.load_training_rows(fact)).withColumn("bb_lower", F.lit(3.0))
    before, after = split.toPandas(), ML.scale_features(split).toPandas()
    for ticker, frame in before.groupby("ticker_id"):
        frame = frame.sort_values("date_id")
        train = frame[frame.split == "train"]
        scaled = after[after.ticker_id == ticker].sort_values("date_id")
        for name in FEATURES:
            std = train[name].astype(float).std(ddof=0)
            want = (frame[name] - train[name].mean()) / (std if std > 0 else 1.0)
            assert np.allclose(scaled[name].to_numpy(float), want.to_numpy(float)), name


def test_sequences_hold_the_rows_before(gold):
    fact, _, _ = gold
    rows = ML.load_training_rows(fact)
    frame = rows.filter("ticker_id = 1").toPandas().sort_values("date_id")
    got = ML.lookback_sequences(rows).filter("ticker_id = 1").toPandas().sort_values("date_id")
    x, y = frame[FEATURES].to_numpy(float), frame[TARGET].to_numpy(float)
    assert len(got) == len(frame) - 30
    for i, (sequence, target) in enumerate(zip(got["sequence"], got[TARGET]), start=30):
        assert np.allclose(np.stack([np.array(s) for s in sequence]), x[i - 30:i]) and target == y[i]


# ---- forecasters

def test_ar_coefficients_are_least_squares(gold):
    fact, _, _ = gold
    rows = FC.with_differences(fact)
    phi = {r["ticker_id"]: r["phi"] for r in as_dicts(FC.fit_ar(rows))}
    predicted = {(r["ticker_id"], r["date_id"]): r["predicted"] for r in as_dicts(FC.ar_forecast(rows, FC.fit_ar(rows)))}
    for ticker, frame in fact.toPandas().groupby("ticker_id"):
        frame = frame.sort_values("date_id")
        close = frame["close"].to_numpy(float)
        d = np.diff(close)
        x = np.array([d[t - 5:t][::-1] for t in range(5, len(d))])
        want = np.linalg.lstsq(x, d[5:], rcond=None)[0]
        assert np.allclose(phi[ticker], want, atol=1e-6)
        last = close[-1] + d[-5:][::-1] @ want
        assert math.isclose(predicted[ticker, frame["date_id"].iloc[-1]], last, rel_tol=1e-9)
        # too little history: the last close stands in
        assert predicted[ticker, frame["date_id"].iloc[2]] == close[2]


def test_only_small_systems_reach_python(gold):
    fact, _, _ = gold
    text = plan(FC.fit_ar(FC.with_differences(fact)))
    python = next(i for i, line in enumerate(text.splitlines()) if "ArrowEvalPython" in line)
    aggregate = next(i for i, line in enumerate(text.splitlines()) if "HashAggregate" in line)
    assert python < aggregate  # above the aggregation


def test_training_compares_models_on_the_same_rows(spark, gold, tmp_path):
    fact, _, _ = gold
    result = train_and_compare(fact, "run-1", maxIter=5)
    metrics = {r["model"]: r for r in as_dicts(result.metrics)}
    assert set(metrics) == {"naive", "ar", "trees"} and len({m["n_scored"] for m in metrics.values()}) == 1
    assert all(m["mae"] > 0 for m in metrics.values())
    importance = as_dicts(result.importance)
    assert len(importance) == 15
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)
    log = as_dicts(result.log)
    assert {(r["model"], r["kind"]) for r in log} >= {("ar", "metric"), ("trees", "param"), ("naive", "metric")}
    write_comparison(result.comparison, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == [
        "model", "MAE", "RMSE", "MAPE (%)", "Dir. Accuracy (%)", "Sharpe Ratio"]


def test_service_forecast_answers_from_the_latest_row(gold):
    fact, _, tickers = gold
    rows = as_dicts(predict_next_close(fact, tickers), "ticker")
    assert [r["ticker"] for r in rows] == ["AAA", "BBB"]
    latest = {r["ticker_id"]: r for r in as_dicts(SV.latest_close(fact))}
    assert rows[0]["current_close"] == latest[1]["close"]
    assert all((r["predicted_direction"] == "UP") == (r["predicted_close"] > r["current_close"]) for r in rows)


# ---- scores

def scored(spark, rows):
    return spark.createDataFrame(rows, "model string, actual double, predicted double, current_close double")


def test_metrics_against_numpy(spark):
    rng = random.Random(4)
    rows = [("m", rng.uniform(-5, 20), rng.choice([rng.uniform(0, 20), 10.0]), 10.0) for _ in range(60)]
    rows += [("m", 0.0, 1.0, 5.0), ("m", 5.0, 5.0, 5.0), ("m", 4.0, 3.0, 0.0)]
    frame = scored(spark, rows + [("m", 1.0, None, 1.0), ("m", 1.0, float("nan"), 1.0)])
    got = as_dicts(M.forecast_metrics(frame))[0]
    a, p, c = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    assert got["n_scored"] == 63
    assert math.isclose(got["mae"], np.abs(a - p).mean()) and math.isclose(got["rmse"], np.sqrt(((a - p) ** 2).mean()))
    keep = a != 0
    assert math.isclose(got["mape_pct"], 100 * np.abs((a - p)[keep] / a[keep]).mean())
    assert math.isclose(got["dir_accuracy_pct"], 100 * (np.sign(a - c) == np.sign(p - c)).mean())
    keep = c != 0
    earned = np.sign(p - c)[keep] * ((a - c)[keep] / c[keep])
    assert math.isclose(got["sharpe"], earned.mean() / earned.std() * math.sqrt(252))


def test_sharpe_is_zero_without_spread(spark):
    assert as_dicts(M.forecast_metrics(scored(spark, [("m", 1.0, 1.0, 1.0)] * 3)))[0]["sharpe"] == 0.0


def test_common_rows_drop_what_one_model_missed(spark):
    frame = spark.createDataFrame(
        [(1, "a", 1.0, 1.0, 1.0), (2, "a", 1.0, 1.0, 1.0), (1, "b", 1.0, 2.0, 1.0), (2, "b", 1.0, None, 1.0)],
        "k int, model string, actual double, predicted double, current_close double")
    common = M.on_common_rows(frame, ["k"])
    assert sorted((r["k"], r["model"]) for r in as_dicts(common)) == [(1, "a"), (1, "b")]


def test_best_model_has_least_error_and_ties_go_by_name(spark):
    frame = scored(spark, [("b", 1.0, 2.0, 1.5), ("a", 1.0, 2.0, 1.5), ("c", 1.0, 5.0, 0.5)])
    best = as_dicts(M.best_model(M.forecast_metrics(frame)))[0]
    assert (best["best"], best["best_mae"]) == ("a", 1.0)


def test_histogram_equals_numpy(spark):
    rng = random.Random(8)
    residuals = [rng.gauss(0, 3) for _ in range(500)]
    got = {r["bin"]: r["frequency"] for r in as_dicts(M.residual_histogram(
        scored(spark, [("m", x, 0.0, 1.0) for x in residuals])))}
    want, _ = np.histogram(residuals, bins=30)
    assert [got.get(i, 0) for i in range(30)] == want.tolist()


def test_overlay_keeps_existing_predictions(spark):
    wide = spark.createDataFrame([(1, 1.0, None), (2, 2.0, float("nan")), (3, 3.0, 9.0)], "k int, a double, b double")
    rows = [(r["k"], r["model"]) for r in as_dicts(M.forecast_overlay(wide, ["a", "b"], ["k"]), "k", "model")]
    assert rows == [(1, "a"), (2, "a"), (3, "a"), (3, "b")]


# ---- serving

def test_history_is_oldest_first_and_bounded(gold):
    fact, _, tickers = gold
    rows = as_dicts(SV.history(fact, tickers, "aaa", 5))
    ids = [r["date_id"] for r in rows]
    assert len(ids) == 5 and ids == sorted(ids)
    last = fact.filter("ticker_id = 1").agg(F.max("date_id")).first()[0]
    assert ids[-1] == last
    with pytest.raises(ValueError):
        SV.history(fact, tickers, "AAA", 0)
    assert SV.history(fact, tickers, "AAA", 10_000).count() == fact.filter("ticker_id = 1").count()
    assert "TakeOrderedAndProject" in plan(SV.history(fact, tickers, "AAA", 5))


def test_star_reports_cover_one_ticker_or_all(gold):
    fact, dates, tickers = gold
    assert SV.star(fact, dates, tickers).count() == 230
    one = SV.rsi_zones(SV.star(fact, dates, tickers, "BBB"))
    assert one.count() == 90 and as_dicts(one)[0]["overbought"] == 70


def test_actuals_come_from_the_next_trading_day(spark):
    closes = spark.createDataFrame(
        [("A", dt.date(2024, 1, 5), 1.0), ("A", dt.date(2024, 1, 8), 2.0), ("A", dt.date(2024, 1, 9), 3.0)],
        "ticker string, date date, close double")
    at = [(3, 9), (5, 16), (6, 12), (7, 23), (8, 1), (9, 16)]
    rows = [("A", dt.datetime(2024, 1, d, h), 0.0, "UP", "m", None) for d, h in at]
    rows += [("A", dt.datetime(2024, 1, 5, 1), 0.0, "UP", "m", 42.0), ("B", dt.datetime(2024, 1, 5), 0.0, "UP", "m", None)]
    predictions = spark.createDataFrame(rows, SV.PREDICTIONS)
    got = {(r["ticker"], r["predicted_at"].day, r["predicted_at"].hour): r["actual_close"]
           for r in as_dicts(SV.fill_actuals(predictions, closes))}
    assert got == {("A", 3, 9): 1.0, ("A", 5, 16): 2.0, ("A", 6, 12): 2.0, ("A", 7, 23): 2.0, ("A", 8, 1): 3.0,
                   ("A", 9, 16): None, ("A", 5, 1): 42.0, ("B", 5, 0): None}


def test_weekly_accuracy_compares_with_the_predicted_close(spark):
    monday = dt.datetime(2024, 1, 1, 16)
    rows = [("A", monday, 10.0, "UP", "m", 11.0), ("A", monday, 10.0, "UP", "m", 9.0),
            ("A", monday, 10.0, "DOWN", "m", 9.0), ("A", monday, 10.0, "UP", "m", None)]
    got = as_dicts(SV.weekly_accuracy(spark.createDataFrame(rows, SV.PREDICTIONS)))
    assert got == [{"week": dt.datetime(2024, 1, 1), "accuracy_pct": 66.7}]


def test_live_queries(spark):
    frame = bars(spark, {"A": [float(i) for i in range(1, 91)]}, interval="1m", step=dt.timedelta(minutes=1))
    now = frame.agg(F.max("window_start")).scalar()
    assert SV.last_minutes(frame, "A", 60, now).count() == 61  # both ends included
    assert SV.last_minutes(frame, "A").count() == 0            # wall clock: nothing recent
    latest = as_dicts(SV.latest_bars(frame, 3))
    assert [r["close"] for r in latest] == [90.0, 89.0, 88.0]
    day = F.lit("2024-01-01").cast("date")
    assert as_dicts(SV.vwap_with_sma10(frame, day, "A"))[0]["sma_10"] == 1.0


def test_unchanged_prediction_counts_as_down(spark):
    frame = spark.sql("select 'A' ticker, timestamp'2024-01-01' predicted_at, 10d predicted, 10d current_close")
    row = as_dicts(SV.prediction_rows(frame, "m"))[0]
    assert (row["predicted_direction"], row["predicted_change_pct"]) == ("DOWN", 0.0)
    assert SV.prediction_log(SV.prediction_rows(frame, "m")).columns == SV.PREDICTIONS.fieldNames()


def test_trees_serve_tickers_of_any_price_level(spark):
    rng = random.Random(4)
    rows = []
    for ticker, level in ((1, 10.0), (2, 10_000.0)):
        close = level
        for i in range(160):
            following = close * (1 + rng.uniform(-0.02, 0.02))
            split = "train" if i < 110 else "validation" if i < 135 else "test"
            rows.append((ticker, 20240101 + i, close, following, split, *[rng.random() for _ in FEATURES if _ != "close"]))
            close = following
    names = [f for f in FEATURES if f != "close"]
    schema = "ticker_id int, date_id int, close double, target_next_close double, split string, " + ", ".join(f"`{n}` double" for n in names)
    scaled = ML.scale_features(spark.createDataFrame(rows, schema), with_close=True)
    got = FC.tree_forecast(FC.fit_trees(scaled, maxIter=5), scaled.filter("split = 'test'")).collect()
    assert len(got) == 50 and all(abs(r["predicted"] - r["close"]) < 0.2 * r["close"] for r in got)
    assert {round(r["close"] / 10 ** (1 if r["ticker_id"] == 1 else 4)) for r in got} <= {0, 1, 2}
