"""Forecasts with moving-average terms against plain loops and full refits."""

import numpy as np
import pytest

from tickloom.operators import arma


def series(seed, n, theta=(0.5, 0.2), phi=(0.3,)):
    rng = np.random.default_rng(seed)
    e, d = rng.normal(size=n), np.zeros(n)
    for t in range(n):
        d[t] = sum(p * d[t - i - 1] for i, p in enumerate(phi) if t > i) + e[t] + sum(q * e[t - i - 1] for i, q in enumerate(theta) if t > i)
    return (100 + np.cumsum(d)).tolist()


def fact(spark, closes):
    rows = [(k, 20200101 + (i // 28 // 12) * 10000 + (i // 28 % 12) * 100 + i % 28, float(c)) for k, cs in closes.items() for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, "ticker_id long, date_id int, close double").repartition(4)


def changes(closes, lags):
    d = np.diff(closes)
    out = np.full((len(closes), lags), np.nan)
    for i in range(lags):
        out[i + 1:, i] = d[:len(closes) - i - 1]
    return out


def fit(x, y):
    known = ~np.isnan(x).any(axis=1) & ~np.isnan(y)
    if known.sum() < 2 * x.shape[1]:
        return None
    return np.linalg.lstsq(x[known], y[known], rcond=None)[0]


def full_refits(closes):
    """Each row's forecast by fitting everything anew."""
    d = changes(closes, arma.LONG_AR + 1)
    e = np.full(len(closes), np.nan)
    for t in range(len(closes)):
        beta = fit(d[:t, 1:], d[:t, 0])
        if beta is not None:
            e[t] = d[t, 0] - d[t, 1:] @ beta
    lag = lambda k: np.concatenate([np.full(k, np.nan), e])[:len(e)]
    x = np.column_stack([d[:, 1:arma.AR + 1], lag(1), lag(2)])
    out = []
    for t in range(len(closes)):
        beta = fit(x[:t + 1], d[:t + 1, 0])
        now = np.concatenate([d[t, :arma.AR], [e[t], e[t - 1] if t else np.nan]])
        step = np.nan if beta is None else now @ beta
        out.append(closes[t] if np.isnan(step) else closes[t] + step)
    return out


@pytest.mark.parametrize("block_rows", [16, 37, 4096])
def test_each_row_equals_a_fit_on_its_history(spark, block_rows):
    closes = {1: series(1, 150), 2: series(2, 90), 3: [5.0] * 60, 4: [7.0], None: series(3, 70)}
    got = {}
    for r in arma.expanding_forecast(fact(spark, closes), block_rows=block_rows).collect():
        got.setdefault(r["ticker_id"], []).append((r["date_id"], r["predicted"]))
    for key, values in closes.items():
        assert [p for _, p in sorted(got[key])] == pytest.approx(full_refits(values), rel=1e-7)


def test_no_later_close_is_seen(spark):
    closes = series(4, 120)
    early = sorted((r["date_id"], r["predicted"]) for r in arma.expanding_forecast(fact(spark, {1: closes[:80]}), block_rows=32).collect())
    late = sorted((r["date_id"], r["predicted"]) for r in arma.expanding_forecast(fact(spark, {1: closes}), block_rows=32).collect())
    assert [p for _, p in early] == pytest.approx([p for _, p in late[:80]], rel=1e-9)


@pytest.mark.parametrize("block_rows", [8, 33, 4096])
def test_innovations_equal_a_plain_loop(spark, block_rows):
    closes = {1: series(5, 200), 2: series(6, 75), 9: series(7, 40)}
    models = spark.createDataFrame([(1, 0, [0.3, 0.1, 0.0, -0.1, 0.05], [0.6, -0.2]), (2, 0, [0.2, 0.0, 0.0, 0.0, 0.0], [-1.1, 0.3])],
                                   "ticker_id long, date_id int, phi array<double>, theta array<double>")
    rows = arma.with_changes(fact(spark, closes), arma.AR + 1, block_rows=block_rows)
    got = {}
    for r in arma.innovations(rows, models, block_rows=block_rows).collect():
        got.setdefault(r["ticker_id"], []).append((r["pos"], r["e0"], r["e1"]))
    for m in models.collect():
        d, now, before, expect = changes(closes[m["ticker_id"]], arma.AR + 1), 0.0, 0.0, []
        for row in d:
            u = 0.0 if np.isnan(row).any() else row[0] - row[1:] @ np.array(m["phi"])
            now, before = u - m["theta"][0] * now - m["theta"][1] * before, now
            expect.append((now, before))
        assert np.array([x[1:] for x in sorted(got[m["ticker_id"]])]) == pytest.approx(np.array(expect), abs=1e-9)
    assert all(x[1] == 0 for x in got[9])


def test_kept_model_finds_the_coefficients_and_beats_the_last_close(spark):
    closes = series(8, 1500)
    table = fact(spark, {1: closes})
    kept = arma.kept_models(arma.expanding_models(table))
    model = kept.first()
    assert model["theta"][0] + model["phi"][0] == pytest.approx(0.8, abs=0.15)  # the first step of the response is identified
    for forecast in (arma.kept_forecast(table, kept), arma.expanding_forecast(table)):
        pairs = [r["predicted"] for r in sorted(forecast.collect(), key=lambda r: r["date_id"])]
        error = np.std(np.array(closes[201:]) - np.array(pairs[200:-1]))
        assert error == pytest.approx(1.0, abs=0.06) and error < 0.85 * np.std(np.diff(closes))


def test_roots_come_inside(spark):
    for theta in ([3.0, 0.5], [0.2, -4.0], [0.0, 0.0], [2.0, 1.0], [0.4, 0.1]):
        inner = arma._invertible(theta)
        assert np.abs(np.roots([1.0, *inner])).max(initial=0) <= arma.MOST + 1e-9
    assert arma._invertible([0.4, 0.1]) == pytest.approx([0.4, 0.1])


def test_empty_table(spark):
    none = fact(spark, {1: [1.0]}).filter("close < 0")
    assert arma.expanding_forecast(none).count() == 0
    assert arma.kept_models(arma.expanding_models(none)).count() == 0
