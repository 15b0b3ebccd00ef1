import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from tickloom.schemas import BRONZE

DAY0 = dt.datetime(2024, 1, 1)


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def bars(spark, series, interval="1d", step=dt.timedelta(days=1)):
    """``series``: ticker -> list of closes or of (close, volume)."""
    rows = []
    for ticker, values in series.items():
        for i, value in enumerate(values):
            close, volume = value if isinstance(value, tuple) else (value, 100 + (i * 37) % 50)
            start = DAY0 + i * step
            rows.append((ticker, start, start + step, close, close, close, close, volume, None, None,
                         interval, DAY0, "test", "b0", start.date()))
    return spark.createDataFrame(rows, BRONZE)


def ticks(spark, rows):
    """Rows of (ticker, price, volume, timestamp_ms, seq)."""
    return spark.createDataFrame(
        rows, "ticker string, price double, volume long, timestamp_ms long, seq long")


def as_dicts(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()] if order else [r.asDict() for r in df.collect()]


def shuffled(df, seed=7):
    return df.orderBy(F.rand(seed))
