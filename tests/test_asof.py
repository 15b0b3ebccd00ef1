"""As-of join against a plain loop, and history lines that do not parse."""

import datetime as dt
import random

import pytest

from tickloom.operators.asof import asof_join
from tickloom.sources.history import read_history_checked

START = dt.datetime(2001, 1, 1)


def brute(left, right, forward, exact):
    out = []
    for i, k, t in left:
        near = [(abs((u - t).total_seconds()), -v) for q, u, v in right if None not in (k, t, q, u) and q == k
                and (u == t and exact or (u > t if forward else u < t))]
        out.append((i, -min(near)[1] if near else None))
    return sorted(out)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("exact", [False, True])
def test_equals_a_plain_loop(spark, forward, exact):
    rng = random.Random(7)

    def time():  # ties, close rows and gaps of years
        return None if rng.random() < 0.03 else START + dt.timedelta(days=rng.choice([0, 1, 2, 4000, 9000]), seconds=rng.randrange(40))

    left = [(i, rng.choice(["a", "a", "a", "b", "none", None]), time()) for i in range(300)]
    right = [(rng.choice(["a", "a", "b", "other", None]), time(), rng.randrange(50)) for _ in range(120)]
    got = asof_join(
        spark.createDataFrame(left, "id int, k string, t timestamp"), spark.createDataFrame(right, "k string, u timestamp, v int"),
        ["k"], "t", "u", ["v"], forward=forward, exact=exact, block_rows=7)
    assert got.columns == ["id", "k", "t", "v"]
    rows = [(r.id, r.v) for r in got.collect()]
    local = [(i, k, t) for i, k, t in left]
    assert sorted(rows, key=lambda r: r[0]) == brute(local, right, forward, exact)


def test_empty_sides_and_clashing_names(spark):
    left, right = "k string, t timestamp", "k string, u timestamp, v int"
    one = spark.createDataFrame([("a", START)], left)
    assert asof_join(one, spark.createDataFrame([], right), ["k"], "t", "u", ["v"]).collect()[0].v is None
    assert asof_join(spark.createDataFrame([], left), spark.createDataFrame([("a", START, 1)], right), ["k"], "t", "u", ["v"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(one, one.withColumn("u", one.t), ["k"], "t", "u", ["t"])


def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    head = "ticker,date,open,high,low,close,volume,source,ingested_at"
    good = "0700,2024-01-02T00:00:00,1,2,0.5,1.5,10,x,y"
    bad = {
        "0700,2024-01-03T00:00:00,1,2,0.5,abc,10,x,y": "close",
        "0700,not a day,1,2,0.5,1.5,ten,x,y": "date,volume",
        "0700,2024-01-05T00:00:00,1,2": "line",
        good + ",more": "line",
    }
    (tmp_path / "h.csv").write_text("\n".join([head, good, *bad]) + "\n")
    rows, rejects = read_history_checked(spark, str(tmp_path))
    assert [(r.ticker, r.close, r.volume) for r in rows.collect()] == [("0700", 1.5, 10)]
    assert {r.raw: r.failed for r in rejects.collect()} == bad
