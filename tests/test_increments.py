"""Indicators continued batch by batch, and releases that switch as a whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY0, as_dicts, bars
from tickloom.operators.indicators import add_indicators, continue_indicators, split_late
from tickloom.plans import pipeline as P
from tickloom.schemas import INDICATORS
from tickloom.session import cut_lineage
from tickloom.sources import release

COLUMNS = ["is_outlier", *INDICATORS]


def walk(seed, n):
    rng, price, out = random.Random(seed), 100.0, []
    for _ in range(n):
        price = max(1.0, price + rng.choice([0, 0, 1, -1, 2.5, -2.5]))
        out.append((round(price, 2), rng.randint(1, 5000)))
    return out


def by_key(df):
    return {(r["ticker"], r["bar_interval"], r["window_start"]): [r[c] for c in COLUMNS] for r in df.collect()}


@pytest.mark.parametrize("cuts", [(700, 1400), (1, 2), (33, 34), (600, 1201)])
def test_batches_equal_one_run(spark, cuts):
    frame = bars(spark, {"A": walk(1, 1900), "B": walk(2, 650), "C": [(5.0, 7)] * 900, None: walk(3, 40)}).cache()
    day = F.datediff("window_start", F.lit(DAY0))
    state, got = None, {}
    for low, high in zip((0, *cuts), (*cuts, 10**6)):
        batch = frame.filter((day >= low) & (day < high))
        if low:  # a series that begins later, and one that has no bars for a while
            batch = batch.unionByName(bars(spark, {f"N{low}": walk(low, 50)}))
        done, state = continue_indicators(cut_lineage(batch, "batch"), state, block_rows=600, warmup=600)
        got |= by_key(done)
    whole = by_key(add_indicators(frame.unionByName(bars(spark, {f"N{c}": walk(c, 50) for c in cuts})), COLUMNS))
    assert got.keys() == whole.keys()
    for key, values in whole.items():
        assert [v is None for v in got[key]] == [v is None for v in values], key
        assert [v or 0 for v in got[key]] == pytest.approx([v or 0 for v in values], rel=1e-9, abs=1.1e-4), key  # rounded to four digits
    ends = {r["ticker"]: r["rows"] for r in state.collect()}
    assert ends["A"] == 1900 and ends["B"] == 650 and ends[None] == 40


def test_late_bars_are_told_apart_and_empty_batches_keep_the_state(spark):
    first = cut_lineage(bars(spark, {"A": walk(1, 60), "B": walk(2, 30)}), "batch")
    _, state = continue_indicators(first)
    later, late = split_late(bars(spark, {"A": walk(5, 61), "B": walk(2, 40)}).filter(F.col("window_start") >= DAY0 + dt.timedelta(days=30)), state)
    assert {r["ticker"] for r in later.collect()} == {"B"} and {r["ticker"] for r in late.collect()} == {"A"}
    done, same = continue_indicators(cut_lineage(first.filter("1 = 0"), "none"), state)
    assert done.count() == 0
    order = lambda s: as_dicts(s.orderBy("ticker"))
    assert order(same) == order(state)


def test_increments_equal_one_run_and_corrections_are_computed_anew(spark, tmp_path):
    lake = P.Lake(str(tmp_path / "lake"), ("month",))
    from tickloom.sources.lake import write_bars
    table = bars(spark, {"A": walk(1, 90), "B": walk(2, 90)})
    root = f"{lake.root}/releases"

    def land(part, name):
        write_bars(part, lake.bronze, partition_by=lake.partition_by)
        return P.run_increment(spark, lake, part, name)

    cut = DAY0 + dt.timedelta(days=60)
    land(table.filter(F.col("window_start") < cut), "r1")
    land(table.filter(F.col("window_start") >= cut), "r2")
    assert len(release.current(spark, root)["silver"]) == 2
    assert by_key(release.read(spark, root, "silver")) == by_key(add_indicators(table, COLUMNS))
    fixed = table.filter((F.col("ticker") == "A") & (F.col("window_start") == DAY0 + dt.timedelta(days=20))) \
        .withColumns({"close": F.lit(500.0), "ingested_at": F.lit(DAY0 + dt.timedelta(days=999))})
    land(fixed, "r3")
    assert len(release.current(spark, root)["silver"]) == 1
    expect = table.join(fixed.select("ticker", "window_start"), ["ticker", "window_start"], "left_anti").select(*table.columns).unionByName(fixed)
    assert by_key(release.read(spark, root, "silver")) == by_key(add_indicators(expect, COLUMNS))
    assert release.read(spark, root, "fact_stock_prices").count() == 180


def test_a_death_or_a_bad_verdict_shows_the_old_release(spark, tmp_path):
    root = str(tmp_path / "releases")
    frame = lambda n: spark.createDataFrame([(n,)], "n long")
    shown = lambda: {k: release.read(spark, root, k).first()["n"] for k in release.current(spark, root)}
    assert release.read(spark, root, "a") is None
    first = release.Release(spark, root, "r1")
    first.add("a", frame(1))
    first.add("b", frame(1))
    assert shown() == {}
    assert first.publish() and shown() == {"a": 1, "b": 1}
    dead = release.Release(spark, root, "r2")
    dead.add("a", frame(2))  # the run ends here
    assert shown() == {"a": 1, "b": 1}
    refused = release.Release(spark, root, "r3")
    refused.add("a", frame(3))
    refused.add("b", frame(3))
    assert not refused.publish(lambda: False) and shown() == {"a": 1, "b": 1}
    assert refused.publish() and shown() == {"a": 3, "b": 3}


def test_parts_are_joined_when_they_are_many(spark, tmp_path):
    root = str(tmp_path / "releases")
    for i in range(5):
        run = release.Release(spark, root, f"r{i}")
        run.extend("a", spark.createDataFrame([(i,)], "n long"), parts=3)
        run.publish()
        assert sorted(r["n"] for r in release.read(spark, root, "a").collect()) == list(range(i + 1))
    assert len(release.current(spark, root)["a"]) == 2
