"""Upserts that are merged on read."""

import glob

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan
from tickloom.sources import changes as C
from tickloom.sources import release

ROW = "k string, d int, v long"


def rows(df):
    return sorted(map(tuple, df.select("k", "d", "v").collect()), key=str)


def test_any_batches_and_packing_give_the_newest_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    assert C.read_merged(spark, root, "bars", ["k", "d"]) is None
    expect = {}
    for i in range(7):
        batch = [(k, d, 100 * i + d) for k in ("a", None, "hot") for d in range(i, i + 4)]
        batch += [(k, d, v - 1) for k, d, v in batch]  # an older copy of each row in the same batch
        C.append_changes(spark.createDataFrame(batch, ROW), root, "bars", ["k", "d"], ["v"], parts=3)
        expect |= {(k, d): max(v for k2, d2, v in batch if (k2, d2) == (k, d)) for k, d, _ in batch}
        want = sorted(((k, d, v) for (k, d), v in expect.items()), key=str)
        before = C.read_merged(spark, root, "bars", ["k", "d"])
        assert rows(before) == want
        if i == 4:
            C.pack(spark, root, "bars", ["k", "d"], share=100.0)
            assert len(release.current(spark, root)["bars" + C.CHANGES]) == 1
            assert rows(C.read_merged(spark, root, "bars", ["k", "d"])) == want
        if i == 5:
            C.pack(spark, root, "bars", ["k", "d"], share=0.0)
            assert "bars" + C.CHANGES not in release.current(spark, root)
            assert rows(C.read_merged(spark, root, "bars", ["k", "d"])) == rows(before) == want  # a reader from before still reads


def test_a_batch_writes_its_own_rows_and_a_repeated_one_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    C.append_changes(spark.range(1000).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("d"), F.col("id").alias("v")), root, "bars", ["k", "d"])
    C.pack(spark, root, "bars", ["k", "d"])
    before = set(glob.glob(f"{root}/runs/*/*/*.parquet"))
    small = spark.createDataFrame([("a", 5, -1), ("b", 1, 1)], ROW)
    for _ in range(2):
        C.append_changes(small, root, "bars", ["k", "d"])
        merged = C.read_merged(spark, root, "bars", ["k", "d"])
        assert merged.count() == 1001 and merged.filter("d = 5").first()["v"] == -1
    new = set(glob.glob(f"{root}/runs/*/*/*.parquet")) - before
    assert spark.read.parquet(*new).count() == 4
    # the rows are not shuffled: the keys of the changes are broadcast
    assert "BroadcastHashJoin" in plan(merged) and "SortMergeJoin" not in plan(merged)


def test_empty_batches_other_columns_and_a_death_before_the_pointer(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    C.append_changes(spark.createDataFrame([], ROW), root, "bars", ["k", "d"])
    assert C.read_merged(spark, root, "bars", ["k", "d"]) is None
    C.append_changes(spark.createDataFrame([("a", 1, 1)], ROW), root, "bars", ["k", "d"])
    with pytest.raises(ValueError, match="columns of bars"):
        C.append_changes(spark.createDataFrame([("a", 1)], "k string, d int"), root, "bars", ["k", "d"])
    with monkeypatch.context() as m:
        m.setattr(release.Release, "publish", lambda self: 1 / 0)
        for step in (lambda: C.append_changes(spark.createDataFrame([("a", 1, 2)], ROW), root, "bars", ["k", "d"]),
                     lambda: C.pack(spark, root, "bars", ["k", "d"])):
            with pytest.raises(ZeroDivisionError):
                step()
            assert rows(C.read_merged(spark, root, "bars", ["k", "d"])) == [("a", 1, 1)]
    C.append_changes(spark.createDataFrame([("a", 1, 2)], ROW), root, "bars", ["k", "d"])
    assert rows(C.read_merged(spark, root, "bars", ["k", "d"])) == [("a", 1, 2)]
