"""Connected components of long chains; batches of a bounded size; shuffle files."""

import random
import time

import pyarrow as pa
import pytest

from tickloom.llm import common


def chain(ids):
    return list(zip(ids, ids[1:]))


@pytest.mark.parametrize("order", ["shuffled", "falling"])
def test_long_chains_settle_in_few_rounds(spark, monkeypatch, order):
    ids = list(range(10_000, 12_000))
    random.Random(6).shuffle(ids) if order == "shuffled" else ids.reverse()
    small = [(5, 3), (3, 5), (8, 8), (4, 9), (9, 7)]
    stored, store = [], common.store
    monkeypatch.setattr(common, "store", lambda df, name: stored.append(name) or store(df, name))
    got = common.components(spark.createDataFrame(chain(ids) + small, "a long, b long")).collect()
    assert dict(map(tuple, got)) == dict.fromkeys(ids, 10_000) | {3: 3, 5: 3, 4: 4, 9: 4, 7: 4}
    assert len(got) == 2_005
    assert stored.count("labels") <= 1 + 2 * 16


def test_batches_for_python_are_bounded_by_bytes(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = [(i, "x" * 5_000) for i in range(4_000)] + [(4_000, "y" * (2 * common.BATCH_BYTES))]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    got = common.table(spark, str(tmp_path), "documents").mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 4_001
    assert all(r.bytes < 1.1 * common.BATCH_BYTES + 5_000 for r in got if r.bytes < 2 * common.BATCH_BYTES)
    assert sum(r.bytes >= 2 * common.BATCH_BYTES for r in got) == 1
    # the powers for hashing grow in steps, whatever comes first
    for n in (1, common.CHUNK_BYTES // 4, common.CHUNK_BYTES + 7, 3):
        up, down = common._powers(n)
        assert len(up) == len(down) == n and (up * down == 1).all()


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {f for f in files.split() if "shuffle_" in f}

    spark.range(1_000).selectExpr("id as doc_id", "repeat('x', cast(id as int)) as text").write.parquet(str(tmp_path / "documents.parquet"))
    docs = common.table(spark, str(tmp_path), "documents")
    before = shuffled()
    counts = docs.groupBy("text").count()
    got = common.store(counts.join(docs.groupBy("text").agg({"doc_id": "max"}), "text"), "counts")
    assert got.count() == 1_000
    assert len(counts.collect()) == len(counts.collect()) == 1_000  # a frame can be run again
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
