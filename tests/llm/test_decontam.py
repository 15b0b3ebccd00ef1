"""Decontamination against a plain search over all windows."""

import random
import re
from collections import Counter

from tickloom.llm import decontam

DOCS = "doc_id long, text string, row long, item_id long, m int"
ITEMS = "item_id long, text string, row long"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items):
    out = []
    for i, text, *_ in docs:
        w = words(text)
        for item, said, _ in items:
            v = words(said)
            if not v or item is None:
                continue
            k = min(5, len(v))
            bag = Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
            m, best = len(v) - k + 1, None
            for s in range(len(w) - len(v) + 1):
                seen = Counter(tuple(w[s + j:s + j + k]) for j in range(m))
                common = sum((seen & bag).values())
                if 10 * common >= 8 * (2 * m - common) and (best is None or common > best[1]):
                    best = (s, common)
            if best:
                out.append((i, item, best[0], best[1], m))
    return sorted(out, key=repr)


def test_against_all_windows(spark):
    rng = random.Random(8)
    word = lambda: rng.choice([f"w{rng.randrange(200)}", "the", "Zürich", "42"])
    items = [(i, " ".join(word() for _ in range(n)), 0) for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 20, 20, 37, 60, 60, 120])]
    items += [(50, "ha " * 30, 0), (51, "ha " * 30 + "ho", 0), (52, None, 0), (53, "?!", 0), (None, "orphan item with five words", 0)]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.8:
            said = words(rng.choice(items[5:15])[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                said[rng.randrange(len(said))] = "changed"
            parts += said
        parts += [word() for _ in range(rng.randint(0, 20))]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(p.upper() if rng.random() < 0.2 else p for p in parts), 0, 0, 0))
    docs += [(100, None, 0, 0, 0), (101, "", 0, 0, 0), (102, "ha " * 3_000, 0, 0, 0), (103, docs[1][1], 0, 0, 0), (None, docs[1][1], 0, 0, 0)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = decontam.contaminated(frame, bench)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(docs, items)
    hit = {r[0] for r in brute(docs, items)}
    kept = decontam.without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(d[0]) for d in docs if d[0] not in hit)


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1, "a b c d e f", 0, 0, 0)], DOCS), spark.createDataFrame([], DOCS)
    bench, empty = spark.createDataFrame([(1, "a b c d e f", 0)], ITEMS), spark.createDataFrame([], ITEMS)
    assert decontam.contaminated(some, empty).count() == 0
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.without_contaminated(some, empty).count() == 1


def test_blocks_reach_every_fingerprint_within_the_radius():
    masks = set(decontam.near_masks())
    rng = random.Random(1)
    for _ in range(300):
        change = sum(1 << b for b in rng.sample(range(64), rng.randint(0, decontam.RADIUS)))
        assert any((change >> 8 * i & 255) in masks for i in range(8))


def test_texts_shorter_than_the_item(spark):
    """Items without their last or first words, or some in the middle: the whole text is the one window."""
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(n)), 0) for i, n in enumerate([6, 9, 20, 37, 60, 120])] + [(9, "ha " * 30, 0)]
    docs = []
    for _, said, _ in items:
        w = words(said)
        for cut in (0, 1, 2, 5, 8, 13, 26):
            changed = w[:max(1, len(w) - cut)]
            changed[len(changed) // 2] = "changed"
            docs += [(len(docs) + j, " ".join(x), 0, 0, 0) for j, x in enumerate((w[:max(1, len(w) - cut)], w[cut:], w[:8] + w[8 + cut:], changed))]
    want = []
    for i, text, *_ in docs:
        w = words(text)
        for item, said, _ in items:
            v = words(said)
            bag = Counter(tuple(v[j:j + 5]) for j in range(len(v) - 4))
            m, n = len(v) - 4, max(0, len(w) - 4)
            wide, best = min(m, n), None
            for s in range(n - wide + 1 if n else 0):
                common = sum((Counter(tuple(w[s + j:s + j + 5]) for j in range(wide)) & bag).values())
                if 10 * common >= 8 * (m + wide - common) and (best is None or common > best[1]):
                    best = (s, common, common / (m + wide - common))
            if best:
                want.append((i, item, best[0], best[1], m, best[2]))
    got = sorted(map(tuple, decontam.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()))
    assert got == sorted(want)
    size = {i: len(words(t)) for i, t, *_ in docs}
    assert sum(size[i] - 4 < m for i, _, _, _, m, _ in got) >= 20


def test_no_rows_come_from_python(spark, tmp_path, monkeypatch):
    """Rows of a Python list start Python workers in every executor, which stay there."""
    docs, items, plans, store = str(tmp_path / "documents"), str(tmp_path / "benchmark"), [], decontam.store
    item = " ".join(f"w{i}" for i in range(30))
    spark.createDataFrame([(1, "a b c " + item, 0, 0, 0), (2, "d e f g h", 0, 0, 0)], DOCS).write.parquet(docs)
    spark.createDataFrame([(1, item, 0)], ITEMS).write.parquet(items)

    def look(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(decontam, "store", look)
    assert [r.doc_id for r in decontam.contaminated(spark.read.parquet(docs), spark.read.parquet(items)).collect()] == [1]
    assert plans and not [p for p in plans if "ExistingRDD" in p]
    assert decontam.contaminated(spark.read.parquet(docs), spark.read.parquet(items).filter("item_id is null")).count() == 0
