"""FM-index and passage removal against brute force."""

import random

import numpy as np
import pytest

from tickloom.llm import passages
from tickloom.llm.fmindex import FmIndex

DOCS = "doc_id long, text string, row long, kept string, route long"


def brute(data, window):
    words = {i: [w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w] for i, t, *_ in data}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s:s + window]), i)
    out = []
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out)


def corpus(seed, docs=80):
    rng = random.Random(seed)
    word = lambda: rng.choice([f"w{rng.randrange(300)}", "the", "É日"])
    shared = [[word() for _ in range(rng.choice([10, 12, 13, 20, 60]))] for _ in range(8)]
    texts = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += rng.choice(shared) if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, 40))]
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(parts))
    texts += [texts[3], texts[3], "", None, "a " * 900, "b " + "a " * 700, "a " * 900]
    ids = rng.sample(range(10_000), len(texts))
    return [(i, t, 0, "", 0) for i, t in zip(ids, texts)]


@pytest.mark.parametrize(("seed", "split"), [(1, False), (2, False), (3, True)])
def test_against_brute_force(spark, seed, split):
    data = corpus(seed)
    # shards of 30 words: every minimizer with more than one segment is split
    got = passages.without_repeats(spark.createDataFrame(data, DOCS), ["row"], window=12, gram=5, shard_words=30 if split else 500).drop("row")
    assert sorted(map(tuple, got.collect())) == brute(data, 12)


def test_production_window(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(1, "x " + passage + " y", 0, "", 0), (2, passage.replace("p30", "q"), 0, "", 0), (3, "z " * 40 + passage, 0, "", 0),
            (4, " ".join(passage.split()[:49]), 0, "", 0), (5, " ".join(passage.split()[5:55]) + " end", 0, "", 0)]
    got = passages.without_repeats(spark.createDataFrame(data, DOCS)).collect()
    assert sorted(map(tuple, got)) == brute(data, 50)
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 60, 4: 0, 5: 50}


def test_null_ids_shared_ids_and_empty_table(spark):
    assert passages.without_repeats(spark.createDataFrame([], DOCS)).count() == 0
    p = " ".join(f"p{i}" for i in range(60))
    data = [(None, p, 0, "", 0), (4, p, 0, "", 0), (4, p, 0, "", 0), (4, p + " q", 0, "", 0), (9, p + " q", 0, "", 0)]
    got = passages.without_repeats(spark.createDataFrame(data, DOCS)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("4", 0), ("4", 0), ("4", 0), ("9", 61), ("None", 0)]


def test_index_counts_and_minima():
    rng = np.random.default_rng(7)
    for _ in range(30):
        sizes = rng.integers(0, 40, rng.integers(1, 12))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        symbols = rng.integers(0, 3, bounds[-1])
        index = FmIndex(symbols, bounds, 4)
        seqs = [tuple(symbols[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
        names = np.unique(symbols)
        for _ in range(10):
            pattern = rng.integers(0, 3, rng.integers(1, 5)).tolist()
            low, high = np.array([0]), np.array([len(index.text)])
            for s in reversed(pattern):
                if s not in names:
                    low = high
                    break
                low, high = index.step(low, high, np.array([np.searchsorted(names, s) + 1]))
            want = sum(s[i:i + len(pattern)] == tuple(pattern) for s in seqs for i in range(len(s)))
            assert int(high[0] - low[0]) == want
        value = rng.integers(0, 100, len(sizes))
        least, cuts = index.matching(value)
        for k, s in enumerate(seqs):
            for i in range(len(s) - 3):
                same = [value[j] for j, t in enumerate(seqs) for x in range(len(t) - 3) if t[x:x + 4] == s[i:i + 4]]
                assert least[cuts[k] + i] == min(same)


@pytest.mark.parametrize("split", [False, True])
def test_shards_hold_a_segment_once_however_many_copies_there_are(spark, monkeypatch, split):
    """A third of the rows are copies of one text, others share a passage in different surroundings."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5_000)}"
    text, passage = [[word() for _ in range(n)] for n in (60, 14)]
    texts = [" ".join(text)] * 150 + [" ".join([word() for _ in range(9)] + passage + [word() for _ in range(9)]) for _ in range(150)]
    data = [(i, t, 0, "", 0) for i, t in zip(rng.sample(range(10_000), len(texts)), texts)]
    seen, store = {}, passages.store

    def look(df, name):
        seen[name] = store(df, name)
        if name == "judged":
            copies = seen["segments"].groupBy("route", "content_hash").count()
            assert copies.agg({"count": "max"}).first()[0] >= 150
            assert seen[name].count() == seen[name].select("route", "content_hash").distinct().count()
        return seen[name]

    monkeypatch.setattr(passages, "store", look)
    got = passages.without_repeats(spark.createDataFrame(data, DOCS), ["row"], window=12, gram=5, shard_words=30 if split else 50_000).drop("row")
    assert sorted(map(tuple, got.collect())) == brute(data, 12)
    assert "judged" in seen


def python_steps(plan):
    """Python steps in the tasks of a plan: of the last stage so far, and the most of any stage."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return python_steps(plan.initialPlan())
    children = plan.children()
    below = [python_steps(children.apply(i)) for i in range(children.size())]
    here = max([n for n, _ in below], default=0) + (plan.nodeName() == "MapInArrow")
    most = max([here, *[m for _, m in below]])
    return (0, most) if plan.nodeName() == "Exchange" else (here, most)


def test_a_task_needs_one_python_worker(spark, tmp_path):
    """Also where the ranges are few and Spark would send them to all tasks."""
    p = " ".join(f"p{i}" for i in range(60))
    path = str(tmp_path / "documents")
    spark.createDataFrame([(1, p, 0, "", 0), (2, "a " + p, 0, "", 0), (3, "b", 0, "", 0)], DOCS).write.parquet(path)
    for f in (passages.without_repeats, passages.with_repeats_cut):
        got = f(spark.read.parquet(path))
        assert python_steps(got._jdf.queryExecution().executedPlan())[1] == 1
        assert got.count() == 3
