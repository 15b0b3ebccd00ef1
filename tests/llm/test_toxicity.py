"""The toxicity network: gradients, windows, held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import toxicity

DOCS = "doc_id long, text string, score double, held_out string"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=500, seed=2):
    """Clean text, and text with one or two bad words, some of them forms of a stem that are seen nowhere else."""
    rng = random.Random(seed)
    parts = ["an", "er", "on", "th", "is", "re", "at", "ing"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([3, 20, 60, 200]))]
        bad = rng.random() < 0.25
        for _ in range(2 * bad):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["Scum!", "vile", "zorg" + word(), "zorg" + word() + ","]))
        rows.append((i, " ".join(words), 0.5, "clash"))
        labels.append((i, 0, int(bad)))
    return rows, labels


def test_windows_cover_every_word_and_overlap():
    texts = ["", None, "one", " ".join(str(i) for i in range(toxicity.WINDOW)), " ".join(str(i) for i in range(3 * toxicity.WINDOW + 7))]
    batch = toxicity.read(pa.array(texts))
    assert np.diff(batch.firsts).tolist()[:4] == [1, 1, 1, 1]
    for i, t in enumerate(texts):
        seen = batch.windows[batch.firsts[i]:batch.firsts[i + 1]]
        assert len(np.unique(seen[seen > 0])) == len(set((t or "").split()))
    long = batch.windows[batch.firsts[4]:]
    assert all(len(np.intersect1d(a, b)) >= toxicity.WINDOW - toxicity.STRIDE for a, b in zip(long, long[1:]))


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(toxicity, "GRAMS", 64)
    batch = toxicity.read(pa.array(["alpha beta gamma beta", "delta " * 50]))
    net = toxicity.Network(batch.words[:2].copy(), np.zeros(2, np.float32), np.zeros(64, np.float32), 0.3)
    rng = np.random.default_rng(0)
    net.w = {k: v.astype(np.float64) + rng.normal(0, 0.2, v.shape) for k, v in net.w.items()}
    net.w["word"][-1] = 0
    target = np.array([1.0, 0.0, 1.0][:len(batch.windows)])

    def loss():
        x, _ = net.vectors(batch)
        p = toxicity._sigmoid(net.forward(x.astype(np.float64), batch.windows)[0].astype(np.float64))
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    x, row = net.vectors(batch)
    grad = net.gradients(batch, x, row, batch.windows, target)
    for name, g in grad.items():
        flat = net.w[name].reshape(-1)
        for k in np.argsort(-np.abs(np.asarray(g).reshape(-1)))[:3]:
            old = flat[k]
            flat[k] = old + 1e-2
            up = loss()
            flat[k] = old - 1e-2
            down = loss()
            flat[k] = old
            assert np.asarray(g).reshape(-1)[k] == pytest.approx((up - down) / 2e-2, rel=0.08, abs=2e-4), name


def test_held_out_accuracy_and_no_other_inputs(spark):
    rows, labels = corpus()
    rows += [(900, None, 0.0, ""), (901, "", 0.0, ""), (902, "thanis " * 30_000 + "scum", 0.0, ""), (903, "thanis " * 30_000, 0.0, ""), (None, "scum", 0.0, ""),
             (904, rows[0][1], 0.0, "")]
    got = toxicity.scored(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    tested = [(by[i].predicted, t) for i, _, t in labels if by[i].held_out]
    assert np.mean([a == b for a, b in tested]) >= 0.97
    assert by[900].score == by[901].score and by[904].score == pytest.approx(by[0].score, abs=1e-6)
    assert by[902].predicted == 1 and by[903].predicted == 0 and by[None].predicted == 1


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(120)
    wrong = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    docs = spark.createDataFrame(rows, DOCS)
    a, b = (toxicity.sample(docs, spark.createDataFrame(x, LABELS)) for x in (labels, wrong))
    assert a == b and len(a[0]) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in labels)
    assert len(toxicity.sample(docs, spark.createDataFrame(labels, LABELS), 10)[0]) == 10


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a", 0.0, "")], DOCS)
    assert toxicity.scored(docs, spark.createDataFrame([], LABELS)).first().score == 0.0
    assert toxicity.scored(docs, spark.createDataFrame([(1, None, 1), (1, 0, None)], LABELS)).first().score == 1.0
    assert toxicity.scored(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 0, 1)], LABELS)).count() == 0
