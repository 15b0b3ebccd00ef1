"""Elias-Fano sequences, the trie and language-model scores against plain Python."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import ngram
from tickloom.llm.common import Words
from tickloom.llm.eliasfano import EliasFano, Trie, pack, unpack

DOCS = "doc_id long, text string"


@pytest.mark.parametrize(("n", "top"), [(1, 1), (1, 1 << 60), (1000, 1200), (3000, 300), (5000, 1 << 40), (5000, (1 << 64) - 1)])
def test_sequences_equal_binary_search(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    sequence = EliasFano(unpack(np.frombuffer(pack(EliasFano.build(values)), np.uint8)))
    assert (sequence.value(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, top, 3000, dtype=np.uint64), np.array([0, top - 1, top], np.uint64)])
    place, same = sequence.successor(asked)
    assert (place == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()


def test_trie_finds_what_it_holds_and_nothing_else(tmp_path):
    rng = np.random.default_rng(3)
    words = np.unique(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
    below = [np.unique(rng.integers(0, ngram.START + 1, rng.integers(1, 60))).astype(np.uint32) for _ in words]
    kids, contexts = np.array([len(b) for b in below], np.uint32), np.concatenate(below)
    values = -rng.random(len(contexts)) * 8
    file = tmp_path / "trie"
    file.write_bytes(Trie.build(words, np.arange(1, len(words) + 1), kids, contexts, values))
    trie = Trie(np.memmap(file, np.uint8, "r"))
    node, there = trie.find(words)
    assert there.all() and (trie.counts[node] == np.arange(1, len(words) + 1)).all()
    assert not trie.find(np.setdiff1d(rng.integers(0, 1 << 64, 500, dtype=np.uint64), words))[1].any()
    got, found = trie.look(np.repeat(node, kids), contexts)
    assert found.all() and np.abs(got - values).max() < 8 / 256
    for i, held in enumerate(below):
        asked = np.arange(0, ngram.START + 1, 97, dtype=np.uint32)
        assert (trie.look(np.full(len(asked), node[i]), asked)[1] == np.isin(asked, held)).all()


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [None]


def classes(words):
    import pyarrow as pa
    found = Words(pa.array([" ".join(words)]))
    return dict(zip(words, (found.hashes >> np.uint64(64 - ngram.CLASS_BITS)).tolist(), strict=True))


def plain(docs, weight):
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    group = classes(sorted({w for _, t in docs for w in tokens(t) if w is not None}))
    count, pair, context = collections.Counter(), collections.Counter(), collections.Counter()

    def steps(text):
        words = tokens(text)
        return zip(["start", *[group[w] for w in words[:-1]]], words)

    for i, t in docs:
        if not held(i):
            for g, w in steps(t):
                count[w] += 1
                pair[g, w] += 1
                context[g] += 1
    total, kinds = sum(count.values()), len(count)
    out = []
    for i, t in docs:
        base = score = known = n = 0
        for g, w in steps(t):
            p = (count[w] + 0.1) / (total + 0.1 * (kinds + 1))
            base += math.log10(p)
            score += math.log10((pair[g, w] + weight * p) / (context[g] + weight))
            known += count[w] > 0
            n += 1
        out.append((i, held(i), n, known, total, base, score))
    return out


def corpus(seed, n=250):
    rng = random.Random(seed)
    pool = [f"Wort{i}" for i in range(120)] + ["the", "THE", "of", "É日", "x" * 300]
    docs = [(i * 3, rng.choice([" ", "\n", " \t"]).join(rng.choice(pool) for _ in range(rng.randint(0, 80)))) for i in range(n)]
    return docs + [(1, None), (2, ""), (4, " \n "), (3, docs[1][1]), (None, "the of the"), (5, "the " * 40_000)]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 900, "fine_bytes": 300, "piece": 40}])
def test_scores_equal_plain_counting(spark, options):
    docs = corpus(1)
    frame = spark.createDataFrame(docs, DOCS).repartition(5)
    for name in ("block", "part", "kind", "a", "shard", "score", "n_tokens"):
        frame = frame.withColumn(name, F.lit("clash"))
    model = ngram.train(frame, **options)
    got = sorted(map(tuple, ngram.scored(frame, model).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    expect = sorted(plain(docs, ngram.WEIGHT), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert len(got) == len(expect)
    for a, b in zip(got, expect, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], abs=0.02 * b[2])  # the steps of the codes
    if options:  # "the" is a third of all words and more: its shard has several tasks
        assert max(model.share.values()) * model.shards > 4


def test_held_out_texts_gain_from_context_and_probabilities_sum_to_one(spark):
    rng = random.Random(2)
    follow = {w: rng.sample(range(60), 3) for w in range(60)}

    def text():
        w, out = rng.randrange(60), []
        for _ in range(60):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        return " ".join(out)

    frame = spark.createDataFrame([(i, text()) for i in range(400)], DOCS)
    model = ngram.train(frame)
    held = ngram.scored(frame, model).filter("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert held[1] > held[0] + 0.5 * held[2]
    # the next word after w0: every known word, the end, and the place of unknown ones
    ask = spark.createDataFrame([(i, f"w0 {w}") for i, w in enumerate([*(f"w{i}" for i in range(60)), "unknown"])] + [(900, "w0")], DOCS)
    rows = {r["doc_id"]: r["score"] for r in ngram.scored(ask, model).collect()}
    end = {i: ngram.scored(spark.createDataFrame([(0, f"w{i}")], DOCS), model).first()["score"] for i in (0,)}
    assert end[0] == pytest.approx(rows[900], abs=1e-9) and all(rows[i] < 0 for i in rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    model = ngram.train(none)
    assert ngram.scored(none, model).count() == 0
    lone = ngram.scored(spark.createDataFrame([(7, "a b")], DOCS), model).first()
    assert lone["n_tokens"] == 3 and lone["n_known"] == 0 and lone["base_score"] == pytest.approx(0.0)
