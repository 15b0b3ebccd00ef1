"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import spelling

DOCS = "doc_id long, text string"


def counts(docs, drop=spelling.DROP, least=6, often=5):
    seen = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= least and n >= often}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def random_words(seed, n=500, letters="abéÿ×÷z"):
    rng, words = random.Random(seed), {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.choice([6, 6, 7, 8, 9, 12, 13])))
        for _ in range(rng.randint(0, 4)):
            words[w] = rng.choice([5, 6, 7, 30, 30, 160, 900, 5000])
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + w[i + 1:], w])
            if len(w) < 6:
                break
    return words


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"group_words": 3}), (3, {"slab_letters": 60}), (4, {"group_words": 7, "slab_letters": 200})])
def test_groups_equal_all_pairs(spark, seed, options):
    words = random_words(seed)
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = list(map(tuple, spelling.variant_groups(frame, **options).collect()))
    assert len(got) == len(words) and set(got) == grouped(words)


def test_shared_prefix_of_all_words_and_long_words(spark):
    words = {"z" * 300 + str_: n for str_, n in (("abcdef", 500), ("abcdeg", 6), ("abcde", 40), ("xbcdef", 9), ("xycdef", 7))}
    words |= {"same" * 3 + c: i + 5 for i, c in enumerate("abcdefgh")}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert set(map(tuple, spelling.variant_groups(frame, group_words=4).collect())) == grouped(words)


def test_vocabulary_of_texts(spark):
    rng = random.Random(5)
    pool = ["Bücher", "BÜCHER", "strasse", "Straßen", "naïveté", "x×÷yÀÿ", "short", "dot.dot", "日本語mixedß", "a" * 90, "letters" * 9]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 60)))) for i in range(150)]
    docs += [(3, docs[3][1]), (None, "nothing nothing nothing nothing nothing nothing"), (900, None), (901, ""), (902, "plain " * 30_000)]
    more = spark.createDataFrame(docs, DOCS).withColumn("n", F.lit(3)).withColumn("word", F.lit("clash")).withColumn("form", F.lit("clash"))
    for drop in (spelling.DROP, 3):
        got = {r["word"]: r["n"] for r in spelling.vocabulary(more, drop=drop).collect()}
        assert got == counts(docs, drop)
        assert set(map(tuple, spelling.variant_groups(spelling.vocabulary(more, drop=drop)).collect())) == grouped(got)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert spelling.variant_groups(spelling.vocabulary(none)).count() == 0
    lone = spark.createDataFrame([("single", 9)], "word string, n long")
    assert [tuple(r) for r in spelling.variant_groups(lone).collect()] == [("single", None, "single", 9, 0, None)]
