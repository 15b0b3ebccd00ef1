"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import jaccard

DOCS = "doc_id long, text string, a long, b long, sig long, component long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(data, n, percent):
    sets = [(i, shingles(t, n)) for i, t, *_ in data]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return sorted((i, len(s), find(i)) for i, s in sets)


def corpus(seed, groups=12, members=14):
    """Groups of copies with a few words changed, copies of copies, tiny texts, and one larger hot group."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß", "日本"]
    out = []

    def word():
        return rng.choice(vocabulary)

    def edited(w, changes):
        w = list(w)
        for _ in range(changes):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[word()], [word(), word()], [], ["hot"]])
            w = w or ["x"]
        return w

    for g in range(groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 4, 6, 10, 20, 30, 60, 150, 400]))]
        for _ in range(rng.randint(1, members)):
            base = edited(base, rng.choice([0, 0, 1])) if rng.random() < 0.3 else base
            out.append(edited(base, rng.choice([0, 0, 1, 1, 2, 3])))
    base = [word() for _ in range(90)]
    out += [edited(base, rng.choice([0, 1, 2, 3, 4])) for _ in range(60)]
    texts = [rng.choice([" ", "\n", "  "]).join(w) for w in out] + ["", None, " \t\n", "UP down up", "up DOWN up"]
    ids = rng.sample(range(10_000), len(texts))
    return [(i, t, 1, 2, 3, 4) for i, t in zip(ids, texts)]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 5, 80), (3, 3, 80), (4, 1, 90)])
def test_components_equal_all_pairs(spark, seed, n, percent):
    data = corpus(seed)
    got = jaccard.similar_documents(spark.createDataFrame(data, DOCS), n, percent).collect()
    assert sorted(map(tuple, got)) == brute(data, n, percent)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for size in [1, 2, 5, 9, 10, 11, 19, 20, 40, 77, 200, 900]:
            for _ in range(20):
                a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
                cut = rng.integers(0, size * (100 - percent) // (100 + percent) + 1)
                b = np.concatenate([a[cut:], rng.integers(0, 1 << 63, rng.integers(0, cut + 2), dtype=np.uint64)])
                common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                if 100 * common < percent * union:
                    continue
                x, y = np.unique(a), np.unique(b)
                sigs, cuts, need = jaccard.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), percent)
                both = np.intersect1d(sigs[:cuts[1]], sigs[cuts[1]:])
                assert len(both) and any(np.sum((both & np.uint64(1)) == i) >= max(need[i]) for i in (0, 1))


def test_hashed_sets_have_the_sizes_of_the_real_ones():
    texts = [t for _, t, *_ in corpus(9)]
    grams, bounds = jaccard.shingle_sets(pa.array(texts, pa.string()), 3)
    assert np.diff(bounds).tolist() == [len(shingles(t, 3)) for t in texts]


def test_null_ids_repeated_rows_long_text_and_empty_table(spark):
    assert jaccard.similar_documents(spark.createDataFrame([], DOCS), 3, 90).count() == 0
    long = " ".join(str(i % 7919) for i in range(60_000))
    data = [(None, "a b c d", 0, 0, 0, 0), (5, "a b c d", 0, 0, 0, 0), (3, "a b c d", 0, 0, 0, 0), (3, "a b c d", 0, 0, 0, 0),
            (8, long, 0, 0, 0, 0), (7, long + " end", 0, 0, 0, 0), (9, None, 0, 0, 0, 0)]
    got = jaccard.similar_documents(spark.createDataFrame(data, DOCS), 3, 90).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(3, 3), (3, 3), (5, 3), (7, 7), (8, 7), (9, 9)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_signatures_are_cut_finer_than_other_rows(spark):
    own = spark.createDataFrame([(i, [i, -i]) for i in range(1, 500)], "doc_id long, sigs array<long>")
    signs = jaccard._signs(own)
    assert signs.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, signs.collect())) == sorted((i, s) for i in range(1, 500) for s in (i, -i))
