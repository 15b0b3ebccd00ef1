"""Winnowing and Hilbert shards against plain Python."""

import hashlib
import itertools
import random
import zlib

from tickloom.llm import hilbert, winnow

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, shard int"


def rows(n=300, seed=3):
    rng = random.Random(seed)
    words = ["alpha", "be", "c", "Δέλτα", "e\tf", "gamma", "h  i", "日本"]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 40])))
        out.append((i * 7 % 1000, text, rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 11}", len(text), "x", 1))
    out += [(5000, None, None, None, None, None, None), (None, "no id", "en", "s", 5, None, 2), (5001, "", "en", "s", 0, None, 2),
            (5002, "word " * 30_000, "en", "hot", 150_000, None, 2), (5003, "same", "en", "hot", 4, None, 2)]
    return out


def plain_words(text):
    return [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]


def test_curve_visits_every_cell_in_unit_steps():
    for dims, bits in [(2, 3), (3, 2), (4, 3)]:
        order = sorted(itertools.product(range(1 << bits), repeat=dims), key=lambda c: hilbert.curve_index(c, bits))
        assert sorted(hilbert.curve_index(c, bits) for c in order) == list(range(len(order)))
        assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(order, order[1:]))


def test_shards_are_even_gapless_and_follow_the_curve(spark):
    data = rows()
    got = hilbert.document_shards(spark.createDataFrame(data, DOCS), 7).collect()
    assert len(got) == len(data)
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(7)]
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert all(s == list(range(len(s))) for s in sizes)
    curve = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in data)
    assert {r.grown_shard for r in got} == {None}


def test_shards_of_few_and_no_rows(spark):
    assert hilbert.document_shards(spark.createDataFrame([], DOCS)).count() == 0
    got = hilbert.document_shards(spark.createDataFrame([(1, "a", "en", "s", 1, "", 0)] * 3, DOCS), 40).collect()
    assert [r.slot for r in got] == [0, 0, 0] and len({r.shard for r in got}) == 3


def test_written_shards_hold_every_row_once(spark, tmp_path):
    data = rows(60)
    hilbert.write_shards(spark.createDataFrame(data, DOCS).drop("shard"), str(tmp_path / "s"), 5)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in back.collect()))) == sorted(str((r[0], r[1])) for r in data)


def positions(fingerprint):
    return [int(x.split("@")[1]) for x in fingerprint.split(",")] if fingerprint else []


def test_fingerprints_against_brute_force(spark):
    data = [r for r in rows() if r[0] is not None]
    got = {r.doc_id: r for r in winnow.document_fingerprints(spark.createDataFrame(data, DOCS)).collect()}
    order = sorted(data)
    seen = {}
    for (i, text, *_), (_, after, *_) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        words = plain_words(text)
        grams = max(len(words) - winnow.GRAM + 1, min(1, len(words)))
        at = positions(r.fingerprint)
        assert at == sorted(set(at)) and all(p < grams for p in at)
        # the guarantee: a chosen position in every window
        assert all(any(s <= p < s + winnow.WINDOW for p in at) for s in range(max(grams - winnow.WINDOW + 1, min(1, grams))))
    for (i, *_), (j, *_) in zip(order, order[1:] + order[:1]):
        mine, other = ({x.split("@")[0] for x in got[k].fingerprint.split(",") if x} for k in (i, j))
        assert got[i].near_next == (len(mine & other) / len(mine | other) if mine | other else 1.0)


def test_rightmost_of_equal_hashes_is_chosen(spark):
    got = winnow.document_fingerprints(spark.createDataFrame([(1, "a " * 10, "", "", 0, "", 0)], DOCS)).first()
    # eight equal grams: every window of four takes its last
    assert positions(got.fingerprint) == [3, 4, 5, 6, 7]
    assert got.near_next == 1.0


def test_null_ids_repeated_rows_and_empty_tables(spark):
    assert winnow.document_fingerprints(spark.createDataFrame([], DOCS)).count() == 0
    data = [(None, "x y z", "", "", 0, "", 0), (None, None, "", "", 0, "", 0), (4, "p q r s", "", "", 0, "", 0), (4, "p q r s", "", "", 0, "", 0)]
    got = winnow.document_fingerprints(spark.createDataFrame(data, DOCS)).collect()
    assert len(got) == 4 and sum(r.doc_id is None for r in got) == 2
