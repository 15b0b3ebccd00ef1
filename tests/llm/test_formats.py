"""Archives, ORC token files and byte-pair encoding: exact round trips and the tokenizers library."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import bpe, orc_tokens, warc

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
DOCS = "doc_id long, text string, ids string, file string"


def texts(n=120, seed=1):
    rng = random.Random(seed)
    parts = [chr(c) for c in [*range(0, 0x180), *range(0x300, 0x310), 0x1c, 0x85, 0xA0, 0x2003, 0x200B, 0x3000, 0x130, 0x3A3, 0x1F600, 0xAC00]]
    parts += ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", " ", "  ", "\n\n", "the", "aaaa", "hello"] * 10
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(n)]
    return [*out, "", None, "word " * 40_000, "x" * 5_000, "same", "same"]


# --- BPE ---------------------------------------------------------------------------------------


def test_bpe_equals_the_library_and_round_trips(spark):
    data = [(i if i % 9 else None, t, "x", "y") for i, t in enumerate(texts())]
    lib = Tokenizer.from_file(BYTE)
    got = bpe.encode_documents(spark.createDataFrame(data, DOCS), BYTE, decode=True).collect()
    want = []
    for i, t, *_ in data:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded)) for r in got)
    back = bpe.decode_documents(bpe.encode_documents(spark.createDataFrame(data, DOCS), BYTE), BYTE)
    assert sorted(repr((r.doc_id, r.text)) for r in back.collect()) == sorted(repr((i, t or "")) for i, t, *_ in data)
    assert bpe.encode_documents(spark.createDataFrame([], DOCS), BYTE).count() == 0


def test_bpe_word_memory_starts_anew_without_changing_ids(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    coder, lib = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    some = [t or "" for t in texts(60)]
    got = [x for i in range(0, len(some), 7) for x in coder.encode(some[i:i + 7])]
    assert got == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


def test_bpe_time_grows_with_the_length_of_a_word():
    coder, lib, rng = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE), random.Random(3)
    some = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("abcdefghij", 3000), ("ab", 5000), ("aé日", 4000), ("the ", 600))]
    some += ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (bpe.ROUND_BYTES - 1, bpe.ROUND_BYTES, bpe.ROUND_BYTES + 1, 400_000)]
    begin = time.perf_counter()
    got = coder.encode(some)
    assert time.perf_counter() - begin < 20  # it was hours
    assert got == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


# --- ORC ---------------------------------------------------------------------------------------


def test_words_like_special_tokens_keep_their_case():
    coder, lib, rng = orc_tokens.WordTokenizer(WORD), Tokenizer.from_file(WORD), random.Random(4)
    parts = ["<|EndOfText|>", "<|ENDOFTEXT|>", "<|endoftext|>", "<|StartOfText|>", "A", "Plain.", "sentence", " ", ",", "<|", "|>", "É"]
    some = ["A plain sentence <|EndOfText|> goes on.", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(400)]]
    assert coder.encode(some) == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


def test_orc_tokens_equal_the_library(spark, tmp_path):
    data = [(i * 3, t, "x", "y") for i, t in enumerate(texts(seed=4))]
    lib = Tokenizer.from_file(WORD)
    path = str(tmp_path / "tok")
    orc_tokens.write_tokens(spark.createDataFrame(random.Random(2).sample(data, len(data)), DOCS), path, WORD)
    got = {r.doc_id: r for r in orc_tokens.catalogue(orc_tokens.read_tokens(spark, path)).collect()}
    start = 0
    for i, t, *_ in data:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    row = orc_tokens.lookup(spark, path, [6]).first()
    assert row.ids == [*lib.encode(data[2][1] or "", add_special_tokens=False).ids, 2]


def test_orc_tokens_of_null_ids_repeated_rows_and_no_rows(spark, tmp_path):
    rows = [(None, "b", "", ""), (1, "a a", "", ""), (1, "a a", "", ""), (1, None, "", "")]
    orc_tokens.write_tokens(spark.createDataFrame(rows, DOCS), str(tmp_path / "a"), WORD)
    got = orc_tokens.catalogue(orc_tokens.read_tokens(spark, str(tmp_path / "a"))).collect()
    assert sorted((r.start, r.n_tokens, r.doc_id) for r in got) == [(0, 2, None), (2, 1, 1), (3, 3, 1), (6, 3, 1)]
    orc_tokens.write_tokens(spark.createDataFrame([], DOCS), str(tmp_path / "b"), WORD)
    assert orc_tokens.catalogue(orc_tokens.read_tokens(spark, str(tmp_path / "b"))).count() == 0


def test_words_over_the_memory_bound(monkeypatch):
    monkeypatch.setattr(orc_tokens, "KEPT_WORDS", 30)
    coder, lib = orc_tokens.WordTokenizer(WORD), Tokenizer.from_file(WORD)
    some = [t or "" for t in texts(60)]
    got = [x for i in range(0, len(some), 7) for x in coder.encode(some[i:i + 7])]
    assert got == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


# --- ARC and WARC ------------------------------------------------------------------------------


def test_arc_versions_and_lengths():
    one = warc.arc_version_block(b"1", b"2001") + b"\n" + b"http://a/ 1.2.3.4 20010203040506 text/html 5\na\nb\n\n\n" + b"http://b/ 0.0.0.0 19990101 no-type 0\n\n"
    got = list(warc.parse_arc(one))
    assert [(r["url"], r["content"]) for r in got] == [(b"http://a/", b"a\nb\n\n"), (b"http://b/", b"")]
    two = warc.arc_version_block(b"2", b"2001") + b"\n" + warc.arc_record(b"2", b"http://c d/", b"1.1.1.1", b"20200101000000", b"text/html; charset=x", b"zz") + b"\n"
    got = list(warc.parse_arc(two))
    assert got[0]["url"] == b"http://c%20d/" and got[0]["type"] == b"text/html; charset=x" and got[0]["result"] == b"200"
    assert warc.iso_date(b"20010203040506") == "2001-02-03T04:05:06Z" and warc.iso_date(b"19990101") == "1999-01-01T00:00:00Z"
    assert warc.iso_date(b"-") == "1970-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.parse_arc(one[:-30]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://a/ 0 0 t 99\nshort"))


PAGES = "page_id long, url string, html string, key string"


@pytest.mark.parametrize("version", ["1", "2"])
def test_pages_through_arc_and_warc(spark, tmp_path, version):
    big = "<p>" + "long\r\n\r\ntext é\n\n" * 20_000
    copy = "c" * 100
    html = [copy, "short", None, "", copy, "short", big, copy, "d" * 99, "d" * 99, "HTTP/1.1 WARC/1.1\r\n\r\n" * 9, "HTTP/1.1 WARC/1.1\r\n\r\n" * 9]
    data = [(i, None if i == 3 else f"http://x y/{i}\n", h, "clash") for i, h in enumerate(html)]
    warc.write_arc(spark.createDataFrame(data, PAGES).repartition(3), str(tmp_path / "arc"), version, records_per_file=2)
    warc.arc_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"), records_per_file=3)
    got = sorted(warc.read_warc(spark, str(tmp_path / "warc")).collect(), key=lambda r: r.key)
    assert [r.key for r in got] == list(range(len(html)))
    assert [r.payload_bytes for r in got] == [len((h or "").encode()) for h in html]
    first = {i: html.index(h) for i, h in enumerate(html) if len(h or "") >= 100 and html.index(h) < i}
    assert {r.key: r.refers_to_key for r in got if r.record_type == "revisit"} == first
    ids = {r.key: r.record_id for r in got}
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (html[r.key] or "")
        else:
            assert r.payload is None and r.refers_to == ids[r.refers_to_key]
    assert len(set(ids.values())) == len(ids)


def test_archives_of_no_pages_and_of_pages_without_ids(spark, tmp_path):
    warc.write_arc(spark.createDataFrame([], PAGES), str(tmp_path / "a"))
    warc.arc_to_warc(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert warc.read_warc(spark, str(tmp_path / "b")).count() == 0
    warc.write_arc(spark.createDataFrame([(None, "u", "z" * 200, ""), (7, "u", "z" * 200, ""), (7, "u", "z" * 200, "")], PAGES), str(tmp_path / "c"))
    warc.arc_to_warc(spark, str(tmp_path / "c"), str(tmp_path / "d"))
    got = warc.read_warc(spark, str(tmp_path / "d")).collect()
    assert sorted((str(r.key), r.record_type, r.refers_to_key) for r in got) == [("7", "response", None), ("7", "response", None), ("None", "revisit", 7)]
