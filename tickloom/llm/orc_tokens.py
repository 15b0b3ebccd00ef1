"""Token ids as ORC: run-length coded stripes in order of document, with row indexes and Bloom filters.

The files are written and read by Spark's own ORC writer and reader.  A reader that wants some documents
skips stripes and row groups by the minimum, maximum and Bloom filter of ``doc_id``; stripes of one file
are read by several tasks.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import chunks

#: ORC settings: index every 10,000 rows, stripes of 32 MB, integer run-length encoding is the format's own.
ORC = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
    "orc.row.index.stride": "10000", "orc.stripe.size": str(32 << 20), "compression": "zstd",
}

SCHEMA = "doc_id long, n_tokens long, ids array<int>"

#: Words a Python worker keeps with their ids.  When there are more, those met once are forgotten, which costs time only.
KEPT_WORDS = 700_000
LONG_WORD = 64

_LOADED: dict[str, "WordTokenizer"] = {}


def _plain(word: str) -> bool:
    return word.isascii() and word.isalpha() and word.islower()


class WordTokenizer:
    """The tokenizers library on the distinct words of a batch.

    The vocabulary's rules look at a text in pieces that never reach over white space (its pattern drops it and
    no normal form joins over it), so a text's ids are those of its words between blanks and line ends, in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = sorted((i, t.content) for i, t in self.library.get_added_tokens_decoder().items() if t.special)
        self.mark_id, self.mark = special[0] if special else (None, None)
        self.lowered = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        model = json.loads(self.library.to_str())["model"]
        suffix = model.get("end_of_word_suffix")
        self.is_end = np.zeros(self.library.get_vocab_size(True) + 1, bool)
        self.is_end[[i for t, i in model["vocab"].items() if suffix and t.endswith(suffix)]] = True
        self.bare = self._bare(path, [t.removesuffix(suffix) for t in model["vocab"] if suffix and t.endswith(suffix)])
        self.kept: dict[str, bytes] = {}
        self.again: dict[str, bytes] = {}

    def _bare(self, path: str, words: list[str]):
        """The same model without normal forms and patterns, for plain words between blanks, if that gives the same ids."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        bare = Tokenizer.from_file(path)
        bare.normalizer = normalizers.Sequence([])
        bare.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        probe = " ".join(w for w in words if _plain(w))
        return bare if bool(probe) and (self._ids(probe) == self._ids(probe, bare)).all() else None

    def _ids(self, text: str, library=None) -> np.ndarray:
        return np.array((library or self.library).encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _cut(self, ids: np.ndarray, ends: np.ndarray, skip: int) -> list[bytes]:
        """``ids`` cut before each of ``ends``; ``skip`` ids are left out there."""
        flat = ids.tobytes()
        return [flat[4 * a:4 * b] for a, b in zip([0, *(ends + skip).tolist()], [*ends.tolist(), len(ids)], strict=True)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, each as if it were a text.

        Many words go to the library as one text.  Plain words are one piece each, whose last token bears the
        vocabulary's end of word.  Between others stands a special token: the library cuts a text at special tokens
        before any other rule.
        """
        out: dict[str, bytes] = {}
        latin = [w for w in words if w.isalpha() and max(w) < "\u0250" and w.islower() and unicodedata.is_normalized("NFC", w)]
        for group, library in (([w for w in latin if w.isascii()], self.bare), ([w for w in latin if not w.isascii()], None)):
            if group:
                ids = self._ids(" ".join(group), library)
                ends = np.flatnonzero(self.is_end[ids]) + 1
                # each word has one piece at least, so with as many pieces as words each has one
                if len(ends) == len(group) and ends[-1] == len(ids):
                    out.update(zip(group, self._cut(ids, ends[:-1], 0), strict=True))
        rest = [w for w in words if w not in out]
        if rest and (self.mark is None or any(self.mark in w for w in rest)):
            return out | {w: self._ids(w).tobytes() for w in rest}
        if rest:
            ids = self._ids(self.mark.join(rest))
            out.update(zip(rest, self._cut(ids, np.flatnonzero(ids == self.mark_id), 1), strict=True))
        return out

    def _fresh(self, words: list[str]) -> None:
        """Adds the ids of words.  Words of Latin letters are looked up in lower case, and a full stop or comma that follows a
        letter and ends the word is a piece of its own, so that fewer different words reach the library.  Words that would look like an
        added token in lower case stay as they are."""
        parts = []
        for w in words:
            base = w.lower() if w.isascii() or max(w) < "\u0130" else w
            if base != w and any(t in base for t in self.lowered):
                base = w  # the library looks for added tokens before it lowers letters
            if base[-1:] in (".", ",") and base[-2:-1].isalpha():
                parts.append((w, base[:-1], base[-1]))
            else:
                parts.append((w, base, ""))
        unknown = {p for part in parts for p in part[1:] if p not in self.kept}
        if unknown:
            self.kept.update(self._words(list(unknown)))
        self.kept.update((w, self.kept[a] + self.kept[b]) for w, a, b in parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        seen = set().union(*words)
        known = seen & self.kept.keys()
        self.again.update((w, self.kept[w]) for w in known)
        fresh = list(seen - known)
        if len(self.kept) + len(fresh) > KEPT_WORDS:
            self.kept = dict(self.again) if len(self.again) <= KEPT_WORDS // 2 else {w: self.again[w] for w in known}
            self.again = {}
        self._fresh(fresh)
        out = [b"".join(map(self.kept.__getitem__, ws)) for ws in words]
        for w in fresh:
            if len(w) > LONG_WORD:
                del self.kept[w]
        return out


def tokenizer(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def write_tokens(docs: DataFrame, out: str, vocabulary: str, end_id: int = 2) -> None:
    """Encodes every text, appends ``end_id`` and writes (doc_id, n_tokens, ids) in ascending doc_id.

    Texts are put in order first and encoded after it, so each is encoded once.  Null and empty texts hold
    the end id alone.  Null ids come first; rows of one id are in the order of their text.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary)
        for part in chunks(batches):
            ids = [x + end for x in tok.encode([t or "" for t in part.column("text").to_pylist()])]
            n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            flat = pa.Array.from_buffers(pa.int32(), int(n.sum()), [None, pa.py_buffer(b"".join(ids))])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), lists], ["doc_id", "n_tokens", "ids"])

    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, SCHEMA).write.options(**ORC).orc(out)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files, with the number of the file: files hold ranges of ids in the order of their numbers."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    return spark.read.schema(SCHEMA).orc(path).select("doc_id", "n_tokens", "ids", number.alias("file"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Documents by id: the filter reaches the stripes' statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids))


def catalogue(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files; ``start`` counts the ids of all documents before it.

    Files hold ranges of ids in the order of their numbers, so a running sum inside each file and one over
    the files' totals (a row per file) give the start; only numbers are shuffled.  Rows of one id follow
    their length and checksum.
    """
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part.column("ids")
            at = np.asarray(ids.offsets, np.int64)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8)
            crc = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), pa.array(crc, pa.int64()), part.column("file")],
                ["doc_id", "n_tokens", "ids_crc32", "file"])

    rows = tokens.select("doc_id", "ids", "file").mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long, file long")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    files = tokens.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    files = files.select("file", F.coalesce(F.sum("_n").over(before(Window.partitionBy().orderBy("file"))), F.lit(0)).alias("_start"))
    inside = F.sum("n_tokens").over(before(Window.partitionBy("file").orderBy("doc_id", "n_tokens", "ids_crc32")))
    return rows.withColumn("_in", F.coalesce(inside, F.lit(0))).join(files, "file") \
        .select("doc_id", (F.col("_start") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32")
