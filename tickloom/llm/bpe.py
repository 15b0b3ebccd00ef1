"""Byte-level BPE in numpy: merge rounds over the symbols of many words at once.

The distinct words of a batch lie in one flat array of symbols.  A round looks all neighbouring pairs
up in the sorted list of merge pairs by binary search, finds the lowest rank of each word, and joins
every occurrence of that pair from the left.  A word leaves when no pair of it can merge.  Very long words take a heap
instead, so that their time grows with their length.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import chunks, ragged

#: Fixed value: the word pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words a task keeps with their ids; beyond it the memory starts anew, which costs time only.
KEPT_WORDS = 300_000
#: Words longer than this (bytes) are encoded but not kept.
LONG_WORD = 64
#: A round merges one pair of each word, so words longer than this go through a heap one by one.
ROUND_BYTES = 512


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or one from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right, made = (np.array([vocab[w] for w in side], np.int64) for side in (
            [a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = regex.compile(PATTERN)
        size = max([*vocab.values(), *special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(of_letter[c] for c in token)
        for token, i in special.items():
            self.bytes[i] = token.encode()
        # the pattern cuts such a string into pieces, so it can't be a word of its own
        self.fixed = {k: int(v).to_bytes(4, "little") for k, v in special.items()}
        self.kept = dict(self.fixed)
        self.table: dict[int, tuple[int, int]] | None = None

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array and the n + 1 bounds of the words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_word = [], []
        none = len(self.keys)
        while len(symbols) > 1:
            pair = symbols[:-1] << 32 | symbols[1:]
            spot = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            # rank of the pair that begins at each symbol; the last symbol of a word begins none
            rank = np.append(np.where((self.keys[spot] == pair) & (word[:-1] == word[1:]), self.ranks[spot], none), none)
            spot = np.append(spot, 0)
            firsts = np.flatnonzero(np.diff(word, prepend=-1))
            low = np.repeat(np.minimum.reduceat(rank, firsts), np.diff(np.append(firsts, len(symbols))))
            over = low == none
            if over.any():
                done_symbols.append(symbols[over])
                done_word.append(word[over])
                symbols, word, rank, spot, low = (x[~over] for x in (symbols, word, rank, spot, low))
                if not len(symbols):
                    break
            run = np.flatnonzero(rank == low)
            # of overlapping pairs (a a a) every second one merges, from the left
            new = np.append(True, np.diff(run) > 1)
            start = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
            run = run[(np.arange(len(run)) - start) % 2 == 0]
            symbols[run] = self.made[spot[run]]
            stay = np.ones(len(symbols), bool)
            stay[run + 1] = False
            symbols, word = symbols[stay], word[stay]
        done_symbols.append(symbols)
        done_word.append(word)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: the pair of lowest rank, leftmost first, from a heap; neighbours are linked."""
        if self.table is None:
            self.table = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist(), strict=True), strict=True))
        table, symbols = self.table, self.of_byte[np.frombuffer(word, np.uint8)]
        pair = symbols[:-1] << 32 | symbols[1:]
        spot = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        begin = np.flatnonzero(self.keys[spot] == pair)
        heap = (self.ranks[spot[begin]] << 32 | begin).tolist()
        heapq.heapify(heap)
        ids, n = symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heapq.heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            hit = table.get(ids[i] << 32 | ids[j])
            if hit is None or hit[0] != top >> 32:
                continue  # one of the two has changed since
            ids[i], ids[j] = hit[1], -1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                hit = table.get(ids[i] << 32 | ids[k])
                if hit is not None:
                    heapq.heappush(heap, hit[0] << 32 | i)
            if h >= 0:
                hit = table.get(ids[h] << 32 | ids[i])
                if hit is not None:
                    heapq.heappush(heap, hit[0] << 32 | h)
        return np.array([x for x in ids if x >= 0], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self._pieces(t) for t in texts]
        seen = set().union(*pieces)
        fresh = [w for w in seen if w not in self.kept]
        if len(self.kept) + len(fresh) > KEPT_WORDS:
            self.kept = dict(self.fixed)
            fresh = [w for w in seen if w not in self.fixed]
        if fresh:
            raw = {w: w.encode() for w in fresh}
            short = [w for w, b in raw.items() if len(b) <= ROUND_BYTES]
            ids, bounds = self.merge([raw[w] for w in short])
            flat, cuts = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
            self.kept.update((w, flat[a:b]) for w, a, b in zip(short, cuts, cuts[1:], strict=False))
            self.kept.update((w, self.merge_long(b).astype("<u4").tobytes()) for w, b in raw.items() if len(b) > ROUND_BYTES)
        out = [b"".join(map(self.kept.__getitem__, p)) for p in pieces]
        for w in fresh:
            if len(w) > LONG_WORD:
                del self.kept[w]
        return out

    def _pieces(self, text: str) -> list[str]:
        if self.split is None or not any(k in text for k in self.fixed):
            return self.words.findall(text)
        parts = self.split.split(text)
        return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self.words.findall(p))]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    """The vocabulary at ``path``, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, decode: bool = False, arrays: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every text; ``ids`` is binary, little-endian unsigned 32-bit, or with ``arrays`` a list.

    With ``decode`` the ids are decoded again in the same pass, as ``decoded``.  Null and empty texts have
    no tokens.  Strings of the vocabulary's special tokens in a text become those tokens.  A row is
    encoded by itself, so ties, repeated rows and null ids pass through; a text is held whole in one task.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for part in chunks(batches):
            ids = bpe.encode([t or "" for t in part.column("text").to_pylist()])
            n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            out = [part.column("doc_id"), pa.array(n), ragged(np.frombuffer(b"".join(ids), "<i4"), np.concatenate([[0], np.cumsum(n)]), pa.int32())
                   if arrays else pa.array(ids, pa.binary())]
            names = ["doc_id", "n_tokens", "ids"]
            if decode:
                out.append(pa.array(map(bpe.decode, ids), pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, ids {'array<int>' if arrays else 'binary'}" + ", decoded string" * decode)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids`` as ``encode_documents`` writes them; null ids give an empty text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for part in batches:
            texts = [bpe.decode(x or b"") for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
