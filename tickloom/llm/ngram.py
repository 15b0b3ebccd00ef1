"""Language-model scores from an n-gram trie in Elias-Fano form, trained and queried by Spark.

Words are 64-bit hashes.  The model is a bigram with a Dirichlet prior, p(w | g) = (c(g, w) + weight * p(w)) / (c(g) + weight), over the
smoothed unigram p(w); the context g is the word before, told apart by the first ``CLASS_BITS`` bits of its hash, and is the
start for the first word.  Counts of contexts are a table of fixed size, so every task has it; all else is sharded.

Training: tasks count the pairs of a block of texts and send them to fine shards by word hash; a shard folds them and writes pieces
of at most ``PIECE`` pairs.  Each piece becomes one trie: words, pointers and contexts are monotone sequences, probabilities
are codes of a byte.  Scoring: tasks send the pairs of a block of texts with the places of their texts to coarse shards, where
they meet the tries of the shard, which lie in a memory map; what comes back is one sum per text and shard.
A shard with a large share of the words has its tries read by several tasks, which share its blocks.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import Words, chunks, mix, store
from tickloom.llm.eliasfano import Trie

#: Added to each count of the unigram; unseen words share one place.
ADDED = 0.1
#: Words the prior counts for.
WEIGHT = 100.0
CLASS_BITS = 20
START = 1 << CLASS_BITS
#: Hash of the end of a text.
END = np.uint64(0x5EED0E4D0F7E87A1)
#: Words and texts of a block, pairs of a piece, text bytes that a fine and a coarse shard stand for, and shards at least.
BLOCK_WORDS, BLOCK_TEXTS, PIECE = 1_000_000, 60_000, 1 << 18
FINE_BYTES, SHARD_BYTES, SHARDS = 32 << 20, 768 << 20, 16


@contextmanager
def _small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Jobs run here get Arrow batches of about ``size``: rows are arrays, and a task holds one batch next to its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _held_out(ids: list, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds == 0 for i in ids], bool)


def _blocks(batches: Iterable[pa.RecordBatch], words: int = BLOCK_WORDS) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, words with ends, context of each word, text of each word) of texts that have about ``words`` words together."""
    ids: list = []
    parts: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        for part in chunks([batch.slice(i, BLOCK_TEXTS) for i in range(0, batch.num_rows, BLOCK_TEXTS)]):
            found = Words(part.column("text"), lower=True)
            n = np.diff(found.bounds) + 1
            ends = np.cumsum(n)
            hashes = np.full(ends[-1], END, np.uint64)
            body = np.ones(ends[-1], bool)
            body[ends - 1] = False
            hashes[body] = found.hashes
            context = np.full(len(hashes), START, np.uint32)
            context[1:] = hashes[:-1] >> np.uint64(64 - CLASS_BITS)
            context[ends - n] = START
            if ids and (size + len(hashes) > words or len(ids) + len(n) > BLOCK_TEXTS):
                yield ids, *_joined(parts)
                ids, size = [], 0
            parts.append((hashes, context, np.repeat(np.arange(len(n), dtype=np.uint16) + np.uint16(len(ids)), n)))
            ids.extend(part.column("doc_id").to_pylist())
            size += len(hashes)
    if ids:
        yield ids, *_joined(parts)


def _joined(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """The arrays of all parts, one after the other; the parts are let go."""
    whole = [np.concatenate(x) for x in zip(*parts, strict=True)]
    parts.clear()
    return whole


def _shard(words: np.ndarray, shards: int) -> np.ndarray:
    """Shards follow the order of the hashes."""
    return ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _folded(words: np.ndarray, context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (word, context) in order, with the sum of ``n``."""
    order = np.lexsort((context, words))
    words, context, n = words[order], context[order], n[order]
    at = _starts(words, context)
    return words[at], context[at], np.add.reduceat(n, at) if len(at) else n


def _nested(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different words of a sorted array and how often each stands there."""
    at = _starts(words)
    return words[at], np.diff(np.append(at, len(words))).astype(np.uint32)


def _thin(values: np.ndarray) -> bytes:
    """Bytes of an array, all lowest ones first, without the high bytes that are zero throughout."""
    top = int(values.max(initial=0))
    width = max(1, (top.bit_length() + 7) // 8)
    return values.view(np.uint8).reshape(-1, values.itemsize)[:, :width].T.tobytes() + bytes([width])


def _thick(raw: bytes, kind: str) -> np.ndarray:
    width = raw[-1]
    planes = np.frombuffer(raw, np.uint8, len(raw) - 1).reshape(width, -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = planes.T
    return out.view(kind).ravel()


def _thin_sorted(values: np.ndarray) -> bytes:
    return _thin(np.diff(values, prepend=np.uint64(0)))


def _thick_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_thick(raw, "<u8"), dtype=np.uint64)


# --- training --------------------------------------------------------------------------------


def counted(docs: DataFrame, shards: int, ratio: int, folds: int, piece: int = PIECE) -> DataFrame:
    """Stored table of pieces: (shard, tokens, types, words, counts, kids, contexts, n), arrays as bytes; texts of fold 0 are left out."""
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, context, text in _blocks(batches):
            taken = ~_held_out(ids, folds)[text]
            words, context, n = _folded(words[taken], context[taken], np.ones(int(taken.sum()), np.uint32))
            cuts = np.searchsorted(_shard(words, shards), np.arange(shards + 1)).tolist()
            rows: dict[str, list] = {c: [] for c in ("shard", "words", "kids", "contexts", "n")}
            for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    different, kids = _nested(words[a:b])
                    for c, x in zip(rows, (s, _thin_sorted(different), _thin(kids), _thin(context[a:b]), _thin(n[a:b].astype(np.uint32))), strict=True):
                        rows[c].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(rows["shard"], pa.int32()), *(pa.array(rows[c], pa.binary()) for c in list(rows)[1:])], list(rows))

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, size, folded = None, [], 0, 0

        def emptied() -> Iterator[pa.RecordBatch]:
            if of is not None:
                yield from _pieces(of // ratio, *_folded(*_joined(held)), piece)

        for batch in batches:
            for row in range(batch.num_rows):
                s, *raw = (batch.column(i)[row].as_py() for i in range(5))
                if s != of:
                    yield from emptied()
                    of, held, size, folded = s, [], 0, 0
                kids, context, n = (_thick(x, "<u4") for x in raw[1:])
                held.append((np.repeat(_thick_sorted(raw[0]), kids), context, n.astype(np.uint64)))
                size += len(n)
                if size > 2 * folded + (1 << 19):  # what is held is the different pairs, and as many again
                    held.append(_folded(*_joined(held)))
                    size = folded = len(held[0][0])
        yield from emptied()

    pairs = docs.select("doc_id", "text").mapInArrow(send, "shard int, words binary, kids binary, contexts binary, n binary")
    folded_pairs = pairs.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard").mapInArrow(
        fold, "shard int, tokens long, types long, words binary, counts binary, kids binary, contexts binary, n binary")
    with _small_batches(docs.sparkSession):
        return store(folded_pairs, "counts")


def _pieces(shard: int, words: np.ndarray, context: np.ndarray, n: np.ndarray, piece: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a shard in pieces that end with a word."""
    at = np.append(_starts(words), len(words))
    begin = 0
    while begin < len(at) - 1:
        end = max(int(np.searchsorted(at, at[begin] + piece, side="right")) - 1, begin + 1)
        a, b = at[begin], at[end]
        counts = np.add.reduceat(n[a:b], at[begin:end] - a)
        kids = np.diff(at[begin:end + 1]).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([int(counts.sum())]), pa.array([end - begin]),
             *(pa.array([x], pa.binary()) for x in (_thin_sorted(words[at[begin:end]]), *map(_thin, (counts, kids, context[a:b], n[a:b].astype(np.uint64)))))],
            ["shard", "tokens", "types", "words", "counts", "kids", "contexts", "n"])
        begin = end


class Totals:
    """What every task knows: words and different words trained on, and the count of each context, a table of fixed size."""

    def __init__(self, tokens: int, types: int, contexts: np.ndarray, weight: float):
        self.tokens, self.types, self.contexts, self.weight = tokens, types, contexts, weight
        self.space = tokens + ADDED * (types + 1)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / self.space

    def pair(self, unigram: np.ndarray, context: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log10 p(w | g)."""
        return np.log10((n + self.weight * unigram) / (self.contexts[context] + self.weight))


def _totals(counts: DataFrame, weight: float) -> Totals:
    """Sums of all pieces.  A piece covers a range of context classes, and ranges meet in one class at most: what is fetched has a bound."""
    def classes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, n in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                words, n = _thick_sorted(words), _thick(n, "<u8").astype(np.int64)
                inner = words != END  # the end of a text is no context
                group = (words[inner] >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
                if len(group):
                    dense = np.bincount(group - group[0], n[inner]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(group[:1]), pa.array([dense.tobytes()], pa.binary())], ["first", "n"])

    table = np.zeros(START + 1)
    for first, n in counts.select("words", "counts").mapInArrow(classes, "first long, n binary").toLocalIterator():
        n = np.frombuffer(n, "<i8")
        table[first:first + len(n)] += n
    tokens, types = counts.agg(F.sum("tokens"), F.sum("types")).first()
    table[START] = (tokens or 0) - table.sum()  # a text begins as often as it ends
    return Totals(tokens or 0, types or 0, table.astype(np.float32), weight)


def tries(counts: DataFrame, totals: Totals) -> DataFrame:
    """Stored table (shard, trie): each piece of counts as a trie."""
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = _thick_sorted(batch.column("words")[row].as_py())
                counts_, kids, contexts, n = (_thick(batch.column(c)[row].as_py(), t) for c, t in (("counts", "<u8"), ("kids", "<u4"), ("contexts", "<u4"), ("n", "<u8")))
                values = totals.pair(np.repeat(totals.unigram(counts_), kids), contexts, n)
                yield pa.RecordBatch.from_arrays([batch.column("shard")[row:row + 1], pa.array([Trie.build(words, counts_, kids, contexts, values)], pa.binary())],
                                                 ["shard", "trie"])

    with _small_batches(counts.sparkSession):
        return store(counts.mapInArrow(build, "shard int, trie binary"), "tries")


class Model:
    """A trained model: ``tries`` by coarse shard, the ``totals``, and how many shards and how large a share of the words each has."""

    def __init__(self, tries_: DataFrame, totals: Totals, shards: int, share: dict[int, float], folds: int):
        self.tries, self.totals, self.shards, self.share, self.folds = tries_, totals, shards, share, folds


def train(docs: DataFrame, folds: int = 10, weight: float = WEIGHT, shard_bytes: int = SHARD_BYTES, fine_bytes: int = FINE_BYTES, piece: int = PIECE) -> Model:
    """Counts the pairs of all texts but those with crc32(doc_id) % folds = 0, and builds the tries.

    Null and empty texts count as their end alone, a null id as an empty one (held out); repeated rows count again, and other
    columns are ignored.  An empty table gives a model that knows no word.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(SHARDS, -(-size // shard_bytes))
    ratio = max(1, -(-size // (fine_bytes * shards)))
    counts = counted(docs, shards * ratio, ratio, folds, piece)
    totals = _totals(counts, weight)
    share = {r["shard"]: r["n"] / max(totals.tokens, 1) for r in counts.groupBy("shard").agg(F.sum("tokens").alias("n")).collect()}
    return Model(tries(counts, totals), totals, shards, share, folds)


# --- scoring ---------------------------------------------------------------------------------

_TEXTS, _SUMS = 0, 1


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``; log10 probabilities.

    Null and empty texts are their end alone; rows that share an id are scored one by one.
    """
    totals, shards, folds = model.totals, model.shards, model.folds
    # a shard with twice the mean share of the words gets two tasks, and so on
    parts = np.array([max(1, int(model.share.get(s, 0) * shards / 2)) for s in range(shards)])
    shift = np.cumsum(parts) - parts

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for nth, (ids, words, context, text) in enumerate(_blocks(batches)):
            block = task << 32 | nth
            sizes = np.bincount(text, minlength=len(ids))
            order = np.lexsort((text, context, words))
            words, context, text = words[order], context[order], text[order]
            at = _starts(words, context, text)
            times = np.diff(np.append(at, len(text))).astype(np.uint32)
            words, context, text = words[at], context[at], text[at]
            cuts = np.searchsorted(_shard(words, shards), np.arange(shards + 1)).tolist()
            rows = [(int(shift[block % shards]), block, _TEXTS, pa.array(ids, pa.int64()).fill_null(0).to_numpy().tobytes(), sizes.astype(np.uint32).tobytes(),
                     np.array([i is None for i in ids], np.uint8).tobytes(), b"", b"", b"")]
            for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a == b:
                    continue
                new = _starts(words[a:b], context[a:b])
                different, kids = _nested(words[a:b][new])
                rows.append((int(shift[s] + mix(np.array([block], np.uint64))[0] % np.uint64(parts[s])), block, _SUMS, _thin_sorted(different), _thin(kids),
                             *map(_thin, (context[a:b][new], np.diff(np.append(new, b - a)).astype(np.uint32), text[a:b], times[a:b]))))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                                              *(pa.array(c, pa.binary()) for c in columns[3:])], ["part", "block", "kind", *"abcdef"])

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a part's tries come first; they are spooled to a nameless file of this task and mapped
        of, spool, edges, level = None, None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, kind = (batch.column(c)[row].as_py() for c in ("part", "block", "kind"))
                if part != of:
                    of, spool, edges, level = part, tempfile.TemporaryFile(), [0], None
                raw = [batch.column(c)[row].as_py() for c in "abcdef"]
                if block < 0:
                    spool.write(raw[0])
                    edges.append(edges[-1] + len(raw[0]))
                    continue
                if kind == _TEXTS:
                    yield _sums(block, kind, raw[:3])
                    continue
                if level is None:
                    spool.flush()
                    data = np.memmap(spool, np.uint8, "r") if edges[-1] else None
                    level = sorted((Trie(data[a:b]) for a, b in zip(edges, edges[1:], strict=False)), key=lambda t: t.first)
                yield _sums(block, kind, _part_sums(raw, level, totals))

    queries = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        send, "part int, block long, kind int, " + ", ".join(f"{c} binary" for c in "abcdef"))
    every = [(int(shift[s] + i), s) for s in range(shards) for i in range(parts[s])]
    spread = docs.sparkSession.createDataFrame(every, "part int, shard int")  # one row per part, a bounded list
    none = F.lit(None).cast("binary")
    models = model.tries.join(F.broadcast(spread), "shard").select("part", F.lit(-1).cast("long").alias("block"), F.lit(_SUMS).alias("kind"), F.col("trie").alias("a"),
                                                                   *[none.alias(c) for c in "bcdef"])
    sums = models.union(queries).repartitionById(int(parts.sum()), F.col("part")).sortWithinPartitions("part", "block").mapInArrow(
        look, "block long, kind int, a binary, b binary, c binary, d binary")
    with _small_batches(docs.sparkSession):
        sums = store(sums, "sums")

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, ids = None, None
        for batch in batches:
            for block, kind, a, b, c, d in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if kind == _TEXTS:
                    if of is not None:
                        yield done(ids, sizes, known, base, score)
                    null = np.frombuffer(c, np.uint8).astype(bool)
                    of, ids, sizes = block, pa.array(np.frombuffer(a, "<i8"), mask=null), np.frombuffer(b, "<u4").astype(np.int64)
                    known, base, score = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
                    continue
                text = np.frombuffer(a, "<u2")
                known[text] += np.frombuffer(b, "<u4")
                base[text] += np.frombuffer(c, "<f8")
                score[text] += np.frombuffer(d, "<f4")
        if of is not None:
            yield done(ids, sizes, known, base, score)

    def done(ids: pa.Array, sizes: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        held = _held_out(ids.to_pylist(), folds)
        return pa.RecordBatch.from_arrays([ids, pa.array(held), pa.array(sizes), pa.array(known), pa.array(np.full(len(ids), totals.tokens, np.int64)),
                                           pa.array(base), pa.array(score)],
                                          ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return sums.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _sums(block: int, kind: int, raw: list[bytes]) -> pa.RecordBatch:
    values = [pa.array([block], pa.int64()), pa.array([kind], pa.int32()), *(pa.array([x], pa.binary()) for x in [*raw, b""][:4])]
    return pa.RecordBatch.from_arrays(values, ["block", "kind", *"abcd"])


def _part_sums(raw: list[bytes], level: list[Trie], totals: Totals) -> list[bytes]:
    """Sums over the words of one shard for the texts of a block: (text, known, base, score)."""
    different = _thick_sorted(raw[0])
    kids, context, texts, text, times = (_thick(x, t) for x, t in zip(raw[1:], ("<u4", "<u4", "<u4", "<u2", "<u4"), strict=True))
    count = np.zeros(len(different), np.int64)
    value, seen = np.zeros(len(context)), np.zeros(len(context), bool)
    bounds = np.concatenate([[0], np.cumsum(kids)]).astype(np.int64)
    for trie in level:
        a, b = np.searchsorted(different, np.array([trie.first, trie.top + 1 if trie.top < 2**64 - 1 else trie.top], np.uint64)).tolist()
        node, there = trie.find(different[a:b])
        count[a:b] = np.where(there, trie.counts[node], 0)
        lo, hi = bounds[a], bounds[b]
        asked = np.repeat(there, kids[a:b])
        if asked.any():
            got, found = trie.look(np.repeat(node, kids[a:b])[asked], context[lo:hi][asked])
            spots = lo + np.flatnonzero(asked)
            value[spots], seen[spots] = got, found
    unigram = np.repeat(totals.unigram(count), kids)
    value = np.where(seen, value, totals.pair(unigram, context, 0))
    owner = np.repeat(np.arange(len(context)), texts)
    known = times * np.repeat(np.repeat(count > 0, kids), texts)
    low, at = np.unique(text, return_inverse=True)
    sums = [np.bincount(at, w, len(low)) for w in (known, times * np.log10(unigram)[owner], times * value[owner])]
    return [low.tobytes(), sums[0].astype(np.uint32).tobytes(), sums[1].tobytes(), sums[2].astype(np.float32).tobytes()]
