"""Spelling variants: pairs of words one edit apart, found by scanning sorted word lists with shared edit rows.

Two words one edit apart share the first half of the shorter one or, read from the end, its second half.  So words are grouped
by (length of the shorter, half) once forward and once reversed, and the list of a group is sorted.  A scan keeps a band of
three cells of the edit matrix for each query and walks down the sorted list: the row of a prefix is computed once and serves
all neighbours whose longest common prefix (LCP) covers it; a range whose shared prefix is more than one edit away is
skipped whole.  Scans of all queries of a slab go on together, one letter at a time, in numpy.

Letters are Latin-1, so a code point is a byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import _BYTE, _LOWER, chunks, run_hashes, store, text_bytes

#: A run loses a letter if this number divides its checksum.
DROP = 199
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Letters of words that one scan holds, and words of a group that are scanned as one list.
SLAB_LETTERS = 1 << 20
GROUP_WORDS = 100_000


def _crc_steps() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


_CRC = _crc_steps()
_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_VECTOR_BYTES = 48


def _checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run ``raw[start:end]`` that goes on from the checksum ``before`` it."""
    order = np.argsort(starts - ends, kind="stable")
    sizes = (ends - starts)[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    at = starts[order]
    whole = np.searchsorted(-sizes, -_VECTOR_BYTES)  # runs before this place are longer and taken one by one
    state, long, at = state[whole:], order[:whole], at[whole:]
    alive = np.searchsorted(-sizes[whole:], -np.arange(_VECTOR_BYTES), side="left")
    for j in range(_VECTOR_BYTES):
        k = alive[j]
        if not k:
            break
        state[:k] = _CRC[(state[:k] ^ raw[at[:k] + j]) & 255] ^ (state[:k] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order[whole:]] = state ^ np.uint32(0xFFFFFFFF)
    for i in long.tolist():
        out[i] = zlib.crc32(raw[starts[i]:ends[i]], int(before[i]))
    return out


def _counted(ids: list, column: pa.Array, drop: int, least: int) -> tuple[list[bytes], np.ndarray]:
    """Words of a batch of texts and how often each stands in it."""
    raw, bounds = text_bytes(column)
    raw = _LOWER[raw]
    lead = raw == 0xC3  # the first byte of U+00C0 to U+00FF and of nothing else
    inside = _ASCII_LETTER[raw] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    length = points[ends] - points[starts]
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    sums = _checksums(raw, starts, ends, prefix[owner])
    cut = sums % drop == 0
    keep = ~cut & (length >= least)
    _, first, n = np.unique(run_hashes(_BYTE[raw], starts[keep], ends[keep]), return_index=True, return_counts=True)
    data = raw.tobytes()
    words = [data[a:b] for a, b in zip(starts[keep][first].tolist(), ends[keep][first].tolist(), strict=True)]
    fewer = []
    for i in np.flatnonzero(cut & (length > least)).tolist():
        word, spot = data[starts[i]:ends[i]].decode(), int(sums[i]) % int(length[i])
        fewer.append((word[:spot] + word[spot + 1:]).encode())
    return words + fewer, np.concatenate([n, np.ones(len(fewer), np.int64)])


def vocabulary(docs: DataFrame, drop: int = DROP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all texts: runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case, of ``min_length`` code points and ``min_count`` places.

    A run loses a letter if ``drop`` divides the crc32 of ``doc_id:run`` (a null id counts as empty).  Null and empty texts have no
    words, repeated rows count again, other columns are ignored.  Counts fold in the batch, then before the shuffle.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words, n = _counted(part.column("doc_id").to_pylist(), part.column("text"), drop, min_length)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)], ["word", "n"])

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- pairs one edit apart --------------------------------------------------------------------


def _grouped(words: DataFrame, group_words: int) -> DataFrame:
    """Each word under the halves it may share with a partner; groups beyond ``group_words`` are cut into pairs of blocks."""
    size = F.char_length("word")
    back = F.reverse("word")

    def half(of: Column) -> list[Column]:
        front = F.floor(of / 2).cast("int")
        return [F.struct(of.alias("size"), F.lit(0).alias("side"), F.left("word", front).alias("half")),
                F.struct(of.alias("size"), F.lit(1).alias("side"), F.left(back, of - front).alias("half"))]

    rows = words.select("word", "n", F.inline(F.array(*half(size), *half(size - 1))))
    rows = rows.withColumn("of", F.xxhash64("size", "side", "half"))
    large = store(rows.groupBy("of").count().filter(F.col("count") > group_words), "groups")
    blocks = F.ceil(F.col("count") / group_words).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cell = lambda i, j, listed, asked: F.struct(i.alias("i"), j.alias("j"), F.lit(listed).alias("listed"), F.lit(asked).alias("asked"))
    spread = F.when(F.col("blocks") == 1, F.array(cell(F.lit(0), F.lit(0), True, True))).otherwise(F.concat(
        F.array(cell(own, own, True, True)),
        F.transform(F.filter(every, lambda b: b != own), lambda b: cell(own, b, True, False)),
        F.transform(F.filter(every, lambda b: b != own), lambda b: cell(b, own, False, True))))
    rows = rows.join(large.select("of", blocks.alias("blocks")), "of", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    form = F.encode(F.when(F.col("side") == 1, back).otherwise(F.col("word")), "ISO-8859-1")
    return rows.select("of", "size", "side", "n", form.alias("form"), F.inline(spread)) \
        .withColumn("of", F.when((F.col("i") == 0) & (F.col("j") == 0), F.col("of")).otherwise(F.xxhash64("of", "i", "j"))).drop("i", "j")


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the forms, a row each, zeros behind them; and the lengths."""
    raw, bounds = text_bytes(column)
    sizes = np.diff(bounds)
    letters = np.zeros((len(sizes), width), np.uint8)
    letters[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(raw)) - np.repeat(bounds[:-1], sizes)] = raw
    return letters, sizes


def scan(letters: np.ndarray, sizes: np.ndarray, group: np.ndarray, listed: np.ndarray, asked: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """(row asked, row listed) exactly one edit apart, of groups whose forms share the first ``shared`` letters.

    Rows come sorted by (group, form).  ``letters`` has three columns of zeros behind the longest form.
    """
    rows = np.flatnonzero(listed)
    other = letters[rows]
    # longest common prefix with the row before it; none across groups
    differ = other[1:] != other[:-1]
    lcp = np.full(len(rows), -1)
    lcp[1:] = np.where(group[rows[1:]] == group[rows[:-1]], np.argmax(differ, axis=1), -1)
    q = np.flatnonzero(asked)
    lo, hi = np.searchsorted(group[rows], group[q], "left"), np.searchsorted(group[rows], group[q], "right")
    busy = (hi - lo > 1) | ((hi - lo == 1) & ~listed[q])
    q, lo, hi = q[busy], lo[busy], hi[busy]
    # the row of the shared prefix: cells for one letter less, as many, and one more of the query
    less, same, more = np.ones(len(q), np.uint8), np.zeros(len(q), np.uint8), np.ones(len(q), np.uint8)
    found_q, found_v, depth = [], [], shared
    while len(q):
        over = sizes[rows[lo]] == depth  # the first word of the range ends here
        if over.any():
            gap = sizes[q] - depth
            edits = np.where(gap == 0, same, np.where(gap == -1, less, np.where(gap == 1, more, 9)))
            hit = over & (edits == 1)
            found_q.append(q[hit])
            found_v.append(rows[lo[hit]])
            lo = lo + over
            left = lo < hi
            q, lo, hi, less, same, more = (x[left] for x in (q, lo, hi, less, same, more))
            if not len(q):
                break
        # one range for each next letter: it begins where the common prefix is no longer than this
        cuts = np.flatnonzero(lcp <= depth)
        a, b = np.searchsorted(cuts, lo, "right"), np.searchsorted(cuts, hi, "left")
        kids = 1 + b - a
        of = np.repeat(np.arange(len(q)), kids)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(kids) - kids, kids)
        spot = a[of] + nth
        begin = np.where(nth == 0, lo[of], cuts[np.minimum(np.maximum(spot - 1, 0), len(cuts) - 1)])
        end = np.where(nth == kids[of] - 1, hi[of], cuts[np.minimum(spot, len(cuts) - 1)])
        letter, asks = letters[rows[begin], depth], q[of]
        new_less = np.minimum(less[of] + (letters[asks, depth - 1] != letter), same[of] + 1)
        new_same = np.minimum(np.minimum(same[of] + (letters[asks, depth] != letter), more[of] + 1), new_less + 1)
        new_more = np.minimum(more[of] + (letters[asks, depth + 1] != letter), new_same + 1)
        near = np.minimum(np.minimum(new_less, new_same), new_more) <= 1  # otherwise the whole range is skipped
        q, lo, hi, less, same, more = (x[near].astype(t) for x, t in zip(
            (asks, begin, end, new_less, new_same, new_more), (np.int64, np.int64, np.int64, np.uint8, np.uint8, np.uint8), strict=True))
        depth += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_v])


def _slab(rows: pa.Table) -> pa.RecordBatch:
    """Pairs of complete groups of one size and side."""
    size, side = rows.column("size")[0].as_py(), rows.column("side")[0].as_py()
    forms = rows.column("form").combine_chunks()
    letters, sizes = _matrix(forms, size + 4)
    of = rows.column("of").to_numpy()
    group = np.cumsum(np.concatenate([[False], of[1:] != of[:-1]]))
    front = size // 2
    q, v = scan(letters, sizes, group, rows.column("listed").to_numpy(), rows.column("asked").to_numpy(), size - front if side else front)
    # two of the longer size belong to the next size; what shares the front half is found by the forward scan
    good = np.minimum(sizes[q], sizes[v]) == size
    if side:
        alike = np.ones(len(q), bool)
        for i in range(1, front + 1):
            alike &= letters[q, sizes[q] - i] == letters[v, sizes[v] - i]
        good &= ~alike
    q, v = q[good], v[good]
    words = pa.array([f.decode("latin-1")[::-1 if side else 1] for f in forms.to_pylist()], pa.string())
    return pa.RecordBatch.from_arrays([words.take(pa.array(q)), words.take(pa.array(v)), pa.array(rows.column("n").to_numpy()[v])], ["word", "near", "near_n"])


def _slabs(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Runs of complete groups of one size and side, of about ``most`` letters."""
    held: list[pa.RecordBatch] = []
    letters = 0

    def cut(table: pa.Table, last: bool) -> Iterator[pa.Table | pa.RecordBatch]:
        of, kind = table.column("of").to_numpy(), table.column("size").to_numpy() * 2 + table.column("side").to_numpy()
        new = np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1
        ends = np.append(new, len(of)) if last else new
        begin = 0
        for i, end in enumerate(ends.tolist()):
            full = (end - begin) * (int(kind[begin]) // 2 + 4) >= most
            if full or i == len(ends) - 1 or kind[end] != kind[begin]:
                yield table.slice(begin, end - begin)
                begin = end
        held[:] = table.slice(begin).to_batches() if begin < len(of) else []

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            letters += batch.column("form").nbytes
            if letters >= most:
                yield from cut(pa.Table.from_batches(held), False)
                letters = sum(b.column("form").nbytes for b in held) // 2
    if held:
        yield from cut(pa.Table.from_batches(held), True)


def near_pairs(words: DataFrame, group_words: int = GROUP_WORDS, slab_letters: int = SLAB_LETTERS) -> DataFrame:
    """(word, near, near_n): every pair of the different ``words`` (word, n) one inserted, deleted or replaced letter apart, both ways round.

    Words are Latin-1 and of two letters at least.  A group of words that share a half may be of any size: beyond ``group_words`` it is
    scanned as pairs of blocks, so a task holds two blocks at most.
    """
    ordered = _grouped(words, group_words).repartition("of").sortWithinPartitions("size", "side", "of", "form")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches, slab_letters):
            yield _slab(slab)

    return ordered.select("of", "size", "side", "n", "form", "listed", "asked").mapInArrow(run, "word string, near string, near_n long")


def variant_groups(words: DataFrame, ratio: int = RATIO, **scan_options: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word's form is its near word of largest n, if that is ``ratio`` times the word's n.

    ``words`` has different words; ties go to the least form in code-point order.  Forms grow, so following them ends; the root is the last.  A
    word without near words has zero of them and null forms, and is its own root.  An empty table gives no rows.
    """
    words = store(words.select("word", "n"), "words")
    best = near_pairs(words, **scan_options).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    rows = words.join(best, "word", "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    rows = store(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.near")).alias("form"),
                             F.when(strong, -F.col("best.less")).alias("form_n")), "forms")
    roots = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles how far a word looks, and counts grow by ``ratio`` a step
        roots = store(roots, "roots")
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("up"))
        if not roots.join(up, "root").limit(1).count():
            break
        roots = roots.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
