"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of a word vector (words of the training texts) and the vectors of its runs of three to
seven bytes (any word), scaled by the root of their number.  Two GRUs read a window of words, one from each end; attention weighs their
states into one vector, and a logistic unit scores it.  Windows overlap; the score of a text is that of
its highest window, so a text of any length is read whole and one bad passage is enough.

Training sees only labels of texts, never of windows: each step takes the highest window of each text as
it stands and fits that.  It is done once, on a bounded sample of labelled rows; scoring runs in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tickloom.llm.common import Words, chunks, mix, run_hashes

#: Bounds of the training sample: so many labelled rows, by hash of their id, with texts up to so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 4_000, 20_000
#: Words and texts worked on at once where each stands for many numbers: keeps the memory of training small.
WORD_BLOCK, TEXT_BLOCK = 10_000, 100
WINDOW, STRIDE = 40, 30
WORD_DIM, STATE, GRAMS, GRAM_SIZES = 10, 8, 1 << 16, (3, 5, 6, 7)
CHANCE, LEAST_TEXTS = 4.5, 4
EPOCHS, RATE, BATCH, SEED = 10, 0.02, 128, 17
#: Epochs before which the highest windows are sought anew.
SEARCHES = (0, 1, 2, 4, 7)

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no label is learned from: crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


# --- inputs ----------------------------------------------------------------------------------


@dataclass
class Batch:
    """Distinct words of some texts and the windows over them.

    ``words``: hash of each distinct word; ``grams`` with ``bounds``: its runs of bytes; ``windows``: word numbers
    from 1 on, 0 beyond the end of a text; ``firsts``: n + 1 bounds of the windows by text.
    """

    words: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray
    windows: np.ndarray
    firsts: np.ndarray


def read(column: pa.Array) -> Batch:
    """Windows of all texts; punctuation separates words.  A text without words has one empty window."""
    text = Words(column, lower=True, punctuation=True)
    names, first, number = np.unique(text.hashes, return_index=True, return_inverse=True)
    grams, bounds = _grams(text.raw_lower, text.starts[first], text.ends[first])

    count = np.diff(text.bounds)
    many = np.maximum(-(-(count - WINDOW) // STRIDE), 0) + 1
    firsts = np.concatenate([[0], np.cumsum(many)])
    whose = np.repeat(np.arange(len(count)), many)
    # the last window of a text ends with it
    begin = np.minimum((np.arange(firsts[-1]) - firsts[whose]) * STRIDE, np.maximum(count[whose] - WINDOW, 0))
    at = begin[:, None] + np.arange(WINDOW)
    there = at < count[whose][:, None]
    flat = np.append(number + 1, 0)
    windows = np.where(there, flat[np.where(there, text.bounds[whose][:, None] + at, -1)], 0).astype(np.int32)
    return Batch(names, grams, bounds, windows, firsts)


def joined(batches: list[Batch]) -> Batch:
    """The texts of all batches, with one number for each word."""
    words, first, number = np.unique(np.concatenate([b.words for b in batches]), return_index=True, return_inverse=True)
    sizes = np.concatenate([np.diff(b.bounds) for b in batches])
    begin = np.concatenate([[0], np.cumsum(sizes)])[first]
    bounds = np.concatenate([[0], np.cumsum(sizes[first])])
    grams = np.concatenate([b.grams for b in batches])[np.repeat(begin - bounds[:-1], sizes[first]) + np.arange(bounds[-1])]
    ends = np.cumsum([len(b.words) for b in batches])
    windows = [np.append(0, number[end - len(b.words):end] + 1).astype(np.int32)[b.windows] for b, end in zip(batches, ends, strict=True)]
    firsts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b.firsts) for b in batches]))])
    return Batch(words, grams, bounds, np.concatenate(windows), firsts)


def _grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the runs of bytes of each word, with a mark before and behind it, and their bounds by word."""
    parts, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, len(starts), WORD_BLOCK):
        found, count = _block_grams(raw, starts[i:i + WORD_BLOCK], ends[i:i + WORD_BLOCK])
        parts.append(found)
        counts.append(count)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _block_grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = ends - starts + 2
    at = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(at[-1]) - at[owner]
    edge = (inside == 0) | (inside == sizes[owner] - 1)
    flat = np.where(edge, np.where(inside == 0, 2, 3), raw[np.where(edge, 0, starts[owner] + inside - 1)])
    values, found, whose = mix(flat.astype(np.uint64) + _GOLD), [], []
    for n in GRAM_SIZES:
        begin = np.flatnonzero(inside <= np.maximum(sizes - n, 0)[owner])
        found.append(run_hashes(values, begin, np.minimum(begin + n, at[1:][owner[begin]])))
        whose.append(owner[begin])
    words = np.concatenate(whose)
    order = np.argsort(words, kind="stable")
    return (np.concatenate(found)[order] & np.uint64(GRAMS - 1)).astype(np.int32), np.bincount(words, minlength=len(sizes))


# --- network ---------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights by name, and the sorted hashes of the words that have a vector of their own."""

    def __init__(self, vocabulary: np.ndarray, evidence: np.ndarray, gram_evidence: np.ndarray, rate: float):
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.vocabulary = vocabulary
        self.w = {"word": draw(len(vocabulary) + 1, WORD_DIM), "gram": draw(GRAMS, WORD_DIM), "attend": draw(2 * STATE),
                  "out": draw(2 * STATE), "bias": np.array([np.log(rate / (1 - rate))], np.float32)}
        for side in ("f", "b"):
            self.w |= {f"x{side}": draw(WORD_DIM, 3 * STATE) * 3, f"h{side}": draw(STATE, 3 * STATE), f"c{side}": np.zeros(3 * STATE, np.float32)}
        # the first numbers of the vectors start as what the labels of the sample say of a word and of a run of bytes
        self.w["word"][:-1, 0] += evidence
        self.w["gram"][:, 1] += gram_evidence
        self.w["word"][-1] = 0  # unknown words speak by their bytes alone

    def vectors(self, batch: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Vector of each word number (0: nothing), and the row of each distinct word in the word table."""
        spot = np.minimum(np.searchsorted(self.vocabulary, batch.words), len(self.vocabulary) - 1) if len(self.vocabulary) else np.zeros(len(batch.words), np.int64)
        row = np.where(self.vocabulary[spot] == batch.words, spot, len(self.vocabulary)) if len(self.vocabulary) else spot
        sums = np.zeros((len(batch.words), WORD_DIM), self.w["gram"].dtype)
        for i in range(0, len(batch.words), WORD_BLOCK):
            cuts = batch.bounds[i:i + WORD_BLOCK + 1]
            sums[i:i + WORD_BLOCK] = np.add.reduceat(self.w["gram"][batch.grams[cuts[0]:cuts[-1]]], cuts[:-1] - cuts[0], axis=0)
        x = self.w["word"][row] + sums / np.sqrt(np.maximum(np.diff(batch.bounds), 1))[:, None].astype(np.float32)
        return np.concatenate([np.zeros((1, WORD_DIM), np.float32), x]).astype(np.float32), row

    def forward(self, x: np.ndarray, windows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows; with ``keep``, what the backward pass needs."""
        n, memory = len(windows), {}
        states = np.empty((WINDOW, n, 2 * STATE), np.float32)
        for side, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            given = x @ self.w[f"x{side}"] + self.w[f"c{side}"]
            recur = self.w[f"h{side}"]
            h = np.zeros((n, STATE), np.float32)
            part = slice(0, STATE) if side == "f" else slice(STATE, 2 * STATE)
            steps = []
            for t in order:
                g = given[windows[:, t]]
                u = h @ recur
                zr = 1 / (1 + np.exp(-(g[:, :2 * STATE] + u[:, :2 * STATE])))
                z, r = zr[:, :STATE], zr[:, STATE:]
                c = np.tanh(g[:, 2 * STATE:] + r * u[:, 2 * STATE:])
                if keep:
                    steps.append((t, h, z, r, c, u[:, 2 * STATE:]))
                h = c + z * (h - c)
                states[t, :, part] = h
            if keep:
                memory[side] = steps
        there = (windows > 0).T
        e = np.where(there, states @ self.w["attend"], np.float32(-30))
        a = np.exp(e - e.max(axis=0))
        a *= there
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnd->nd", a, states)
        logit = pooled @ self.w["out"] + self.w["bias"]
        if keep:
            memory |= {"states": states, "a": a, "pooled": pooled}
        return logit, memory

    def gradients(self, batch: Batch, x: np.ndarray, row: np.ndarray, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean cross-entropy of windows."""
        logit, m = self.forward(x, windows, keep=True)
        d = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        states, a, pooled = m["states"], m["a"], m["pooled"]
        grad = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * self.w["out"]
        d_a = np.einsum("nd,tnd->tn", d_pooled, states)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        grad["attend"] = np.einsum("tn,tnd->d", d_e, states)
        d_states = a[:, :, None] * d_pooled + d_e[:, :, None] * self.w["attend"]
        d_x = np.zeros_like(x)
        for side in ("f", "b"):
            recur = self.w[f"h{side}"]
            part = slice(0, STATE) if side == "f" else slice(STATE, 2 * STATE)
            d_given = np.zeros((len(x), 3 * STATE), np.float32)
            d_recur = np.zeros_like(recur)
            d_h = np.zeros((len(windows), STATE), np.float32)
            for t, h, z, r, c, u in reversed(m[side]):
                d_h = d_h + d_states[t, :, part]
                d_c = d_h * (1 - z) * (1 - c * c)
                d_z = d_h * (h - c) * z * (1 - z)
                d_r = d_c * u * r * (1 - r)
                g = np.concatenate([d_z, d_r, d_c], axis=1)
                g_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
                np.add.at(d_given, windows[:, t], g)
                d_recur += h.T @ g_u
                d_h = d_h * z + g_u @ recur.T
            grad |= {f"h{side}": d_recur, f"x{side}": x.T @ d_given, f"c{side}": d_given.sum(axis=0)}
            d_x += d_given @ self.w[f"x{side}"].T
        d_x = d_x[1:]
        grad["word"] = np.zeros_like(self.w["word"])
        np.add.at(grad["word"], row, d_x)
        grad["word"][-1] = 0
        sizes = np.diff(batch.bounds)
        grad["gram"] = np.zeros_like(self.w["gram"])
        np.add.at(grad["gram"], batch.grams, np.repeat(d_x / np.sqrt(np.maximum(sizes, 1))[:, None].astype(np.float32), sizes, axis=0))
        return grad

    def text_scores(self, column: pa.Array, limit: int = 8_192) -> np.ndarray:
        """Highest window score of each text, between 0 and 1."""
        batch = read(column)
        x, _ = self.vectors(batch)
        logits = np.concatenate([self.forward(x, batch.windows[i:i + limit])[0] for i in range(0, len(batch.windows), limit)] or [np.zeros(0, np.float32)])
        return _sigmoid(np.maximum.reduceat(logits, batch.firsts[:-1]).astype(np.float64)) if len(column) else np.zeros(0)


def _evidence(batch: Batch, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in a few texts at least and how far their share among the marked texts is from that among the others; that of all byte runs."""
    def gap(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other, marked = counts
        seen = marked + other
        due = seen * target.mean()
        # signed root of the log-likelihood ratio; what chance gives among so many things is no evidence
        ratio = marked * np.log(np.maximum(marked, 1) / np.maximum(due, 1e-9)) + other * np.log(np.maximum(other, 1) / np.maximum(seen - due, 1e-9))
        root = np.sqrt(2 * np.maximum(ratio, 0))
        return seen, (np.sign(marked - due) * np.clip((root - CHANCE) / 4, 0, 2)).astype(np.float32)

    # in how many texts of each label a word or a run of bytes occurs
    words, grams = np.zeros((2, len(batch.words)), np.int64), np.zeros((2, GRAMS), np.int64)
    sizes = np.diff(batch.bounds)
    for a in range(0, len(target), TEXT_BLOCK):
        cuts = batch.firsts[a:a + TEXT_BLOCK + 1]
        whose = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        pairs = np.unique(np.repeat(whose, WINDOW) * (len(batch.words) + 1) + batch.windows[cuts[0]:cuts[-1]].ravel())
        text, word = np.divmod(pairs, len(batch.words) + 1)
        text, word = text[word > 0], word[word > 0] - 1
        many = sizes[word]
        at = np.repeat(batch.bounds[word] - np.cumsum(many) + many, many) + np.arange(many.sum())
        found = np.unique(np.repeat(text, many) * GRAMS + batch.grams[at])
        label = target[a:a + TEXT_BLOCK]
        for k in (0, 1):
            words[k] += np.bincount(word[label[text] == k], minlength=len(batch.words))
            grams[k] += np.bincount(found[label[found // GRAMS] == k] % GRAMS, minlength=GRAMS)
    seen, word_gap = gap(words)
    often = np.flatnonzero(seen >= LEAST_TEXTS)
    seen, gram_gap = gap(grams)
    return batch.words[often], word_gap[often], np.where(seen >= LEAST_TEXTS, gram_gap, 0).astype(np.float32)


def _part(batch: Batch, windows: np.ndarray) -> tuple[Batch, np.ndarray]:
    """The words of some windows alone, and the windows in their numbers."""
    used, number = np.unique(np.append(windows, 0), return_inverse=True)
    used = used[1:] - 1
    sizes = np.diff(batch.bounds)[used]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(batch.bounds[used] - bounds[:-1], sizes) + np.arange(bounds[-1])
    return Batch(batch.words[used], batch.grams[at], bounds, windows, batch.firsts), number[:-1].reshape(windows.shape)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> Network | float:
    """The fitted network; with one class only, or no text, its rate (0 for none)."""
    target = np.array(labels, np.float32)
    if not 0 < target.sum() < len(target):
        return float(target.mean()) if len(target) else 0.0
    rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    batch = joined([read(part.column("text")) for part in chunks([rows])])
    net = Network(*_evidence(batch, target.astype(np.int64)), float(target.mean()))
    rng = np.random.default_rng(SEED)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for epoch in range(epochs):
        if epoch in SEARCHES:
            x, _ = net.vectors(batch)
            logits = np.concatenate([net.forward(x, batch.windows[i:i + 8_192])[0] for i in range(0, len(batch.windows), 8_192)])
            highest = np.array([a + int(np.argmax(logits[a:b])) for a, b in zip(batch.firsts, batch.firsts[1:], strict=False)])
        order = rng.permutation(len(target))
        for i in range(0, len(order), BATCH):
            some = order[i:i + BATCH]
            part, windows = _part(batch, batch.windows[highest[some]])
            x, row = net.vectors(part)
            grad = net.gradients(part, x, row, windows, target[some])
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                net.w[k] -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return net


# --- Spark -----------------------------------------------------------------------------------


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: at most ``rows`` labelled documents that are not held out, by hash of the id.

    A document with several labels takes the highest, one with several texts the smallest.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # twice as many as needed, as some have no text here; both numbers are bounds
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
    found = docs.select("doc_id", "text").filter(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    got = found.collect()
    return [r["text"] for r in got], [int(r["toxic"] > 0) for r in got]


def scored(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; ``docs`` and its score never meet labels but through the sample.

    Null and empty texts have the score of an empty window.  Rows are scored one by one, so repeated rows and null ids
    pass through.  Without labels of both classes all scores are the rate of the labels there are.
    """
    return with_scores(docs.select("doc_id", "text"), train(*sample(docs, labels, rows))) \
        .select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents, all columns of whatever names, with a score below 0.5; nulls, repeated rows and empty tables as in ``scored``."""
    name = "_score"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return with_scores(docs, train(*sample(docs, labels, rows)), name).filter(F.col(name) < 0.5).drop(name)


def with_scores(docs: DataFrame, model: Network | float, name: str = "score") -> DataFrame:
    """The rows with their score, any columns they have."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the input

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for part in chunks(batches):
            score = np.full(part.num_rows, net) if isinstance(net, float) else net.text_scores(part.column("text"))
            yield part.append_column(name, pa.array(score, pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))
