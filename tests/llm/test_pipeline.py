"""The corpus pipeline against its stages done by brute force."""

import random

import public_tokenizers
import test_decontam
import test_jaccard
import test_passages
import test_toxicity
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import jaccard, passages, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rows, labels = test_toxicity.corpus(400)
    rng = random.Random(11)
    words = lambda n: " ".join(f"t{rng.randrange(900)}" for _ in range(n))
    texts = [t for _, t, *_ in rows]
    passage, item = words(70), words(30)
    texts += [words(80), words(20) + "\n" + passage, passage + " " + words(25), words(10) + "  " + item + " " + words(9), "", None]
    near = texts[-6].split()
    near[5] = "other"
    texts += [texts[-6], " ".join(near), passage]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return docs, labels, [(1, item), (2, words(12))]


def test_stages_and_run(spark, tmp_path):
    docs, labels, items = corpus()
    sf = str(tmp_path)
    spark.createDataFrame(docs, DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    frame = spark.read.parquet(f"{sf}/documents.parquet")
    scored = toxicity.scored(frame, spark.read.parquet(f"{sf}/labels.parquet"))
    left = {r.doc_id for r in scored.collect() if not r.predicted}
    data = [d for d in docs if d[0] in left]
    assert 70 < len(docs) - len(data) < 130, len(docs) - len(data)
    group = {i: c for i, _, c in test_jaccard.brute(data, 5, 80)}
    data = [d for d in data if group[d[0]] == d[0]]
    assert len(data) < len(left) - 1
    kept = {i: (k, gone) for i, k, _, gone in test_passages.brute(data, 50)}
    cut = [(d[0], kept[d[0]][0] if kept[d[0]][1] else d[1], *d[2:]) for d in data]
    assert sum(kept[d[0]][1] for d in data) == 140
    dirty = {i for i, *_ in test_decontam.brute(cut, [(*x, 0) for x in items])}
    assert len(dirty) == 1
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d[0]: lib.encode(d[1] or "", add_special_tokens=False).ids for d in cut if d[0] not in dirty}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want

    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        frame = stage(spark, frame, sf)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = f"{sf}/stage{k}"
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in frame.filter("text is not null").collect()) == sorted((d[0], d[1]) for d in cut if d[0] not in dirty and d[1] is not None)
    assert all(r.n_chars == len(r.text) for r in frame.filter("text is not null").collect())


def test_stages_keep_columns_of_any_name(spark):
    docs, labels, _ = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    more = frame
    names = ["n_words", "kept", "n_removed", "_score", "score", "whole", "carried", "row", "spans", "component_id", "A b"]
    for name in names:
        more = more.withColumn(name, F.lit(name))
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for stage in (passages.with_repeats_cut, lambda d: toxicity.without_toxic(d, label), jaccard.one_of_each_group):
        plain, wide = stage(frame), stage(more)
        assert wide.columns == [*frame.columns, *names]
        assert sorted(map(repr, wide.select(*frame.columns).collect())) == sorted(map(repr, plain.collect()))
        assert wide.select(F.col("`A b`"), "kept").distinct().collect() == [("A b", "kept")]
