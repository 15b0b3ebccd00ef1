"""Winnowing fingerprints: k-gram hashes of the words, the smallest of each window, with positions.

Any run of ``GRAM + WINDOW - 1`` words that two texts share gives them a common fingerprint.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import ordered_buckets

GRAM, WINDOW = 3, 4
#: Fixed modulus and base of the rolling hash: products stay within a long.
PRIME, BASE = 2_147_483_647, 1_000_003
_SHIFT = 1 << 32


def with_fingerprint(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds ``name``: array of longs, ``hash * 2**32 + (2**32 - 1 - position)``, in order of position.

    The packed form makes the minimum of a window the smallest hash and, among equals, the
    rightmost.  Fewer than ``gram`` words make one gram, fewer than ``window`` grams one window; a text
    without words (null, empty, blank) has an empty array.
    """
    words, h, grams = f"_{name}_w", f"_{name}_h", f"_{name}_g"
    n = F.greatest(F.size(h) - gram + 1, F.lit(1))

    def hashed(i: Column) -> Column:
        # the value a rolling hash has at i: sum of word[i + j] * BASE ** (gram - 1 - j) modulo PRIME, by Horner's rule
        value = F.get(F.col(h), i)
        for j in range(1, gram):
            value = F.pmod(value * BASE + F.coalesce(F.get(F.col(h), i + j), F.lit(0)), F.lit(PRIME))
        return value * _SHIFT + (_SHIFT - 1) - i.cast("long")

    return (
        df.withColumn(words, F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+"))
        .withColumn(h, F.transform(F.filter(F.col(words), lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
        .withColumn(grams, F.when(F.size(h) > 0, F.transform(F.sequence(F.lit(0), n - 1), hashed)).otherwise(F.array().cast("array<long>")))
        .withColumn(name, F.when(F.size(grams) > 0, F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(grams) - window, F.lit(0))),
            lambda i: F.least(*[F.get(F.col(grams), i + j) for j in range(window)])))).otherwise(F.col(grams)))
        .drop(words, h, grams)
    )


def as_text(fingerprint: str) -> Column:
    """``hash@position`` in hexadecimal and decimal, joined by commas."""
    return F.array_join(F.transform(F.col(fingerprint), lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, 32))), F.lit("@"), (F.lit(_SHIFT - 1) - v.bitwiseAND(F.lit(_SHIFT - 1))).cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of the hashes of two fingerprints; two empty ones are alike, an empty and another are not."""
    hashes = [F.array_distinct(F.transform(F.col(c), lambda v: F.shiftright(v, 32))) for c in (a, b)]
    union = F.size(F.array_union(*hashes))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(*hashes)) / union)


def with_next(df: DataFrame, id_col: str, column: str, name: str, tie: str) -> DataFrame:
    """Adds ``name``, the ``column`` of the next row by ``id_col``; the last row's is the first's.

    The table is cut into buckets that follow the id, and the first row of a bucket is lent to the
    bucket before it; a row moves once.  Null ids come first, rows with one id follow ``tie``.
    """
    lowest = F.lit(-(1 << 63))
    rows = df.withColumn("_key", F.coalesce(F.col(id_col), lowest))
    bucket = ordered_buckets(df.select(F.coalesce(F.col(id_col), lowest).alias("_key")), "_key")
    # one row per bucket, and their number is fixed by the shuffle width
    firsts = df.select(F.coalesce(F.col(id_col), lowest).alias("_key")).select("_key", bucket.alias("_b")) \
        .groupBy("_b").agg(F.min("_key").alias("_key"))
    around = Window.partitionBy().orderBy("_b")
    last = F.max("_b").over(Window.partitionBy())
    firsts = firsts.select("_key", F.coalesce(F.lag("_b").over(around), last).alias("_lend"))
    copies = F.inline(F.array_compact(F.array(
        F.struct(F.col("_home").alias("_bucket"), F.lit(False).alias("_lent")),
        F.when(F.col("_lend").isNotNull(), F.struct(F.col("_lend").alias("_bucket"), F.lit(True).alias("_lent"))))))
    order = Window.partitionBy("_bucket").orderBy("_lent", "_key", tie)
    return (
        rows.withColumn("_home", bucket).join(F.broadcast(firsts), "_key", "left")
        .select(*df.columns, "_key", copies)
        .withColumn(name, F.lead(column).over(order))
        .filter("not _lent").drop("_key", "_bucket", "_lent")
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses; see the query's contract.

    Null text counts as empty.  The edited text keeps the first ``n - n div 2`` code points and goes on with
    the first ``n div 2`` (or all) of the next document.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    half = F.expr("n_chars div 2").cast("int")
    rows = (
        with_next(docs, "doc_id", "text", "next", "_tie")
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
                                       F.substring(F.col("next"), F.lit(1), half)))
    )
    # only texts were moved; the fingerprint of the next document is computed again where it is needed
    for text, name in (("text", "fp"), ("edited", "edited_fp"), ("next", "next_fp")):
        rows = with_fingerprint(rows, text, name)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("fp").alias("fingerprint"), as_text("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
