"""Quotation linking: which message a reply quotes, and conversations in reply order without quotes.

A line's quote level is the number of ``>`` it begins with.  Quoted lines are normalised (lower case, blanks
folded), hashed and joined to the first message of the conversation that has the line as its own.  The
parent of a message is the latest message its outermost quoted lines come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import store

MARKS = r"^\s*((?:>\s?)+)"
#: Rounds of pointer doubling: reply chains up to 2**40.
ROUNDS = 40


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"\s+", " ")))


def own_text(text: str) -> Column:
    """The lines that are not quoted, without the lines that announce a quote, trimmed."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    quoted = lambda x: F.coalesce(x.rlike(MARKS), F.lit(False))
    kept = F.filter(lines, lambda x, i: ~quoted(x) & ~(x.rlike(r"wrote:\s*$") & quoted(F.get(lines, i + 1))))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")


def linked_messages(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, parent_turn, thread_root, depth, n_quoted, n_linked, body.

    ``parent_turn`` is null for a message without a quote that an earlier message of its conversation explains;
    it is then the root of its thread at depth 0.  (thread_root, depth, turn) is the reply order.
    ``n_quoted`` counts different quoted lines, ``n_linked`` those with an origin.  Null text is empty; blank lines link
    nothing.  Rows that share conv_id and turn are one message for links and keep their own texts; rows with a
    null in one of the two are roots.
    """
    messages = messages.select("conv_id", "turn", "role", "text")
    lines = messages.filter("conv_id is not null and turn is not null") \
        .select("conv_id", "turn", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")) \
        .select("conv_id", "turn", level(F.col("line")).alias("level"), normal(F.col("line")).alias("norm")).filter("norm <> ''") \
        .select("conv_id", "turn", "level", F.xxhash64("norm").alias("h"))
    # folded before the shuffle: a line that all messages have is one row per task
    origins = lines.filter("level = 0").groupBy("conv_id", "h").agg(F.min("turn").alias("origin"))
    quotes = lines.filter("level > 0").groupBy("conv_id", "turn", "h").agg(F.min("level").alias("level"))
    found = quotes.join(origins.withColumnRenamed("conv_id", "_c").withColumnRenamed("h", "_h"),
                        (F.col("conv_id") == F.col("_c")) & (F.col("h") == F.col("_h")) & (F.col("origin") < F.col("turn")), "left")
    parents = found.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("origin").isNotNull(), F.struct((-F.col("level")).alias("outer"), "origin"))).alias("best"),
        F.count(F.lit(1)).alias("n_quoted"), F.count("origin").alias("n_linked"))
    parents = store(parents.select("conv_id", "turn", F.col("best.origin").alias("parent_turn"), "n_quoted", "n_linked"), "parents")
    paths = _paths(parents.filter("parent_turn is not null").select("conv_id", "turn", "parent_turn"))
    return (
        messages.join(parents, ["conv_id", "turn"], "left").join(paths, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", "role", "parent_turn", F.coalesce("root", "turn").alias("thread_root"),
                F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
                F.coalesce("n_linked", F.lit(0)).alias("n_linked"), own_text("text").alias("body"))
    )


def _paths(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of all replies, by doubling: each round a message takes over what its pointer knows.

    Messages whose pointer has reached the root of the thread take no part in later rounds.
    """
    open_ = store(replies.select("conv_id", "turn", F.col("parent_turn").alias("root"), F.lit(1).alias("depth")), "paths")
    done = open_.limit(0)
    for _ in range(ROUNDS):
        up = open_.unionByName(done).select("conv_id", F.col("turn").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        step = store(open_.join(up, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("_root", "root").alias("root"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.col("_root").isNull().alias("_over")), "paths")
        done = done.unionByName(step.filter("_over").drop("_over"))
        open_ = step.filter("not _over").drop("_over")
        if not open_.limit(1).count():
            return done
    raise RuntimeError("reply chains did not end")


def write_conversations(linked: DataFrame, path: str) -> None:
    """Messages in reply order: by conversation, thread, depth and turn; a long conversation goes over several files."""
    order = ["conv_id", "thread_root", "depth", "turn"]
    linked.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def as_replies(messages: DataFrame) -> DataFrame:
    """The conversations as a mail archive has them: each message quotes the one before it, and that one's own predecessor a level deeper."""
    def quoted(text: str, mark: str) -> Column:
        return F.concat(F.array_join(F.transform(F.split(F.col(text), "\n"), lambda x: F.concat(F.lit(mark), x)), "\n"), F.lit("\n"))

    text = messages.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("said"))
    out = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("own"))
    for back, name in ((1, "before"), (2, "earlier")):
        other = text.groupBy("conv_id", (F.col("turn") + back).alias("turn")).agg(F.min("said").alias(name))
        out = out.join(other, ["conv_id", "turn"], "left")
    parts = [F.coalesce(quoted("earlier", "> > "), F.lit("")), F.coalesce(quoted("before", "> "), F.lit(""))]
    return out.select("conv_id", "turn", "role", F.concat(*parts, "own").alias("text"))
