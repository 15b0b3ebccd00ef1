"""Quotation links on mail-like threads."""

from tickloom.llm import quoting

MESSAGES = "conv_id long, turn long, role string, text string, origin long, depth int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0) for r in rows], MESSAGES)


def linked(spark, rows):
    return {(r.conv_id, r.turn): r for r in quoting.linked_messages(table(spark, rows)).collect()}


def test_nested_levels_link_to_their_messages(spark):
    got = linked(spark, [
        (1, 0, "a", "Shall we meet?\nOn Monday."),
        (1, 1, "b", "> shall   we MEET?\n\nYes, at noon."),
        (1, 2, "c", "On Tuesday b wrote:\n> > Shall we meet?\n> Yes, at noon.\n\nFine.\n"),
        (1, 3, "d", ">> Shall we meet?\nA fork."),
        (1, 4, "a", "> Nobody said this\nalone"),
        (2, 1, "x", "> Shall we meet?\nother conversation"),
    ])
    assert {k: (r.parent_turn, r.thread_root, r.depth) for k, r in got.items()} == {
        (1, 0): (None, 0, 0), (1, 1): (0, 0, 1), (1, 2): (1, 0, 2), (1, 3): (0, 0, 1), (1, 4): (None, 4, 0), (2, 1): (None, 1, 0)}
    assert got[1, 2].body == "Fine." and got[1, 1].body == "Yes, at noon." and got[1, 0].body == "Shall we meet?\nOn Monday."
    assert (got[1, 2].n_quoted, got[1, 2].n_linked) == (2, 2) and (got[1, 4].n_quoted, got[1, 4].n_linked) == (1, 0)


def test_long_chain_and_its_order(spark, tmp_path):
    rows = [(7, t, "u", f"message {t}" if t == 0 else f"> message {t - 1}\nmessage {t}") for t in range(70)]
    frame = quoting.linked_messages(table(spark, rows))
    got = frame.collect()
    assert all((r.thread_root, r.depth, r.body) == (0, r.turn, f"message {r.turn}") for r in got)
    quoting.write_conversations(frame, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 70


def test_nulls_blank_long_and_repeated_rows(spark):
    rows = [(None, 1, "a", "x"), (1, None, "a", "> x"), (1, 1, None, None), (1, 2, "b", " \n>\n> \n"), (1, 3, "b", "line\n" * 20_000), (1, 4, "b", "> line\n" * 20_000),
            (1, 4, "b", "> line\n" * 20_000)]
    got = quoting.linked_messages(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assert [(r.parent_turn, r.depth, r.body) for r in got if r.turn == 4] == [(3, 1, "")] * 2
    assert quoting.linked_messages(table(spark, [])).count() == 0


def test_plain_conversations_as_replies(spark):
    plain = table(spark, [(1, 0, "a", "first\n\nsecond"), (1, 1, "b", None), (1, 2, "a", "third"), (1, 4, "b", "after a gap")])
    text = {r.turn: r.text for r in quoting.as_replies(plain).collect()}
    assert text == {0: "first\n\nsecond", 1: "> first\n> \n> second\n", 2: "> > first\n> > \n> > second\n> \nthird", 4: "> > third\nafter a gap"}
