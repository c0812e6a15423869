from pyspark.sql import functions as F

from ratelattice.llm import quotes

SCHEMA = "conv_id bigint, turn bigint, role string, text string, line string, hash string"


def run(spark, rows):
    return quotes.link_quotes(spark.createDataFrame([(*r, "l", "h") for r in rows], SCHEMA)).collect()


def test_links_threads_and_order(spark):
    rows = [
        (1, 0, "user", "First question.\nSecond line"),
        (1, 1, "user", "Another topic"),
        (1, 2, "assistant", "On Monday someone wrote:\n> first   QUESTION.\nAn answer."),
        (1, 3, "user", "> > First question.\n> An answer.\nThanks\nfor that"),
        (1, 4, "assistant", ">Another topic\n> another topic\n> An answer.\nSure"),
        (1, 5, "user", "> nobody said this\nHm"),
        (2, 0, "user", "> An answer.\nother conversation"),
        (None, 3, "user", "> Hm\nlost"),
        (2, None, "user", None),
        (1, 6, "user", ""),
    ]
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert len(got) == len(rows)
    one = {t: got[1, t] for t in range(7)}
    assert {t: r.parent_turn for t, r in one.items()} == {0: None, 1: None, 2: 0, 3: 2, 4: 1, 5: None, 6: None}
    assert {t: r.thread_turn for t, r in one.items()} == {0: 0, 1: 1, 2: 0, 3: 0, 4: 1, 5: 5, 6: 6}
    assert [t for t in sorted(one, key=lambda t: one[t].reply_order)] == [0, 2, 3, 1, 4, 5, 6]
    assert {t: r.text for t, r in one.items()} == {
        0: "First question.\nSecond line", 1: "Another topic", 2: "An answer.", 3: "Thanks\nfor that", 4: "Sure", 5: "Hm", 6: "",
    }
    assert (one[3].quoted_lines, one[3].linked_lines) == (2, 2) and (one[5].quoted_lines, one[5].linked_lines) == (1, 0)
    assert got[2, 0].parent_turn is None and got[None, 3].text == "lost" and got[2, None].text == ""


def test_a_line_said_often_links_to_its_latest_message(spark):
    rows = [(5, t, "user", "same line") for t in range(50)] + [(5, t, "user", "> same line\nyes") for t in range(50, 80)] + [(5, 60, "user", "> same line\nagain")]
    got = run(spark, rows)
    assert len(got) == 81 and {r.parent_turn for r in got if r.turn >= 50} == {49}
    assert sorted(r.reply_order for r in got) == list(range(81))


def test_levels(spark):
    df = spark.createDataFrame([("> > a",), (">>>b",), ("a > b",), ("",)], "x string")
    assert [r.n for r in df.select(quotes.quote_level(F.col("x")).alias("n")).collect()] == [2, 3, 0, 0]


def test_empty_table_and_plan(spark):
    assert run(spark, []) == []
    plan = quotes.link_quotes(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_passages_tell_the_message_where_lines_do_not(spark):
    rows = [
        (1, 0, "user", "Thanks, that works"),
        (1, 1, "user", "See you"),
        (1, 4, "assistant", "Thanks, that works\nSee you\n\nBye"),
        (1, 5, "user", "> Thanks, that works\n> See you\nWhy?"),
        (1, 6, "user", "> Thanks, that works\n> See you\n>\n> Bye\nAll of it"),
    ]
    assert {r.turn: r.parent_turn for r in run(spark, rows) if r.turn > 4} == {5: 4, 6: 4}


def test_lines_wrapped_anew_link(spark):
    rows = [
        (1, 0, "user", "Hello"),
        (1, 1, "user", "A long line that a mail client wraps when it is quoted\n\nAnother one"),
        (1, 2, "user", "> A long line that a mail client\n> wraps when it is quoted\nYes"),
    ]
    (last,) = [r for r in run(spark, rows) if r.turn == 2]
    assert (last.parent_turn, last.quoted_lines, last.linked_lines) == (1, 2, 2)


def test_deeper_quotes_give_a_parent_where_the_first_level_does_not(spark):
    rows = [
        (1, 0, "user", "Question"),
        (1, 1, "user", "> Question\nAnswer"),
        (1, 2, "user", "> > Question\nStill open"),
        (2, 0, "user", "Question"),
        (2, 1, "user", ">> Question\nYes"),
    ]
    assert {(r.conv_id, r.turn): r.parent_turn for r in run(spark, rows)} == {(1, 0): None, (1, 1): 0, (1, 2): 1, (2, 0): None, (2, 1): 0}


def brute_parents(rows):
    """Replies of one quoted line each, by a plain search backwards."""
    out = {}
    for conv, turn, _, text in rows:
        quoted = [x[2:] for x in text.split("\n") if x.startswith("> ")]
        earlier = [(t, own) for c, t, _, own in rows if c == conv and t < turn]
        hits = [t for t, own in earlier if quoted and quoted[0] in own.split("\n")]
        out[conv, turn] = max(hits, default=None)
    return out


def test_generated_threads_match_a_search_backwards(spark):
    """A conversation with a third of all messages, lines said again and again, a very long message."""
    import random

    rng = random.Random(3)
    said = [f"line number {i} of what is said" for i in range(25)]
    rows = []
    for i in range(400):
        conv = 0 if i % 3 == 0 else 1 + i % 20
        own = rng.choice(said)
        rows.append((conv, i, "user", f"> {rng.choice(said)}\n{own}" if rng.random() < 0.6 else own))
    rows.append((1, 500, "user", "\n".join(f"word {i}" for i in range(20_000))))
    rows.append((1, 501, "user", "> word 19999\nwell"))
    got = {(r.conv_id, r.turn): r.parent_turn for r in run(spark, rows)}
    assert got == brute_parents(rows)
