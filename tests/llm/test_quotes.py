"""Quotation linking by hand-made threads, and against its SQL twin."""

from __future__ import annotations

import duckdb
import pandas as pd

from sheetlake.llm.oracles import OP10
from sheetlake.llm.quotes import conversations

ROWS = [
    (1, 0, "user", "Hello there.\n\nHow are   you?", "x"),
    (1, 1, "assistant", "> How are you?\r\nFine!\n> > nothing known\nok", "x"),
    (1, 2, "user", "Other thing", "x"),
    (1, 3, "user", "> > how ARE you?\n> Fine!\nGreat", "x"),
    (1, 4, "user", ">> Hello there.\n> lost words\nhm", "x"),
    (1, 4, "user", "second part", "x"),
    (1, 5, None, "> Great\nend", "x"),
    (1, 5, None, "> Great\nend", "x"),
    (1, None, "x", "q", "x"),
    (None, 3, None, None, "x"),
    (2, 0, "user", None, "x"),
    (2, 1, "user", "> \nblank", "x"),
    (2, 2, "user", "> Great\nnot in this conversation", "x"),
    (3, 0, "user", "one line\nanother line", "x"),
    (3, 1, "user", "> one line\n> another line\nboth", "x"),
    (3, 2, "user", " \t> another line\nhalf", "x"),
    (3, 3, "user", "\x0b> another line", "x"),
]


def plain(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()
    return sorted(tuple(str(int(x)) if isinstance(x, float) else str(x) for x in row) for row in rows)


def test_replies_follow_what_they_quote(spark):
    messages = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, thread string")
    found = conversations(messages.repartition(3)).toPandas()
    by = {(x.conv_id, x.turn, x.body): x for x in found.itertuples()}
    assert len(found) == len(ROWS)
    assert by[1, 1, "Fine!\nok"].reply_to == 0
    assert (by[1, 3, "Great"].reply_to, by[1, 3, "Great"].quote_level) == (1, 1)
    assert (by[1, 4, "hm"].reply_to, by[1, 4, "hm"].quote_level) == (0, 2)
    assert by[1, 4, "second part"].reply_to == 0
    assert by[1, 5, "end"].thread == 0
    assert by[1, 2, "Other thing"].position == 8
    assert pd.isna(by[2, 2, "not in this conversation"].reply_to)
    assert by[3, 1, "both"].reply_to == 0 and by[3, 2, "half"].reply_to == 0
    assert by[1, 1, "Fine!\nok"].formatted == "<|im_start|>assistant\nFine!\nok<|im_end|>\n"
    assert conversations(messages.limit(0)).count() == 0

    frame = pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text", "thread"])
    with duckdb.connect() as database:
        database.register("given", frame.astype({"conv_id": "Int64", "turn": "Int64"}))
        database.sql("CREATE VIEW conversations AS SELECT conv_id::BIGINT conv_id, turn::BIGINT turn, role, text FROM given")
        assert plain(database.sql(OP10).df()) == plain(found)


def test_excerpts_link_to_the_latest_message_that_says_all_of_them(spark):
    origin = "First line here\nsecond line here\nthird line here\n\nA sentence one. And sentence two! Then three.\n\nLast\nparagraph. It ends."
    quotes = {
        2: "> First line here\n> second line here\na",
        3: "> And sentence two!\nb",
        4: "> third line here\n>\n> A sentence one. And sentence two! Then three.\nc",
        5: "> Last paragraph.\nd",
        6: "> First line here\n> never said\ne",
    }
    rows = [(1, 0, "user", origin), (1, 1, "user", "First line here\nother")] + [(1, k, "user", x) for k, x in quotes.items()]
    rows.append((1, 7, "user", "second line here\nFirst line here"))
    found = {x.turn: x.reply_to for x in conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert found == {0: None, 1: None, 2: 0, 3: 0, 4: 0, 5: 0, 6: None, 7: None}
