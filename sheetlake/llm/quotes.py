"""Chat formatting: quoted passages linked to the messages they come from, with DataFrame functions only.

A line's quote level is the number of ``>`` marks in front of it.  Neighbouring
lines of one level form a passage.  Passages are compared by a hash of their
normalised text (white space collapsed, A-Z in lower case).  What a message
says itself (level 0) can be found whole, by passage, by paragraph or by line; a quoted
passage links to the latest earlier message of the conversation that says it.  An excerpt
that no message says as such a whole links to the latest earlier message that says
all of its lines, all sentences of its lines, or all sentences of its paragraphs.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.operators.ordered import running_total
from sheetlake.session import written

MARKS = r"^[ \t]*(>[ \t]?)+"
ROUNDS = 64


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, ascii_uppercase, ascii_lowercase), "[ \\t-\\r]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds ``_parts``: an array of (level, no, text), one for each passage of each message, in order."""
    lines = F.transform(
        _lines(F.col("text")),
        lambda x: F.struct(_level(x).cast("long").alias("level"), F.regexp_replace(x, MARKS, "").alias("text")),
    )
    changes = F.transform(
        F.col("_lines"),
        lambda x, k: F.when((k == 0) | (x["level"] != F.col("_lines")[F.greatest(k - 1, F.lit(0))]["level"]), k),
    )
    starts = F.filter(F.col("_changes"), lambda x: x.isNotNull())
    part = F.transform(
        F.col("_starts"),
        lambda first, k: F.struct(
            F.col("_lines")[first]["level"].alias("level"),
            k.alias("no"),
            F.array_join(
                F.transform(
                    F.slice(
                        F.col("_lines"),
                        first + 1,
                        F.coalesce(F.get(F.col("_starts"), k + 1), F.size("_lines")) - first,
                    ),
                    lambda x: x["text"],
                ),
                "\n",
            ).alias("text"),
        ),
    )
    return (
        messages.withColumn("_lines", lines)
        .withColumn("_changes", changes)
        .withColumn("_starts", starts)
        .withColumn("_parts", part)
        .drop("_lines", "_changes", "_starts")
    )


def _own(parts: Column) -> Column:
    """The passages a message says itself."""
    return F.transform(F.filter(parts, lambda x: x["level"] == 0), lambda x: x["text"])


def body(parts: Column) -> Column:
    """What a message says itself, without quotes and outer white space."""
    return F.regexp_replace(F.array_join(_own(parts), "\n"), r"\A[ \t-\r]+|[ \t-\r]+\z", "")


def _units(text: Column) -> list[Column]:
    """Three ways to take a text apart: lines, sentences of lines, sentences of paragraphs; each an array of hashes."""
    lines = F.split(text, "\n")
    paragraphs = F.transform(F.split(text, "\\n[ \\t-\\r]*\\n"), _normal)
    sentences = [F.flatten(F.transform(x, lambda y: F.split(y, "(?<=[.!?])[ \\t-\\r]+"))) for x in (lines, paragraphs)]
    filled = [F.filter(F.transform(x, _normal), lambda y: y != "") for x in (lines, *sentences)]
    return [F.array_sort(F.array_distinct(F.transform(x, lambda y: F.sha2(y, 256)))) for x in filled]


def excerpts(keyed: DataFrame, lost: DataFrame) -> DataFrame:
    """(conv_id, turn, level, origin): earlier turns that say all units of a passage ``lost(conv_id, turn, level, units)``.

    Candidates come from the unit that the fewest messages of the conversation say.
    """
    key = ["conv_id", "turn", "level", "unit_set"]
    sets = lost.select("conv_id", "turn", "level", F.explode("units").alias("units")).where(F.size("units") > 0)
    sets = sets.withColumn("unit_set", F.sha2(F.concat_ws(" ", "units"), 256)).distinct()
    units = written(sets.select(*key, F.size("units").alias("n"), F.explode("units").alias("hash")), "units")
    own = F.transform(_own(F.col("_parts")), lambda x: F.concat(*_units(x)))
    said = keyed.select("conv_id", F.col("turn").alias("origin"), F.explode(F.array_distinct(F.flatten(own))).alias("hash"))
    wanted = units.select("conv_id", "hash").distinct()
    origins = written(said.join(wanted, ["conv_id", "hash"], "left_semi").distinct(), "unit_origins")
    known = origins.groupBy("conv_id", "hash").agg(F.count(F.lit(1)).alias("_messages"))
    rarest = (
        units.join(known, ["conv_id", "hash"])
        .groupBy(*key, "n")
        .agg(F.min(F.struct("_messages", "hash")).alias("_least"), F.count(F.lit(1)).alias("_known"))
        .where("_known = n")
        .select(*key, F.col("_least.hash").alias("hash"))
    )
    candidates = rarest.join(origins, ["conv_id", "hash"]).where("origin < turn").drop("hash")
    return (
        candidates.join(units, key)
        .join(origins, ["conv_id", "origin", "hash"])
        .groupBy(*key, "origin", "n")
        .agg(F.count(F.lit(1)).alias("_said"))
        .where("_said = n")
        .select("conv_id", "turn", "level", "origin")
    )


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, quote_level): the latest earlier turn that a message quotes.

    The outermost level with a known origin counts: a quote within a quote only
    where the message around it is not found.
    """
    keyed = messages.where("conv_id is not null and turn is not null")
    said = keyed.select(
        "conv_id",
        F.col("turn").alias("origin"),
        F.explode(
            F.array_distinct(
                F.transform(
                    F.concat(
                        F.array(F.array_join(_own(F.col("_parts")), "\n")),
                        _own(F.col("_parts")),
                        F.flatten(F.transform(_own(F.col("_parts")), lambda x: F.split(x, "\\n[ \\t-\\r]*\\n"))),
                        F.flatten(F.transform(_own(F.col("_parts")), lambda x: F.split(x, "\n"))),
                    ),
                    lambda x: F.sha2(_normal(x), 256),
                )
            )
        ).alias("hash"),
    )
    quoted = keyed.select("conv_id", "turn", F.explode(F.filter("_parts", lambda x: x["level"] > 0)).alias("_part")).select(
        "conv_id",
        "turn",
        F.col("_part.level").alias("level"),
        F.sha2(_normal(F.col("_part.text")), 256).alias("hash"),
        (_normal(F.col("_part.text")) == "").alias("_blank"),
        F.array(*_units(F.col("_part.text"))).alias("units"),
    )
    quoted = written(quoted.where("not _blank").drop("_blank").distinct(), "quoted")
    wanted = quoted.select("conv_id", "hash").distinct()
    origins = said.join(wanted, ["conv_id", "hash"], "left_semi").distinct()
    found = quoted.join(origins, ["conv_id", "hash"]).where("origin < turn")
    lost = quoted.join(found.select("conv_id", "turn", "level", "hash"), ["conv_id", "turn", "level", "hash"], "left_anti")
    found = found.select("conv_id", "turn", "level", "origin").unionByName(excerpts(keyed, lost))
    latest = found.groupBy("conv_id", "turn", "level").agg(F.max("origin").alias("origin"))
    best = latest.groupBy("conv_id", "turn").agg(F.min("level").alias("level"))
    return latest.join(best, ["conv_id", "turn", "level"]).select(
        "conv_id", "turn", F.col("origin").alias("reply_to"), F.col("level").alias("quote_level")
    )


def roots(found: DataFrame) -> DataFrame:
    """(conv_id, turn, root): the first message that a chain of replies leads back to, by doubling the steps."""
    now = written(found.select("conv_id", "turn", F.col("reply_to").alias("root")), "roots")
    for _ in range(ROUNDS):
        ahead = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("_next"))
        step = now.join(ahead, ["conv_id", "root"], "left")
        if step.where("_next is not null").isEmpty():
            break
        now = written(step.select("conv_id", "turn", F.coalesce("_next", "root").alias("root")), "roots")
    return now


def conversations(messages: DataFrame) -> DataFrame:
    """Messages in reply order, without quotes, one row each.

    Returns conv_id, turn, role, reply_to, quote_level, thread (the turn that a chain of replies leads back
    to; the own turn without a quote), position (from 1, by thread and turn), body and
    formatted.  A reply always comes after what it replies to, as only earlier turns
    are quoted.  Rows of one conversation and turn are parts of one message: they
    share their link and follow each other by role and text.  Rows without
    ``conv_id`` or ``turn`` are kept, never linked, and have no position.  A null text is empty, a null
    role is ``user``.  An empty table gives no rows; other columns are ignored.
    """
    plain = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    rows = parsed(plain)
    found = written(links(rows), "replies")
    threads = roots(found)
    said = rows.select("conv_id", "turn", "role", body(F.col("_parts")).alias("body"))
    whole = (
        said.join(found, ["conv_id", "turn"], "left")
        .join(threads, ["conv_id", "turn"], "left")
        .withColumn("thread", F.coalesce("root", "turn"))
        .drop("root")
        .withColumn("_role", F.coalesce("role", F.lit("")))
    )
    able = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    order = ["thread", "turn", "_role", "body"]
    counted = running_total(whole.where(able), ["conv_id"], order, F.lit(1), "position")
    counted = counted.unionByName(whole.where(~able).withColumn("position", F.lit(None).cast("long")))
    return counted.select(
        "conv_id",
        "turn",
        "role",
        "reply_to",
        "quote_level",
        "thread",
        "position",
        "body",
        F.concat(
            F.lit("<|im_start|>"), F.coalesce("role", F.lit("user")), F.lit("\n"), F.col("body"), F.lit("<|im_end|>\n")
        ).alias("formatted"),
    )
