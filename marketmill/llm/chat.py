"""Chat formatting: the dialogue once for every participant, with that speaker as the assistant.

Spark functions only. Long dialogues come in parts of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.windows import rank_rows

#: Turns in one rendered part.
PART_TURNS = 256


#: A mark in a text, with the backslashes that tell an escaped one.
MARK = r"<(\\*)\|im_"


def escaped(text: Column) -> Column:
    """A text in which no mark can be read: each gets one more backslash behind its bracket, which can be taken out again."""
    return F.regexp_replace(text, MARK, r"<$1\\|im_")


def _name(role: Column) -> Column:
    return F.translate(escaped(F.coalesce(role, F.lit("unknown"))), "\n", " ")


def _segment(role: Column, text: Column, speaker: Column) -> tuple[Column, Column]:
    """Head and body of a turn as ``speaker`` sees it; the body ends with the closing mark."""
    head = (
        F.when(role == "system", F.lit("<|im_start|>system\n"))
        .when(F.coalesce(role, F.lit("unknown")) == speaker, F.lit("<|im_start|>assistant\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), _name(role), F.lit("\n")))
    )
    return head, F.concat(escaped(F.coalesce(text, F.lit(""))), F.lit("<|im_end|>\n"))


def rotate(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """Rows (conv, speaker, block, part, n_turns, rendered, masks) for every participant of every dialogue.

    ``rendered`` writes the speaker's turns as assistant and all others as users
    with their names; marks in texts and names are escaped, and a line end in a name is a blank. ``masks`` has the code-point spans [start, end) of the speaker's
    own contents with their closing marks, on which a loss is to be taken. A
    system turn stays a system turn and has no perspective of its own; a
    dialogue with system turns alone gives no rows, nor does an empty table. The first system turn of a dialogue opens every other
    part as well, where it does not count as one of the ``n_turns``.

    Turns are ordered by number (null last), then role and text (null first); repeated rows are
    kept. A null role speaks as "unknown", a null text is empty, a null
    dialogue id is a dialogue like any other. A dialogue is cut by turn number
    into blocks, and blocks into parts of ``part_turns`` turns (block and part
    number from 0; turns without a number are block null, and numbered by ranges, which runs a job), so that no dialogue is ever
    gathered in one row or in one task. Other columns are not used.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    speakers = rows.filter(F.coalesce(F.col("role"), F.lit("")) != "system")
    speakers = speakers.select(F.col("conv").alias("c"), F.coalesce("role", F.lit("unknown")).alias("speaker")).distinct()
    first = rows.filter(F.col("role") == "system").groupBy(F.col("conv").alias("s")).agg(
        # null numbers last, null texts first
        F.min(F.struct(F.col("turn").isNull().alias("late"), "turn", F.col("text").isNotNull().alias("said"), "text")).alias("opening")
    )
    speakers = speakers.join(first, F.col("c").eqNullSafe(F.col("s")), "left").drop("s")
    rows = rows.withColumn("block", F.floor(F.col("turn") / part_turns))
    same = Window.partitionBy("conv", "block").orderBy("turn", F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    numbered = rows.filter(F.col("turn").isNotNull()).withColumn("n", F.row_number().over(same).cast("long"))
    loose = rank_rows(rows.filter(F.col("turn").isNull()), [F.asc_nulls_first("role"), F.asc_nulls_first("text")], "n", ["conv"])
    rows = numbered.unionByName(loose.withColumn("n", F.col("n") + 1))
    rows = rows.withColumn("part", F.floor((F.col("n") - 1) / part_turns))
    parts = rows.groupBy("conv", "block", "part").agg(
        F.sort_array(F.collect_list(F.struct("n", "role", "text", "turn"))).alias("turns")
    )
    both = parts.join(speakers, F.col("conv").eqNullSafe(F.col("c")))

    def seen(t: Column) -> Column:
        head, body = _segment(t["role"], t["text"], F.col("speaker"))
        own = (F.coalesce(t["role"], F.lit("unknown")) == F.col("speaker"))
        return F.struct(head.alias("head"), body.alias("body"), own.alias("own"))

    def opens(t: Column) -> Column:
        o = F.col("opening")
        return (t["role"] == "system") & t["turn"].eqNullSafe(o["turn"]) & t["text"].eqNullSafe(o["text"])

    again = F.col("opening").isNotNull() & ~F.exists("turns", lambda t: F.coalesce(opens(t), F.lit(False)))
    head, body = _segment(F.lit("system"), F.col("opening.text"), F.col("speaker"))
    none = F.array().cast("array<struct<head:string,body:string,own:boolean>>")
    opening = F.when(again, F.array(F.struct(head.alias("head"), body.alias("body"), F.lit(False).alias("own")))).otherwise(none)
    both = both.withColumn("seen", F.concat(opening, F.transform("turns", seen)))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.length(s["head"])
        end = start + F.length(s["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        masks = F.when(s["own"], F.concat(acc["masks"], span)).otherwise(acc["masks"])
        return F.struct(end.alias("at"), masks.alias("masks"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.aggregate("seen", F.struct(F.lit(0).alias("at"), none.alias("masks")), step)
    return both.select(
        F.col("conv").alias(conv),
        "speaker",
        "block",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("seen", lambda s: F.concat(s["head"], s["body"])), "").alias("rendered"),
        spans["masks"].alias("masks"),
    )
