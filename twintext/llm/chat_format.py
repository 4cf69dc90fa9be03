"""Chat rendering from every participant's point of view.

A dialogue of several speakers gives one training text per participant: that
speaker's turns are the assistant's and are trained on, all others are users
with their names, system turns stay system turns. Masks are the character spans
of the assistant's words with their closing mark. Built-in expressions only.

Dialogues have no bound, so texts are cut into parts: ``turns`` consecutive turn
numbers each. A turn number that more than ``crowd`` rows share has parts of its
own, dealt out by a hash. Parts in the order ``(block, turn, lane)``, nulls
first, give the whole dialogue.

Rows equal in all four columns are one turn if they have a conversation id and a
turn number; without one of them nothing says so, and each is a turn of its own.
Marks inside what is said are escaped, so a turn cannot pose as another: each
``<|`` gets a backslash between its two characters, behind those it may have
already, which taking one away undoes. In names, backslashes are doubled and line
breaks written as ``\\n`` and ``\\r`` before that. All other text stays as it is.

A dialogue gives one rendering per participant: the output is turns times
participants, which is the feature.

Rows without a conversation id are one dialogue, rows without a turn number come first, a null text is empty, and a
turn without a role is said by a user without a name, who is no participant. A
dialogue without participants has no rows; an empty table gives none. Texts are
rendered whole. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import Scratch

SYSTEM = "system"
_OPEN, _CLOSE = "<|im_start|>", "<|im_end|>\n"


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def _name(role: Column) -> Column:
    plain = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    plain = F.replace(F.replace(plain, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return _escaped(plain)


def _header(role: Column, speaker: Column) -> Column:
    named = F.when(role.isNull(), F.lit("user")).otherwise(F.concat(F.lit("user name="), _name(role)))
    kind = F.when(role == speaker, "assistant").when(role == SYSTEM, SYSTEM).otherwise(named)
    return F.concat(F.lit(_OPEN), kind, F.lit("\n"))


def segments(turns: DataFrame, turns_per_part: int = 32, crowd: int = 64) -> DataFrame:
    """Every turn from every point of view: one row per turn and participant.

    ``(conv_id, speaker, block, crowded_turn, lane, turn, role, text, header, trained)``,
    ``text`` with marks escaped.
    """
    scratch = Scratch(turns.sparkSession, "chat-format")
    counted = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("__times"))
    times = F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.col("__times")).otherwise(F.lit(1))
    copies = F.sequence(F.lit(1).cast("long"), times.cast("long"))
    rows = scratch.write(counted.select("conv_id", "turn", "role", "text", F.explode(copies).alias("__copy")), "turns")
    speakers = rows.where(F.col("role") != SYSTEM).select(
        F.col("conv_id").alias("__conv"), F.col("role").alias("speaker")
    )
    speakers = scratch.write(speakers.distinct(), "speakers")
    crowds = rows.groupBy(F.col("conv_id").alias("__at"), F.col("turn").alias("__turn")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    crowds = scratch.write(crowds.where(F.col("__n") > crowd), "crowds")
    lanes = F.ceil(F.col("__n") / crowd).cast("int")
    hashed = F.when(F.col("__copy") == 1, F.xxhash64("role", "text")).otherwise(F.xxhash64("role", "text", "__copy"))
    placed = rows.join(
        crowds, F.col("conv_id").eqNullSafe(F.col("__at")) & F.col("turn").eqNullSafe(F.col("__turn")), "left"
    ).select(
        "conv_id",
        "turn",
        "role",
        _escaped(F.coalesce("text", F.lit(""))).alias("text"),
        F.floor(F.col("turn") / turns_per_part).cast("long").alias("block"),
        F.when(F.col("__n").isNotNull(), F.col("turn")).alias("crowded_turn"),
        F.coalesce(F.pmod(hashed, lanes).cast("int"), F.lit(0)).alias("lane"),
    )
    seen = placed.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv")))
    return seen.select(
        *placed.columns,
        "speaker",
        _header(F.col("role"), F.col("speaker")).alias("header"),
        F.coalesce(F.col("role") == F.col("speaker"), F.lit(False)).alias("trained"),
    )


def perspectives(turns: DataFrame, turns_per_part: int = 32, crowd: int = 64) -> DataFrame:
    """``(conv_id, speaker, block, crowded_turn, lane, n_turns, text, trained)``: one row per part.

    ``trained`` holds the spans ``(start, end)``, in characters from 0, to train on.
    """
    turn = F.struct("turn", "role", "text", "header", "trained")
    parts = (
        segments(turns, turns_per_part, crowd)
        .groupBy("conv_id", "speaker", "block", "crowded_turn", "lane")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )

    def rendered(t: Column) -> Column:
        return F.concat(t["header"], t["text"], F.lit(_CLOSE))

    def spans(all_turns: Column) -> Column:
        nothing = F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
        )

        def add(acc: Column, t: Column) -> Column:
            start = acc["at"] + F.char_length(t["header"])
            end = acc["at"] + F.char_length(rendered(t))
            span = F.array(F.struct(start.alias("start"), end.alias("end")))
            return F.struct(
                end.alias("at"), F.when(t["trained"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
            )

        return F.aggregate(all_turns, nothing, add, lambda acc: acc["spans"])

    return parts.select(
        "conv_id",
        "speaker",
        "block",
        "crowded_turn",
        "lane",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", rendered), "").alias("text"),
        spans(F.col("turns")).alias("trained"),
    )


def flat(turns: DataFrame) -> DataFrame:
    """:func:`perspectives` with the spans as text: ``start-end start-end ...``."""
    shown = F.transform("trained", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return perspectives(turns).withColumn("trained", F.array_join(shown, " "))
