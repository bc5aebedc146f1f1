"""Chat formatting with a declarative template, in DataFrame functions alone.

``format_chat`` orders a conversation's rows by turn, runs the template's finite-state machine over the roles and
emits text segments: an opening mark, the body and a closing mark for each turn, each with a loss flag. Control
strings in a text get one backslash more between ``<`` and the word, whatever number is there already; reading takes
one away, so the text comes back as it was. ``read_chat`` works on the formatted text and the segments alone.

Defined cases: a null text or role is empty. Turns of equal number are ordered by role and text, null turns come
first. Rows with a null conversation id form one conversation. Repeated rows are repeated turns. A conversation
whose roles break the turn order is formatted all the same, with ``valid`` false and ``bad_turn`` the position of
the first wrong role (the number of turns if it merely ends too early). Very long texts are formatted whole. Extra
columns are ignored; an empty table gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``next`` names the roles that may follow a state (a state is the role read last; ``-`` is the state after an error); ``last`` the states to end in.
TEMPLATE = {
    "mark": "turn",
    "loss": ["assistant"],
    "next": {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "last": ["assistant"],
}


def _escaped(text: Column, mark: str) -> Column:
    return F.regexp_replace(text, rf"<(\\*)(/?{mark})", r"<\\$1$2")


def _unescaped(text: Column, mark: str) -> Column:
    return F.regexp_replace(text, rf"<\\(\\*)(/?{mark})", "<$1$2")


def _role_out(role: Column) -> Column:
    """A role inside its mark: backslash, ``>`` and line feed are written as two characters."""
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def _role_in(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\", -1), lambda x: F.replace(F.replace(x, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def format_chat(rows: DataFrame, template: dict = TEMPLATE, key: str = "conv_id") -> DataFrame:
    """``key, turn, role, text`` -> ``key, segments array<struct<role, kind, text, loss>>, formatted, valid, bad_turn``."""
    mark = template["mark"]
    none = F.lit("")
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), none).alias("role"), F.coalesce(F.col("text").cast("string"), none).alias("text"))
    talks = rows.groupBy(F.col(key).alias(key)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    may = F.create_map(*[F.lit(x) for state, roles in template["next"].items() for role in roles for x in (f"{state}>{role}", role)])
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["role"].alias("role"), F.lit("open").alias("kind"), F.concat(F.lit(f"<{mark}:"), _role_out(t["role"]), F.lit(">\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(t["role"].alias("role"), F.lit("body").alias("kind"), _escaped(t["text"], mark).alias("text"), t["role"].isin(template["loss"]).alias("loss")),
                F.struct(t["role"].alias("role"), F.lit("close").alias("kind"), F.lit(f"\n</{mark}>\n").alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    def step(acc: Column, t: Column) -> Column:
        after = F.coalesce(F.try_element_at(may, F.concat(acc["state"], F.lit(">"), t["role"])), F.lit("-"))
        return F.struct(after.alias("state"), F.when(after != "-", acc["good"] + 1).otherwise(acc["good"]).alias("good"))

    machine = F.aggregate("turns", F.struct(F.lit("start").alias("state"), F.lit(0).alias("good")), step)
    out = talks.select(key, segments.alias("segments"), machine.alias("end"))
    valid = F.col("end.state").isin(template["last"])
    return out.select(
        key,
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        valid.alias("valid"),
        F.when(~valid, F.col("end.good")).alias("bad_turn"),
    )


def read_chat(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Adds ``turns array<struct<role, text>>`` (from ``formatted``) and ``loss_text`` (from the loss mask over ``segments``)."""
    mark = template["mark"]
    pieces = F.split("formatted", rf"\n</{mark}>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def parsed(piece: Column) -> Column:
        parts = F.split(piece, ">\n", 2)
        return F.struct(_role_in(F.substring(parts[0], len(mark) + 3, 1 << 30)).alias("role"), _unescaped(parts[1], mark).alias("text"))

    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: _unescaped(s["text"], mark))
    return formatted.withColumn("turns", F.transform(pieces, parsed)).withColumn("loss_text", F.array_join(under, ""))
