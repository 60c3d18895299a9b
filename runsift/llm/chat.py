"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its reply is trainable. A
conversation that ends with another turn, or has no assistant turn, gets one more example without a target, so that no
turn is lost. Turns are marked `### role`, a line break, the text and `</turn>`; both marks and the escape character are
escaped in roles and texts, and reading back undoes it exactly. Only DataFrame functions are used.

Defined cases: a null text or role is empty; a null conversation id is a conversation of its own; turns go by number
(null first), then role, then text, so repeated rows and equal numbers have one order; empty tables give no example;
other columns of the input are not read. A conversation's turns form one row, and an example holds its whole context:
both are bounded by the longest conversation, which is what a training example must hold anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_MARK = "### "
TURN_END = "</turn>\n"
TARGET_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """No turn mark is left, and every inserted or given backslash is followed by the character it protects."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("</"), F.lit("<\\/"))
    return F.replace(out, F.lit("##"), F.lit("#\\#"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    """A role stays on its line: its line breaks become a backslash and the letter n, a backslash n two of them."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    """Between pairs of backslashes, a backslash and n is a line break; the other escapes go as in texts."""
    parts = F.split(role, r"\\\\")
    plain = F.transform(parts, lambda p: F.regexp_replace(F.replace(p, F.lit("\\n"), F.lit("\n")), r"\\(.)", "$1"))
    return F.array_join(plain, "\\")


def turns_by_conversation(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of a conversation in order."""
    empty = F.lit("")
    rows = turns.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def examples(turns: DataFrame, target_role: str = TARGET_ROLE) -> DataFrame:
    """(conv_id, n_turns, text, loss_start, loss_end): one row per target turn, loss span in code points of text.

    `n_turns` counts the turns in the example. A closing example without a target has an empty span at its end.
    """
    shown = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(TURN_MARK), _escaped_role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == target_role).alias("target"),
        ),
    )
    rows = turns_by_conversation(turns).select("conv_id", shown.alias("shown"))
    last = F.size("shown")
    ends = F.filter(
        F.sequence(F.lit(1), last), lambda i: F.element_at("shown", i)["target"] | (i == last)
    )
    rows = rows.select("conv_id", "shown", F.explode(ends).alias("n_turns"))
    own = F.element_at("shown", F.col("n_turns"))
    context = F.array_join(
        F.transform(
            F.slice("shown", F.lit(1), F.col("n_turns") - 1), lambda s: F.concat(s["head"], s["body"], F.lit(TURN_END))
        ),
        "",
    )
    rows = rows.select("conv_id", "n_turns", context.alias("context"), own.alias("own"))
    whole = F.concat("context", "own.head", "own.body", F.lit(TURN_END))
    body_start = F.length("context") + F.length("own.head")
    body_end = body_start + F.length("own.body")
    target = F.col("own.target")
    return rows.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        whole.alias("text"),
        F.when(target, body_start).otherwise(F.length(whole)).alias("loss_start"),
        F.when(target, body_end).otherwise(F.length(whole)).alias("loss_end"),
    )


def parsed_turns(text: Column) -> Column:
    """The turns of a formatted text, read back: array of (role, text)."""
    pieces = F.split(text, TURN_END)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        role = F.substring(piece, F.lit(len(TURN_MARK) + 1), cut - len(TURN_MARK) - 1)
        body = F.substring(piece, cut + 1, F.length(piece))
        return F.struct(_unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars): conversations as the examples hold them.

    The longest example holds every turn; the loss spans of all examples, in order, hold each target once.
    """
    loss = F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    rows = formatted.select(
        "conv_id", "text", "n_turns", F.struct("n_turns", unescaped(loss).alias("loss")).alias("span")
    )
    whole = rows.groupBy("conv_id").agg(
        F.max_by("text", "n_turns").alias("text"),
        F.sort_array(F.collect_list("span")).alias("spans"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        parsed_turns(F.col("text")).alias("turns"),
        F.array_join(F.col("spans.loss"), "").alias("loss_text"),
        "formatted_chars",
    )
