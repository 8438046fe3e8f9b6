"""Chat formatting by prefix-target expansion, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: A control string is one of these characters, then one of the tails; the escape puts a backslash between.
#: Covers this template's marks, <|...|> marks in general, <s>, </s>, [INST], [/INST], <<SYS>> and <</SYS>>.
_HEAD = r"(<|\[)"
_TAIL = r"(/?s>|/?SYS>|/?INST\]|\|)"


def escape(text: Column) -> Column:
    """Make control strings in a text plain; `unescape` gives back the text exactly."""
    return F.regexp_replace(text, _HEAD + r"(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"\\(\\*)" + _TAIL, "$1$2$3")


def _role(role: Column) -> Column:
    """A role on one line: a backslash or line feed in it is written as two characters."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def _role_back(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def format_chats(turns: DataFrame, target: str = "assistant") -> DataFrame:
    """Training examples of conversations: conv_id, example, formatted, loss_start, loss_chars, last.

    `turns` has conv_id, turn, role, text. Each `target` turn gives one example: all turns up to it, formatted,
    with only that turn's text under the loss, as an offset and length in characters of `formatted`. What
    follows the last target turn, or a conversation without one, is kept as a last example without a loss
    (loss_chars null). Turns stand in the order of `turn`, then role, then text; nulls are first. Null roles
    and texts count as empty; rows with a null conv_id form one conversation; repeated rows are turns of their
    own. Other columns are ignored; an empty table gives an empty result.

    A conversation is formatted once, in one row; as a context is a prefix of it, an example is a substring.
    """
    ready = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select(
        "*",
        F.concat(F.lit(OPEN), _role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = ready.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        F.concat("head", "body", F.lit(CLOSE)).alias("marked"),
        F.sum(F.length("head") + F.length("body") + len(CLOSE)).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.length("body").alias("chars"),
        (F.col("role") == target).alias("trained"),
        (F.lead("role").over(order).isNull()).alias("last"),
    )
    own = F.struct("n", "marked", "upto", "chars", "trained", "last")
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(own)).alias("t"))
    ends = F.filter("t", lambda t: t["trained"] | t["last"])
    cut = F.transform(ends, lambda t: t.dropFields("marked"))
    return (
        whole.select("conv_id", F.array_join(F.transform("t", lambda t: t["marked"]), "").alias("whole"), cut.alias("ends"))
        .select("conv_id", "whole", F.posexplode("ends").alias("example", "end"))
        .select(
            "conv_id",
            F.col("example").cast("long").alias("example"),
            F.expr("substring(whole, 1, end.upto)").alias("formatted"),
            F.when(F.col("end.trained"), F.col("end.upto") - len(CLOSE) - F.col("end.chars")).alias("loss_start"),
            F.when(F.col("end.trained"), F.col("end.chars").cast("long")).alias("loss_chars"),
            F.col("end.last").alias("last"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted text."""
    parts = F.split(formatted, r"<\|turn\|>", -1)
    return F.transform(
        F.filter(parts, lambda p, number: number > 0),
        lambda p: F.struct(
            _role_back(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(
                F.substr(
                    p,
                    F.length(F.substring_index(p, "\n", 1)) + 2,
                    F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(CLOSE),
                )
            ).alias("text"),
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """What a conversation's examples hold, read back from the formatted texts, in one row each."""
    turns = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = unescape(F.expr("substring(formatted, int(loss_start) + 1, int(loss_chars))"))
    back = examples.select(
        "conv_id",
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("loss_chars").isNotNull(), F.struct("example", loss.alias("text"))).alias("loss"),
        F.when(F.col("last"), turns).alias("turns"),
    ).select("conv_id", "chars", "loss", F.size("turns").cast("long").alias("n"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "")
    return (
        back.groupBy("conv_id")
        .agg(
            F.max("n").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            text.alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
