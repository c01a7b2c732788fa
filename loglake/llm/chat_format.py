"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the prompt, and only
that reply is trainable. Built-in expressions only.

A turn is written ``<|role|>`` newline text newline ``</s>`` newline. Control strings inside a text
get a backslash in front; backslashes that already stand there are doubled, so the original comes
back exactly. A role is percent-encoded. Since a text's control strings always follow a backslash
and the template's own follow a newline, the two cannot be confused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import text_or_empty

#: The strings that common chat templates give a meaning to, as a pattern.
CONTROL = r"</?s>|\[/?INST\]|<</?SYS>>|<\|"
TURN_END = "\n</s>\n"


def escape(text: Column) -> Column:
    """Put a backslash before each control string, doubling those before it."""
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"$1$1\\$2")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, rf"(\\*)\1\\({CONTROL})", "$1$2")


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.url_encode(role), F.lit("|>\n"))


def format_chat(conversations: DataFrame) -> DataFrame:
    """Examples of all conversations: ``conv_id, example, text, loss_start, loss_chars, trained``.

    ``text[loss_start : loss_start + loss_chars]`` (code points) is the trainable reply, escaped.
    Turns that follow the last reply, or a conversation without one, make a last example with
    ``trained`` false and an empty loss span, so that no turn is lost.

    Rows are ordered by ``turn``, nulls first; equal turns by role, then text; repeated rows stay.
    A null role or text counts as empty; rows with a null ``conv_id`` form one conversation. Other
    columns are ignored; an empty table gives no examples. A conversation is one row while it is
    formatted, as its digest and its longest example need all of it.
    """
    turns = (
        conversations.select(
            "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), text_or_empty().alias("text"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    bodies = turns.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(
            t["role"].alias("role"), header(t["role"]).alias("head"), escape(t["text"]).alias("body"))).alias("turns"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (F.element_at("turns", i)["role"] == "assistant") | (i == F.size("turns")))
    placed = bodies.select("conv_id", "turns", F.posexplode(ends).alias("example", "end"))
    last = F.element_at("turns", F.col("end"))
    context = F.array_join(
        F.transform(F.slice("turns", 1, F.col("end") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))), "")
    parts = placed.select(
        "conv_id", "example", (last["role"] == "assistant").alias("trained"),
        F.concat(context, last["head"]).alias("prompt"), last["body"].alias("body"))
    return parts.select(
        "conv_id", "example",
        F.concat("prompt", "body", F.lit(TURN_END)).alias("text"),
        F.length("prompt").cast("long").alias("loss_start"),
        F.when(F.col("trained"), F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
        "trained",
    )


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text: ``array<struct<role, text>>``."""
    pieces = F.split(text, TURN_END, -1)

    def turn(piece: Column) -> Column:
        role = F.regexp_extract(piece, r"^<\|([^|]*)\|>\n", 1)
        return F.struct(
            F.url_decode(role).alias("role"),
            unescape(F.substring(piece, F.length(role) + 6, F.length(piece))).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def read_back(examples: DataFrame) -> DataFrame:
    """What each conversation's examples hold: all turns from its longest, all replies from their spans."""
    loss = unescape(F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    whole = (
        examples.select("conv_id", "example", "text", loss.alias("loss"))
        .groupBy("conv_id")
        .agg(
            F.max(F.struct("example", "text"))["text"].alias("longest"),
            F.array_join(F.transform(
                F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda e: e["loss"]), "").alias("loss"),
            F.sum(F.length("text")).alias("formatted_chars"),
        )
        .select("conv_id", parse_turns(F.col("longest")).alias("turns"), "loss", "formatted_chars")
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
