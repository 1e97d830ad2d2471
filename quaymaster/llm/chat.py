"""Chat template by relational operations: sorted turn structs, merged by role, joined to text.

A conversation becomes blocks ``<|im_start|>role\\n ... <|im_end|>\\n``. Adjacent turns of one
role share a block, in which ``<|im_sep|>`` parts their texts, so nothing is lost by merging.
Texts and roles are escaped: a ``<`` that is followed by any number of backslashes and a bar
gets one more backslash, so ``<|`` occurs in marks only; a role also writes backslash and
newline as two characters. Both are undone exactly when reading back.

Null texts and roles are empty. Turns sort by (turn, role, text), nulls first; repeated rows are
turns of their own. A null conversation id is an id like any other. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Marks of the template.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    lined = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(lined)


def unescape_role(role: Column) -> Column:
    """Backslash pairs are parted first, so that a newline mark is not seen across two of them."""
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``segments``: the formatted text in pieces with their loss flag.

    Joined, the segments are the formatted text; the texts of the trained role are under the loss.
    """
    rows = turns.select(
        "conv_id", F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def pieces(turn: Column, i: Column) -> Column:
        first = i == 0
        before = F.get(F.col("turns"), i - 1)["role"]
        opened = F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"))
        lead = (
            F.when(first, opened)
            .when(before == turn["role"], F.lit(SEPARATOR))
            .otherwise(F.concat(F.lit(END + "\n"), opened))
        )
        return F.array(
            F.struct(lead.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == TRAINED_ROLE).alias("loss")),
        )

    closing = F.array(F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("turns", pieces)), closing)
    return gathered.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, as they were before merging and escaping."""
    blocks = F.split(formatted, r"<\|im_end\|>\n", -1)
    whole = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        opened = F.substring(block, len(START) + 1, 2**31 - 1)
        role = F.substring_index(opened, "\n", 1)
        body = opened.substr(F.length(role) + 2, F.length(opened))
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(whole, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
