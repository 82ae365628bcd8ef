"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only that reply is trainable. Turns after the last reply form one
closing example without a trainable part, so that nothing of a conversation is
lost. All of it is DataFrame functions.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a
backslash becomes ``\\b``, ``<|`` becomes ``<\\p``, and in roles a line end becomes
``\\n``; so control strings of a text can't be taken for the template's.

Defined cases: null roles and texts count as empty; rows are ordered by turn (null
first), then role and text, repeated rows are turns of their own; a null
conversation id is a conversation; other columns are ignored; an empty table gives
no rows. A conversation's turns are held in one row, as its examples must be: an
example holds all turns before its reply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("<\\p"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def expand(turns: DataFrame) -> DataFrame:
    """One row per example: ``conv_id``, ``example``, ``formatted``, ``loss_start``, ``loss_length``.

    Examples are numbered from 0. The trainable part begins at the 0-based code
    point ``loss_start`` of ``formatted``; the closing example has length null.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), _escaped_role(role), F.lit("\n"))
    body = escape(text)
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            role.alias("role"),
            text.alias("text"),
            F.concat(head, body, F.lit(END)).alias("written"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    last = F.size("ts") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: (F.get("ts", i)["role"] == ASSISTANT) | (i == last))
    each = grouped.select("conv_id", "ts", F.posexplode(targets).alias("example", "at"))
    is_reply = F.get("ts", F.col("at"))["role"] == ASSISTANT
    before = F.array_join(F.slice("ts.written", 1, F.col("at")), "")
    return each.select(
        "conv_id",
        "example",
        before.alias("_before"),
        F.get("ts", F.col("at")).alias("_t"),
        is_reply.alias("_reply"),
    ).select(
        "conv_id",
        "example",
        F.concat("_before", "_t.written").alias("formatted"),
        F.when(F.col("_reply"), F.length("_before") + F.col("_t.head")).alias("loss_start"),
        F.when(F.col("_reply"), F.col("_t.body")).alias("loss_length"),
    )


def trainable(example: Column, start: Column, length: Column) -> Column:
    """Reply of an example, as it was before it was escaped."""
    return unescape(F.substring(example, start + 1, length))


def turns_of(formatted: Column) -> Column:
    """Turns of an example, read back: an array of (role, text)."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    written = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, len(START) + 1, F.length(p)))
    return F.transform(
        written,
        lambda p: F.struct(
            unescape(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digest per conversation of what its examples hold."""
    loss = F.when(F.col("loss_length").isNotNull(), trainable(F.col("formatted"), F.col("loss_start"), F.col("loss_length")))
    per = examples.select("conv_id", "example", "formatted", loss.alias("loss"))
    replies = F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))))
    whole = per.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"),
        F.array_join(replies["loss"], "").alias("loss"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    turns = whole.select("*", turns_of(F.col("last")).alias("ts"))
    said = F.transform("ts", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id",
        F.size("ts").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
