"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them
in order into one text. Text parts are escaped; any other part becomes its placeholder and is
recorded as an attachment with its reference, its place and the tokens it expands to. Turns
are marked by control strings, and a loss mask tells which characters a model should learn.

Escaping is reversible: a backslash goes between ``<`` and ``|`` (``<|`` becomes ``<\\|``,
``<\\|`` becomes ``<\\\\|`` and so on), so no control string can occur inside a text. Roles are
escaped alike, and a line break in a role becomes ``</``.

Cases: null text, role and part list count as empty; a null type is text. A part of unknown
type is an attachment of 0 tokens. Turns go by number, null first; equal numbers by role, then
content; repeated rows are turns of their own. A null conversation id is one conversation. An
empty table gives an empty result; other columns are ignored. A conversation is one cell of
the result, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER_PLACEHOLDER = "<|attachment|>"
# Tokens of one unit: an image tile, a second of sound, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "<(\\\\*)\\|", "<\\\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "<\\\\(\\\\*)\\|", "<$1|")


def escape_role(role: Column) -> Column:
    marked = F.regexp_replace(role, "<(\\\\*)([|/])", "<\\\\$1$2")
    return F.replace(marked, F.lit("\n"), F.lit("</"))


def unescape_role(role: Column) -> Column:
    marked = F.replace(role, F.lit("</"), F.lit("\n"))
    return F.regexp_replace(marked, "<\\\\(\\\\*)([|/])", "<$1$2")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("long").alias("units"),
    )
    return F.array(part).cast(f"array<{PART}>")


def _kind(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text"))


def visit(part: Column) -> Column:
    """What a part contributes to the text of its turn."""
    placeholder = F.lit(OTHER_PLACEHOLDER)
    for kind, mark in PLACEHOLDERS.items():
        placeholder = F.when(_kind(part) == kind, F.lit(mark)).otherwise(placeholder)
    text = escape(F.coalesce(part["text"], F.lit("")))
    return F.when(_kind(part) == "text", text).otherwise(placeholder)


def part_tokens(part: Column) -> Column:
    """Tokens that a placeholder expands to."""
    rate = F.lit(0)
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(_kind(part) == kind, F.lit(tokens)).otherwise(rate)
    return (rate * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))).cast("long")


def format_conversations(
    turns: DataFrame,
    learned_role: str = "assistant",
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
) -> DataFrame:
    """One row per conversation: id, formatted, loss_spans, attachments, expanded_tokens.

    ``loss_spans``: first character (from 1) and length of each text of the learned role.
    ``attachments``: ordinal, turn, type, ref, tokens, in the order of the placeholders.
    """
    content = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    rows = turns.select(
        F.col(conversation).alias("_conv"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"), content.alias("_parts"),
    )
    body = F.array_join(F.transform("_parts", visit), "")
    rows = rows.withColumn("_body", body).withColumn(
        "_head", F.concat(F.lit(START), escape_role(F.col("_role")), F.lit("\n"))
    )
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit(END + "\n")))
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_body", "_parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0)) + F.length("_head") + 1
    placed = rows.withColumn("_at", F.row_number().over(order)).withColumn("_first", first)
    attached = F.transform(
        F.filter("_parts", lambda p: _kind(p) != "text"),
        lambda p: F.struct(
            F.col("_turn").alias("turn"), _kind(p).alias("type"), p["ref"].alias("ref"),
            part_tokens(p).alias("tokens"),
        ),
    )
    turn_row = F.struct(
        F.col("_at").alias("at"), F.col("_piece").alias("piece"), attached.alias("attached"),
        F.when(
            F.col("_role") == learned_role,
            F.struct(F.col("_first").alias("first"), F.length("_body").alias("length")),
        ).alias("loss"),
    )
    whole = placed.groupBy("_conv").agg(F.sort_array(F.collect_list(turn_row)).alias("_turns"))
    flat = F.flatten(F.transform("_turns", lambda t: t["attached"]))
    numbered = F.transform(flat, lambda a, i: F.struct(
        (i + 1).alias("ordinal"), a["turn"].alias("turn"), a["type"].alias("type"),
        a["ref"].alias("ref"), a["tokens"].alias("tokens"),
    ))
    spans = F.filter(F.transform("_turns", lambda t: t["loss"]), lambda s: s.isNotNull())
    return whole.select(
        F.col("_conv").alias(conversation),
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"), numbered.alias("attachments"),
        F.aggregate(flat, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias(
            "expanded_tokens"
        ),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted text: array of role and text, unescaped; placeholders stay."""
    marked = F.split(formatted, "\\Q" + START + "\\E")
    # What stands before the first mark is empty.
    pieces = F.slice(marked, F.lit(2), F.greatest(F.size(marked) - 1, F.lit(0)))

    def read(piece: Column) -> Column:
        line = F.locate("\n", piece)
        text = F.substring(piece, line + 1, F.length(piece) - line - len(END + "\n"))
        return F.struct(
            unescape_role(F.substring(piece, F.lit(1), line - 1)).alias("role"),
            unescape(text).alias("text"),
        )

    return F.transform(pieces, read)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["first"], s["length"]))), ""
    )
