"""Chats to training text: typed content parts, escaped control strings, and a loss mask.

A message is a list of parts (kind, text, uri, tokens). Text goes in as it is; images, audio and documents become
placeholders numbered through the conversation, with a record of what they refer to and how many
tokens they expand to. A part of another kind counts as text.

A turn is written as <|im_start|>role, line end, body, <|im_end|>, line end. In texts and roles a `<`
that comes before a `|`, with any number of backslashes between, gets one backslash more; so no text can hold a
control string, and taking one away gives back the text. Line ends and backslashes in a role are
escaped before that.

Only DataFrame functions are used. A conversation is one text, so its turns meet in one task; nothing
else does. Turns are ordered by turn, equal ones by role and text; a null turn comes first. Null
texts and roles are empty; a null conv_id is a conversation of its own. Repeated rows are turns like
any other. An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
#: Tokens that an attachment expands to where its part doesn't say.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}
PARTS = "array<struct<kind: string, text: string, uri: string, tokens: int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # A pair of backslashes is kept apart while line ends are put back.
    plain = unescape(role)
    pieces = F.split(plain, r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda piece: F.replace(piece, F.lit("\\n"), F.lit("\n"))), "\\")


def text_parts(text: str = "text") -> Column:
    """A message of one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.col(text).alias("text"),
            F.lit(None).cast("string").alias("uri"),
            F.lit(None).cast("int").alias("tokens"),
        )
    )


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*EXPANDED), F.lit(False))


def _expanded(part: Column) -> Column:
    usual = F.coalesce(*[F.when(part["kind"] == kind, F.lit(n)) for kind, n in EXPANDED.items()])
    return F.coalesce(part["tokens"], usual)


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation, from rows of conv_id, turn, role and parts.

    formatted; turns: start and end of each body in characters of it, whether loss is taken there;
    attachments: number, kind, uri, tokens, in order; n_tokens_expanded: their sum.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = F.coalesce(F.col("parts").cast(PARTS), F.array().cast(PARTS))
    rows = messages.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.filter(parts, lambda part: part.isNotNull()).alias("parts"),
    )
    rows = rows.withColumn("raw", F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], p["uri"], F.lit(""))), ""))
    attached = F.filter("parts", _is_attachment)
    rows = rows.withColumn("before", F.sum(F.size(attached)).over(upto) - F.size(attached))

    def visited(part: Column, at: Column) -> Column:
        number = F.col("before") + F.size(F.filter(F.slice("parts", 1, at), _is_attachment)) + 1
        placeholder = F.concat(F.lit("<|"), part["kind"], F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.when(_is_attachment(part), placeholder).otherwise(escape(F.coalesce(part["text"], F.lit(""))))

    def recorded(part: Column, at: Column) -> Column:
        return F.struct(
            (F.col("before") + at + 1).alias("number"),
            part["kind"].alias("kind"),
            part["uri"].alias("uri"),
            _expanded(part).alias("tokens"),
        )

    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        "raw",
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("parts", visited), "").alias("body"),
        F.transform(attached, recorded).alias("attachments"),
    )
    size = F.length("head") + F.length("body") + len(END)
    rows = rows.withColumn("end", F.sum(size).over(upto)).select(
        "conv_id",
        "end",
        F.concat("head", "body", F.lit(END)).alias("segment"),
        (F.col("end") - len(END) - F.length("body")).alias("body_start"),
        (F.col("end") - len(END)).alias("body_end"),
        (F.col("role") == ASSISTANT).alias("loss"),
        "attachments",
    )
    in_order = F.sort_array(F.collect_list(F.struct("end", "segment", "body_start", "body_end", "loss", "attachments")))
    chats = rows.groupBy("conv_id").agg(in_order.alias("rows"))
    attachments = F.flatten(F.transform("rows", lambda row: row["attachments"]))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda row: row["segment"]), "").alias("formatted"),
        F.transform(
            "rows",
            lambda row: F.struct(
                row["body_start"].alias("start"), row["body_end"].alias("end"), row["loss"].alias("loss")
            ),
        ).alias("turns"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("n_tokens_expanded"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, at (place of the turn, from 0), role, body, loss_text: the turns as `formatted` has them.

    loss_text is what lies under the mask, unescaped; null outside it.
    """
    segments = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.size("turns"))
    cut = chats.select("conv_id", F.posexplode(F.arrays_zip(segments.alias("segment"), "turns")).alias("at", "row"))
    cut = cut.select("conv_id", "at", F.col("row.segment").alias("segment"), F.col("row.turns").alias("mask"))
    upto = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("segment") + len(START)
    # Where the segment begins in `formatted`, behind its control string.
    cut = cut.withColumn("begin", F.sum(size).over(upto) - F.length("segment"))
    body = F.expr(f"substring(segment, instr(segment, '\\n') + 1, length(segment) - instr(segment, '\\n') - {len(END)})")
    under = F.expr("substring(segment, CAST(mask.start - begin + 1 AS INT), CAST(mask.end - mask.start AS INT))")
    return cut.select(
        "conv_id",
        "at",
        unescape_role(F.substring_index("segment", "\n", 1)).alias("role"),
        unescape(body).alias("body"),
        F.when(F.col("mask.loss"), unescape(under)).alias("loss_text"),
    )


def chat_digest(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    chats = format_chats(messages)
    turns = read_back(chats.withColumn("conv_id", F.struct("conv_id", F.length("formatted").alias("chars"))))
    rows = F.sort_array(F.collect_list(F.struct("at", "role", "body", "loss_text")))
    whole = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit("\n"), r["body"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("rows", lambda r: F.coalesce(r["loss_text"], F.lit(""))), "")
    return turns.groupBy("conv_id").agg(rows.alias("rows")).select(
        F.col("conv_id.conv_id").alias("conv_id"),
        F.size("rows").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("conv_id.chars").cast("long").alias("formatted_chars"),
    )
