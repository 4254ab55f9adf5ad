"""Chat formatting of typed content parts, and reading the formatted text back.

One conversation becomes one text. Every turn is ``<turn>role``, a line feed, the content and ``</turn>`` with a line
feed. A backslash inside a role or text becomes ``\\s`` and ``<`` becomes ``\\l``, so no text can hold a control string,
and the way back is two plain replacements. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"

# Expanded size of an attachment's placeholder, in tokens.
IMAGE_PATCH = 28  # pixels per side and token
AUDIO_RATE = 25  # tokens per second
PAGE_TOKENS = 512  # tokens per document page

PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A plain text as the single part of a message."""
    none = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            none.cast("string").alias("ref"),
            none.cast("int").alias("width"),
            none.cast("int").alias("height"),
            none.cast("double").alias("seconds"),
            none.cast("int").alias("pages"),
        )
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(False))


def _kind(part: Column) -> Column:
    known = part["type"].isin("image", "audio", "document")
    return F.when(F.coalesce(known, F.lit(False)), part["type"]).otherwise(F.lit("other"))


def _tokens(part: Column) -> Column:
    """How many tokens the placeholder of an attachment expands to; 0 where its measures are missing."""
    side = lambda pixels: F.ceil(F.greatest(pixels, F.lit(0)) / IMAGE_PATCH)
    return F.coalesce(
        F.when(part["type"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["type"] == "audio", F.ceil(F.greatest(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(part["type"] == "document", F.greatest(part["pages"], F.lit(0)).cast("bigint") * PAGE_TOKENS),
        F.lit(0),
    ).cast("bigint")


def format_chats(messages: DataFrame, id_column: str = "conv_id", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: the formatted text, its loss spans and its attachments.

    ``messages`` has the id column, ``turn``, ``role`` and ``parts`` of type ``PARTS``. The visitor walks the parts of
    a turn in order: text is escaped, every other part becomes a placeholder ``<kind number>`` numbered through the
    conversation. ``loss`` lists the code-point start and length of the content of every turn of ``trained_role``.
    ``attachments`` lists number, turn position, kind, reference and expanded tokens; ``attachment_tokens`` sums them.

    Rows go by ``turn``, ties by role and then by the parts; repeated rows are turns of their own; a null turn comes
    first. A null role, null parts or null text counts as empty; a part of unknown type is an ``other`` of 0 tokens.
    Rows with a null id form one conversation. No rows give no conversations. Other columns are not read. The result
    is one text per conversation by definition, so a conversation must fit one row.
    """
    rows = messages.select(
        F.col(id_column).alias("id"),
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("parts"), F.array().cast(PARTS)).alias("parts"),
    )
    rows = rows.withColumn("others", F.size(F.filter("parts", lambda p: ~_is_text(p))))
    order = Window.partitionBy("id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "position": F.row_number().over(order),
            "first": F.coalesce(F.sum("others").over(before), F.lit(0)),
        }
    )
    # Placeholders are numbered by the attachments before them: those of earlier turns and of earlier parts.
    number = lambda i: F.col("first") + F.size(
        F.filter(F.slice("parts", F.lit(1), i), lambda p: ~_is_text(p))
    )
    flat = F.transform(
        "parts",
        lambda p, i: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<"), _kind(p), F.lit(" "), number(i).cast("string"), F.lit(">"))
        ),
    )
    found = F.filter(
        F.transform(
            "parts",
            lambda p, i: F.when(
                ~_is_text(p),
                F.struct(
                    number(i).cast("bigint").alias("number"),
                    F.col("position").alias("turn"),
                    _kind(p).alias("kind"),
                    p["ref"].alias("ref"),
                    _tokens(p).alias("tokens"),
                ),
            ),
        ),
        lambda a: a.isNotNull(),
    )
    rows = rows.withColumns({"content": F.array_join(flat, ""), "found": found})
    head = F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumns({"head": head, "piece": F.concat(head, F.col("content"), F.lit(CLOSE))})
    rows = rows.withColumn("offset", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    span = F.struct(
        (F.col("offset") + F.length("head")).cast("bigint").alias("start"),
        F.length("content").cast("bigint").alias("length"),
    )
    turns = F.sort_array(
        F.collect_list(
            F.struct("position", "piece", F.when(F.col("role") == trained_role, span).alias("span"), "found")
        )
    )
    chats = rows.groupBy("id").agg(turns.alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: t["found"]))
    return chats.select(
        F.col("id").alias(id_column),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text); placeholders stay in the text."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        pieces,
        lambda piece: F.struct(
            _unescape_role(F.substr(F.substring_index(piece, "\n", 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(piece, F.length(F.substring_index(piece, "\n", 1)) + 2)).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    spans = F.transform(
        loss, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
    )
    return unescape(F.array_join(spans, ""))
