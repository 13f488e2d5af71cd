"""Chat formatting: turns of typed parts become one marked text with a loss mask.

A visitor goes over the parts of each turn in order. Text is escaped; an
image, an audio clip or a document becomes a placeholder, and what it stands
for is noted in the list of attachments together with the number of tokens it
will take. DataFrame functions only.

No control string can be read from a text: all of them begin with ``<`` or
``[``, and escaping leaves neither character in a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
TRAINED_ROLE = "assistant"
ATTACHED = ("image", "audio", "document")

ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
NEWLINE = ("\n", "&#10;")  # in roles only, since a newline ends the role

#: Parts of a turn.
PARTS = (
    "array<struct<kind: string, text: string, ref: string, "
    "width: int, height: int, seconds: double, pages: int>>"
)


@dataclass(frozen=True)
class Expansion:
    """Tokens a placeholder expands to; an attachment of unknown size takes one."""

    pixels_per_side: int = 28
    audio_per_second: float = 25.0
    per_page: int = 512

    def tokens(self, part: Column) -> Column:
        def patches(side: str) -> Column:
            return F.ceil(part[side] / self.pixels_per_side)

        image = patches("width") * patches("height")
        audio = F.ceil(part["seconds"] * self.audio_per_second)
        pages = part["pages"].cast("long") * self.per_page
        kind = part["kind"]
        size = F.when(kind == "image", image).when(kind == "audio", audio).otherwise(pages)
        return F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in ((*NEWLINE,), *reversed(ESCAPES)):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in
               (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *nothing))


def is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*ATTACHED), F.lit(False))


def visit(part: Column) -> Column:
    """What a part puts into the text. A part of another kind counts as text."""
    mark = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
    return F.when(is_attachment(part), mark).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def format_chat(messages: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``segments``, ``attachments``, ``expanded_tokens``.

    Reads ``conv_id``, ``turn``, ``role`` and ``parts`` (``PARTS``). Turns go
    by ``turn``, null first, equal ones by role and text; repeated rows are
    repeated turns. A null role or text is empty, null parts are none, a null
    ``conv_id`` is a conversation. ``segments`` are struct(text, loss); joined
    they are the formatted text, and those with ``loss`` are what is trained
    on: the bodies of the assistant's turns. ``attachments`` are in the order
    of their placeholders: struct(turn, kind, ref, tokens).

    A conversation ends up as one value, so all its turns meet in one task.
    """
    parts = F.coalesce("parts", F.array().cast(PARTS))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.replace(escape(role), *map(F.lit, NEWLINE)).alias("role"),
        F.array_join(F.transform(parts, visit), "").alias("body"),
        role.alias("raw_role"),
        F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "").alias("raw_text"),
        F.transform(
            F.filter(parts, is_attachment),
            lambda p: F.struct(
                F.col("turn").cast("long").alias("turn"),
                p["kind"].alias("kind"),
                p["ref"].alias("ref"),
                expansion.tokens(p).alias("tokens"),
            ),
        ).alias("attached"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "raw_role", "raw_text", "body", "attached"))
    numbered = turns.withColumn("place", place)
    whole = numbered.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("place", "role", "body", "attached"))).alias("turns"),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def segments(turn: Column) -> Column:
        start = F.concat(F.lit(TURN_START), turn["role"], F.lit("\n"))
        return F.array(
            segment(start, F.lit(False)),
            segment(turn["body"], turn["role"] == TRAINED_ROLE),
            segment(F.lit(TURN_END), F.lit(False)),
        )

    return whole.select(
        "conv_id",
        "n_turns",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def trained_text(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_turns(text: Column) -> Column:
    """Roles and texts back from a formatted text: array of struct(role, text).

    Placeholders stay in the text as they are.
    """
    pieces = F.split(text, F.lit(r"<\|im_start\|>"))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substr(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(TURN_END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)
