"""Chat formatting with typed content parts.

A turn's content is an array of parts.  A visitor turns each part into text: a text
part is escaped, an image, audio or document part becomes a placeholder, and its
reference and expanded token count are recorded in order.

    <|role|>\\n content </s>\\n

Control strings hold ``<`` or ``[``.  Texts and roles get ``%25``, ``%3C`` and ``%5B``
for ``%``, ``<`` and ``[`` (roles also ``%7C`` for ``|``), so none can come from a text
and every text can be read back.

One row per turn, so a conversation of any length is never held in one value.  A null
role, text or list of parts is empty; an unknown part type is a document part.  Turns
of one conversation are ordered by turn, then formatted text; nulls first.  Rows that
repeat are turns of their own, and an empty table gives no rows.  Texts of any length are
formatted in their row.  Columns other than those of a turn are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
END = "</s>\n"
_ESCAPES = (("%", "%25"), ("<", "%3C"), ("[", "%5B"))
_NO_SPANS = "array<struct<start:int,end:int>>"


def escape(text: Column) -> Column:
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """Plain text as a list of one part."""
    empty = {name: F.lit(None).cast(kind) for name, kind in
             (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            *[value.alias(name) for name, value in empty.items()])).cast(f"array<{PART}>")


class PartVisitor:
    """What each type of part becomes, and how many tokens its placeholder stands for."""

    def __init__(self, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 256):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens

    def text(self, part: Column) -> Column:
        return escape(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        side = lambda name: F.ceil(F.coalesce(part[name], F.lit(0)) / self.patch)
        return (side("width") * side("height")).cast("long")

    def audio(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_rate).cast("long")

    def document(self, part: Column) -> Column:
        return (F.coalesce(part["pages"], F.lit(1)) * self.page_tokens).cast("long")

    def kind(self, part: Column) -> Column:
        return F.when(part["type"].isin("text", "image", "audio"), part["type"]).otherwise(F.lit("document"))

    def flatten(self, part: Column) -> Column:
        kind = self.kind(part)
        return F.when(kind == "text", self.text(part)).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>")))

    def tokens(self, part: Column) -> Column:
        kind = self.kind(part)
        return (F.when(kind == "image", self.image(part)).when(kind == "audio", self.audio(part))
                .otherwise(self.document(part)))


def format_turns(turns: DataFrame, parts: str = "parts", role: str = "role", conv: str = "conv_id", turn: str = "turn",
                 learned: str = "assistant", visitor: PartVisitor | None = None) -> DataFrame:
    """One row per turn: ``segment``, ``loss`` (spans in code points), ``attachments`` and ``n_expanded``.

    Text parts of ``learned`` turns are under the loss mask.  The formatted
    conversation is its segments one after another.  No shuffle.
    """
    visitor = visitor or PartVisitor()
    head = F.concat(F.lit("<|"), F.replace(escape(F.coalesce(F.col(role), F.lit(""))), F.lit("|"), F.lit("%7C")), F.lit("|>\n"))
    own = F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), head.alias("_head"),
                        (F.col(role).eqNullSafe(learned)).alias("_learned"), F.filter(own, lambda p: p.isNotNull()).alias("_parts"))
    rows = rows.withColumn("_pieces", F.transform("_parts", lambda p: F.struct(
        visitor.flatten(p).alias("body"), (visitor.kind(p) == "text").alias("is_text"))))
    state = F.struct(F.length("_head").alias("at"), F.array().cast(_NO_SPANS).alias("spans"))

    def mark(done: Column, piece: Column) -> Column:
        end = done["at"] + F.length(piece["body"])
        span = F.struct(done["at"].alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(piece["is_text"] & F.col("_learned"), F.array_append(done["spans"], span))
                        .otherwise(done["spans"]).alias("spans"))

    others = F.filter("_parts", lambda p: visitor.kind(p) != "text")
    attachments = F.transform(others, lambda p, i: F.struct(
        i.alias("number"), visitor.kind(p).alias("type"), p["ref"].alias("ref"), visitor.tokens(p).alias("n_tokens")))
    return rows.select(
        "conv_id", "turn",
        F.concat("_head", F.array_join(F.col("_pieces.body"), ""), F.lit(END)).alias("segment"),
        F.aggregate("_pieces", state, mark)["spans"].alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda total, a: total + a["n_tokens"]).alias("n_expanded"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Role and text of each turn read back from its segment, the text under the mask, and the segment's length.

    Placeholders of attachments stay in the text as they are.
    """
    mark = F.instr("segment", "|>\n")
    role = unescape(F.replace(F.substring("segment", F.lit(3), mark - 3), F.lit("%7C"), F.lit("|")))
    body = F.substring("segment", mark + 3, F.length("segment") - (mark + 2) - len(END))
    masked = F.transform("loss", lambda s: F.substring(F.col("segment"), s["start"] + 1, s["end"] - s["start"]))
    return formatted.select("conv_id", "turn", "segment", role.alias("role"), unescape(body).alias("text"),
                            unescape(F.array_join(masked, "")).alias("learned"), F.length("segment").cast("long").alias("n_chars"))


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digest_conversations(read: DataFrame) -> DataFrame:
    """One row per conversation, from its turns in order.

    Turns are sorted by Spark and hashed as they come, so a task holds a few numbers
    of one conversation, however long that is.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun = None, False
        n = chars = formatted = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def row() -> tuple:
            return current, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

        for batch in batches:
            done = []
            for conv, role, text, learned, length in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != current:
                    if begun:
                        done.append(row())
                    current, begun = conv, True
                    n = chars = formatted = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                n += 1
                chars += len(learned)
                formatted += length
                turns.update(f"{role}\n{text}\n".encode("utf-8"))
                loss.update(learned.encode("utf-8"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _DIGEST.types)], schema=_DIGEST)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row(), _DIGEST.types)], schema=_DIGEST)

    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.select(F.col("conv_id").cast("long"), "role", "text", "learned", "n_chars").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
