"""Chat formatting of typed content parts, with loss mask, and reading it back.

A turn has a role and parts: text, image, audio or document. A visitor with one method for each
kind flattens them in order: text is escaped, the others become placeholders that name their
kind, their number within the turn and the tokens they stand for; reference and tokens go to
the turn's attachments. The template puts ``<s>[INST] .. </s>`` around user turns,
``<s>[ASST] .. </s>`` around assistant turns and ``<s>[ROLE:name] .. </s>`` around others. All
its control strings begin with ``<`` or ``[``; in texts and names these become ``\\l`` and
``\\b``, and ``\\`` becomes ``\\\\``, so no text can imitate a control string and all of it comes
back. In names, which end at ``]``, that one becomes ``\\r``. The loss mask covers the body of
assistant turns.

Formatting works turn by turn in built-in functions; a conversation is its segments in order,
with nothing between. Reading back streams the segments of a partition, sorted by
conversation, so even a conversation with a large part of all rows needs little memory.

Defined results: null texts, roles and parts are empty; rows of a conversation are ordered by
turn (nulls last), then role, then formatted text, and repeated rows stay; a null conv_id is one
conversation; an empty table gives an empty result. Unknown kinds count as documents. Other
columns are unused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
OPEN, CLOSE = "<s>", " </s>"
USER, ASSISTANT = "[INST] ", "[ASST] "
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
           "loss_sha256 string, formatted_chars long")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLAIN = {"\\": "\\", "l": "<", "b": "[", "r": "]"}
_PLACEHOLDER = re.compile(r"\[(\w+):(\d+):(\d+)\]")


def escape(text: Column, name: bool = False) -> Column:
    text = F.coalesce(text, F.lit(""))
    marks = [("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), *[("]", "\\r")] * name]
    for plain, safe in marks:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text) if "\\" in text else text


class PartVisitor:
    """Columns for a part: what stands in the text, and how many tokens it expands to."""

    def __init__(self, patch: int = 14, audio_rate: int = 25, page_tokens: int = 512):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens

    def image(self, part: Column) -> Column:
        def cells(side: str) -> Column:
            return F.ceil(F.coalesce(part[side], F.lit(0)) / self.patch)
        return cells("width") * cells("height")

    def audio(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_rate)

    def document(self, part: Column) -> Column:
        return F.coalesce(part["pages"], F.lit(0)).cast("long") * self.page_tokens

    def tokens(self, part: Column) -> Column:
        return F.when(part["kind"] == "image", self.image(part)).when(
            part["kind"] == "audio", self.audio(part)).otherwise(self.document(part))

    def kind(self, part: Column) -> Column:
        known = part["kind"].isin("text", "image", "audio")
        return F.when(known, part["kind"]).otherwise(F.lit("document"))

    def flatten(self, parts: Column) -> Column:
        def visit(part: Column, number: Column) -> Column:
            mark = F.concat(F.lit("["), self.kind(part), F.lit(":"), number.cast("string"),
                            F.lit(":"), self.tokens(part).cast("string"), F.lit("]"))
            return F.when(part["kind"] == "text", escape(part["text"])).otherwise(mark)
        return F.array_join(F.transform(parts, visit), "")

    def attachments(self, parts: Column) -> Column:
        numbered = F.transform(parts, lambda p, i: F.struct(
            i.alias("part"), self.kind(p).alias("kind"), p["ref"].alias("ref"),
            self.tokens(p).cast("long").alias("tokens")))
        return F.filter(numbered, lambda a: a["kind"] != "text")


def text_part(text: Column) -> Column:
    """A turn's plain text as its only part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            *[F.lit(None).cast(t).alias(n) for n, t in none.items()]))


def format_turns(turns: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """(conv_id, turn, role, formatted, loss_start, loss_end, attachments).

    ``turns`` has conv_id, turn, role and either ``parts`` (array of PART) or ``text``. The
    loss span counts code points of the segment; it is empty where nothing is learned.
    """
    visitor = visitor or PartVisitor()
    parts = (F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
             if "parts" in turns.columns else text_part(F.col("text")))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), visitor.flatten(parts).alias("body"),
        visitor.attachments(parts).alias("attachments"))
    mine = F.col("role") == "assistant"
    head = F.when(F.col("role") == "user", F.lit(USER)).when(mine, F.lit(ASSISTANT)).otherwise(
        F.concat(F.lit("[ROLE:"), escape(F.col("role"), name=True), F.lit("] ")))
    start = F.lit(len(OPEN + ASSISTANT))
    return rows.select(
        "conv_id", "turn", "role", F.concat(F.lit(OPEN), head, "body", F.lit(CLOSE)).alias("formatted"),
        F.when(mine, start).otherwise(0).alias("loss_start"),
        F.when(mine, start + F.char_length("body")).otherwise(0).alias("loss_end"),
        "attachments")


class TurnParser:
    """Reads turns from formatted text that comes in any pieces."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """(role, body) of every turn that is complete by now; the body is still escaped."""
        self.rest += piece
        while (end := self.rest.find(CLOSE)) >= 0:
            turn, self.rest = self.rest[:end], self.rest[end + len(CLOSE):]
            head, _, body = turn.removeprefix(OPEN).partition("] ")
            if not turn.startswith(OPEN + "["):
                raise ValueError(f"no turn begins at {turn[:30]!r}")
            role = {"[INST": "user", "[ASST": "assistant"}.get(head)
            yield unescape(head.removeprefix("[ROLE:")) if role is None else role, body


def body_parts(body: str) -> list[tuple]:
    """Text parts and placeholders (kind, number, tokens) of a body, in order."""
    parts: list[tuple] = []
    at = 0
    for m in _PLACEHOLDER.finditer(body):
        if m.start() > at:
            parts.append(("text", unescape(body[at:m.start()])))
        parts.append((m[1], int(m[2]), int(m[3])))
        at = m.end()
    if at < len(body):
        parts.append(("text", unescape(body[at:])))
    return parts


def read_digests(segments: DataFrame) -> DataFrame:
    """One row of digests for each conversation, read from its formatted segments in order."""
    columns = ["conv_id", "formatted", "loss_start", "loss_end"]
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    order = [F.col("turn").asc_nulls_last(), "role", "formatted"]
    ready = segments.repartition("conv_id").sortWithinPartitions("conv_id", *order).select(columns)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current = [], None

        def finish() -> None:
            done.append((current, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        begun = False
        for batch in batches:
            for conv, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != current:
                    if begun:
                        finish()
                    begun, current, parser = True, conv, TurnParser()
                    n_turns = loss_chars = chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                learned = unescape(text[start:end])
                loss_chars += len(learned)
                loss.update(learned.encode())
                for role, body in parser.feed(text):
                    n_turns += 1
                    turns.update(f"{role}\n{unescape(body)}\n".encode())
            if done:
                yield batch_of(done)
                done = []
        if begun:
            finish()
            yield batch_of(done)

    return ready.mapInArrow(digest, DIGESTS)
