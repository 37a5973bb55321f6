"""Chat formatting of turns with typed content parts.

A visitor flattens a turn's parts in order: text as it is, images, audio and documents as numbered placeholders,
with an attachment (place, kind, reference) and the tokens that the placeholder expands to for each. A turn becomes
``### role: body</turn>`` and a line feed. Inside a body every control string and every backslash of the
texts is escaped with a backslash, so no text can open or close a turn or pose as a placeholder, and reading back
restores it exactly.

Turns are dealt by conversation, sorted inside each partition and streamed, so a conversation of any length needs
the memory of one turn.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marajo.llm.arrow import small_batches

END = "</turn>\n"
#: Control strings that texts must not contain unescaped, and the escape itself.
_CONTROL = re.compile(r"\\|###|</turn>|<\|")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|<\|)")
#: Characters of a role that could end it or start a control string.
_ROLE = re.compile(r"[\\:#<]")
#: One whole turn: its escaped role and body.
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.S)

_PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_ATTACHMENT = "struct<at:int,kind:string,ref:string,tokens:int>"
_SEGMENTS = f"conv_id long, turn long, role string, segment string, start long, loss_start long, loss_end long, attachments array<{_ATTACHMENT}>, expanded_tokens long"
_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(body: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], body)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn; rates are tokens by tile, second and page."""

    tile: int = 448
    tile_tokens: int = 256
    second_tokens: float = 25.0
    page_tokens: int = 600
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        """A null part says nothing; one of another type, or none, is a placeholder of its own kind without tokens."""
        if part is not None:
            getattr(self, f"visit_{part['type']}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        tiles = max(1, math.ceil((part["width"] or 0) / self.tile)) * max(1, math.ceil((part["height"] or 0) / self.tile))
        self._attach("image", part, tiles * self.tile_tokens)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * self.second_tokens))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part["pages"] or 0) * self.page_tokens)

    def visit_unknown(self, part: dict) -> None:
        self._attach("unknown", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"at": len(self.attachments), "kind": kind, "ref": part["ref"], "tokens": tokens})
        self.pieces.append(f"<|{kind}:{len(self.attachments) - 1}|>")


def turn_segment(role: str | None, body: str) -> tuple[str, int, int]:
    """A formatted turn, and where its body starts and ends in it."""
    head = "### " + _ROLE.sub(lambda m: "\\" + m[0], role or "") + ": "
    return head + body + END, len(head), len(head) + len(body)


def format_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """The formatted conversations of ``turns``, a row per turn in order.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``, or ``parts`` (array of typed parts) where not null.
    ``segment`` is the turn's stretch of the conversation, from code point ``start``; ``loss_start`` and
    ``loss_end`` bound the stretch under the loss mask in the conversation (equal where there is none: other roles,
    or an empty body). Null texts are empty, null roles an empty name. Turns of equal number go by role, then text;
    repeated rows are repeated turns; rows of null ``conv_id`` form one conversation. Parts of an unknown or null type
    become placeholders of kind ``unknown``, null parts nothing. A conversation is one text, so one task writes it turn by
    turn, however long it is. Other columns are not read; an empty table gives no rows.
    """
    parts = F.lit(None).cast(f"array<{_PART}>")
    if "parts" in turns.columns:
        parts = F.col("parts").cast(f"array<{_PART}>")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text"), parts.alias("parts"),
    )
    dealt = small_batches(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def scan(batches):
        now, at = object(), 0
        for batch in batches:
            made: list[dict] = []
            for row in batch.to_pylist():
                if row["conv_id"] != now:
                    now, at = row["conv_id"], 0
                visitor = PartVisitor()
                for part in row["parts"] if row["parts"] is not None else [{"type": "text", "text": row["text"]}]:
                    visitor.visit(part)
                segment, first, last = turn_segment(row["role"], "".join(visitor.pieces))
                if (row["role"] or "") != trained_role:
                    last = first
                made.append({
                    "conv_id": now, "turn": row["turn"], "role": row["role"], "segment": segment, "start": at, "loss_start": at + first,
                    "loss_end": at + last, "attachments": visitor.attachments, "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
                })
                at += len(segment)
            yield pa.RecordBatch.from_pylist(made, _schema())

    return dealt.mapInArrow(scan, _SEGMENTS)


def _schema() -> pa.Schema:
    attachment = pa.struct([("at", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())])
    longs = {"conv_id", "turn", "start", "loss_start", "loss_end", "expanded_tokens"}
    names = ["conv_id", "turn", "role", "segment", "start", "loss_start", "loss_end", "attachments", "expanded_tokens"]
    return pa.schema([(n, pa.int64() if n in longs else pa.list_(attachment) if n == "attachments" else pa.string()) for n in names])


class Reader:
    """Reads a formatted conversation back, fed in stretches of any length."""

    def __init__(self):
        self.rest = ""
        self.n_turns = self.chars = self.loss_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.at = 0

    def feed(self, stretch: str, masked: list[tuple[int, int]]) -> None:
        """``masked``: loss intervals in the conversation that lie in what is fed by now and weren't passed before."""
        text = self.rest + stretch
        base, done = self.at, 0
        self.chars += len(stretch)
        for m in iter(lambda: _TURN.match(text, done), None):
            role, body = re.sub(r"\\(.)", r"\1", m[1], flags=re.S), unescape(m[2])
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode())
            done = m.end()
        for start, end in masked:
            plain = unescape(text[start - base : end - base])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.rest, self.at = text[done:], base + done

    def close(self, conv_id: int | None) -> dict:
        if self.rest:
            raise ValueError(f"conversation {conv_id} ends inside a turn")
        return {
            "conv_id": conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, digests of what the output of :func:`format_turns` says: number of turns, SHA-256 of role,
    line feed, text, line feed of each, code points and SHA-256 of the unescaped text under the loss mask, and
    formatted code points. Partitions must be as :func:`format_turns` leaves them: whole conversations in order. The rows
    of a null ``conv_id`` give one row, as any conversation does; null or repeated segments can't come from there. An
    empty table gives no rows."""

    def scan(batches):
        now, reader, found = None, None, []
        kinds = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")]
            for conv_id, segment, start, end in zip(*columns, strict=True):
                if reader is None or conv_id != now:
                    if reader is not None:
                        found.append(reader.close(now))
                    now, reader = conv_id, Reader()
                reader.feed(segment, [(start, end)] if end > start else [])
            if found:
                yield pa.RecordBatch.from_pylist(found, kinds)
                found = []
        if reader is not None:
            yield pa.RecordBatch.from_pylist([reader.close(now)], kinds)

    return segments.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(scan, _DIGESTS)
