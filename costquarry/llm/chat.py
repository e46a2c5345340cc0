"""Chat formatting with typed content parts.

A visitor flattens the parts of each turn into text and ordered placeholders, records what each
placeholder refers to and how many tokens it expands to, and notes which code points count for the
loss. Control strings inside texts are escaped so that the formatted string can be read back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.llm import runtime

# The template's control strings; of other templates' the ones that texts may hold are escaped too.
BEGIN, TURN, TEXT, END, DONE = "<s>", "<|turn|>", "<|text|>", "<|end|>", "</s>"
#: A backslash, or the first character of a control string: a backslash is put behind it.
_ESCAPE = re.compile(r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])")
_UNESCAPE = re.compile(r"([\\<\[])\\")
_PLACEHOLDER = re.compile(r"<\|\w+ \d+\|>")

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
FORMATTED = "conv_id {id}, formatted string, loss_spans array<struct<begin:long,end:long>>, attachments array<struct<place:int,turn:int,type:string,ref:string,tokens:long>>, attachment_tokens long"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\g<0>\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class PartVisitor:
    """Visits the parts of one conversation in order; unknown kinds become placeholders of one token."""

    def __init__(self, loss_role: str = "assistant", patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 256):
        self.loss_role, self.patch, self.audio_rate, self.page_tokens = loss_role, patch, audio_rate, page_tokens
        self.out: list[str] = []
        self.at = 0
        self.spans: list[dict[str, int]] = []
        self.attachments: list[dict[str, Any]] = []

    def put(self, s: str) -> None:
        self.out.append(s)
        self.at += len(s)

    def turn(self, number: int, role: str | None, parts: list[dict[str, Any]] | None) -> None:
        self.put(TURN + escape(role or "") + TEXT)
        for part in parts or []:
            if part is not None:
                getattr(self, f"visit_{part['type'] or 'text'}", self.visit_other)(number, role, part)
        self.put(END)

    def visit_text(self, number: int, role: str | None, part: dict[str, Any]) -> None:
        begin = self.at
        self.put(escape(part["text"] or ""))
        if role == self.loss_role and self.at > begin:
            self.spans.append({"begin": begin, "end": self.at})

    def _attach(self, number: int, part: dict[str, Any], tokens: int) -> None:
        place = len(self.attachments)
        kind = re.sub(r"\W", "_", part["type"]) or "part"
        self.put(f"<|{kind} {place}|>")
        self.attachments.append({"place": place, "turn": number, "type": part["type"], "ref": part["ref"], "tokens": max(1, tokens)})

    def visit_image(self, number: int, role: str | None, part: dict[str, Any]) -> None:
        self._attach(number, part, math.ceil((part["width"] or 0) / self.patch) * math.ceil((part["height"] or 0) / self.patch))

    def visit_audio(self, number: int, role: str | None, part: dict[str, Any]) -> None:
        self._attach(number, part, math.ceil((part["seconds"] or 0) * self.audio_rate))

    def visit_document(self, number: int, role: str | None, part: dict[str, Any]) -> None:
        self._attach(number, part, (part["pages"] or 0) * self.page_tokens)

    def visit_other(self, number: int, role: str | None, part: dict[str, Any]) -> None:
        self._attach(number, part, 1)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted string; placeholders are left out of the text."""
    if not (formatted.startswith(BEGIN) and formatted.endswith(DONE)):
        raise ValueError("not a formatted conversation")
    turns = []
    for piece in formatted[len(BEGIN) : -len(DONE)].split(TURN)[1:]:
        role, text = piece.removesuffix(END).split(TEXT)
        turns.append((unescape(role), unescape(_PLACEHOLDER.sub("", text))))
    return turns


def text_part(text: Column) -> Column:
    """A plain string as an array of one text part (null: a part with empty text)."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in empty.items())))


def format_chats(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: formatted string, loss spans (code points), attachments and their tokens.

    Turns go by `turn`, null first; ties by role, then parts, so repeated rows stay and reruns agree.
    A null role is an empty one; null parts and texts are empty. Rows of a null id are one conversation.
    A conversation is one output row, so it is gathered whole, however long; nothing else is. An empty table
    gives no rows; other columns are not read.
    """
    runtime.ship(df.sparkSession)
    one = F.struct(df[turn].alias("turn"), df[role].alias("role"), df[parts].alias("parts"))
    grouped = df.select(df[conv_id].alias("conv_id"), one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    schema = FORMATTED.format(id=df.schema[conv_id].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b, rows = batch.slice(at, 256), {"formatted": [], "loss_spans": [], "attachments": [], "attachment_tokens": []}
                for turns in b.column("turns").to_pylist():
                    v = PartVisitor(loss_role)
                    v.put(BEGIN)
                    for i, t in enumerate(turns):
                        v.turn(i, t["role"], t["parts"])
                    v.put(DONE)
                    rows["formatted"].append("".join(v.out))
                    rows["loss_spans"].append(v.spans)
                    rows["attachments"].append(v.attachments)
                    rows["attachment_tokens"].append(sum(a["tokens"] for a in v.attachments))
                kinds = kinds or {
                    "formatted": pa.string(),
                    "loss_spans": pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
                    "attachments": pa.list_(pa.struct([("place", pa.int32()), ("turn", pa.int32()), ("type", pa.string()),
                        ("ref", pa.string()), ("tokens", pa.int64())])),
                    "attachment_tokens": pa.int64(),
                }
                yield pa.RecordBatch.from_arrays([b.column("conv_id"), *(pa.array(rows[k], t) for k, t in kinds.items())], ["conv_id", *kinds])

    return grouped.mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from format_chats(): turns and the text under the loss mask, as counts and digests.

    A row for each conversation, whatever its id; a conversation without assistant text has an empty loss text.
    Only the columns of format_chats() are read, so further ones do no harm. No rows: no rows.
    """
    runtime.ship(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist()):
                turns = read_back(text)
                loss = "".join(unescape(text[s["begin"] : s["end"]]) for s in spans)
                rows.append((len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), len(text)))
            n, turns_sha, chars, loss_sha, total = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(n, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(chars, pa.int64()),
                    pa.array(loss_sha, pa.string()), pa.array(total, pa.int64()), b.column("attachment_tokens")],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "attachment_tokens"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "loss_spans", "attachment_tokens").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attachment_tokens long"
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
