"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them in order:
texts are escaped, every other part becomes a numbered placeholder, its reference is recorded and so
is the number of tokens it expands to. A turn is marked ``<s>role[INST]content[/INST]</s>``. Inside
roles, texts and references a backslash is put after each ``<`` and ``[``, so no control string can stand
there, and taking it away gives the text back exactly. The loss mask covers the content of assistant turns.

Output rows are turns, so a conversation of any length is no single value; joined in order of turn they
are its text. ``read_back`` goes through that order in each partition with running digests and keeps
nothing of a conversation but its current turn.

Null texts and roles are empty; unknown parts are kept as document parts. Turns that tie are ordered
by role and text; repeated rows are turns of their own. Null conv_ids are one conversation. A null turn
comes first. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import shuffle_width

START, BODY, STOP, END = "<s>", "[INST]", "[/INST]", "</s>"
LOSS_ROLE = "assistant"
PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<kind: string, ref: string, tokens: long>"
TURN = f"conv_id long, turn long, formatted string, loss array<struct<first: int, last: int>>, attachments array<{ATTACHMENT}>, expanded long"
_TURN = re.compile(r"<s>((?:[^<\[]+|<\\|\[\\)*)\[INST\]((?:[^<\[]+|<\\|\[\\|<part:\d+>)*)\[/INST\]</s>")


def escape(text: str) -> str:
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


class PartVisitor:
    """Flattens the parts of one turn; counts are tokens that a placeholder stands for."""

    patch, tokens_per_second, tokens_per_page = 14, 25, 256

    def __init__(self) -> None:
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, ceil((part.get("width") or 0) / self.patch) * ceil((part.get("height") or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, ceil((part.get("seconds") or 0) * self.tokens_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.tokens_per_page)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.out.append(f"<part:{len(self.attachments)}>")
        self.attachments.append({"kind": kind, "ref": part.get("ref") or "", "tokens": tokens})


def text_parts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, parts: each row's text as its only part."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce("text", F.lit("")).alias("text"),
        *[F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))],
    )
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.array(part).alias("parts"))


def formatted(turns: DataFrame) -> DataFrame:
    """``turns``: conv_id, turn, role, parts (array of ``PART``). One output row (``TURN``) for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        attachment = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
        for batch in batches:
            texts, losses, attached, expanded = [], [], [], []
            for role, parts in zip(batch.column(2), batch.column(3), strict=True):
                visitor = PartVisitor()
                for part in parts.as_py() or []:
                    visitor.visit(part)
                role, content = role.as_py() or "", "".join(visitor.out)
                head = START + escape(role) + BODY
                texts.append(head + content + STOP + END)
                losses.append([{"first": len(head), "last": len(head) + len(content)}] if role == LOSS_ROLE else [])
                attached.append(visitor.attachments)
                expanded.append(sum(a["tokens"] for a in visitor.attachments))
            columns = [pa.array(texts, pa.string()), pa.array(losses, loss_type), pa.array(attached, attachment), pa.array(expanded, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], [x.split()[0] for x in ("conv_id", "turn", "formatted", "loss", "attachments", "expanded")])

    return turns.select("conv_id", "turn", "role", "parts").mapInArrow(run, TURN)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, content) of the turns of a formatted text; placeholders stay as they are."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def read_back(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from formatted turns only."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    order = ["turn", "formatted"]
    dealt = rows.repartition(shuffle_width(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in schema.split(", ")]

        def closed(c: dict) -> tuple:
            return c["id"], c["n"], c["turns"].hexdigest(), c["loss_chars"], c["loss"].hexdigest(), c["chars"]

        def made(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            out = []
            for conv_id, text, loss in zip(*batch.columns, strict=True):
                key, text = conv_id.as_py(), text.as_py()
                if now is None or now["id"] != key:
                    if now is not None:
                        out.append(closed(now))
                    now = {"id": key, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                for role, content in parse(text):
                    now["turns"].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                    now["n"] += 1
                for span in loss.as_py():
                    part = unescape(text[span["first"] : span["last"]])
                    now["loss"].update(part.encode("utf-8", "surrogatepass"))
                    now["loss_chars"] += len(part)
                now["chars"] += len(text)
            yield made(out)
        if now is not None:
            yield made([closed(now)])

    return dealt.select("conv_id", "formatted", "loss").mapInArrow(run, schema)
