"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio, document. A visitor flattens them
into text and numbered placeholders, and records for each placeholder what it
refers to and how many tokens it stands for. The template marks turns; its control
strings, and those of common others, are broken up where they stand in a text, so
that only the template's own marks read as marks, and reading undoes that.

The output is a row for each turn. A conversation's formatted text is its rows'
``piece`` in order, so no conversation is ever held whole.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from math import ceil, isfinite

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"
# What is escaped: a bracket that begins a control string, and the escape itself.
CONTROL = re.compile(r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PIECE = re.compile(r"<\|turn\|>(.*?)<\|body\|>(.*?)<\|end\|>\n", re.DOTALL)
# A part or a message stands for no more tokens than this, whatever length it names.
MOST_TOKENS = 2**62
HOLDER = re.compile(r"<\|(image|audio|document|other):[0-9]+\|>")

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<number:int,type:string,ref:string,tokens:long,at:long>"
FORMATTED = (
    "turn_role string, piece string, loss_start long, loss_end long, "
    f"attachments array<{ATTACHMENT}>, expanded_tokens long"
)


def escape(text: str) -> str:
    """No control string is left in the result; ``unescape`` gives the text back."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


@dataclass
class Flatten:
    """Visits the parts of one message in order."""

    # Side of an image tile; tokens of a tile, of a second of audio, of a page.
    tile: int = 28
    per_tile: int = 1
    per_second: int = 25
    per_page: int = 256
    body: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        if part:
            getattr(self, f"visit_{part['type'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (ceil(max(0, part[side] or 0) / self.tile) for side in ("width", "height"))
        tiles = across * down
        self._attach("image", part, tiles * self.per_tile)

    def visit_audio(self, part: dict) -> None:
        # a length that is no finite number counts as unknown
        seconds = part["seconds"] or 0
        self._attach("audio", part, ceil(seconds * self.per_second) if isfinite(seconds) else 0)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * self.per_page)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append(
            {"number": number, "type": kind, "ref": part["ref"], "tokens": min(max(0, tokens), MOST_TOKENS), "at": self.length}
        )
        self._add(f"<|{kind}:{number}|>")

    def _add(self, text: str) -> None:
        self.body.append(text)
        self.length += len(text)


def text_part(text: Column) -> Column:
    """The parts of a message that is a text alone."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        "array<struct<type:string,text:string>>"
    )


def _full(parts: Column, present: list[str]) -> Column:
    fields = [f.split(":") for f in PART.removeprefix("struct<").removesuffix(">").split(",")]
    return F.transform(
        parts,
        lambda p: F.when(
            p.isNotNull(),
            F.struct(*[(p[n] if n in present else F.lit(None)).cast(t).alias(n) for n, t in fields]),
        ),
    )


def format_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn=("assistant",)
) -> DataFrame:
    """A row for each turn: its keys, formatted ``piece``, loss mask, attachments.

    ``loss_start`` and ``loss_end`` delimit the learned text within the piece, in code
    points; both are null for roles not in ``learn``. Each attachment has its number in
    the message, type, reference, expanded tokens and place in the body. Null or empty
    parts give an empty body, null parts in a list nothing, null roles an empty role,
    types that are unknown a placeholder of no tokens, as do sizes and lengths that are
    null, negative or not finite. Repeated rows stay, in any number.
    """
    present = [f.name for f in turns.schema[parts].dataType.elementType.fields]
    kinds = dict(turns.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, of in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                flat = Flatten()
                for part in of or []:
                    flat.visit(part)
                head = f"{TURN}{escape(name or '')}{BODY}"
                span = (len(head), len(head) + flat.length) if name in learn else (None, None)
                tokens = min(sum(a["tokens"] for a in flat.attachments), MOST_TOKENS)
                rows.append((name or "", f"{head}{''.join(flat.body)}{END}", *span, flat.attachments, tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(KINDS))],
                [conv, turn, *NAMES],
            )

    source = turns.select(conv, turn, role, _full(F.col(parts), present).alias("parts"))
    return source.mapInArrow(each, f"`{conv}` {kinds[conv]}, `{turn}` {kinds[turn]}, {FORMATTED}")


NAMES = ["turn_role", "piece", "loss_start", "loss_end", "attachments", "expanded_tokens"]
KINDS = [
    pa.string(),
    pa.string(),
    pa.int64(),
    pa.int64(),
    pa.list_(
        pa.struct(
            [("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64()), ("at", pa.int64())]
        )
    ),
    pa.int64(),
]


def read_piece(piece: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders are no text."""
    role, body = PIECE.fullmatch(piece).groups()
    return unescape(role), unescape(HOLDER.sub("", body))


class _Digest:
    """Running digests of one conversation: some hundred bytes, however long it is."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.all, self.learned = sha256(), sha256()

    def add(self, piece: str, start: int | None, end: int | None) -> None:
        role, text = read_piece(piece)
        self.turns += 1
        self.chars += len(piece)
        self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            learned = unescape(HOLDER.sub("", piece[start:end]))
            self.loss += len(learned)
            self.learned.update(learned.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


def conversations(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """A row for each conversation, read back from its pieces.

    conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. Turns stand
    in the order of ``turn``, null first; equal turns by role, then by piece. Null
    conversation ids are one conversation. A digest needs a conversation's turns one
    after another: they are sorted on disk and stream through one task, never held.
    """
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = dict(formatted.dtypes)[conv]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kinds = None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            types = [kinds, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            done, kinds = [], batch.schema.field(0).type
            for key, piece, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv != key:
                    done += [now.row()] if now else []
                    now = _Digest(key)
                now.add(piece, start, end)
            if done:
                yield out(done)
        if now:
            yield out([now.row()])

    ordered = formatted.repartition(conv).sortWithinPartitions(conv, turn, "turn_role", "piece")
    return ordered.select(conv, "piece", "loss_start", "loss_end").mapInArrow(
        each,
        f"`{conv}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
