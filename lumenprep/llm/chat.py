"""Chat formatting: conversations through compiled templates, with the loss mask, and back.

Rows of a conversation go through a task as a stream in turn order (turn, role, text), so a conversation of any length
needs the memory of one turn; copies of a conversation are conversations of their own.

Defined results: null text and null role are empty; a null turn comes first; rows with a null conv_id are one
conversation; equal turns are ordered by role and text, and repeated rows are each rendered; an empty table gives an empty
one; other columns are ignored. Control strings inside roles and texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ship
from .template import Template, unescape, unescape_line

BEGIN, END = "<|im_start|>", "<|im_end|>"
CHAT = (
    "{% for m in messages %}" + BEGIN + "{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    + END + "\n{% endfor %}"
)


def render(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """conv_id, part long (0, 1, ..), formatted string, mask array<array<int>>: a row for each turn, in order within its partition.

    The formatted conversation is the parts in order; mask has [start, end) of the generated characters of each part.
    """
    ship(turns.sparkSession)
    Template(template)  # an error shows here, not in a task
    key, kind = turns.schema["conv_id"].dataType.simpleString(), to_arrow_type(turns.schema["conv_id"].dataType)
    source = (
        turns.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        schema = pa.schema([("conv_id", kind), ("part", pa.int64()), ("formatted", pa.string()), ("mask", pa.list_(pa.list_(pa.int32())))])
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held: list[tuple] = []
        size = 0
        for conv, own in groupby(rows, lambda r: r[0]):
            for part, (text, spans) in enumerate(compiled.stream({"role": r[1], "text": r[2]} for r in own)):
                held.append((conv, part, text, [list(x) for x in spans]))
                size += len(text)
                if size > 1 << 21 or len(held) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    return source.mapInArrow(run, f"conv_id {key}, part long, formatted string, mask array<array<int>>")


def turns_of(text: str) -> tuple[list[tuple[str, str]], str]:
    """The whole turns at the start of a formatted text, and what is left of it."""
    out, at = [], 0
    while text.startswith(BEGIN, at):
        line = text.find("\n", at)
        end = text.find(END, line) if line >= 0 else -1
        if end < 0 or end + len(END) >= len(text):
            break
        out.append((unescape_line(text[at + len(BEGIN) : line]), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return out, text[at:]


def digests(formatted: DataFrame) -> DataFrame:
    """Reads conversations back from render()'s output with CHAT, which must come as it was partitioned and ordered there."""
    ship(formatted.sparkSession)
    key, kind = formatted.schema["conv_id"].dataType.simpleString(), to_arrow_type(formatted.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        schema = pa.schema([("conv_id", kind), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        held: list[tuple] = []
        for conv, own in groupby(rows, lambda r: r[0]):
            turns, loss, n, chars, loss_chars, left = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
            for _, _, text, mask in own:
                chars += len(text)
                for a, b in mask:
                    part = unescape(text[a:b])
                    loss_chars += len(part)
                    loss.update(part.encode())
                found, left = turns_of(left + text)
                n += len(found)
                for role, said in found:
                    turns.update(f"{role}\n{said}\n".encode())
            if left:
                raise ValueError(f"conversation {conv} cannot be read back from {left[:80]!r}")
            held.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(held) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    return formatted.mapInArrow(run, f"conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
