"""Conversations rendered by a compiled template, with marks on generated text.

Rows are brought together by conversation, sorted by turn, and rendered as a stream: one
piece of output at a time, so a task holds one batch of rows and one text, however long a
conversation is. The output is a table of pieces; those of a conversation, joined in order,
are its formatted text, and the marked ones are what a model is trained to say. Reading
back parses these pieces alone.

A conversation is one sequence: its digest needs its turns one after another, so a very
large one takes one task long, in bounded memory.

Cases: a null text or role counts as empty. Rows of one turn go by role, then text; a null
turn comes first. Rows without a conversation id are one conversation, with a null id.
Repeated rows are repeated turns. Texts and roles may hold control strings: they are escaped
and read back as they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import templates

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' ~ '' }}{{ message.role | escape | one_line }}{{ '\\n' }}"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{% endfor %}"
)
PIECES = "conv_id bigint, piece bigint, text string, generated boolean"
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)
_ROWS = 2_000  # pieces in a batch of output
_CHARS = 1 << 22  # or characters


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


class _Out:
    """Collects rows into batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, row: tuple, chars: int) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.chars += chars
        return self.flush() if len(self.rows) >= _ROWS or self.chars > _CHARS else None

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        self.rows, self.chars = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


_PIECE_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("generated", pa.bool_())]
)
_READ_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _renderer(source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, out = templates.compile_template(source), _Out(_PIECE_SCHEMA)
        for conversation, rows in groupby(_rows(batches), key=lambda row: row[0]):
            messages = ({"role": role or "", "text": text or ""} for _, role, text in rows)
            for k, (text, generated) in enumerate(render({"messages": messages})):
                if batch := out.add((conversation, k, text, generated), len(text)):
                    yield batch
        yield out.flush()

    return run


def format_conversations(
    turns: DataFrame,
    template: str = TEMPLATE,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, piece, text, generated): the formatted conversations in pieces. The pieces
    of a conversation follow each other, in order, in one partition."""
    templates.compile_template(template)  # report mistakes here, not in a task
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(_renderer(template), PIECES)
    )


def _turns(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Role and text of each turn, read from the formatted text."""
    held = ""
    for piece in pieces:
        held += piece
        while (at := held.find(END + "\n")) >= 0:
            whole, held = held[:at], held[at + len(END) + 1 :]
            role, _, text = whole.removeprefix(START).partition("\n")
            yield templates.unescape(templates.many_lines(role)), templates.unescape(text)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(_READ_SCHEMA)
    for conversation, rows in groupby(_rows(batches), key=lambda row: row[0]):
        said, learned = hashlib.sha256(), hashlib.sha256()
        sizes = {"turns": 0, "loss": 0, "all": 0}

        def pieces(rows=rows, learned=learned, sizes=sizes):
            for _, _, text, generated in rows:
                sizes["all"] += len(text)
                if generated:
                    plain = templates.unescape(text)
                    sizes["loss"] += len(plain)
                    learned.update(plain.encode("utf-8", "surrogatepass"))
                yield text

        for role, text in _turns(pieces()):
            sizes["turns"] += 1
            said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        row = (conversation, sizes["turns"], said.hexdigest(), sizes["loss"], learned.hexdigest(), sizes["all"])
        if batch := out.add(row, 0):
            yield batch
    yield out.flush()


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, from its pieces in order: turns, the digest of role and text of
    each, characters and digest of the marked text, characters of all."""
    return pieces.mapInArrow(_reader, READ)
