"""Fill-in-the-middle by piece tables: nothing is copied until the bytes are asked for.

A document is a list of descriptors (buffer, first byte, bytes) over two immutable buffers, its
text and the sentinels. Cutting splits the one descriptor of the text at two code points, a
form arranges the parts with sentinels before them, and the inverse arrangement restores them.
Digests run along the descriptors. Restoring sees the output and the form alone: it finds the
sentinels in the output, which becomes the text buffer of a table of its own, cuts there, and
arranges the parts in the order of the text.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_of, in_tasks, pieces_of, text_rows

TEXT, SENTINEL = 0, 1
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = (SENTINELS[i:i + 3] for i in (0, 3, 6))
# Parts in the order of the output; a part's number is its place in the text.
FORMS = {"plain": (), "psm": (0, 2, 1), "spm": (2, 0, 1)}
# The sentinel before each part of the text: prefix, middle, suffix.
MARKS = (0, 6, 3)
PLAIN_FROM, SPM_BELOW = 90, 20


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def arranged(parts: list[Piece], form: str) -> list[Piece]:
    """The pieces of an output: each part of the form behind its sentinel."""
    if not FORMS[form]:
        return parts
    return [p for i in FORMS[form] for p in (Piece(SENTINEL, MARKS[i], 3), parts[i])]


def split(piece: Piece, first: int, second: int) -> list[Piece]:
    """A piece cut after ``first`` and ``second`` of its bytes."""
    return [Piece(piece.buffer, piece.start, first), Piece(piece.buffer, piece.start + first, second - first),
            Piece(piece.buffer, piece.start + second, piece.length - second)]


def parted(output: bytes, form: str) -> list[Piece]:
    """The parts of an output in the order of the text, found by its sentinels."""
    order = FORMS[form]
    whole = Piece(TEXT, 0, len(output))
    if not order:
        return [whole]
    marks = [SENTINELS[MARKS[i]:MARKS[i] + 3] for i in order]
    second = output.index(marks[1], 3)
    third = output.index(marks[2], second + 3)
    behind = [Piece(TEXT, a, b - a) for a, b in ((3, second), (second + 3, third), (third + 3, len(output)))]
    return [behind[order.index(i)] for i in range(3)]


def digest(pieces: list[Piece], buffers: tuple) -> str:
    """Hex SHA-256 along the pieces."""
    running = hashlib.sha256()
    for buffer, start, length in pieces:
        running.update(buffers[buffer][start:start + length])
    return running.hexdigest()


def rendered(pieces: list[Piece], buffers: tuple) -> bytes:
    return b"".join(buffers[b][s:s + n] for b, s, n in pieces)


def _draws(key) -> list:
    """h1 to h4 of a document, from its id; a null id is written as nothing."""
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(name, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _text_bytes(batch: pa.RecordBatch):
    """(bytes, ends of texts, byte of every code point, ends of texts in code points)."""
    texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = memoryview(texts.buffers()[2])[low:high] if high > low else memoryview(b"")
    ends = offsets - low
    begins = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) if high > low else np.zeros(0, np.int64)
    return data, ends, np.append(begins, high - low), np.searchsorted(begins, ends)


_TABLE = ("key long, n long, form string, prefix_chars long, middle_chars long, "
          "pieces array<struct<buffer:int,start:long,length:long>>, output string, output_sha256 string")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document cut, arranged and rendered: the columns of ``_TABLE`` with doc_id for key.

    ``pieces`` are the descriptors of the output over the document's UTF-8 text (buffer 0) and
    ``SENTINELS`` (buffer 1); ``output_sha256`` is taken along them. The cuts and the form follow
    from the id alone, so a repeated run agrees; a text that is empty or holds a sentinel stays
    plain. A null text is empty; a null id stays null and counts as no digits; rows that repeat
    an id are cut each; other columns are passed over; an empty table gives no rows.
    """
    rows = text_rows(docs, id_col, text_col)
    drawn = rows.select("key", "text", *[h.alias(f"h{i + 1}") for i, h in enumerate(_draws(id_of(F.col("key"))))])
    schema = pa.schema([
        ("key", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("pieces", pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))),
        ("output", pa.string()), ("output_sha256", pa.string())])

    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                yield _transformed(part, schema)

    return in_tasks(drawn, work, _TABLE).withColumn("doc_id", id_of(F.col("key"))).drop("key")


def _transformed(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    data, ends, points, last = _text_bytes(batch)
    n = np.diff(last)
    h1, h2, h3, h4 = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6))
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    first = points[last[:-1] + low] - ends[:-1]
    second = points[last[:-1] + high] - ends[:-1]
    forms, pieces, outputs, digests = [], [], [], []
    for i in range(batch.num_rows):
        text = bytes(data[ends[i]:ends[i + 1]])
        plain = not text or h3[i] % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
        form = "plain" if plain else "spm" if h4[i] % 100 < SPM_BELOW else "psm"
        whole = Piece(TEXT, 0, len(text))
        table = arranged([whole] if plain else split(whole, int(first[i]), int(second[i])), form)
        buffers = (text, SENTINELS)
        forms.append(form)
        pieces.append([p._asdict() for p in table])
        outputs.append(rendered(table, buffers))
        digests.append(digest(table, buffers))
    no_cut = np.array([f == "plain" for f in forms], bool)
    return pa.RecordBatch.from_arrays([
        batch.column(0), pa.array(n.astype(np.int64)), pa.array(forms, pa.string()),
        pa.array(low.astype(np.int64), mask=no_cut), pa.array((high - low).astype(np.int64), mask=no_cut),
        pa.array(pieces, schema.field("pieces").type), pa.array(outputs, pa.binary()).cast(pa.string()),
        pa.array(digests, pa.string())], schema=schema)


def restore(outputs: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``outputs`` with restored (the text) and restored_sha256, from output and form alone.

    A null output or form gives nulls; an unknown form, or an output without the sentinels of
    its form, fails. Columns that are called like the new ones are replaced.
    """
    kept = [f for f in outputs.schema if f.name not in ("restored", "restored_sha256")]
    own = outputs.select(*[F.col(f"`{f.name}`") for f in kept])
    at = [own.columns.index(c) for c in (output_col, form_col)]

    def work(batches):
        for batch in batches:
            for rows in pieces_of(batch, output_col):
                texts, digests = [], []
                for output, form in zip(*(rows.column(i).to_pylist() for i in at)):
                    if output is None or form is None:
                        texts.append(None)
                        digests.append(None)
                        continue
                    raw = output.encode()
                    parts, buffers = parted(raw, form), (raw, SENTINELS)
                    texts.append(rendered(parts, buffers).decode())
                    digests.append(digest(parts, buffers))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                    [*rows.schema.names, "restored", "restored_sha256"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return in_tasks(own, work, f"{ddl}, restored string, restored_sha256 string")
