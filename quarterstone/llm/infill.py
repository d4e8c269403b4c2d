"""Fill-in-the-middle examples by piece tables.

A document is a table of descriptors (buffer, start, end) over immutable buffers: its text, and the
three sentinels. Cutting splits descriptors, an arrangement permutes them and puts sentinels
between them, the inverse permutation restores the order. No operation copies text: a table is
written out, or hashed, by going through its descriptors.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import text_or_empty, tidied

# The sentinels before prefix, suffix and middle, in the parts' order in a text.
SENTINELS = (b"<P>", b"<M>", b"<S>")
PREFIX, MIDDLE, SUFFIX = range(3)
# The parts' order in the output of each form.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

ARRANGED = "form string, n long, prefix_chars long, middle_chars long, output string, output_sha256 string"
RESTORED = "text string, restored_sha256 string"


@dataclass(frozen=True)
class Piece:
    buffer: memoryview
    start: int
    end: int

    @property
    def view(self) -> memoryview:
        return self.buffer[self.start:self.end]


class PieceTable:
    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces

    @classmethod
    def of(cls, text: bytes | memoryview) -> PieceTable:
        return cls([Piece(memoryview(text), 0, len(text))])

    def cut(self, *places: int) -> PieceTable:
        """Descriptors split at ascending offsets of the whole; an offset at an edge gives an empty piece."""
        pieces, at = [], 0
        places = list(places)
        for piece in self.pieces:
            size, start = piece.end - piece.start, piece.start
            while places and places[0] <= at + size:
                middle = piece.start + places.pop(0) - at
                pieces.append(Piece(piece.buffer, start, middle))
                start = middle
            pieces.append(Piece(piece.buffer, start, piece.end))
            at += size
        return PieceTable(pieces)

    def permuted(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable([self.pieces[i] for i in order])

    def restored(self, order: tuple[int, ...]) -> PieceTable:
        """The inverse of ``permuted``."""
        return self.permuted(tuple(int(i) for i in np.argsort(order)))

    def headed(self, heads: tuple[bytes, ...]) -> PieceTable:
        """A whole sentinel before each piece."""
        return PieceTable([p for head, piece in zip(heads, self.pieces) for p in (Piece(memoryview(head), 0, len(head)), piece)])

    def written(self) -> bytes:
        return b"".join(piece.view for piece in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for piece in self.pieces:
            digest.update(piece.view)
        return digest.hexdigest()


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers from the document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def line_ends(text: np.ndarray) -> np.ndarray:
    """Where each line ends; what follows the last line feed is a line if it is not empty."""
    ends = np.flatnonzero(text == 10) + 1
    return ends if not len(text) or text[-1] == 10 else np.append(ends, len(text))


def code_points(text: np.ndarray) -> int:
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def arrange(text: bytes, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple[str, int, int | None, int | None, PieceTable]:
    """Form, number of lines, code points of prefix and middle, and the table of the output."""
    data = np.frombuffer(text, np.uint8)
    ends = line_ends(data)
    n = len(ends)
    a, b, c, d = draws(seed, doc_id)
    table = PieceTable.of(text)
    if not text or any(s in text for s in SENTINELS) or c % 100 >= rate:
        return "plain", n, None, None, table
    form = "spm" if d % 100 < spm else "psm"
    first, second = sorted((a % (n + 1), b % (n + 1)))
    first, second = (int(ends[k - 1]) if k else 0 for k in (first, second))
    order = ORDERS[form]
    output = table.cut(first, second).permuted(order).headed(tuple(SENTINELS[i] for i in order))
    return form, n, code_points(data[:first]), code_points(data[first:second]), output


def rebuild(output: bytes, form: str) -> PieceTable:
    """The table of the text behind an output: pieces between the sentinels, in the inverse order."""
    table = PieceTable.of(output)
    if form == "plain":
        return table
    order, places, at = ORDERS[form], [], 0
    for i in order:
        at = output.index(SENTINELS[i], at)
        places += [at, at + len(SENTINELS[i])]
        at = places[-1]
    # empty, sentinel, part, sentinel, part, sentinel, part
    return table.cut(*places).permuted((2, 4, 6)).restored(order)


def _slices(batch: pa.RecordBatch, size: int):
    """Parts of a batch of some ``size`` bytes of text, one row at least, with their texts as bytes."""
    texts = pc.fill_null(batch.column(batch.num_columns - 1).cast(pa.large_binary()), b"")
    lengths = pc.binary_length(texts).to_numpy()
    at = 0
    while at < batch.num_rows:
        held, to = 0, at
        while to < batch.num_rows and (to == at or held + lengths[to] <= size):
            held += lengths[to]
            to += 1
        yield batch.slice(at, to - at), texts.slice(at, to - at).to_pylist()
        at = to


def _arrange_batches(id_at: int, seed: int, rate: int, spm: int, size: int):
    def run(batches):
        for batch in batches:
            for part, texts in _slices(batch, size):
                rows = [arrange(t, i, seed, rate, spm) for t, i in zip(texts, part.column(id_at).to_pylist())]
                form, n, prefix, middle, tables = zip(*rows)
                written = [t.written() for t in tables]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(form), pa.array(n, pa.int64()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array(written, pa.binary()).cast(pa.string()), pa.array([t.sha256() for t in tables])],
                    [*part.schema.names[:-1], *(c.split()[0] for c in ARRANGED.split(", "))])
    return run


def _rebuild_batches(form_at: int, size: int):
    def run(batches):
        for batch in batches:
            for part, outputs in _slices(batch, size):
                tables = [rebuild(o, f) for o, f in zip(outputs, part.column(form_at).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([t.written() for t in tables], pa.binary()).cast(pa.string()),
                     pa.array([t.sha256() for t in tables])], [*part.schema.names[:-1], "text", "restored_sha256"])
    return run


def _fields(frame: DataFrame, columns: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    return "".join(f"`{c}` {kinds[c]}, " for c in columns)


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, columns: tuple[str, ...] = (),
              size: int = 1 << 22) -> DataFrame:
    """A row per document: doc_id, further ``columns`` of the documents, form, n, prefix_chars, middle_chars, output, output_sha256.

    Units are lines (n of them). Of 100 documents about ``rate`` are rearranged, ``spm`` in 100 of these with the suffix
    first; the others, empty texts and texts that contain a sentinel stay as they are (plain, no
    counts). Cuts and form follow from the seed and doc_id alone, so that reruns and other
    partitionings agree; rows without doc_id draw as from an empty id. A null text is empty. Repeated rows come back as
    often as given, empty tables empty; columns not named are not read. Texts are taken whole, about
    ``size`` bytes at a time and one text at least.
    """
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(f"`{c}`") for c in columns], text_or_empty().alias("text"))
    kept = given.columns[:-1]
    return given.mapInArrow(tidied(_arrange_batches(0, seed, rate, spm, size)), _fields(given, kept) + ARRANGED)


def restore(rows: DataFrame, columns: tuple[str, ...] = ("doc_id",), size: int = 1 << 22) -> DataFrame:
    """``columns`` of the rows, form, text and restored_sha256: the texts behind ``output`` and ``form``.

    A null output is empty, a null form plain. An output that lacks a sentinel of its form stops the
    job, since its text is not known.
    """
    given = rows.select(*[F.col(f"`{c}`") for c in columns], F.coalesce("form", F.lit("plain")).alias("form"),
                        F.coalesce("output", F.lit("")).alias("output"))
    kept = given.columns[:-1]
    return given.mapInArrow(tidied(_rebuild_batches(len(columns), size)), _fields(given, kept) + RESTORED)


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM texts),
cut AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:n], '') AS s
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""
