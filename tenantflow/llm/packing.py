"""Sum-of-squares packing of documents into windows of a fixed number of tokens.

Every task packs the documents of its own partition, in their order, and no row moves
between tasks. A document's whole windows are written at once. The rest is placed
online: of the fill levels that can take it, and a new window, it goes where the sum of
the squared numbers of windows per level grows least. The level array holds these
numbers; the windows of a level wait in a list.

At the end of a task, or when more than ``max_open`` windows wait, the fullest windows
are filled up with pieces cut from the emptiest, so that one window at most is left. Its
tokens are cut into sequences whose lengths are powers of two, which need no padding.

Rows: one for each piece. A null or empty text has the end id as its only token.
Repeated rows and null ids are packed like any other row. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import record_batch, texts_of
from tenantflow.llm.wordcodes import ID_TYPE, MAX_KNOWN, shared_encoder

#: Sequence numbers of a task start at its partition number shifted by this.
_TASK_SHIFT = 36


@dataclass
class Piece:
    """Consecutive tokens of one document, as raw ids. ``doc``: its id and all its tokens."""

    doc: tuple
    start: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // ID_TYPE.itemsize

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        at = tokens * ID_TYPE.itemsize
        return (
            Piece(self.doc, self.start, self.ids[:at]),
            Piece(self.doc, self.start + tokens, self.ids[at:]),
        )


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece)


class Packer:
    """Packs the documents of one task. ``closed`` collects finished sequences."""

    def __init__(self, window: int, max_open: int) -> None:
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.waiting: list[list[Window]] = [[] for _ in range(window)]
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def add(self, doc_id: object, ids: bytes) -> None:
        piece = Piece((doc_id, len(ids) // ID_TYPE.itemsize), 0, ids)
        while len(piece) >= self.window:
            full, piece = piece.cut(self.window)
            self.closed.append([full])
        if len(piece):
            self._place(piece)
        if self.n_open > self.max_open:
            self.drain()

    def _place(self, piece: Piece) -> None:
        size = len(piece)
        level = self._best_level(size)
        if level:
            window = self.waiting[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = Window()
        window.add(piece)
        self._keep(window)

    def _best_level(self, size: int) -> int:
        """The level with the least growth of the sum of squares; 0 is a new window."""
        top = self.window - size
        here, after = self.counts[1 : top + 1], self.counts[size + 1 : self.window + 1]
        growth = 2 * (after - here) + 2
        if top:
            growth[-1] = 1 - 2 * here[-1]  # a full window leaves the array
        growth = np.where(here > 0, growth, np.iinfo(np.int64).max)
        new = 2 * int(self.counts[size]) + 1
        if not len(growth):
            return 0
        best = len(growth) - 1 - int(np.argmin(growth[::-1]))  # of equal ones the fullest
        return best + 1 if growth[best] <= new else 0

    def _keep(self, window: Window) -> None:
        if window.fill == self.window:
            self.closed.append(window.pieces)
            return
        self.waiting[window.fill].append(window)
        self.counts[window.fill] += 1
        self.n_open += 1

    def drain(self) -> None:
        """Fill windows up from the emptiest ones until at most one is open."""
        rest = [window for level in self.waiting for window in level]
        self.waiting = [[] for _ in range(self.window)]
        self.counts[:] = 0
        self.n_open = 0
        low, high = 0, len(rest) - 1
        while low < high:
            target, donor = rest[high], rest[low]
            missing = self.window - target.fill
            piece = donor.pieces.pop()
            donor.fill -= len(piece)
            if len(piece) > missing:
                piece, left = piece.cut(missing)
                donor.add(left)
            target.add(piece)
            if target.fill == self.window:
                self.closed.append(target.pieces)
                high -= 1
            if not donor.pieces:
                low += 1
        if low == high and rest[low].pieces:
            self._keep(rest[low])

    def finish(self) -> None:
        self.drain()
        for level in self.waiting:
            for window in level:
                self._close_in_powers(window)
        self.waiting = [[] for _ in range(self.window)]

    def _close_in_powers(self, window: Window) -> None:
        pieces, left = window.pieces[::-1], window.fill
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            sequence = []
            while room:
                piece = pieces.pop()
                if len(piece) > room:
                    piece, after = piece.cut(room)
                    pieces.append(after)
                sequence.append(piece)
                room -= len(piece)
            self.closed.append(sequence)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = 4096,
    max_open: int = 1024,
    with_ids: bool = False,
    max_known: int = MAX_KNOWN,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``window`` tokens.

    ``with_ids`` adds the tokens of each piece as raw little-endian 32-bit integers.
    ``max_known`` bounds the words that a worker remembers; ids do not depend on it.
    """
    id_field = docs.select(F.col("doc_id")).schema.fields[0]
    schema = T.StructType(
        [
            T.StructField("doc_id", id_field.dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
        + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    )
    arrow = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, max_known)
        end = np.array([end_id], dtype=ID_TYPE).tobytes()
        packer = Packer(window, max_open)
        sequence = TaskContext.get().partitionId() << _TASK_SHIFT
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                packer.add(doc_id, encoder.encode(text) + end)
                if len(packer.closed) >= 2000:
                    yield written(packer.closed, sequence)
                    sequence += len(packer.closed)
                    packer.closed = []
        packer.finish()
        if packer.closed:
            yield written(packer.closed, sequence)

    def written(sequences: list[list[Piece]], first: int) -> pa.RecordBatch:
        rows = []
        for number, pieces in enumerate(sequences, first):
            offset = 0
            for piece in pieces:
                doc_id, tokens = piece.doc
                row = (doc_id, piece.start, len(piece), zlib.crc32(piece.ids), tokens, number, offset)
                rows.append((*row, piece.ids) if with_ids else row)
                offset += len(piece)
        return record_batch(arrow, zip(*rows))

    return docs.select("doc_id", "text").mapInArrow(pack, schema)
