"""Cost-balanced packing of token sequences (operator 4).

Each task packs the documents it reads, so nothing is shuffled and no group can grow hot.  A document's
ids are cut into whole sequences and a remainder.  Remainders wait in a bounded block; once it is full
they are assigned in descending length, each to the sequence of lowest cost that still has room for it.
The cost of a piece is linear plus quadratic in its length, as attention runs within pieces.  A remainder
that no sequence has room for is cut to fill the cheapest ones.  Tokens beyond the last whole sequence of
a block move on to the next one; those of a task's last block go to sequences whose lengths are powers of
two, which need no padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.tokenids import ID, encoder

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long"
)
_ARROW = pa.schema(
    [
        (name, pa.binary() if kind == "binary" else pa.int64())
        for name, kind in (part.split() for part in SCHEMA.split(", "))
    ]
)


class Packer:
    """Packs pieces ``(doc_id, start, ids, doc_tokens)`` of one task into sequences."""

    def __init__(self, size: int, block_tokens: int, linear: float, quadratic: float, first_id: int):
        self.size, self.block_tokens, self.next_id = size, block_tokens, first_id
        self.linear, self.quadratic = linear, quadratic
        self.waiting: list[tuple] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def _put(self, piece: tuple, sequence: int, offset: int, total: int) -> None:
        doc, start, ids, n = piece
        self.rows.append((doc, start, len(ids), ids.tobytes(), n, sequence, offset, total))

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.size
        for start in range(0, whole, self.size):
            self._put((doc, start, ids[start : start + self.size], n), self.next_id, 0, self.size)
            self.next_id += 1
        if whole < n:
            self.waiting.append((doc, whole, ids[whole:], n))
            self.tokens += n - whole
        if self.tokens >= self.block_tokens:
            self.pack(self.tokens // self.size)

    def pack(self, sequences: int) -> None:
        """Fill so many whole sequences from the waiting pieces; what is left keeps waiting."""
        cost, room = np.zeros(sequences), np.full(sequences, self.size)
        self.waiting.sort(key=lambda p: -len(p[2]))
        left, free = [], sequences * self.size
        for piece in self.waiting:
            while piece is not None and free:
                doc, start, ids, n = piece
                fits = room >= len(ids)
                if not fits.any():
                    fits = room > 0
                at = int(np.where(fits, cost, np.inf).argmin())
                k = min(len(ids), int(room[at]))
                self._put((doc, start, ids[:k], n), self.next_id + at, self.size - int(room[at]), self.size)
                cost[at] += self.linear * k + self.quadratic * k * k
                room[at] -= k
                free -= k
                piece = (doc, start + k, ids[k:], n) if k < len(ids) else None
            if piece is not None:
                left.append(piece)
        self.next_id += sequences
        self.waiting, self.tokens = left, sum(len(p[2]) for p in left)

    def finish(self) -> None:
        self.pack(self.tokens // self.size)
        stream = self.waiting
        for total in (1 << b for b in reversed(range(self.tokens.bit_length())) if self.tokens >> b & 1):
            offset = 0
            while offset < total:
                doc, start, ids, n = stream.pop(0)
                k = min(len(ids), total - offset)
                self._put((doc, start, ids[:k], n), self.next_id, offset, total)
                offset += k
                if k < len(ids):
                    stream.insert(0, (doc, start + k, ids[k:], n))
            self.next_id += 1
        self.waiting, self.tokens = [], 0

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in _ARROW]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
        )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    block_tokens: int = 1 << 20,
    remembered: int = 400_000,
    special_tokens: bool = False,
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``size`` tokens.

    A null or empty text is the end id alone; a null id is kept; repeated rows are packed each for
    itself; an empty table gives no pieces; other columns are ignored.  Among sequences of equal cost
    the first is taken.  ``remembered`` chunks of text are kept by each worker: fewer take less memory and
    more time, and change no result.  With ``special_tokens`` their strings in a text are those tokens, else
    ordinary text.  Sequence ids are unique, not contiguous.  ``docs`` should come from files or a
    staged table, so that a task that is run again reads its rows in the same order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = encoder(tokenizer_path, remembered, special_tokens)
        end = np.array([end_id], dtype=ID).tobytes()
        packer = Packer(size, block_tokens, linear, quadratic, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc.as_py(), np.frombuffer(tokens.encode(text.as_py() or "") + end, dtype=ID))
                if len(packer.rows) >= 2_000:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    columns = F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    return docs.select(*columns).mapInArrow(run, SCHEMA)
