"""Benchmark items in documents, by pigeonhole pieces and bit-parallel edit distance (operator 6).

Words of items and documents are lower-cased and joined by single blanks.  An item of n characters may
differ from a passage of a document by up to a twentieth of n edits, k in number.  Cut into k + 1 pieces,
at least one piece must occur in the passage unchanged; so exact hits of the pieces, found with one
automaton for all items in one pass over each text, give all places where an item can be.  There the
least edit distance of the item to any stretch of text is computed with Myers' bit vectors.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import stage

#: Characters of items that one automaton is built for, some 130 MB of it; more items take more passes over
#: the texts, of which so many run at once, each in a worker of its own.
BLOCK_CHARS, PASSES = 1 << 21, 2
HITS = "doc_id long, item_ids array<long>, distances array<int>"
_WORD = re.compile(r"\w+")


def normalised(text: str | None) -> str:
    """Words in lower case with a blank around each; nothing if there are none."""
    words = _WORD.findall(text.lower()) if text else []
    return f" {' '.join(words)} " if words else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces that make up the item, and where each begins."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Item:
    """One item and the bit masks of its characters."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.id, self.text, self.budget = item_id, text, int(len(text) * rate)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def distance(self, text: str) -> int:
        """Least edit distance to any stretch of ``text``."""
        n = len(self.text)
        full, top = (1 << n) - 1, 1 << (n - 1)
        up, down, score, best, masks = full, 0, n, n, self.masks
        for c in text:
            same = masks.get(c, 0)
            vertical = same | down
            flat = (((same & up) + up) ^ up) | same
            more, less = down | (full & ~(flat | up)), up & flat
            if more & top:
                score += 1
            elif less & top:
                score -= 1
                if score < best:
                    best = score
            more, less = (more << 1) & full, (less << 1) & full
            up, down = less | (full & ~(vertical | more)), more & vertical
        return best


class Block(NamedTuple):
    """Some of the items, normalised, under a name of its own."""

    name: str
    items: list[tuple[int, str]]
    rate: float


_BUILT: dict[str, Matcher] = {}


def matcher(block: Block) -> Matcher:
    """The matcher of a block, built once by each Python worker, which keeps the last one only."""
    if block.name not in _BUILT:
        _BUILT.clear()
        _BUILT[block.name] = Matcher(block.items, block.rate)
    return _BUILT[block.name]


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [Item(i, t, rate) for i, t in items]
        starts: dict[str, list[tuple[int, int]]] = {}
        for at, item in enumerate(self.items):
            for offset, piece in pieces(item.text, item.budget):
                starts.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in starts.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int]]:
        """``(item_id, distance)`` of each item that the normalised text holds."""
        places: dict[int, list[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for at, offset in where:
                places.setdefault(at, []).append(end + 1 - size - offset)
        found = []
        for at, starts in places.items():
            item = self.items[at]
            reach, best = len(item.text) + item.budget, item.budget + 1
            lo = hi = None
            for start in sorted(starts) + [None]:
                if start is not None and hi is not None and start - item.budget <= hi:
                    hi = start + reach
                    continue
                if hi is not None:
                    best = min(best, item.distance(text[max(0, lo) : hi]))
                if start is not None:
                    lo, hi = start - item.budget, start + reach
            if best <= item.budget:
                found.append((item.id, best))
        return sorted(found)


def _blocks(items: DataFrame, block_chars: int, rate: float) -> Iterator[Block]:
    """Items with words, normalised, in blocks of a bounded size on average."""
    items = items.select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = ((r.item_id, normalised(r.text)) for r in part.toLocalIterator())
        held = sorted({(i, t) for i, t in rows if i is not None and t})
        if held:
            yield Block(uuid.uuid4().hex, held, rate)


def _passes(rows: DataFrame, blocks: Iterator[Block], one: Callable[[DataFrame, Block], DataFrame]) -> DataFrame:
    """One map pass over the rows for each block; the rows are staged between so many passes."""
    for n, block in enumerate(blocks):
        if n and n % PASSES == 0:
            rows = stage(rows, "passes")
        rows = one(rows, block)
    return rows


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = 0.05,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_ids, distances`` for each row: the items that its text holds, by id, and how exactly.

    ``items`` has ``item_id, text``; those with a null id or without words match nothing, repeated ones
    count once, and of several texts of one id the best distance counts.  A null or empty text holds no
    item.  Repeated rows and null ids are kept as they are.  An empty table gives an empty one; with no
    items the lists are empty.  Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.array().cast("array<long>").alias("item_ids"),
        F.array().cast("array<int>").alias("distances"),
        F.col(text_col).alias("text"),
    )
    return _passes(rows, _blocks(items, block_chars, rate), _search).drop("text")


def _search(rows: DataFrame, block: Block) -> DataFrame:
    """``rows`` with the block's items added to those found before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher(block).find
        for batch in batches:
            found = []
            for ids, distances, text in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                best = dict(zip(ids, distances, strict=True))
                for item, distance in find(normalised(text)):
                    best[item] = min(distance, best.get(item, distance))
                found.append(sorted(best.items()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[i for i, _ in f] for f in found], type=pa.list_(pa.int64())),
                    pa.array([[d for _, d in f] for f in found], type=pa.list_(pa.int32())),
                    batch.column(3),
                ],
                names=batch.schema.names,
            )

    return rows.mapInArrow(run, HITS + ", text string")


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    rate: float = 0.05,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were, without a shuffle."""
    at = docs.columns.index(text_col)

    def without(rows: DataFrame, block: Block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = matcher(block).find
            for batch in batches:
                clean = [not find(normalised(t.as_py())) for t in batch.column(at)]
                yield batch.filter(pa.array(clean, type=pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    return _passes(docs, _blocks(items, block_chars, rate), without)
