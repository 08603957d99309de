"""Passages of three or more lines that other documents have had before (operator 1).

Every three consecutive lines of a document are a window, known by 128 bits of hash.  The first
occurrence of a window, by document id and position, stays; later ones cover their lines, and lines that
any later occurrence covers go.  Only hashes and positions are staged and shuffled: once to find the windows that
occur more than once, combined before the shuffle, and once to find their later occurrences.

A line of more than LONG words counts as several: it is cut after each word that is the longest, and of
equally long ones the last by its bytes, among its REACH neighbours to both sides.  Where a line is cut
depends on the words around alone, so a passage inside a long line is cut alike wherever it stands, and
every part has more than REACH words but the line's last.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import bounded, splittable, stage
from batchgate.llm.periodic_runs import words_of
from batchgate.llm.wordhash import mix, numbers

WINDOW = 3
#: Words from which on a line is cut, and neighbours to each side that a cut's word outdoes.
LONG, REACH = 24, 4
#: Characters of texts that are handled at once, unless one text has more.
SLICE = 1 << 20
WINDOWS = "doc_id long, pos int, key struct<a: long, b: long>"
_SALT = numbers(2 * WINDOW + 2, 41)
_BASES = numbers(2, 44)
_BYTES = [numbers(256, 45 + side) for side in (0, 1)]
_REMOVED = ("removed_lines", "removed_parts")


class Layout(NamedTuple):
    """Lines and parts of some texts; parts are lines, or what long ones are cut into.

    ``lines`` of all texts, ``line_first`` of each text (and the end), ``part_first`` of each line (and the
    end), ``words`` of all lines, each distinct one once, ``word_first`` of each part (and the end), and
    which lines are ``long``.
    """

    lines: list[str]
    line_first: np.ndarray
    part_first: np.ndarray
    words: pa.DictionaryArray
    word_first: np.ndarray
    long: np.ndarray


def _outdoing(rank: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Words that outdo their neighbours in the line: those before strictly, those after at least."""
    # As many places without a word between lines as a neighbourhood reaches.
    place = np.arange(len(rank)) + REACH * (line + 1)
    held = np.full(len(rank) + REACH * (int(line[-1]) + 2), -1, dtype=np.int64)
    held[place] = rank
    best = np.ones(len(rank), dtype=bool)
    for k in range(1, REACH + 1):
        best &= (rank > held[place - k]) & (rank >= held[place + k])
    return best


def layout(texts: list[str]) -> Layout:
    """Cut texts into lines, and long lines into parts."""
    each = [t.split("\n") for t in texts]
    lines = [x for e in each for x in e]
    words, first = words_of(pa.array(lines, type=pa.large_string()))
    n = np.diff(first)
    long = n > LONG
    begins = np.zeros(len(words) + 1, dtype=bool)
    begins[first[:-1][n > 0]] = True
    mine = np.repeat(long, n)
    coded = words.dictionary_encode()
    if mine.any():
        known = pa.table({"n": pc.utf8_length(coded.dictionary.cast(pa.large_string())), "w": coded.dictionary})
        rank = np.empty(len(known), dtype=np.int64)
        rank[pc.sort_indices(known, [("n", "ascending"), ("w", "ascending")]).to_numpy()] = np.arange(len(known))
        line = np.repeat(np.cumsum(long)[long] - 1, n[long])
        at = np.flatnonzero(mine)
        cut = at[_outdoing(rank[coded.indices.to_numpy()[at]], line)]
        begins[cut + 1] = True
    begins[-1] = False
    # A line without words is a part of none.
    parts = np.maximum(np.add.reduceat(np.append(begins, False), first[:-1]) * (n > 0), 1)
    part_first = np.concatenate([[0], np.cumsum(parts)])
    word_first = np.empty(part_first[-1] + 1, dtype=np.int64)
    word_first[part_first[:-1]] = first[:-1]
    inner = np.setdiff1d(np.flatnonzero(begins), first[:-1], assume_unique=False)
    line = np.searchsorted(first, inner, "right") - 1
    nth = np.arange(len(inner)) - np.searchsorted(line, line)
    word_first[part_first[line] + nth + 1] = inner
    word_first[-1] = len(words)
    return Layout(lines, np.cumsum([0] + [len(e) for e in each]), part_first, coded, word_first, long)


def _bytes_hashed(values: pa.Array, side: int) -> np.ndarray:
    """One number for each text: byte values times powers of an odd base, added up and mixed."""
    values = values.cast(pa.large_binary())
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    size = np.diff(ends)
    out = np.zeros(len(values), dtype=np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        held = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]
        begin = (ends[:-1] - ends[0])[some]
        powers = np.multiply.accumulate(np.full(int(size.max()), _BASES[side], dtype=np.uint64))
        place = np.arange(len(held)) - np.repeat(begin, size[some])
        out[some] = np.add.reduceat(_BYTES[side][held] * powers[place], begin)
    return mix(out + size.astype(np.uint64) * _SALT[side])


def part_hashes(held: Layout) -> list[np.ndarray]:
    """Two numbers for each part: of a line as it is, or of the words of a long line's part."""
    short = pa.array(held.lines, type=pa.large_string()).filter(pa.array(~held.long))
    whole = np.repeat(held.long, np.diff(held.part_first))
    first, size = held.word_first[:-1][whole], np.diff(held.word_first)[whole]
    begin = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(begin, size)
    code = held.words.indices.to_numpy()[place + np.repeat(first, size)]
    weight = numbers(int(size.max()) if len(size) else 1, 43)[place]
    out = []
    for side in (0, 1):
        h = np.empty(len(whole), dtype=np.uint64)
        h[~whole] = _bytes_hashed(short, side)
        if len(size):
            word = _bytes_hashed(held.words.dictionary, side)
            h[whole] = mix(np.add.reduceat(word[code] * weight, begin) + size.astype(np.uint64))
        out.append(h)
    return out


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    a, held = 0, 0
    for b, t in enumerate(texts):
        held += len(t)
        if held >= SLICE:
            yield a, b + 1
            a, held = b + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, pos, key`` of each window; positions count parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _slices(texts):
                held = layout(texts[a:b])
                h = part_hashes(held)
                begin = held.part_first[held.line_first]
                n = np.maximum(np.diff(begin) - (WINDOW - 1), 0)
                pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(begin[:-1], n) + pos
                keys = []
                for side in (0, 1):
                    total = np.zeros(len(at), dtype=np.uint64)
                    for j in range(WINDOW):
                        total = mix(total + h[side][at + j] * _SALT[2 + 2 * j + side])
                    keys.append(pa.array(total.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(np.repeat(np.arange(b - a), n))),
                        pa.array(pos.astype(np.int32)),
                        pa.StructArray.from_arrays(keys, names=["a", "b"]),
                    ],
                    names=["doc_id", "pos", "key"],
                )

    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, WINDOWS)


def _place(window: DataFrame) -> Column:
    """Orders windows by document and position, as one number unless ids lie too far apart for that.

    The least number of a group is found by hashing, the least struct only by sorting all rows.
    """
    low, high = window.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or high - low >= 1 << 32:
        return F.struct("doc_id", "pos")
    return F.shiftleft(F.col("doc_id") - F.lit(low).cast("long"), 31) + F.col("pos")


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ranges``: first and last part, from 0, of each stretch that later occurrences cover."""
    window = stage(_windows(docs, id_col, text_col), "windows")
    place = _place(window)
    first = window.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    later = splittable(window, first.where("n > 1").drop("n"), "key", "inner")
    later = later.where(place > F.col("first")).select("doc_id", "pos").distinct()
    # Windows of one document.
    line = Window.partitionBy("doc_id").orderBy("pos")
    later = later.withColumn("gap", (F.col("pos") - F.lag("pos").over(line) > WINDOW).cast("int"))
    later = later.withColumn("stretch", F.sum(F.coalesce("gap", F.lit(0))).over(line))
    merged = later.groupBy("doc_id", "stretch").agg(
        F.min("pos").alias("lo"), (F.max("pos") + (WINDOW - 1)).alias("hi")
    )
    ranges = F.array_sort(F.collect_list(F.struct("lo", "hi")))
    return merged.groupBy("doc_id").agg(ranges.alias("ranges"))


def without(texts: list[str], ranges: list[list[dict]]) -> Iterator[tuple[str, int, int]]:
    """Each text without the parts in its ranges, and how many lines and parts went.

    What is left of a line that is cut has single blanks between its words.
    """
    for a, b in _slices(texts):
        held = layout(texts[a:b])
        gone = np.zeros(held.part_first[-1] + 1, dtype=np.int32)
        first = held.part_first[held.line_first]
        for t, mine in enumerate(ranges[a:b]):
            gone[[first[t] + r["lo"] for r in mine]] += 1
            gone[[first[t] + r["hi"] + 1 for r in mine]] -= 1
        left = np.cumsum(gone[:-1]) == 0
        kept = np.add.reduceat(left.astype(np.int64), held.part_first[:-1])
        size = np.diff(held.part_first)
        for t in range(b - a):
            out, removed = [], 0
            for i in range(held.line_first[t], held.line_first[t + 1]):
                if kept[i] == size[i]:
                    out.append(held.lines[i])
                elif kept[i]:
                    parts = held.part_first[i] + np.flatnonzero(left[held.part_first[i] : held.part_first[i + 1]])
                    words = np.concatenate([np.arange(held.word_first[p], held.word_first[p + 1]) for p in parts])
                    out.append(b" ".join(held.words.take(pa.array(words)).to_pylist()).decode())
                else:
                    removed += 1
            yield "\n".join(out), removed, int((~left[first[t] : first[t + 1]]).sum())


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from the text, and ``n_lines, removed_lines, removed_parts`` added.

    Lines end at newlines and are compared as they are, blank ones too; long ones are compared by their
    parts, and what is left of one that is cut has single blanks between its words.  A document of fewer
    than three lines and parts has no window.  A text all of whose lines go becomes empty; a null text
    stays null, with no lines; an empty text has one, empty line.  ``removed_lines`` counts lines that go
    as a whole.  Rows with a null id stay as they are.  Repeated rows of one id are one document: the
    first occurrence in it stays in each of its rows.  An empty table gives an empty one.  Columns named
    ``n_lines`` or ``removed_lines`` are replaced, all others kept.
    """
    cut = stage(repeated_ranges(docs, id_col, text_col), "ranges")
    cut = cut.withColumnsRenamed({"doc_id": "__cut_id", "ranges": "__cut_ranges"})
    rows = docs.join(bounded(cut, F.size("__cut_ranges")), F.col(id_col).cast("long") == F.col("__cut_id"), "left")
    rows = rows.drop("__cut_id", "n_lines", *_REMOVED)
    n_lines = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"))) + 1
    rows = rows.withColumn("n_lines", F.coalesce(n_lines, F.lit(0)).cast("long"))
    rows = rows.withColumns({c: F.lit(0).cast("long") for c in _REMOVED})
    names = [c for c in rows.columns if c != "__cut_ranges"]
    ranges_at, *changed = (rows.columns.index(c) for c in ("__cut_ranges", text_col, *_REMOVED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, ranges = list(batch.columns), batch.column(ranges_at)
            some = pc.and_(ranges.is_valid(), batch.column(changed[0]).is_valid())
            if some.true_count:
                new = [columns[c].to_pylist() for c in changed]
                rows_cut = np.flatnonzero(some.to_numpy(zero_copy_only=False)).tolist()
                found = without([new[0][i] for i in rows_cut], [ranges[i].as_py() for i in rows_cut])
                for i, value in zip(rows_cut, found, strict=True):
                    for values, v in zip(new, value, strict=True):
                        values[i] = v
                for c, values in zip(changed, new, strict=True):
                    columns[c] = pa.array(values, type=columns[c].type)
            kept = [i for i in range(len(columns)) if i != ranges_at]
            yield pa.RecordBatch.from_arrays([columns[i] for i in kept], names=[batch.schema.names[i] for i in kept])

    return rows.mapInArrow(run, rows.select(*[F.col(f"`{c}`") for c in names]).schema)
