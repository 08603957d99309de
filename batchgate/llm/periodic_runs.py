"""Maximal periodic runs of words, and texts with each run cut to its first period (operator 11).

A run is a stretch of words with a smallest period q, at least ``times`` periods and ``least`` words long,
that no neighbouring word extends.  Each task writes the words of some texts as one run-length grammar by
recompression.  For every period p the places 0, (times - 1) p, 2 (times - 1) p, ... of a text are
compared with those p further on: any run of ``times`` periods holds such a pair, and a harmonic sum
bounds their number by n log n.  Where the two words agree, the grammar says exactly how far the
agreement reaches to both sides.  A stretch found by several periods is a run of the smallest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.recompression import agreeing, grammar
from batchgate.llm.wordhash import text_bytes, word_spans

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
#: Bytes of text written as one grammar, unless a single text has more, and pairs compared at a time.
SLICE_BYTES, PAIRS = 1 << 20, 1 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts as one binary array, and the first word of each text (and the last one's end)."""
    data, at = text_bytes(texts)
    first, last = word_spans(data, at)
    edges = np.zeros(len(data) + 1, dtype=np.int8)
    edges[first] += 1
    edges[last] -= 1
    solid = data[np.cumsum(edges[:-1]) > 0]
    ends = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(solid))]
    )
    return words, np.searchsorted(first, at)


def _pairs(n: np.ndarray, at: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``place, period, text`` of all pairs of the harmonic grids, at most about PAIRS at a time."""
    periods = n // times
    text = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (times - 1) * period
    count = -(-(n[text] - period) // step)
    total = np.cumsum(count)
    a = 0
    while a < len(text):
        b = max(int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")), a + 1)
        c = count[a:b]
        which = np.repeat(np.arange(a, b), c)
        place = (np.arange(len(which)) - np.repeat(np.cumsum(c) - c, c)) * step[which]
        yield at[text[which]] + place, period[which], text[which]
        a = b


def runs_of(words: np.ndarray, first: np.ndarray, times: int = 4, least: int = 6) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of all runs, by text, start and period.

    ``words`` are numbers, equal for equal words; ``first`` is the first word of each text, and the end.
    """
    n = np.diff(first)
    texts = len(n)
    # A symbol of its own before the first text and after each.
    shift = np.arange(texts) + 1
    symbols = np.empty(len(words) + texts + 1, dtype=np.int64)
    top = int(words.max()) + 1 if len(words) else 0
    symbols[np.concatenate([[0], first[1:] + shift])] = top + np.arange(texts + 1)
    symbols[np.arange(len(words)) + np.repeat(shift, n)] = words
    levels, at = grammar(symbols, 64 + texts), first[:-1] + shift
    found = [np.zeros((4, 0), dtype=np.int64)]
    for place, period, text in _pairs(n, at, times):
        same = symbols[place] == symbols[place + period]
        x, p, t = place[same], period[same], text[same]
        right = agreeing(levels, x, x + p, True)
        left = agreeing(levels, x - 1, x - 1 + p, False)
        length = left + p + right
        long = length >= np.maximum(least, times * p)
        found.append(np.stack([t, x - left - at[t], length, p])[:, long])
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of a batch of at most SLICE_BYTES of text, or of one text."""
    size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
    a = 0
    while a < len(size):
        b = max(int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE_BYTES, "right")), a + 1)
        yield a, b
        a = b


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, least: int = 6
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row; runs are ordered by start, then period.

    Words are cut at bytes 0x20 and 0x09-0x0D and compared as they are; ``start`` counts words from 0.
    ``collapsed`` is the text without the words that some run holds after its first period, joined by
    single spaces.  A null or empty text, or one of blanks, has no words, no runs and an empty
    ``collapsed``.  Each row is judged by itself, so null and repeated ids, ties and repeated rows need
    no rule; an empty table gives an empty one; other columns are ignored.  A map: nothing is shuffled.
    """
    if times < 2 or least < 1:
        raise ValueError("runs need at least two periods and one word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(batch.column(1)):
                part = batch.slice(a, b - a)
                words, first = words_of(part.column(1))
                numbers = words.dictionary_encode().indices.to_numpy()
                text, start, length, period = runs_of(numbers, first, times, least)
                covered = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(covered, first[text] + start + period, 1)
                np.add.at(covered, first[text] + start + length, -1)
                kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
                rest = pa.LargeListArray.from_arrays(np.searchsorted(kept, first), words.take(pa.array(kept)))
                runs = pa.StructArray.from_arrays(
                    [pa.array(c, type=pa.int64()) for c in (start, length, period)], fields=list(_RUN)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(first), type=pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.searchsorted(text, np.arange(len(first))), type=pa.int32()), runs
                        ),
                        pc.binary_join(rest, pa.scalar(b" ", type=pa.large_binary())).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RUNS)
