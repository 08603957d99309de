"""A run-length grammar by recompression, and exact extensions of repeats by it (part of operator 11).

Level 0 is a sequence of symbols.  Each further level first makes one symbol of each block of equal
neighbours, then one of each pair whose first symbol falls in the left half of the alphabet and whose
second falls in the right half; the halves are drawn anew at each level.  Equal symbols get equal names,
so two equal stretches are written alike on every level but for a few symbols at their ends.  How far
two places agree is therefore found by climbing while both stand at the edge of a symbol and walking
down again once symbols differ; blocks of equal symbols are passed in one step.

The first and the last symbol of level 0 must occur nowhere else: no walk gets past them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from batchgate.llm.wordhash import mix


class Level(NamedTuple):
    """One level: its symbols, and for each place the block of equal symbols around it."""

    symbol: np.ndarray
    block_first: np.ndarray
    block_last: np.ndarray
    #: First and last place of the level below that each place stands for; None on level 0.
    child_first: np.ndarray | None
    child_last: np.ndarray | None
    #: Place of the level above that holds each place, and whether it is that one's first or last child.
    parent: np.ndarray | None
    opens: np.ndarray | None
    closes: np.ndarray | None


def _named(keys: np.ndarray) -> np.ndarray:
    """Small numbers, equal for equal keys."""
    return pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)


def grammar(symbols: np.ndarray, least: int = 64) -> list[Level]:
    """Levels from ``symbols`` (small numbers) up to one of at most ``least`` places."""
    levels: list[Level] = []
    symbol, child_first, child_last = symbols.astype(np.int64), None, None
    most = 16 + 4 * int(len(symbols)).bit_length()
    while True:
        first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        last = np.append(first[1:], len(symbol)) - 1
        size = last - first + 1
        block_first = np.repeat(first, size).astype(np.int32)
        block_last = np.repeat(last, size).astype(np.int32)
        if len(symbol) <= least or len(levels) == most:
            levels.append(Level(symbol, block_first, block_last, child_first, child_last, None, None, None))
            return levels
        block = _named(symbol[first] * (size.max() + 1) + size)
        left = (mix(block.astype(np.uint64) + np.uint64((len(levels) + 1) << 40)) & np.uint64(1)).astype(bool)
        joined = left[:-1] & ~left[1:]
        turned = ~left[:-1] & left[1:]
        if turned.sum() > joined.sum():
            joined = turned
        # A block that is the second of a pair belongs to the parent of the one before.
        begins = np.concatenate([[True], ~joined])
        head = np.flatnonzero(begins)
        tail = np.append(head[1:], len(first)) - 1
        second = np.where(tail > head, block[tail] + 1, 0)
        above = _named(block[head] * (block.max() + 2) + second)
        opens, closes = np.zeros(len(symbol), dtype=bool), np.zeros(len(symbol), dtype=bool)
        opens[first[head]] = True
        closes[last[tail]] = True
        parent = np.repeat((np.cumsum(begins) - 1).astype(np.int32), size)
        levels.append(Level(symbol, block_first, block_last, child_first, child_last, parent, opens, closes))
        symbol, child_first, child_last = above, first[head].astype(np.int32), last[tail].astype(np.int32)


def agreeing(levels: list[Level], x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
    """How many symbols agree from places ``x`` and ``y`` (x < y) on, to the right or to the left."""
    i, j = x.astype(np.int64), y.astype(np.int64)

    def steps(level: Level, asked: np.ndarray) -> None:
        """Pass what the two blocks share."""
        a, b = i[asked], j[asked]
        if forward:
            shared = np.minimum(level.block_last[a] - a, level.block_last[b] - b) + 1
        else:
            shared = -1 - np.minimum(a - level.block_first[a], b - level.block_first[b])
        i[asked] += shared
        j[asked] += shared

    down: list[np.ndarray] = []
    live = np.arange(len(x))
    for level in levels:
        edge = level.opens if forward else level.closes
        if edge is None:
            down.append(live)
            break
        up, stuck = [], []
        while len(live):
            at_edge = edge[i[live]] & edge[j[live]]
            up.append(live[at_edge])
            live = live[~at_edge]
            same = level.symbol[i[live]] == level.symbol[j[live]]
            stuck.append(live[~same])
            live = live[same]
            steps(level, live)
        down.append(np.concatenate([*stuck, live]))
        live = np.concatenate([*up, live])
        i[live], j[live] = level.parent[i[live]], level.parent[j[live]]

    carried = np.zeros(0, dtype=np.int64)
    for depth in range(len(down) - 1, -1, -1):
        level = levels[depth]
        carried = np.concatenate([carried, down[depth]])
        live = carried
        while len(live):
            live = live[level.symbol[i[live]] == level.symbol[j[live]]]
            steps(level, live)
        if depth:
            below = level.child_first if forward else level.child_last
            i[carried], j[carried] = below[i[carried]], below[j[carried]]
    return np.abs(i - x)
