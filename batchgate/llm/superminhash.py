"""SuperMinHash signatures: one random permutation of the slots for each element.

Element e puts the value ``j + r`` (r uniform in [0, 1), new for each level j) into slot ``p(j)`` of its
own permutation p, and each slot keeps its smallest value.  Two sets agree in a slot with a probability
of their Jaccard similarity, with less variance than independent hashes give.  Values of a level are
below all of the next one, so levels run one after another over all elements at once, and a set leaves
as soon as all of its slots are filled: after the first level or two if it is large.

Values are integers: the level in the upper 32 bits, r in the lower ones.
"""

from __future__ import annotations

import numpy as np

from batchgate.llm.wordhash import mix, numbers

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
_STEP = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)
#: Elements handled at once; permutations take ``slots`` times two bytes for each.
CHUNK = 1 << 14


def _level(elements: np.ndarray, j: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Each element's value at level ``j``, and the place that it swaps with place ``j``."""
    random = mix(elements + _STEP * np.array([j + 1], dtype=np.uint64))
    place = np.uint64(j) + ((random & _LOW) * np.uint64(slots - j) >> np.uint64(32))
    return (np.uint64(j) << np.uint64(32)) | (random >> np.uint64(32)), place.astype(np.int64)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values for each set of 64-bit numbers; an empty set's row is all ones."""
    out = np.full((len(sets), slots), _EMPTY, dtype=np.uint64)
    order = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: len(sets[i]))
    chunk: list[int] = []
    size = 0
    for i in order:
        if chunk and size + len(sets[i]) > CHUNK:
            out[chunk] = _together([sets[k] for k in chunk], slots)
            chunk, size = [], 0
        chunk.append(i)
        size += len(sets[i])
    if chunk:
        out[chunk] = _together([sets[k] for k in chunk], slots)
    return out


def _together(sets: list[np.ndarray], slots: int) -> np.ndarray:
    out = np.full(len(sets) * slots, _EMPTY, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    value, place = _level(elements, 0, slots)
    np.minimum.at(out, owner * slots + place, value)
    table = out.reshape(len(sets), slots)
    order = None
    for j in range(1, slots):
        open_sets = (table == _EMPTY).any(axis=1)
        if not open_sets.any():
            break
        keep = open_sets[owner]
        if not keep.all():
            owner, elements = owner[keep], elements[keep]
            place, order = place[keep], None if order is None else order[keep]
        rows = np.arange(len(elements))
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
        # What level j - 1 swapped.
        taken = order[rows, place]
        order[rows, place] = order[:, j - 1]
        order[:, j - 1] = taken
        value, place = _level(elements, j, slots)
        np.minimum.at(out, owner * slots + order[rows, place], value)
    return table


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each set and band of ``rows`` neighbouring slots."""
    values = mix(table[:, : bands * rows].reshape(len(table), bands, rows))
    places = numbers(bands * rows, 11).reshape(bands, rows)
    return mix((values * places).sum(axis=2, dtype=np.uint64)).view(np.int64)


def nibble_sketch(table: np.ndarray) -> np.ndarray:
    """Four bits for each slot, 16 slots to a number.  Slots that differ agree there once in 16."""
    bits = (mix(table) & np.uint64(15)).reshape(len(table), -1, 16)
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(bits << shift, axis=2).view(np.int64)
