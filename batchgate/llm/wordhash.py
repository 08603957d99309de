"""Words of whole texts as 64-bit numbers, a batch at a time.

A word is a longest run of bytes other than space and 0x09-0x0D, its A-Z lower-cased.  Its number is a
sum of byte values times powers of an odd base, mixed; so is that of a run of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    start = np.uint64(seed) * np.uint64(1_000_003)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + start) * _GOLD) | np.uint64(1)


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between words that are runs of letters: all of ASCII but letters.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = True
_BYTE = numbers(256, 1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = numbers(1, 2)
_PLACE = numbers(64, 3)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins (and the last ends); null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at, data = texts.buffers()
    at = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray, between: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word; no word reaches over the end of a text."""
    solid = ~between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(
    texts: pa.Array, between: np.ndarray = _BLANK, most: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words in order, and the first word of each text (and the last one's end).

    With ``most``, a word counts as its first so many bytes.
    """
    data, at = text_bytes(texts)
    first, last = word_spans(data, at, between)
    byte = np.where(between, np.uint64(0), _BYTE)
    out = np.empty(len(first), dtype=np.uint64)
    for a in range(0, len(first), 1 << 16):
        s = first[a : a + (1 << 16)]
        lengths = last[a : a + (1 << 16)] - s
        lo, hi = s[0], last[min(a + (1 << 16), len(first)) - 1]
        powers = np.multiply.accumulate(np.full(lengths.max() + 1, _BASE[0], dtype=np.uint64))
        place = np.arange(hi - lo) - np.repeat(s - lo, np.diff(np.append(s, hi)))
        value = byte[data[lo:hi]] * powers[np.minimum(place, len(powers) - 1)]
        if most is not None:
            value[place >= most] = 0
            lengths = np.minimum(lengths, most)
        out[a : a + (1 << 16)] = mix(np.add.reduceat(value, s - lo) + lengths.astype(np.uint64))
    return out, np.searchsorted(first, at)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct numbers of all runs of ``k`` words; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, k)
    total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    for j in range(size):
        total += words[j : n - size + 1 + j] * _PLACE[j]
    return np.unique(mix(total))
