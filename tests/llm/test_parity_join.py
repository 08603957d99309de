"""The parity-sketch join, against a comparison of all pairs."""

from __future__ import annotations

import random

import numpy as np

from batchgate.llm import parity_join
from batchgate.llm.wordhash import numbers

from .conftest import frame


def plain_sets(rows):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    out = []
    for d, text in rows:
        w = (text or "").translate(lower).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        k = min(3, len(w))
        out.append((d, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()))
    return out


def plain_links(sets):
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if a is not None and b is not None and both and 100 * both >= 90 * (len(x) + len(y) - both):
                yield a, b


def plain_components(sets):
    root = {d: d for d, _ in sets}
    changed = True
    links = list(plain_links(sets))
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
    return root


def check(llm, rows):
    got = parity_join.linked(frame(llm, rows)).collect()
    sets = plain_sets(rows)
    root = plain_components(sets)
    want = sorted(str((d, len(s), root[d])) for d, s in sets)
    assert sorted(str(tuple(r)) for r in got) == want


def changed(rng, words, text, times):
    w = text.split()
    for _ in range(times):
        w[rng.randrange(len(w))] = rng.choice(words)
    return " ".join(w)


def test_links_of_odd_texts(llm, odd):
    check(llm, odd)


def test_links_about_the_threshold(llm, words):
    rng = random.Random(2)
    rows = []
    for n in (8, 10, 11, 12, 20, 21, 22, 40, 60, 61, 200, 700):
        base = " ".join(rng.choice(words) for _ in range(n))
        for times in (0, 1, 1, 2, 3, 5, 8, 13):
            rows.append((len(rows), changed(rng, words, base, min(times, n // 4))))
        rows.append((len(rows), base + " " + rng.choice(words)))
        rows.append((len(rows), base + " " + " ".join(rng.choice(words) for _ in range(n // 10))))
    rng.shuffle(rows)
    check(llm, rows)


def test_links_inside_a_large_family(llm, words):
    """Many texts that are alike, only some of them enough to be linked, and exact copies of each."""
    rng = random.Random(9)
    base = " ".join(rng.choice(words) for _ in range(150))
    texts = [changed(rng, words, base, rng.randint(0, 7)) for _ in range(120)]
    rows = [(d, t) for d, t in enumerate(texts * 2)]
    rng.shuffle(rows)
    check(llm, rows)


def test_links_of_an_empty_table(llm):
    assert parity_join.linked(frame(llm, [])).count() == 0


def test_each_linked_pair_shares_a_piece():
    """Sets that differ as much as a linked pair can, in elements chosen at random, over all sizes."""
    rng = np.random.default_rng(6)
    pool = numbers(1 << 16, 77)
    for a in [*range(9, 90), 150, 333, 1000, 4321, 20_000]:
        apart = 2 * a // parity_join.APART
        for more in {0, apart // 2, apart}:
            # ``more`` elements are added and as many removed as the threshold lets.
            less = next(k for k in range(apart, -1, -1) if 100 * (a - k) >= 90 * (a + more) or k == 0)
            chosen = rng.choice(pool, a + more, replace=False)
            x, y = np.sort(chosen[:a]), np.sort(chosen[less:])
            both = a - less
            if 100 * both < 90 * (a + more):
                continue
            px, py = parity_join._own_and_low(x), parity_join._own_and_low(y)
            assert np.intersect1d(np.concatenate(px), np.concatenate(py)).size
            bits = np.unpackbits((parity_join.sketch(x) ^ parity_join.sketch(y)).view(np.uint8)).sum()
            assert bits <= less + more


def test_bands_leave_no_gap():
    edges = parity_join.band_edges()
    for size in range(9, 3000):
        largest = max(s for s in range(size, size + size // 8 + 2) if 100 * size >= 90 * s)
        band = np.searchsorted(edges, [size, largest], "right") - 1
        assert band[1] - band[0] in (0, 1)
