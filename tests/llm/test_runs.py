"""Periodic runs by recompression, against plain code."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from batchgate.llm import periodic_runs, queries
from batchgate.llm.recompression import agreeing, grammar

from .conftest import frame


def plain_runs(w, times=4, least=6):
    """``(start, length, period)`` by comparing all words with those p further on, for all p."""
    found = {}
    for p in range(1, len(w) // times + 1):
        i = 0
        while i + p < len(w):
            if w[i] == w[i + p]:
                start = i
                while i + p < len(w) and w[i] == w[i + p]:
                    i += 1
                if i - start + p >= max(least, times * p):
                    found.setdefault((start, i - start + p), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def check(llm, rows, **how):
    got = periodic_runs.find_runs(frame(llm, rows), **how).collect()
    assert len(got) == len(rows)

    def plain(d, text):
        w = words(text)
        runs = plain_runs(w, **how)
        return str((d, len(w), [tuple(r) for r in runs], collapsed(w, runs)))

    assert sorted(str((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got) == sorted(
        plain(d, t) for d, t in rows
    )


def random_words(rng, letters):
    w = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
    if rng.random() < 0.7:
        w += [rng.choice(letters) for _ in range(rng.randint(1, 7))] * rng.randint(2, 20)
        w += [rng.choice(letters) for _ in range(rng.randint(0, 9))]
    return w


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghij"])
def test_runs_of_random_texts(llm, letters):
    rng = random.Random(len(letters))
    check(llm, [(d, " ".join(random_words(rng, letters))) for d in range(60)])


def test_runs_of_odd_texts(llm, odd):
    check(llm, odd)


def test_runs_of_fewer_periods(llm):
    rng = random.Random(3)
    check(llm, [(d, "\n".join(random_words(rng, "abc"))) for d in range(40)], times=2, least=5)


def test_runs_of_an_empty_table(llm):
    assert periodic_runs.find_runs(frame(llm, [])).count() == 0


def test_runs_need_two_periods(llm):
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.find_runs(frame(llm, []), times=1)


def test_one_run_of_a_very_long_text(llm):
    text = "x " + "one two three four five " * 60_000 + "y"
    (row,) = periodic_runs.find_runs(frame(llm, [(1, text)])).collect()
    assert [tuple(r) for r in row.runs] == [(1, 300_000, 5)]
    assert row.collapsed == "x one two three four five y"


def test_words_keep_their_case_and_texts_their_borders(llm):
    check(llm, [(1, "a A " * 8), (2, "a a a"), (3, "a a a"), (4, "a" * 40)])


def test_extensions_to_both_sides():
    rng = np.random.default_rng(4)
    symbols = np.concatenate([[9], rng.integers(0, 3, 700), np.tile([1, 2], 150), [1] * 90, [8]])
    levels = grammar(symbols, 4)
    x = rng.integers(1, len(symbols) - 2, 500)
    y = rng.integers(x + 1, len(symbols) - 1)
    right, left = agreeing(levels, x, y, True), agreeing(levels, x, y, False)
    for a, b, r, n in zip(x, y, right, left, strict=True):
        assert (symbols[a : a + r] == symbols[b : b + r]).all() and symbols[a + r] != symbols[b + r]
        assert (symbols[a - n + 1 : a + 1] == symbols[b - n + 1 : b + 1]).all() and symbols[a - n] != symbols[b - n]


def test_the_query_on_documents_with_periods(llm):
    docs = {r.doc_id: words(r.text) for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.QUERIES["op11_periodic_runs"](llm, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    turned = 0
    for r in got:
        w = docs[r.doc_id]
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g, turned = h // 10, turned + 1
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + i % p] for i in range(len(w) - a)]
        runs = plain_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        said = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert turned
