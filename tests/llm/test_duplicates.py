"""Line dedup, SuperMinHash, near duplicates and components."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from batchgate.llm import line_dedup, near_dedup, queries, superminhash, wordhash
from batchgate.llm.components import components

from .conftest import frame


def line_parts(line):
    """Words of each part of a line, or None for a line that is compared as it is."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]
    if len(words) <= line_dedup.LONG:
        return [None]
    key = [(len(w), w.encode()) for w in words]
    parts, near = [[]], line_dedup.REACH
    for i, w in enumerate(words):
        parts[-1].append(w)
        before, after = key[max(0, i - near) : i], key[i + 1 : i + 1 + near]
        if i + 1 < len(words) and all(key[i] > k for k in before) and all(key[i] >= k for k in after):
            parts.append([])
    return parts


def cut_lines(rows):
    """What should stay of each text, by reading all lines in order of id."""
    seen, out = set(), {}
    for d, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        if d in out:
            continue
        lines = text.split("\n")
        units = [(n, p) for n, line in enumerate(lines) for p in line_parts(line)]
        names = [lines[n] if p is None else tuple(p) for n, p in units]
        gone = set()
        for i in range(len(names) - 2):
            window = tuple(names[i : i + 3])
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        left, removed = [], 0
        for n, line in enumerate(lines):
            mine = [i for i, u in enumerate(units) if u[0] == n]
            kept = [i for i in mine if i not in gone]
            if kept == mine:
                left.append(line)
            elif kept:
                left.append(" ".join(w for i in kept for w in units[i][1]))
            else:
                removed += 1
        out[d] = ("\n".join(left), len(lines), removed)
    return out


def check_lines(llm, rows):
    got = line_dedup.drop_repeated_lines(frame(llm, rows)).collect()
    want = cut_lines(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None or r.text is None:
            assert r.removed_lines == r.removed_parts == 0
        else:
            assert (r.text, r.n_lines, r.removed_lines) == want[r.doc_id]
            assert (r.kept, r.start) == ("x", "y")


def test_lines_of_odd_texts(llm, odd):
    check_lines(llm, odd)


def test_lines_of_random_texts(llm):
    rng = random.Random(5)
    check_lines(llm, [(d, "\n".join(rng.choice("abc ") for _ in range(rng.randint(1, 30)))) for d in range(60)])


def test_passages_inside_long_lines(llm, words):
    """60 words that two unrelated documents have inside a line, at its begin, or over two lines' ends."""
    rng = random.Random(31)

    def some(n):
        return [rng.choice(words) + rng.choice(words) for _ in range(n)]

    passage = some(60)
    rows = [
        (1, " ".join(some(40) + passage + some(30))),
        (2, " ".join(some(10)) + "\n" + " ".join(passage + some(50))),
        (3, " ".join(some(90))),
        (4, "\n".join(" ".join(some(20)) for _ in range(8)) + " " + " ".join(passage)),
    ]
    check_lines(llm, rows)
    got = {r.doc_id: r.text.split() for r in line_dedup.drop_repeated_lines(frame(llm, rows)).collect()}
    assert got[1] == rows[0][1].split() and got[3] == rows[2][1].split()
    for d in (2, 4):
        left = sum(w in passage for w in got[d])
        assert left <= 24
        assert [w for w in got[d] if w not in passage] == [w for w in rows[d - 1][1].split() if w not in passage]


def test_lines_of_long_random_texts(llm):
    rng = random.Random(17)
    texts = [" ".join(rng.choice(["a", "bb", "cé", "漢字", "ddd"]) for _ in range(rng.choice([5, 24, 25, 70]))) for _ in range(12)]
    check_lines(llm, [(d, "\n".join(rng.choice(texts) for _ in range(rng.randint(1, 5)))) for d in range(60)])


def test_ranges_with_many_entries_are_not_broadcast(llm, monkeypatch):
    from batchgate.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    check_lines(llm, [(d, "a\nb\nc\n" + f"{d}\n" * 2 + "a\nb\nc") for d in range(9)])


def test_lines_of_an_empty_table(llm):
    assert line_dedup.drop_repeated_lines(frame(llm, [])).count() == 0


@pytest.mark.parametrize("ids", [(1, 2, 3), (-5, 0, 2**32 - 6), (-5, 0, 2**32 - 5), (-(2**63), 7, 2**63 - 1)])
def test_first_windows_are_found_without_a_sort_unless_ids_lie_far_apart(llm, ids):
    a, b, c = ids
    text = "\n".join("abcdefg")
    rows = [(c, "x\n" + text), (b, text + "\nz\n" + text), (a, "c\nd\ne\nf"), (b, text + "\nz\n" + text), (None, text)]
    check_lines(llm, rows)
    plan = line_dedup.repeated_ranges(frame(llm, rows))._jdf.queryExecution().executedPlan().toString()
    assert ("SortAggregate" in plan) == (c - a >= 2**32)


def test_first_windows_of_rows_with_one_id_and_other_texts(llm):
    """The first place counts over all rows of an id, whichever row holds it."""
    got = line_dedup.repeated_ranges(frame(llm, [(4, "q\nr\na\nb\nc"), (4, "a\nb\nc"), (9, "a\nb\nc")])).collect()
    assert {(r.doc_id, *(tuple(x) for x in r.ranges)) for r in got} == {(4, (2, 4)), (9, (0, 2))}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same(llm, name):
    got = queries.QUERIES[name](llm, "/root/testdata/sf0.001").toArrow()
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(queries.SQL[name]).to_arrow_table()
    order = sorted(got.column_names)
    assert order == sorted(want.column_names)

    def rows(table):
        return sorted(str([r[c] for c in order]) for r in table.to_pylist())

    assert rows(got) == rows(want)


def plain_signature(elements, slots):
    """Each element by itself, its permutation shuffled level by level."""
    out = [2**64 - 1] * slots
    for e in elements:
        order = list(range(slots))
        for j in range(slots):
            value, place = superminhash._level(np.array([e], dtype=np.uint64), j, slots)
            k = int(place[0])
            assert j <= k < slots
            order[j], order[k] = order[k], order[j]
            out[order[j]] = min(out[order[j]], int(value[0]))
    return out


@pytest.mark.parametrize("sizes", [(1,), (2, 3, 40), (300, 5, 0, 17)])
def test_signatures_equal_those_of_one_element_after_another(sizes):
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in sizes]
    got = superminhash.signatures(sets, 64)
    assert [list(map(int, row)) for row in got] == [plain_signature(s.tolist(), 64) for s in sets]


@pytest.mark.parametrize("n", [20, 400])
def test_agreeing_slots_estimate_the_similarity_with_little_variance(n):
    rng = np.random.default_rng(2)
    shared = round(n * 1.5 / 1.75)
    found = []
    for _ in range(40):
        x = rng.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
        a, b = superminhash.signatures([x[:n], x[n - shared :]], 384)
        found.append((a == b).mean())
    truth = shared / (2 * n - shared)
    assert abs(np.mean(found) - truth) < 0.012
    assert np.std(found) < (truth * (1 - truth) / 384) ** 0.5 * 1.1


def test_words_are_cut_at_ascii_blanks_only():
    texts = ["A b\tC\x0bd", None, "", "  ", "é a", "zz ZZ aB", "x" * 9000]
    hashes, first = wordhash.word_hashes(pa.array(texts))
    count = [len(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    assert list(np.diff(first)) == count
    assert hashes[first[5]] == hashes[first[5] + 1] != hashes[first[5] + 2]


def plain_components(rows):
    """Links over all pairs of full sets."""
    sets = defaultdict(list)
    table = {i: i + 32 for i in range(65, 91)}
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
        if d is not None:
            sets[d].append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d in ids}, sets


def check_near(llm, rows):
    got = near_dedup.near_duplicates(frame(llm, rows)).collect()
    want, sets = plain_components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}


def test_near_duplicates_of_odd_texts(llm, odd):
    check_near(llm, odd)


def test_near_duplicates_of_copies_with_edits(llm, words):
    """Groups around an original that is not their smallest id, chains, and pairs about the threshold."""
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [rng.choice(words) for _ in range(rng.choice([9, 60, 150]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words) + "z"
            rows.append((rng.randrange(10**6), " ".join(copy)))
            if g % 2:
                base = copy
    check_near(llm, rows)


def test_one_document_of_each_group_stays(llm, odd):
    docs = frame(llm, odd)
    got = near_dedup.keep_one(docs)
    assert got.schema == docs.schema
    ids = sorted((r.doc_id for r in got.collect() if r.doc_id is not None))
    want, _ = plain_components(odd)
    assert ids == sorted(d for d in want if want[d] == d)
    assert sum(r.doc_id is None for r in got.collect()) == 2


def test_near_duplicates_of_an_empty_table(llm):
    assert near_dedup.near_duplicates(frame(llm, [])).count() == 0
    assert near_dedup.keep_one(frame(llm, [])).count() == 0


def test_components_of_chains_stars_and_loops(llm):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(100, 140)]
    rng.shuffle(chain)
    star = [(500, 501 + i) for i in range(30)]
    links = [*chain, *star, (7, 7), (3, None), (900, 901), (901, 900)]
    got = {r.node: r.root for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 141)} | {501 + i: 500 for i in range(30)} | {901: 900}
    assert got == want
