"""Decontamination, fingerprints, licences, languages and toxicity."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchgate.llm import decontaminate, language_id, licenses, queries, toxicity

from .conftest import frame

SMALL = "/root/testdata/sf0.01"


def plain_distance(item, text):
    """Least edit distance of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=60))
def test_bit_vectors_give_the_edit_distance(item, text):
    assert decontaminate.Item(0, item, 0.1).distance(text) == plain_distance(item, text)


@pytest.fixture(scope="module")
def benchmark(words):
    rng = random.Random(21)
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(10, 30))).capitalize() + ".") for i in range(20)]
    return [*items, (20, None), (21, " ... "), (None, "no id at all"), (3, items[3][1]), (3, "another text of item three")]


def planted(benchmark, words, odd):
    rng = random.Random(22)
    rows = list(odd)
    for k in range(60):
        text = [rng.choice(words) for _ in range(80)]
        item = list(benchmark[k % 20][1])
        for _ in range(rng.randint(0, len(item) // 14)):
            item[rng.randrange(len(item))] = rng.choice("qxz ")
        text.insert(rng.randrange(80), "".join(item))
        rows.append((1000 + k, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_items_are_found_within_the_error_budget(llm, benchmark, words, odd, block):
    rows = planted(benchmark, words, odd)
    # A null id and a repeated one on texts that hold items.
    rows += [(None, rows[-1][1]), (1001, rows[-2][1])]
    items = llm.createDataFrame(benchmark, "item_id long, text string")
    got = decontaminate.contamination(frame(llm, rows), items, block_chars=block).collect()
    names = [(i, decontaminate.normalised(t)) for i, t in benchmark if i is not None]
    want = []
    for d, text in rows:
        found = {}
        for i, item in names:
            if item and len(text or "") < 3000:
                n = plain_distance(item, decontaminate.normalised(text))
                if n <= len(item) // 20:
                    found[i] = min(n, found.get(i, n))
        want.append(str((d, sorted(found.items()))))
    assert sum("[(" in w for w in want) > 20
    assert sorted(str((r.doc_id, list(zip(r.item_ids, r.distances, strict=True)))) for r in got) == sorted(want)
    # Every row stays, null and repeated ids too, however many blocks there are.
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in rows)


def test_clean_documents_stay_as_they_are(llm, benchmark, words, odd):
    docs = frame(llm, planted(benchmark, words, odd))
    items = llm.createDataFrame(benchmark, "item_id long, text string")
    hit = {r.doc_id for r in decontaminate.contamination(docs, items).where("size(item_ids) > 0").collect()}
    for block in (1 << 24, 300):
        clean = decontaminate.keep_clean(docs, items, block_chars=block)
        assert clean.schema == docs.schema
        assert sorted(map(str, clean.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id not in hit)


def test_no_items_and_no_documents(llm, odd):
    none = llm.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(frame(llm, odd), none).collect()
    assert len(got) == len(odd) and not any(r.item_ids for r in got)
    assert decontaminate.keep_clean(frame(llm, odd), none).count() == len(odd)
    assert decontaminate.contamination(frame(llm, []), none).count() == 0


def test_licences_of_files_and_of_directories_above(llm):
    mit, apache = (t for _, t in licenses.TEMPLATES[:2])
    rows = [
        (1, "a/README", f"{mit}\nmore text follows here"),
        (2, "a/b/c/x.txt", "nothing"),
        (3, "a/b/LICENSE", f"\n{apache.upper()}\n"),
        (4, "a/b/c/y.txt", f"words before\n{mit}"),
        (5, "z/q.txt", "the license is under the version of this work"),
        (6, "a/d/e.txt", None),
        (7, None, mit),
        (None, "a/f.txt", apache),
        (8, "top.txt", ""),
        (2, "a/b/c/x.txt", "nothing"),
        (9, "a/b/d.txt", "Licensed under the Apache License, version 2.0, and so on for a long line of other words"),
    ]
    files = llm.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("mine"))
    got = {(r.id, r.path): (r.license, r.origin, r.license_dir) for r in licenses.scan(files).collect()}
    assert got == {
        (1, "a/README"): ("MIT", "own", None),
        (2, "a/b/c/x.txt"): ("Apache-2.0", "inherited", "a/b"),
        (3, "a/b/LICENSE"): ("Apache-2.0", "own", None),
        (4, "a/b/c/y.txt"): ("MIT", "own", None),
        (5, "z/q.txt"): (None, "none", None),
        (6, "a/d/e.txt"): ("MIT", "inherited", "a"),
        (7, None): ("MIT", "own", None),
        (None, "a/f.txt"): ("MIT", "inherited", "a"),
        (8, "top.txt"): (None, "none", None),
        (9, "a/b/d.txt"): ("Apache-2.0", "inherited", "a/b"),
    }
    assert licenses.scan(files).count() == len(rows)
    assert licenses.scan(files.limit(0)).count() == 0


def test_languages_of_held_out_documents(llm):
    got = queries.QUERIES["op9_language_id"](llm, SMALL).toPandas()
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    both = got.merge(docs, on="doc_id")
    apart = both[both.held_out]
    assert len(got) == len(docs) and len(apart) > 250
    assert (apart.lang == apart.lang_pred).mean() >= 0.99
    assert got.score.between(0, 1).all()


def test_bundles_equal_sums_of_bound_vectors():
    encoder = language_id.Encoder(64)
    text = "Ab, ab!"
    letters = [" ", "a", "b", " ", "a", "b", " "]
    want = sum(
        np.roll(encoder.vector(ord(x)), 2) * np.roll(encoder.vector(ord(y)), 1) * encoder.vector(ord(z))
        for x, y, z in zip(letters, letters[1:], letters[2:], strict=False)
    )
    assert encoder.bundle(*encoder.runs(text)).tolist() == want.tolist()


def test_languages_of_odd_texts(llm, odd):
    docs = frame(llm, odd).withColumn("score", F.lit("mine"))
    learned = language_id.prototypes(docs)
    assert sorted(learned) == ["en"]
    got = language_id.identify(docs.coalesce(1), learned).collect()
    for r, (d, t) in zip(got, odd, strict=True):
        assert r.doc_id == d and 0 <= r.score <= 1
        assert r.lang_pred == ("en" if any(c.isalpha() for c in t or "") else "und")
    none = language_id.identify(docs, language_id.prototypes(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language_id.identify(docs.limit(0), learned).count() == 0


def test_toxic_documents_that_training_has_not_seen(llm):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    got = toxicity.flag(docs, labels.where(seen)).toPandas().merge(labels.where(~seen).toPandas(), on="doc_id")
    truth, found = got.toxic_y == 1, got.toxic_x
    assert truth.sum() > 50
    assert found[truth].mean() >= 0.8 and found[~truth].mean() <= 0.005
    assert ((got.p_low_quality > 0.5) == (got.quality == 0)).mean() >= 0.9


def test_later_models_see_out_of_fold_probabilities(monkeypatch):
    """The second category is the first one's opposite, which words alone do not tell."""
    rng = np.random.default_rng(5)
    n = 300
    first = rng.integers(0, 2, n)
    sets = [np.array([1 + f], dtype=np.uint64) for f in first]
    seen = []
    real = toxicity.fit

    def spy(rows, truth, *rest):
        seen.append((rows.dense.shape, truth.copy()))
        return real(rows, truth, *rest)

    monkeypatch.setattr(toxicity, "fit", spy)
    truth = np.column_stack([first, 1 - first]).astype(float)
    chain = toxicity.fit_chain(("a", "b"), sets, np.zeros((n, 1)), truth, np.ones(n))
    # One model on all rows and one for each fold left out, then one that has the probability beside the share.
    assert [s for s, _ in seen] == [(n, 1), *[(n - n // 3, 1)] * 3, (n, 2)]
    a, b = chain.predict(sets, np.zeros((n, 1)))
    assert ((a > 0.5) == (first == 1)).all() and ((b > 0.5) == (first == 0)).all()


def test_a_model_equals_newton_steps():
    """The fitted model against one found by plain Newton steps on the dense matrix of the same rows."""
    rng = np.random.default_rng(8)
    n, n_words = 300, 12
    sets = [np.flatnonzero(rng.random(n_words) < 0.3).astype(np.uint64) for _ in range(n)]
    dense, weight, penalty = rng.random((n, 2)), rng.random(n) + 0.2, 1e-2
    x = np.zeros((n, n_words + 3))
    for i, s in enumerate(sets):
        x[i, s.astype(int)] = 1
    x[:, n_words:-1], x[:, -1] = dense, 1
    truth = (rng.random(n) < 1 / (1 + np.exp(-(x @ rng.standard_normal(n_words + 3))))).astype(float)
    ridge = np.append(np.full(n_words + 2, penalty), 0)
    best, share = np.zeros(n_words + 3), weight / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ best))
        down = x.T @ (share * (p - truth)) + ridge * best
        best -= np.linalg.solve((x.T * (share * p * (1 - p))) @ x + np.diag(ridge), down)
    rows = toxicity.Rows.of(sets, dense, np.arange(n_words, dtype=np.uint64))
    model = toxicity._fit(rows, truth, weight, n_words, penalty)
    assert np.allclose(np.concatenate([model.words, model.dense, [model.bias]]), best, atol=0.02)
    assert np.allclose(model.probability(rows), 1 / (1 + np.exp(-x @ best)), atol=2e-3)


def test_telling_words_by_a_plain_table():
    rng = np.random.default_rng(9)
    sets = [np.flatnonzero(rng.random(8) < 0.4).astype(np.uint64) for _ in range(200)]
    truth = np.array([float(0 in s) if rng.random() < 0.8 else float(rng.random() < 0.5) for s in sets])
    rows = toxicity.Rows.of(sets, np.zeros((200, 1)), np.arange(8, dtype=np.uint64))
    want = []
    for w in range(8):
        table = np.array([[sum((w in s) == a and t == b for s, t in zip(sets, truth, strict=True)) for b in (0, 1)] for a in (0, 1)])
        expected = np.outer(table.sum(axis=1), table.sum(axis=0)) / 200
        if ((table - expected) ** 2 / expected).sum() >= toxicity.CHI_SQUARE:
            want.append(w)
    assert 0 in want and toxicity.telling(rows, truth, 8).tolist() == want


def test_labels_other_than_0_and_1_are_refused(llm, odd):
    docs = frame(llm, odd)
    labels = llm.createDataFrame([(1, 1, 0), (5, 0, 2)], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError, match="other than 0 and 1"):
        toxicity.flag(docs, labels)


def test_a_labelled_id_gives_one_row_to_the_fit(llm, words, monkeypatch):
    rows = [(1, "bad " * 5 + str(i)) for i in range(50)] + [(2, "good words")]
    labels = llm.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda c, sets, *a, **k: seen.append(len(sets)) or toxicity.Chain(c))
    toxicity.train(frame(llm, rows), labels.withColumnRenamed("quality", "good"), ("good", "toxic"))
    assert seen == [2]


def test_toxicity_of_odd_texts_and_labels(llm, odd):
    docs = frame(llm, odd).withColumn("toxic", F.lit("mine"))
    labels = llm.createDataFrame(
        [(1, 1, 0), (7, 0, 0), (7, 0, 0), (12, 1, 1), (None, 1, 1), (3, None, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for known in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.flag(docs.coalesce(1), known).collect()
        assert [r.doc_id for r in got] == [d for d, _ in odd]
        empty = [r for r, (_, t) in zip(got, odd, strict=True) if not (t or "").strip()]
        assert empty and not any(r.toxic or r.p_toxic for r in empty)
        clean = toxicity.keep_clean(docs, known)
        assert clean.schema == docs.schema
        assert clean.count() == sum(not r.toxic for r in got)
    assert toxicity.flag(docs.limit(0), labels).count() == 0


def test_features_of_texts():
    sets, shares = toxicity.features(pa.array(["Bad, bad day!", None, ""]))
    assert [len(s) for s in sets] == [2, 0, 0]
    assert shares[0].round(3).tolist() == [0.667, round(9 / 13, 3), round(2 / 13, 3), round(float(np.log(4)) / 10, 3)]
