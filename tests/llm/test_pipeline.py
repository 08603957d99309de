"""The pipeline: its stages one by one, and what it does as a whole."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from batchgate.llm.common import stage
from batchgate.llm.tokenids import ID

from .conftest import frame
from .test_duplicates import cut_lines, plain_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(llm, words, tmp_path_factory):
    """Documents with a toxic word, repeated passages, near copies and benchmark items, and their tables."""
    rng = random.Random(31)

    def text(n):
        return "\n".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(n))

    passage, item = text(4), " ".join(rng.choice(words) for _ in range(25))
    rows = {d: text(rng.randint(3, 12)) for d in range(300)}
    for d in range(0, 300, 10):
        rows[d] += " vile"
    for d in (41, 42, 43):
        rows[d] += "\n" + passage
    # A line of its own is no passage, so the copies reach the near duplicates.
    base = " ".join(rng.choice(words) for _ in range(22))
    rows[51] = base
    rows[56] = rows[55]
    for d in (52, 53, 54):
        rows[d] = base + f" tail{d}"
    rows[61] += " " + item
    rows[62] = item[:40] + "x" + item[41:] + "\n" + rows[62]
    rows |= {301: None, 302: "", 303: " ", 304: "word"}
    folder = tmp_path_factory.mktemp("corpus")
    docs = frame(llm, sorted(rows.items())).select(COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(d, 1, int(d % 10 == 0)) for d in range(200)]
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    llm.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_stages_are_these():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "line_dedup",
        "near_dedup",
        "decontamination",
        "packing",
    ]


def after_line_dedup(rows):
    """Texts as line dedup leaves them, without those that lose all lines."""
    want = cut_lines(rows.items())
    left = {d: want.get(d, (None, 1, 0)) for d in rows}
    return {d: text for d, (text, n, removed) in left.items() if not 0 < removed == n}


def test_what_each_stage_does(llm, corpus):
    folder, rows = corpus
    docs, kept = llm.read.parquet(f"{folder}/documents.parquet"), dict(rows)
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs):
        out = stage(stages[name](llm, docs, folder), "test")
        assert out.columns == COLUMNS
        return out, {r.doc_id: r for r in out.collect()}

    docs, got = step("toxicity", docs)
    kept = {d: t for d, t in kept.items() if not (t or "").endswith("vile")}
    assert {d: r.text for d, r in got.items()} == kept

    docs, got = step("line_dedup", docs)
    kept = after_line_dedup(kept)
    assert {d: r.text for d, r in got.items()} == kept
    assert 55 in kept and 56 not in kept and kept[302] == ""
    assert got[42].n_chars == len(kept[42]) < len(rows[42])

    docs, got = step("near_dedup", docs)
    root, _ = plain_components(kept.items())
    kept = {d: t for d, t in kept.items() if root[d] == d}
    assert {d: r.text for d, r in got.items()} == kept
    assert 51 in kept and not {52, 53, 54} & kept.keys()

    docs, got = step("decontamination", docs)
    kept = {d: t for d, t in kept.items() if d not in (61, 62)}
    assert {d: r.text for d, r in got.items()} == kept

    pieces = {}
    for r in stages["packing"](llm, docs, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, ID).tolist()))
    check_pieces(pieces, kept)


def check_pieces(pieces, kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert pieces.keys() == kept.keys()
    for d, parts in pieces.items():
        ids = tokenizer.encode(kept[d] or "", add_special_tokens=False).ids
        assert [x for _, p in sorted(parts) for x in p] == [*ids, 1]


def test_the_whole_pipeline(llm, corpus):
    folder, rows = corpus
    clean = {d: t for d, t in rows.items() if not (t or "").endswith("vile")}
    clean = after_line_dedup(clean)
    root, _ = plain_components(clean.items())
    clean = {d: t for d, t in clean.items() if root[d] == d and d not in (61, 62)}
    pieces = {}
    for r in corpus_pipeline.run(llm, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, ID).tolist()))
    check_pieces(pieces, clean)


def test_stages_take_odd_and_empty_tables(llm, odd, corpus):
    folder, _ = corpus
    full = frame(llm, odd).withColumn("id", F.lit("x")).withColumn("component_id", F.lit(None).cast("int"))
    for docs in (full, full.limit(0)):
        for name, fn in corpus_pipeline.STAGES:
            out = stage(fn(llm, docs, folder), "odd")
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
            else:
                assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_the_library_works_without_the_subpackage(tmp_path):
    """Neither the entry point nor anything outside needs these operators."""
    top = Path(corpus_pipeline.__file__).parent
    for p in top.rglob("*.py"):
        if "llm" not in p.parts and p.name != "corpus_pipeline.py" and "tests" not in p.relative_to(top).parts:
            to = tmp_path / p.relative_to(top)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_text(p.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
