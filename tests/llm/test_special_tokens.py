"""Ids of texts that hold strings of special tokens, as an untouched tokenizer gives them."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from batchgate.llm import queries
from batchgate.llm.tokenids import ID, TokenEncoder

from .conftest import frame

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["a", " b", "It's", "\n", "  ", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "é", " 42,", "漢"]


def untouched(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("path", "want"), [(BYTE, [64, 220, 50256, 275]), (WORD, [320, 49407, 321])])
def test_special_tokens_have_the_ids_of_an_untouched_tokenizer(path, want):
    encoder, plain = TokenEncoder(path, 20, 10, special_tokens=True), Tokenizer.from_file(path)
    assert np.frombuffer(encoder.encode("a <|endoftext|> b"), ID).tolist() == want

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
    def check(text):
        got = np.frombuffer(encoder.encode(text), ID).tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids

    check()


def test_queries_count_special_tokens_once(llm, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "plain words"), (3, "<|endoftext|><|startoftext|>")]
    docs = frame(llm, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = {d: [*untouched(WORD, t), 1] for d, t in rows}
    got = {r.doc_id: r for r in queries.QUERIES["op10_binary_records"](llm, str(tmp_path)).collect()}
    at = 0
    for d, found in sorted(ids.items()):
        assert (got[d].n_tokens, got[d].start) == (len(found), at)
        assert got[d].ids_crc32 == zlib.crc32(np.array(found, dtype=ID).tobytes())
        at += len(found)
    want = {d: len(untouched(BYTE, t)) + 1 for d, t in rows}
    assert {r.doc_id: r.doc_tokens for r in queries.QUERIES["op4_packing"](llm, str(tmp_path)).collect()} == want
    packed = corpus_pipeline.STAGES[-1][1](llm, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.doc_tokens for r in packed} == want
