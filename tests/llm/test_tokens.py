"""Token ids, packing, records and unigram counts."""

from __future__ import annotations

import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from tokenizers import Tokenizer, models, pre_tokenizers

from batchgate.llm import packing, records, token_counts
from batchgate.llm.tokenids import ID, TokenEncoder

from .conftest import frame

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = "ab cdE'st\n\t   .,!?09éß́İſ漢🎉<|>\u001c​"


def library(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_remembered_words_give_the_ids_of_the_library(path):
    encoder = TokenEncoder(path, chunks=20, words=10)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(ALPHABET, max_size=40), max_size=4))
    def check(texts):
        assert [np.frombuffer(encoder.encode(t), ID).tolist() for t in texts] == library(path, texts)

    check()


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_latin_words_go_to_the_model_alone(path, monkeypatch):
    """Accents, digits and punctuation cost no more than letters do; the ids are the library's."""
    texts = ["Über élan, 1984!", "naïve\nœuvre ñ'll ¿qué? «½ µ×÷»", "don't \"stop\" ÀÉÎ łódź", "a\x7fb \x01 \xadx"]
    texts += [f"a{chr(i)}b {chr(i)}1 {chr(i)}" for i in range(0x21, 0x250) if not chr(i).isspace() and max(chr(i).lower()) < "ɐ"]
    encoder, asked = TokenEncoder(path), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda text: asked.append(text) or whole(text))
    assert [np.frombuffer(encoder.encode(t), ID).tolist() for t in texts] == library(path, texts)
    assert asked == []
    encoder.encode("words 漢字")
    assert [t.strip() for t in asked] == ["漢字"]


def test_packing_places_every_id_once_and_pads_nothing(llm, odd):
    docs = frame(llm, odd)
    got = packing.pack(docs.coalesce(1), BYTE, size=64, block_tokens=500).collect()
    texts = [t or "" for _, t in odd]
    ids = [i + [1] for i in library(BYTE, texts)]
    placed = {}
    for r in got:
        placed.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, ID).tolist()))
        assert len(r.ids) == 4 * r.length > 0
    expected = {}
    for (d, _), i in zip(odd, ids, strict=True):
        expected.setdefault((d, len(i)), []).append(i)
    assert placed.keys() == expected.keys()
    for key, found in placed.items():
        n = len(expected[key])
        assert sum(len(x) for _, x in found) == n * key[1]
        if n == 1:
            assert [x for _, part in sorted(found) for x in part] == expected[key][0]
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length, total in sorted(parts):
            assert offset == at
            at += length
        assert at == total <= 64
        assert total & (total - 1) == 0


def test_packing_balances_cost_and_takes_the_longest_first():
    packer = packing.Packer(10, 1 << 30, 1.0, 0.1, 0)
    for d, n in enumerate([6, 6, 4, 2, 2]):
        packer.add(d, np.full(n, d, dtype=ID))
    packer.pack(2)
    got = {(r[0], r[5], r[6]) for r in packer.rows}
    # 6 and 6 open both; 4 fills the first; the two of 2 fill the second.
    assert got == {(0, 0, 0), (1, 1, 0), (2, 0, 6), (3, 1, 6), (4, 1, 8)}


def test_packing_of_an_empty_table(llm):
    assert packing.pack(frame(llm, []), BYTE).count() == 0


@pytest.mark.parametrize("seed", [None, 3])
def test_records_come_back_as_they_were_written(llm, odd, tmp_path, seed):
    manifest = records.write_records(frame(llm, odd).repartition(3), WORD, str(tmp_path / "out"), file_bytes=300)
    got = records.read_records(manifest, seed).collect()
    want = [i + [1] for i in library(WORD, [t or "" for _, t in odd])]
    assert sorted((r.doc_id is not None, r.doc_id or 0, zlib.crc32(r.ids)) for r in got) == sorted(
        (d is not None, d or 0, zlib.crc32(np.array(i, dtype=ID).tobytes())) for (d, _), i in zip(odd, want, strict=True)
    )
    order = sorted(got, key=lambda r: r.start)
    at = 0
    for r in order:
        assert (r.start, 4 * r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert keys == sorted(keys)
    assert manifest.count() > 3


def test_damaged_records_are_refused(llm, tmp_path):
    manifest = records.write_records(frame(llm, [(1, "some text")]), WORD, str(tmp_path / "out"))
    path = manifest.first().path
    data = bytearray(open(path, "rb").read())
    data[13] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(PythonException, match="damaged record"):
        records.read_records(manifest).count()


def test_records_of_an_empty_table(llm):
    assert records.read_records(records.write_records(frame(llm, []), WORD)).count() == 0


def plain_best(pieces, byte, word):
    """Best split by plain dynamic programming over one word."""
    text = token_counts.MARK + word
    best = [(0.0, 0)]
    for end, c in enumerate(text, 1):
        size = len(c.encode())
        options = [(best[-1][0] + size * byte, -best[-1][1] - size)]
        for begin in range(end):
            if text[begin:end] in pieces:
                options.append((best[begin][0] + pieces[text[begin:end]], -best[begin][1] - 1))
        s, n = max(options)
        best.append((s, -n))
    return best[-1][1], best[-1][0]


@pytest.fixture(scope="module")
def pieces():
    return token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def test_trie_scores_equal_those_of_each_word_alone(pieces, words):
    trie = token_counts.UnigramTrie(*pieces, limit=300)
    for w in [*words, "", "x" * 300, "漢字", "🎉a", *words[:50]]:
        n, s = trie.best(w)
        m, t = plain_best(*pieces, w)
        assert n == m and s == pytest.approx(t)


def test_counts_agree_with_the_unigram_model_of_a_library(pieces, words):
    vocab = [("<unk>", -100.0), *pieces[0].items()]
    model = Tokenizer(models.Unigram(vocab, unk_id=0))
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    trie = token_counts.UnigramTrie(*pieces)
    for w in words:
        ids = model.encode(token_counts.MARK + w).ids
        # Equal sums may be split otherwise.
        assert trie.best(w)[1] == pytest.approx(math.fsum(vocab[i][1] for i in ids))
        assert trie.best(w)[0] <= len(ids)


def test_token_counts_of_odd_texts(llm, odd, pieces):
    got = token_counts.count_tokens(frame(llm, odd).coalesce(1), public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(odd)
    for r, (d, text) in zip(got, odd, strict=True):
        found = [plain_best(*pieces, w) for w in (text or "").split() if len(w) < 1000]
        assert r.doc_id == d and r.n_pretokens == len((text or "").split())
        if d != 12:
            assert r.n_tokens == sum(n for n, _ in found)
            assert r.log_prob == pytest.approx(sum(s for _, s in found))
    empty = token_counts.count_tokens(frame(llm, []), public_tokenizers.path("piece_bpe_32k.model"))
    assert empty.count() == 0


def test_files_of_many_small_records(llm):
    """Files are closed by records too, and each is read by a task of its own."""
    docs = frame(llm, [(d, "") for d in range(1000)])
    manifest = records.write_records(docs.coalesce(1), public_tokenizers.path("word_bpe_49k.json"), file_records=64)
    held = manifest.collect()
    assert all(m.n_records <= 64 for m in held) and sum(m.n_records for m in held) == 1000
    got = records.read_records(manifest)
    assert got.rdd.getNumPartitions() == len(held)
    assert [r.doc_id for r in sorted(got.collect(), key=lambda r: r.start)] == list(range(1000))
    mixed = records.read_records(manifest, seed=3)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, got.collect()))
