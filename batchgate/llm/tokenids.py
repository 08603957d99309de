"""Token ids of whole texts by the ``tokenizers`` library, with each distinct word encoded once.

Both public tokenizers split a text into words before they merge, and never across the start of a blank
between two words; so a text's ids are those of its chunks one after another.  Chunks, and the words in
them, are kept in bounded memories, and only new words reach the library.  Texts in which that might not
hold (runs of blanks, other white space, letters that normalising may join or that change with their
neighbours when lower-cased, strings of added tokens that count as such) are encoded whole.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable

import numpy as np
import regex
from tokenizers import Tokenizer

ID = np.dtype("<u4")

# Fixed value: the word pattern of the byte-level tokenizer.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: that of the lower-casing tokenizer.
PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# The same for texts of ASCII alone, where Python's own expressions do and are faster.
ASCII_BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
ASCII_PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+"

#: Latin letters, numbers and signs end before this character; all versions of Unicode agree on them, and none of
#: them joins another.
_AFTER_LATIN = "\u0250"


def _letters() -> list[str]:
    """The letter for each byte in the models' alphabet: a byte that can be seen is its own, others are from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(other)) for b in range(256)]


_LETTER = _letters()

#: White space other than blank and newline, and characters that some count as such.
_ODD = "".join(chr(i) for i in range(0x3001) if (chr(i).isspace() and chr(i) not in " \n") or i in (0x180E, 0x200B, 0x2060)) + "﻿"
_ODD_ASCII = [c for c in _ODD if c.isascii()]


class Memory(dict):
    """What ``make`` gives for a key, remembered for the last ``limit`` to twice as many keys in use."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class TokenEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    Strings of special tokens inside a text are ordinary text, or with ``special_tokens`` the ids of those
    tokens, as the library gives them unless told otherwise.
    """

    def __init__(self, path: str, chunks: int = 400_000, words: int = 100_000, special_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        added = self.tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added] if special_tokens else []
        self.byte_level = self.tokenizer.normalizer is None
        self._model = self.tokenizer.model
        self._pattern = regex.compile(BYTE_WORDS if self.byte_level else PLAIN_WORDS)
        self._ascii_pattern = re.compile(ASCII_BYTE_WORDS if self.byte_level else ASCII_PLAIN_WORDS)
        self._word = Memory(self._encode_word, words)
        self._chunk = Memory(self._encode_chunk, chunks)

    @property
    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def whole(self, text: str) -> bytes:
        """Ids straight from the library."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=ID).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(t in text for t in self._added) or not self._separable(text):
            return self.whole(text)
        known = self._chunk
        if not self.byte_level:
            return b"".join(map(known.__getitem__, text.lower().replace("\n", " ").split(" ")))
        # A chunk stands for itself after a blank, or after the newline that it begins with.
        first, *rest = text.replace("\n", " \n").split(" ")
        return self._encode_words(first) + b"".join(map(known.__getitem__, rest))

    def _separable(self, text: str) -> bool:
        if text.isascii():
            if any(c in text for c in _ODD_ASCII):
                return False
        elif any(c in text for c in _ODD):
            return False
        elif not self.byte_level and ("İ" in text or "Σ" in text or not unicodedata.is_normalized("NFC", text)):
            return False
        if not self.byte_level:
            return True
        return not (
            text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        )

    def _encode_chunk(self, chunk: str) -> bytes:
        after_blank = self.byte_level and chunk[0] != "\n"
        # Letters alone are one word.
        if chunk.isascii() and chunk.isalpha():
            return self._ids("Ġ" + chunk if after_blank else chunk)
        if after_blank:
            chunk = " " + chunk
        words = self._words(chunk)
        return self._encode_word(words[0]) if len(words) == 1 else self._joined(words)

    def _encode_words(self, text: str) -> bytes:
        return self._joined(self._words(text))

    def _words(self, text: str) -> list[str]:
        return (self._ascii_pattern if text.isascii() else self._pattern).findall(text)

    def _joined(self, words: list[str]) -> bytes:
        """The ids of words; those that are chunks by themselves are remembered as such, and only once."""
        if not self.byte_level:
            return b"".join([self._chunk[w] for w in words])
        return b"".join([self._chunk[w[1:]] if len(w) > 1 and w[0] == " " else self._word[w] for w in words])

    def _encode_word(self, word: str) -> bytes:
        """The ids of one match of the pattern, which the library would not split any more."""
        if word.isascii() and word.isprintable():
            letters = "Ġ" + word[1:] if word[0] == " " else word
        elif max(word) < _AFTER_LATIN:
            letters = "".join([_LETTER[b] for b in word.encode()])
        else:
            return self.whole(word)
        return self._ids(letters)

    def _ids(self, letters: str) -> bytes:
        """The ids of a word in the model's alphabet."""
        ids = [t.id for t in self._model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[tuple[str, int, bool], TokenEncoder] = {}


def encoder(path: str, chunks: int = 400_000, special_tokens: bool = False) -> TokenEncoder:
    """One encoder for each Python worker; it remembers up to twice as many chunks, some 200 bytes each."""
    key = path, chunks, special_tokens
    if key not in _ENCODERS:
        _ENCODERS[key] = TokenEncoder(path, chunks, chunks // 4, special_tokens)
    return _ENCODERS[key]
