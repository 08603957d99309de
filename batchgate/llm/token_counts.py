"""Token counts under a unigram model, each shared prefix scored once (operator 2).

A pre-token is a run of characters other than white space with the word mark in front.  Its tokens are
the split into vocabulary pieces of the highest sum of log-probabilities, of equal ones that of fewest
pieces.  That of each prefix depends on the prefix alone, so a task puts the distinct pre-tokens that it
meets into a trie, scores each node once from its ancestors, and keeps the counts of the nodes that end
a pre-token.  The trie starts anew beyond a number of nodes, which changes no result.  Nothing is
shuffled.

Public vocabularies give ranks; Zipf's law makes log-probabilities of them.  A character that no piece
covers is a token for each of its UTF-8 bytes.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
COUNTS = "doc_id long, n_pretokens long, n_tokens long, log_prob double"


def vocabulary(path: str) -> tuple[dict[str, float], float]:
    """Log-probability of each piece of a model file, in order of rank, and that of a single byte."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    total = sum(1 / (rank + 1) for rank in range(len(plain) + 256))
    pieces = {model.id_to_piece(i): -math.log((rank + 1) * total) for rank, i in enumerate(plain)}
    return pieces, -math.log((len(plain) + 256) * total)


class UnigramTrie:
    """Best splits of all pre-tokens met so far; at most ``limit`` nodes beyond those of one pre-token."""

    def __init__(self, pieces: dict[str, float], byte: float, limit: int = 1_000_000):
        self.pieces, self.byte, self.limit = pieces, byte, limit
        self.longest = max(map(len, pieces), default=1)
        self.found: dict[str, tuple[int, float]] = {}
        self._clear()

    def _clear(self) -> None:
        self.found.clear()
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.count = array("d", [0.0]), array("q", [0])

    def best(self, word: str) -> tuple[int, float]:
        """Number of tokens and log-probability of a pre-token, given without the mark."""
        known = self.found.get(word)
        if known is None:
            if len(self.score) > self.limit:
                self._clear()
            known = self.found[word] = self._insert(MARK + word)
        return known

    def _insert(self, text: str) -> tuple[int, float]:
        child, score, count, pieces = self.child, self.score, self.count, self.pieces
        path = [0]
        for end, c in enumerate(text, 1):
            node = child.get((path[-1], c))
            if node is None:
                at = path[-1]
                size = len(c.encode("utf-8", "surrogatepass"))
                best, fewest = score[at] + size * self.byte, count[at] + size
                for begin in range(max(0, end - self.longest), end):
                    p = pieces.get(text[begin:end])
                    if p is not None:
                        at = path[begin]
                        s, n = score[at] + p, count[at] + 1
                        if s > best or (s == best and n < fewest):
                            best, fewest = s, n
                node = child[path[-1], c] = len(score)
                score.append(best)
                count.append(fewest)
            path.append(node)
        return count[path[-1]], score[path[-1]]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens, log_prob`` for each row.

    A null or empty text, or one of white space, has no tokens and a log-probability of 0.  Repeated rows
    and null ids are counted each for itself; an empty table gives an empty one; other columns are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = UnigramTrie(*vocabulary(model_path))
        best = trie.best
        for batch in batches:
            pretokens, tokens, probs = [], [], []
            for text in batch.column(1):
                found = [best(w) for w in (text.as_py() or "").split()]
                pretokens.append(len(found))
                tokens.append(sum([n for n, _ in found]))
                probs.append(math.fsum([s for _, s in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(pretokens, type=pa.int64()),
                    pa.array(tokens, type=pa.int64()),
                    pa.array(probs, type=pa.float64()),
                ],
                names=["doc_id", "n_pretokens", "n_tokens", "log_prob"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, COUNTS)
