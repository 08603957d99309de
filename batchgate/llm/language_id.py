"""Language of texts by hyperdimensional profiles (operator 9).

Each letter has a random vector of +1 and -1.  A run of three letters (a blank stands for all between
words) is bound into one vector: the first letter's turned by two places times the second's turned by
one times the third's.  A text is the bundle, that is the sum, of its runs' vectors, a language that of
all its texts.  A text gets the language whose prototype has the largest cosine with its bundle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
#: A prototype takes 4 kB; more languages are refused, as they go to every task.
MOST_LANGUAGES = 4096
UNKNOWN = "und"
#: Vectors of runs that a task remembers, 4 kB each.
REMEMBERED = 16_384


class Encoder:
    """Bundles of texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letter = np.array([chr(i).isalpha() for i in range(0x110000)])
        self._vectors: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self._row: dict[int, int] = {}
        self._runs = np.empty((REMEMBERED, self.dimensions), dtype=np.float32)

    def vector(self, letter: int) -> np.ndarray:
        if letter not in self._vectors:
            bits = np.random.default_rng([97, letter]).integers(0, 2, self.dimensions)
            self._vectors[letter] = (2 * bits - 1).astype(np.float32)
        return self._vectors[letter]

    def runs(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct runs of three of a text and how often each occurs; none if it has no letter."""
        code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        solid = self.letter[code]
        if not solid.any():
            return code[:0], code[:0]
        code[~solid] = 32
        code = np.concatenate([[32], code, [32]])
        code = code[np.concatenate([[True], (code[1:] != 32) | (code[:-1] != 32)])]
        return np.unique(code[:-2] << 42 | code[1:-1] << 21 | code[2:], return_counts=True)

    def bundle(self, runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dimensions, dtype=np.float64)
        for at in range(0, len(runs), 4096):
            part = runs[at : at + 4096].tolist()
            if len(self._row) + len(part) > REMEMBERED:
                self._clear()
            row = self._row
            for r in part:
                if r not in row:
                    a, b, c = (self.vector(x & 0x1FFFFF) for x in (r >> 42, r >> 21, r))
                    self._runs[len(row)] = np.roll(a, 2) * np.roll(b, 1) * c
                    row[r] = len(row)
            rows = self._runs[[row[r] for r in part]]
            # Whole numbers up to 2 ** 24 are exact in single precision.
            if counts.max() < 4096:
                out += counts[at : at + 4096].astype(np.float32) @ rows
            else:
                out += counts[at : at + 4096].astype(np.float64) @ rows
        return out


def _merged(runs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate(runs), return_inverse=True)
    total = np.zeros(len(keys), dtype=np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return keys, total


def prototypes(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """A bundle for each language of ``docs``; rows without language, text or letters count for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        held: dict[str, tuple[list, list]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                runs, counts = encoder.runs(text.as_py())
                if len(runs):
                    name = lang.as_py()
                    mine = held.setdefault(name, ([], []))
                    mine[0].append(runs)
                    mine[1].append(counts)
                    size[name] = size.get(name, 0) + len(runs)
                    if size[name] > 1 << 19:
                        keys, total = _merged(*mine)
                        held[name], size[name] = ([keys], [total]), 0
        names = sorted(held)
        sums = [np.rint(encoder.bundle(*_merged(*held[n]))).astype(np.int64) for n in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, type=pa.string()), pa.array(sums, type=pa.list_(pa.int64()))], names=["lang", "sums"]
        )

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    parts = parts.mapInArrow(run, "lang string, sums array<long>")
    added = parts.select("lang", F.posexplode("sums").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    row = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])
    learned = added.groupBy("lang").agg(row.alias("sums")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(learned) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r.lang: np.array(r.sums, dtype=np.float64) for r in learned}


def identify(
    docs: DataFrame, learned: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row; the score is the cosine, 0 where it is negative.

    Of languages with equal cosines the first by name is taken.  A null text or one without a letter is
    ``und`` with score 0, and so is any if no language was learned.  Repeated rows and null ids are kept;
    an empty table gives an empty one; other columns are ignored.
    """
    names = sorted(learned)
    unit = np.array([learned[n] / (np.linalg.norm(learned[n]) or 1) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                runs, counts = encoder.runs(text.as_py()) if names else ((), ())
                bundle = encoder.bundle(runs, counts) if len(runs) else None
                size = np.linalg.norm(bundle) if bundle is not None else 0
                cosine = unit @ bundle / size if size else np.zeros(max(1, len(names)))
                at = int(cosine.argmax())
                langs.append(names[at] if len(runs) else UNKNOWN)
                scores.append(float(min(1, max(0, cosine[at]))) if len(runs) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, type=pa.string()), pa.array(scores, type=pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
