"""Toxicity by a classifier chain (operator 5).

Categories are predicted one after another by linear (logistic) models over the distinct words of a text, their
beginnings and a few shares of it.  Each model also sees the probabilities of all earlier categories; in training
those are out-of-fold, from models that have not seen the document, as they will be in use.

The models are fitted on a bounded sample of labelled documents, ``per_stratum`` of each combination of
labels, weighted to the numbers that all labels have.  Everything is predicted in one pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import stage
from batchgate.llm.wordhash import LETTERS, text_bytes, word_hashes

FOLDS = 3
#: Words of a model: those of at least this chi-square with the category, and at most so many.
CHI_SQUARE, MOST_WORDS = 16.0, 4000
#: Bytes of a word's beginnings that are features of their own, for words that training has not seen.
BEGINNINGS = (4, 6)
SHARES = 4
SLICE = 256


def features(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct words and beginnings of words of each text, by number, and its shares.

    Words are runs of letters; the shares are those of distinct words, of letters and of blanks, and the
    logarithm of the number of words.
    """
    words, first = word_hashes(texts, LETTERS)
    parts = np.stack([words, *[word_hashes(texts, LETTERS, most)[0] for most in BEGINNINGS]])
    data, at = text_bytes(texts)
    letter = np.concatenate([[0], np.cumsum(~LETTERS[data])])
    blank = np.concatenate([[0], np.cumsum(data <= 32)])
    sets, shares = [], np.zeros((len(texts), SHARES))
    for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        sets.append(np.unique(parts[:, a:b]))
        n, size = max(1, b - a), max(1, at[i + 1] - at[i])
        shares[i] = (
            len(np.unique(words[a:b])) / n,
            (letter[at[i + 1]] - letter[at[i]]) / size,
            (blank[at[i + 1]] - blank[at[i]]) / size,
            np.log1p(b - a) / 10,
        )
    return sets, shares


@dataclass
class Rows:
    """Documents as rows of a sparse matrix of known words beside a dense one of shares."""

    index: np.ndarray
    owner: np.ndarray
    dense: np.ndarray

    @staticmethod
    def of(sets: list[np.ndarray], dense: np.ndarray, vocabulary: np.ndarray) -> Rows:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        words = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        if not len(vocabulary):
            return Rows(words[:0].astype(np.int64), owner[:0], dense)
        index = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
        known = vocabulary[index] == words
        return Rows(index[known], owner[known], dense)

    def with_column(self, column: np.ndarray) -> Rows:
        return Rows(self.index, self.owner, np.column_stack([self.dense, column]))

    def where(self, keep: np.ndarray) -> Rows:
        place = np.cumsum(keep) - 1
        mine = keep[self.owner]
        return Rows(self.index[mine], place[self.owner[mine]], self.dense[keep])


@dataclass
class Model:
    """A logistic model; with one class in training, a constant."""

    words: np.ndarray
    dense: np.ndarray
    bias: float

    def margin(self, rows: Rows) -> np.ndarray:
        hits = np.bincount(rows.owner, weights=self.words[rows.index], minlength=len(rows.dense))
        return hits + rows.dense @ self.dense + self.bias

    def probability(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def telling(rows: Rows, truth: np.ndarray, n_words: int) -> np.ndarray:
    """Words whose presence goes with the truth beyond chance, by chi-square; at most ``MOST_WORDS``."""
    n, positive = len(truth), truth.sum()
    seen = np.bincount(rows.index, minlength=n_words).astype(np.float64)
    hits = np.bincount(rows.index, weights=truth[rows.owner], minlength=n_words)
    spread = seen * (n - seen) * positive * (n - positive)
    chi = n * (hits * n - seen * positive) ** 2 / np.maximum(spread, 1)
    best = np.argsort(-chi, kind="stable")[:MOST_WORDS]
    return np.sort(best[chi[best] >= CHI_SQUARE])


def fit(rows: Rows, truth: np.ndarray, weight: np.ndarray, n_words: int, penalty: float) -> Model:
    """Weighted logistic regression on the telling words, with a squared penalty."""
    chosen = telling(rows, truth, n_words)
    place = np.full(n_words + 1, -1)
    place[chosen] = np.arange(len(chosen))
    index = place[rows.index]
    few = Rows(index[index >= 0], rows.owner[index >= 0], rows.dense)
    model = _fit(few, truth, weight, len(chosen), penalty)
    words = np.zeros(n_words)
    words[chosen] = model.words
    return Model(words, model.dense, model.bias)


def _fit(rows: Rows, truth: np.ndarray, weight: np.ndarray, n_words: int, penalty: float) -> Model:
    """Logistic regression by limited-memory BFGS."""
    n_dense = rows.dense.shape[1]
    total = weight.sum()
    mean = (weight * truth).sum() / total if total else 0.0
    if not 0 < mean < 1:
        return Model(np.zeros(n_words), np.zeros(n_dense), 30.0 if mean == 1 else -30.0)
    sign = 2 * truth - 1

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        model = Model(x[:n_words], x[n_words:-1], x[-1])
        margin = sign * model.margin(rows)
        loss = (weight * np.logaddexp(0, -margin)).sum() / total + penalty * (x[:-1] @ x[:-1]) / 2
        slope = -sign * weight / (1 + np.exp(np.clip(margin, -30, 30))) / total
        words = np.bincount(rows.index, weights=slope[rows.owner], minlength=n_words)
        down = np.concatenate([words, rows.dense.T @ slope, [slope.sum()]])
        down[:-1] += penalty * x[:-1]
        return loss, down

    x = np.zeros(n_words + n_dense + 1)
    x[-1] = np.log(mean / (1 - mean))
    loss, down = value(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(100):
        q, used = down.copy(), []
        for s, y, r in reversed(steps):
            a = r * (s @ q)
            used.append(a)
            q -= a * y
        if steps:
            s, y, _ = steps[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(steps, reversed(used), strict=True):
            q += s * (a - r * (y @ q))
        size, fall = 1.0, q @ down
        while True:
            new, new_down = value(x - size * q)
            if new <= loss - 1e-4 * size * fall or size < 1e-6:
                break
            size /= 2
        s, y = -size * q, new_down - down
        if s @ y > 1e-12:
            steps = [*steps[-9:], (s, y, 1 / (s @ y))]
        done = loss - new < 1e-7
        x, loss, down = x + s, new, new_down
        if done:
            break
    return Model(x[:n_words], x[n_words:-1], float(x[-1]))


@dataclass
class Chain:
    """Models of the categories in order, over one vocabulary."""

    categories: tuple[str, ...]
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    models: list[Model] = field(default_factory=list)

    def predict(self, sets: list[np.ndarray], shares: np.ndarray) -> list[np.ndarray]:
        if not self.models:
            return [np.zeros(len(sets)) for _ in self.categories]
        rows, out = Rows.of(sets, shares, self.vocabulary), []
        for model in self.models:
            out.append(model.probability(rows))
            rows = rows.with_column(out[-1])
        return out


def fit_chain(
    categories: tuple[str, ...],
    sets: list[np.ndarray],
    shares: np.ndarray,
    truth: np.ndarray,
    weight: np.ndarray,
    *,
    least_documents: int = 3,
    penalty: float = 3e-5,
) -> Chain:
    """``truth`` has a column for each category; words in fewer than ``least_documents`` rows are left out."""
    words, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0))
    chain = Chain(categories, words[counts >= least_documents])
    n, size = len(sets), len(chain.vocabulary)
    rows, fold = Rows.of(sets, shares, chain.vocabulary), np.arange(n) % FOLDS
    for k in range(len(categories)):
        chain.models.append(fit(rows, truth[:, k], weight, size, penalty))
        if k + 1 < len(categories):
            apart = np.zeros(n)
            for f in range(FOLDS):
                seen = fit(rows.where(fold != f), truth[fold != f, k], weight[fold != f], size, penalty)
                apart[fold == f] = seen.probability(rows.where(fold == f))
            rows = rows.with_column(apart)
    return chain


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: tuple[str, ...],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_stratum: int = 1500,
) -> Chain:
    """Fit the chain on at most ``per_stratum`` labelled documents of each combination of labels.

    ``labels`` has the id and a 0/1 column for each category; other values are refused.  Rows with a null
    are left out; of several rows of an id the largest values count, and one of its texts, chosen by hash.  The sample is drawn by a hash of the id.  Without labelled
    documents the chain has no models and predicts 0.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), *[F.col(c).cast("int") for c in categories])
    known = known.dropna().groupBy("_id").agg(*[F.max(c).alias(c) for c in categories])
    known = stage(known, "labels")
    odd = " or ".join(f"{c} not in (0, 1)" for c in categories)
    if not known.where(odd).isEmpty():
        raise ValueError(f"labels other than 0 and 1 in {', '.join(categories)}")
    # One row for each combination of 0 and 1.
    strata = known.groupBy(*categories).count().orderBy(*categories).collect()
    sample = None
    for s in strata:
        mine = known
        for c in categories:
            mine = mine.where(F.col(c) == s[c])
        mine = mine.orderBy(F.xxhash64("_id"), "_id").limit(per_stratum)
        sample = mine if sample is None else sample.unionByName(mine)
    if sample is None:
        return Chain(categories)
    # A bounded number of rows: per_stratum for each combination of 0 and 1.
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("text").isNotNull()).join(F.broadcast(sample), "_id")
    rows = rows.groupBy("_id", *categories).agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, shares = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s.view(np.int64) for s in sets], type=pa.list_(pa.int64())),
                    pa.array(list(shares), type=pa.list_(pa.float64())),
                    *batch.columns[2:],
                ],
                names=["_id", "words", "shares", *categories],
            )

    schema = "_id long, words array<long>, shares array<double>, " + ", ".join(f"{c} int" for c in categories)
    got = rows.select("_id", "text", *categories).mapInArrow(run, schema).toArrow().sort_by("_id")
    if not len(got):
        return Chain(categories)
    sets = [np.array(x.as_py(), dtype=np.int64).view(np.uint64) for x in got["words"]]
    shares = np.array(got["shares"].to_pylist(), dtype=np.float64)
    truth = np.column_stack([got[c].to_numpy() for c in categories]).astype(np.float64)
    names = [tuple(t) for t in truth.astype(int).tolist()]
    share = {tuple(s[c] for c in categories): s["count"] for s in strata}
    drawn = Counter(names)
    weight = np.array([share[t] / drawn[t] for t in names])
    return fit_chain(categories, sets, shares, truth, weight)


def score(
    docs: DataFrame, chain: Chain, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and a probability ``p_<category>`` for each category and row.

    A null or empty text has the features of no words, and its probabilities are 0.  Repeated rows and null ids are
    kept; an empty table gives an empty one; other columns are ignored.
    """
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets, shares = features(part.column(1))
                full = np.array([len(s) > 0 for s in sets])
                found = [p * full for p in chain.predict(sets, shares)]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, found)], names=["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names))


CATEGORIES = ("low_quality", "toxic")
#: Probability from which a document counts as toxic.
THRESHOLD = 0.5


def _trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_stratum: int) -> Chain:
    known = labels.withColumn("low_quality", 1 - F.col("quality").cast("int"))
    return train(docs, known, CATEGORIES, id_col=id_col, text_col=text_col, per_stratum=per_stratum)


def flag(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", per_stratum: int = 1500
) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, toxic`` for each row.

    ``labels`` has ``quality`` and ``toxic``, both 0/1; low quality is the first category of the chain.
    """
    chain = _trained(docs, labels, id_col, text_col, per_stratum)
    out = score(docs, chain, id_col=id_col, text_col=text_col)
    return out.withColumn("toxic", F.col("p_toxic") >= THRESHOLD)


def keep_clean(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", per_stratum: int = 1500
) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns as they were, without a shuffle."""
    chain = _trained(docs, labels, id_col, text_col, per_stratum)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                sets, shares = features(part.column(at))
                full = np.array([len(s) > 0 for s in sets], dtype=bool)
                yield part.filter(pa.array(~full | (chain.predict(sets, shares)[-1] < THRESHOLD)))

    return docs.mapInArrow(run, docs.schema)
