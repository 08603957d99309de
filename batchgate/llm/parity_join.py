"""Similarity join of sets of word runs by parity sketches (operator 12).

A parity sketch has one bit for each value of a hash; every element flips its bit.  Elements that two
sets share cancel out, so two sketches differ in at most as many bits as the sets do in elements.  Sets
of a and b elements with a Jaccard similarity of at least 0.9 differ in at most (a + b) / 19.

1. Documents of equal sets are one from here on, under the smallest id.
2. Sizes are cut into bands that grow by a quarter.  Within a band no linked pair differs in more than
   some number of elements; the band's sketches have one 64-bit piece more than that, so each linked pair
   shares a piece.  Sets that could be linked with one of the next band get that band's pieces as well.
   No link can be missed.
3. Sets that share a piece form a bucket.  Each is paired with two of the bucket only; a set's three most
   alike partners are compared in full first, and union-find groups the links.
4. In buckets that still hold several groups, sets of different groups are compared where they meet, by
   size and by a sketch of 1024 bits that is the same for all bands.  A pair leaves the join only from
   the first bucket that the two share.  These are compared in full, and union-find runs once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import bounded, splittable, stage
from batchgate.llm.components import components
from batchgate.llm.wordhash import mix, numbers, shingles, word_hashes

SHINGLE = 3
#: Two sets are linked from 100 * shared >= 90 * union on, so they differ in at most (a + b) / APART.
LEAST, APART = 90, 19
#: Longs of the sketch that all sets have alike.
SKETCH = 16
SIGNED = "doc_id long, n int, digest binary, own array<long>, low array<long>, sketch array<long>"
#: Documents handled at once within an Arrow batch.
SLICE = 128
_SALT = numbers(2, 12)


def band_edges() -> np.ndarray:
    """First size of each band; below the first edge only equal sets are linked."""
    edges = [APART // 2]
    while edges[-1] < 1 << 31:
        edges.append(max(edges[-1] + 2, edges[-1] * 5 // 4))
    return np.array(edges, dtype=np.int64)


_EDGES = band_edges()


def pieces(elements: np.ndarray, band: int) -> np.ndarray:
    """The pieces of a set's sketch for ``band``, each with the band and its place mixed in.

    ``elements`` are sorted; an element's upper bits name its piece, the lower six its bit in it.
    """
    most = int(2 * (_EDGES[band + 1] - 1) // APART) + 1
    place = ((elements >> np.uint64(32)) * np.uint64(most)) >> np.uint64(32)
    bit = np.uint64(1) << (mix(elements ^ _SALT[0]) & np.uint64(63))
    held, at = np.unique(place, return_index=True)
    out = np.zeros(most, dtype=np.uint64)
    out[held.astype(np.int64)] = np.bitwise_xor.reduceat(bit, at)
    name = (np.uint64(band + 1) << np.uint64(32)) + np.arange(most, dtype=np.uint64)
    return mix(out ^ mix(name)).view(np.int64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The sketch that is the same for all bands, as SKETCH longs."""
    odd = np.bincount((mix(elements ^ _SALT[1]) & np.uint64(SKETCH * 64 - 1)).astype(np.int64), minlength=SKETCH * 64)
    return np.packbits((odd & 1).astype(np.uint8)).view("<i8")


def _own_and_low(elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of a set for its own band, and for the next one where a partner could be there."""
    none, n = np.zeros(0, dtype=np.int64), len(elements)
    band = int(np.searchsorted(_EDGES, n, "right")) - 1
    if band < 0:
        return none, none
    near = 100 * n >= LEAST * _EDGES[band + 1]
    return pieces(elements, band), pieces(elements, band + 1) if near else none


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, digest, pieces and sketch of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words, first = word_hashes(part.column(1))
                sets = [shingles(words[a:b], SHINGLE) for a, b in zip(first, first[1:], strict=False)]
                own, low = zip(*[_own_and_low(s) for s in sets], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], type=pa.int32()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]),
                        _lists(own),
                        _lists(low),
                        _lists([sketch(s) for s in sets]),
                    ],
                    names=["doc_id", "n", "digest", "own", "low", "sketch"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SIGNED)


def _differing(a: str, b: str) -> str:
    """SQL for the number of bits in which two sketches differ."""
    return " + ".join(f"bit_count({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(SKETCH))


def _possible(a: str, b: str) -> Column:
    """Whether sizes and sketches allow a link; never false for a linked pair."""
    return F.expr(
        f"100L * least({a}.n, {b}.n) >= {LEAST} * greatest({a}.n, {b}.n) "
        f"and {APART} * ({_differing(a, b)}) <= 0L + {a}.n + {b}.n"
    )


def verified(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Those pairs ``(a, b)`` of ids whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sides = [word_hashes(part.column(c)) for c in (2, 3)]
                keep = np.zeros(part.num_rows, dtype=bool)
                for i in range(part.num_rows):
                    x, y = (shingles(words[first[i] : first[i + 1]], SHINGLE) for words, first in sides)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = both > 0 and 100 * both >= LEAST * (len(x) + len(y) - both)
                yield part.select([0, 1]).filter(pa.array(keep))

    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = stage(texts.join(bounded(ids), "id", "left_semi"), "texts")
    both = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
    both = both.join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _buckets(reps: DataFrame) -> DataFrame:
    """``key, rep`` of each piece that several sets share, at least one of them of the piece's band."""

    def named(column: str, own: bool) -> Column:
        return F.transform(column, lambda k: F.struct(k.alias("key"), F.lit(own).alias("own")))

    dealt = reps.select("rep", F.inline(F.concat(named("own", True), named("low", False))))
    often = dealt.groupBy("key").agg(F.count("*").alias("size"), F.max("own").alias("any"))
    shared = often.where("size > 1 and any").select("key")
    return splittable(dealt.select("key", "rep"), shared, "key", "left_semi")


def _stars(bucket: DataFrame, known: DataFrame) -> DataFrame:
    """Each set with the most alike of its buckets' two centres, three at most; ``a > b``."""
    centre = bucket.groupBy("key").agg(F.min("rep").alias("c0"), F.min_by("rep", F.xxhash64("rep", "key")).alias("c1"))
    star = splittable(bucket, centre, "key", "inner")
    star = star.select(F.col("rep").alias("a"), F.explode(F.array("c0", "c1")).alias("b")).where("a != b").distinct()
    side = known.select("rep", "n", "sketch")
    star = star.join(side.alias("x"), F.expr("a = x.rep")).join(side.alias("y"), F.expr("b = y.rep"))
    star = star.where(_possible("x", "y")).selectExpr("a", "b", f"{_differing('x', 'y')} as d")
    # At most two rows for each piece of a.
    likely = Window.partitionBy("a").orderBy("d", "b")
    star = star.withColumn("i", F.row_number().over(likely)).where("i <= 3")
    return star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _across(bucket: DataFrame, known: DataFrame, root: DataFrame) -> DataFrame:
    """All pairs of different groups that share a piece and could be linked; ``a > b``, each once."""
    placed = splittable(bucket, root.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.withColumn("root", F.coalesce("root", "rep"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    open_ = stage(splittable(placed, mixed.select("key"), "key", "left_semi"), "open")
    # As many keys as a document has pieces, at most.
    held = open_.groupBy("rep").agg(F.collect_set("key").alias("keys"))
    open_ = open_.join(stage(held.join(known, "rep"), "held"), "rep")
    return (
        open_.alias("x")
        .join(
            open_.alias("y"),
            F.expr("x.key = y.key and x.rep > y.rep and x.root != y.root")
            & _possible("x", "y")
            & F.expr("array_min(array_intersect(x.keys, y.keys)) = x.key"),
        )
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .distinct()
    )


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row.

    Documents whose sets of 3-word shingles (A-Z lower-cased) have a Jaccard similarity of at least 0.9
    are linked; ``component_id`` is the smallest id that links lead to.  Shorter texts have their whole
    sequence as the one shingle; null texts and texts without words have none and are linked with nothing.
    An id with several rows gets the smallest component of any of them.  A null id gets a null component.  An empty table gives an empty one; other columns
    are ignored.
    """
    rows = stage(signed(docs, id_col, text_col), "signed")
    full = rows.where("n > 0 and doc_id is not null")
    one = F.min_by(F.struct("doc_id", "n", "own", "low", "sketch"), "doc_id").alias("r")
    reps = full.groupBy("digest").agg(one).select("digest", F.col("r.doc_id").alias("rep"), "r.n", "r.own", "r.low", "r.sketch")
    reps = stage(reps, "reps")
    member = splittable(full.select("doc_id", "digest"), reps.select("digest", "rep"), "digest", "inner")

    bucket = stage(_buckets(reps), "buckets")
    inside = stage(bucket.select("rep").distinct(), "inside")
    known = stage(reps.select("rep", "n", "sketch").join(bounded(inside), "rep", "left_semi"), "known")
    links = stage(verified(stage(_stars(bucket, known), "pairs"), docs, id_col, text_col), "verified")
    pairs = stage(_across(bucket, known, components(links)), "pairs")
    root = components(links.unionByName(verified(pairs, docs, id_col, text_col)))

    found = splittable(member.select("doc_id", "rep"), root.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("doc_id", F.coalesce("root", "rep").alias("root"))
    found = found.groupBy("doc_id").agg(F.min("root").alias("root"))
    out = splittable(rows.select("doc_id", "n"), found, "doc_id", "left")
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )
