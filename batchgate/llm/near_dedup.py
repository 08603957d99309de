"""Near-duplicate documents by SuperMinHash, banding, verification and union-find (operator 3).

1. A pass over the texts gives each document the digest of its set of 5-word shingles, 64 band keys of
   its SuperMinHash signature and a sketch of four bits for each of the signature's 384 slots.
2. Documents of equal sets are one from here on, under the smallest id.
3. Documents that share a band key form a bucket.  Each member is paired with two of the bucket, the
   smallest id and one chosen by hash, never with all; pairs whose sketches rule the similarity out go,
   a member's three most likely pairs are verified on the full sets, and union-find groups the links.
4. In buckets that still hold several groups, members of different groups are compared where they meet:
   their sketches, then their sets, folded to 32 bits, whose shared values bound the similarity from
   above.  Only pairs that pass leave the join, each from the first bucket that the two share.  These
   are verified on the full sets, and union-find runs once more.

So the members of a large group of copies are compared with a few of their number each, and yet no
link of two groups is passed over.  A pair at a similarity of exactly 0.75 shares no band with a
probability of 4e-6, and less above that; its sketches rule it out at five standard deviations.
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
from batchgate.llm.superminhash import band_keys, nibble_sketch, signatures
from batchgate.llm.wordhash import shingles, word_hashes

SHINGLE, BANDS, ROWS = 5, 64, 6
SKETCH = BANDS * ROWS // 16
#: At 0.75 90 slots of two sketches are expected to differ, with a standard deviation of at most 8.4.
MOST_DIFFERING = 132
SIGNED = "doc_id long, n int, digest binary, keys array<long>, sketch array<long>"
#: Documents handled at once within an Arrow batch.
SLICE = 256


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, digest, band keys and sketch of each document; of an empty set the keys are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words, first = word_hashes(part.column(1))
                sets = [shingles(words[a:b], SHINGLE) for a, b in zip(first, first[1:], strict=False)]
                table = signatures(sets, BANDS * ROWS)
                keys, sketch = band_keys(table, BANDS, ROWS), nibble_sketch(table)
                full = np.array([len(s) > 0 for s in sets], dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], type=pa.int32()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full == 1].reshape(-1))),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1, dtype=np.int32) * SKETCH),
                            pa.array(sketch.reshape(-1)),
                        ),
                    ],
                    names=["doc_id", "n", "digest", "keys", "sketch"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SIGNED)


def _differing(a: str, b: str) -> str:
    """SQL for the number of slots in which two sketches differ."""
    return " + ".join(
        f"bit_count((({x}) | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | "
        f"shiftrightunsigned({x}, 3)) & 1229782938247303441L)"
        for x in (f"({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(SKETCH))
    )


def _possible(a: str, b: str) -> Column:
    """Whether sizes and sketches allow a similarity of 0.75."""
    return F.expr(
        f"100 * least({a}.n, {b}.n) >= 75 * greatest({a}.n, {b}.n) and "
        f"{_differing(a, b)} <= {MOST_DIFFERING}"
    )


def _bounded_by_sets(a: str, b: str) -> Column:
    """Whether folded sets allow a similarity of 0.75; folding makes one of at most so many as it removes."""
    shared = f"(size(array_intersect({a}.fold, {b}.fold)) + {a}.n - size({a}.fold))"
    return F.expr(f"7 * {shared} >= 3 * ({a}.n + {b}.n)")


def folded(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, fold``: the upper halves of the shingles of the documents in ``ids`` (rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words, first = word_hashes(part.column(1))
                sets = [shingles(words[a:b], SHINGLE) for a, b in zip(first, first[1:], strict=False)]
                folds = [np.unique(s >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(folds, type=pa.list_(pa.int32()))], names=["rep", "fold"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    return rows.join(bounded(ids), "rep", "left_semi").mapInArrow(run, "rep long, fold array<int>")


def verified(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Those pairs ``(a, b)`` of ids whose full sets have a similarity of at least 0.75."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words, first = word_hashes(part.column(2))
                texts, keep = part.column(3), np.zeros(part.num_rows, dtype=bool)
                for i in range(part.num_rows):
                    other = texts[i].as_py()
                    if other != last[0]:
                        last = other, shingles(word_hashes(pa.array([other]))[0], SHINGLE)
                    x, y = shingles(words[first[i] : first[i + 1]], SHINGLE), last[1]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = both > 0 and 100 * both >= 75 * (len(x) + len(y) - both)
                yield part.select([0, 1]).filter(pa.array(keep))

    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = stage(texts.join(bounded(ids), "id", "left_semi"), "texts")
    both = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
    both = both.join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row.

    Documents whose sets of 5-word shingles (A-Z lower-cased) have a Jaccard similarity of at least 0.75
    are linked; ``component_id`` is the smallest id that links lead to.  Shorter texts have their whole
    sequence as the one shingle; null texts and texts without words have none and are linked with
    nothing.  A document with several rows gets the
    smallest component of any of them.  A null id gets a
    null component and is kept.  An empty table gives an empty one; other columns are ignored.
    """
    rows = stage(signed(docs, id_col, text_col), "signed")
    full = rows.where("n > 0 and doc_id is not null")
    group = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = splittable(full.select("doc_id", "digest"), group, "digest", "inner").select("doc_id", "rep")
    reps = full.groupBy("digest").agg(F.min_by(F.struct("doc_id", "n", "keys", "sketch"), "doc_id").alias("r"))
    reps = reps.select(F.col("r.doc_id").alias("rep"), "r.n", "r.keys", "r.sketch")

    dealt = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    shared = dealt.groupBy("key").agg(
        F.count("*").alias("size"), F.min("rep").alias("c0"), F.min_by("rep", F.xxhash64("rep", "band")).alias("c1")
    )
    bucket = stage(splittable(dealt, shared.where("size > 1").drop("size"), "key", "inner"), "buckets")
    inside = stage(bucket.select("rep").distinct(), "inside")
    known = stage(reps.join(bounded(inside), "rep", "left_semi"), "known")

    star = bucket.select(F.col("rep").alias("a"), F.explode(F.array("c0", "c1")).alias("b"))
    star = star.where("a != b").distinct()
    side = known.select("rep", "n", "sketch")
    star = star.join(side.alias("x"), F.expr("a = x.rep")).join(side.alias("y"), F.expr("b = y.rep"))
    star = star.where(_possible("x", "y")).selectExpr("a", "b", f"{_differing('x', 'y')} as d")
    # At most 128 rows for each a.
    likely = Window.partitionBy("a").orderBy("d", "b")
    star = star.withColumn("i", F.row_number().over(likely)).where("i <= 3")
    pairs = star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(verified(stage(pairs, "pairs"), docs, id_col, text_col), "verified")
    root = components(links)

    placed = splittable(bucket.select("key", "band", "rep"), root.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.withColumn("root", F.coalesce("root", "rep"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    open_ = stage(splittable(placed, mixed.select("key"), "key", "left_semi"), "open")
    inside = stage(open_.select("rep").distinct(), "inside")
    folds = stage(folded(docs, inside, id_col, text_col), "folds")
    open_ = open_.join(known, "rep").join(folds, "rep")
    apart = open_.alias("x").join(
        open_.alias("y"),
        F.expr("x.key = y.key and x.rep > y.rep and x.root != y.root")
        & _possible("x", "y")
        & F.expr("array_position(zip_with(x.keys, y.keys, (p, q) -> p = q), true) = x.band + 1")
        & _bounded_by_sets("x", "y"),
    )
    pairs = stage(apart.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct(), "pairs")
    more = stage(verified(pairs, docs, id_col, text_col), "verified")
    root = components(links.unionByName(more))

    found = splittable(member, root.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("doc_id", F.coalesce("root", "rep").alias("root"))
    found = found.groupBy("doc_id").agg(F.min("root").alias("root"))
    out = splittable(rows.select("doc_id", "n"), found, "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, one for each id; null ids stay."""
    found = stage(near_duplicates(docs, id_col, text_col), "components")
    key = F.col(id_col).cast("long") == F.col("__gone_id")
    gone = stage(found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone_id")).distinct(), "gone")
    rest = docs.join(bounded(gone), key, "left_anti")
    often = found.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("__gone_id")).count()
    often = stage(often.where("count > 1").select("__gone_id"), "often")
    if often.isEmpty():
        return rest
    mine = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = rest.join(bounded(often), key, "left_semi").groupBy(F.col(id_col).alias("__gone_id"))
    one = one.agg(F.min_by(mine, F.xxhash64(text_col)).alias("r")).select("r.*")
    return rest.join(bounded(often), key, "left_anti").unionByName(one)
