"""Token ids as length-delimited binary records with an offset index (operator 10).

A record is the payload's length (unsigned 64 bits), the masked checksum of those eight bytes, the
payload and its masked checksum (both unsigned 32 bits), all little-endian.  The checksum is CRC-32,
turned right by 15 bits plus a constant, so that a checksum of data that holds checksums stays useful.
A payload is one document's ids, each in two bytes if the vocabulary allows it, else in four.  Beside
each data file stands an index with one fixed entry for each record: document, byte offset, first token
and number of tokens; with it records can be read in any order.

Files are written by the tasks of a sort by document, each attempt under names of its own, and the
manifest, a staged table, names the files of the attempts that counted.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import shared_path, stage
from batchgate.llm.tokenids import ID, encoder

# Fixed value: the constant of masked checksums.
MASK = 0xA282EAD8
HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<I")
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("start", "<u8"), ("n", "<u8")])
ENTRY = struct.Struct("<qBQQQ")
MANIFEST = "part long, file long, path string, width int, n_records long, n_tokens long, n_bytes long"
RECORDS = "doc_id long, start long, n_tokens long, ids binary"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + TAIL.pack(masked(size)) + payload + TAIL.pack(masked(payload))


def unframe(stream, path: str) -> bytes:
    """The next payload; raises if a length or checksum is wrong."""
    head = stream.read(HEAD.size)
    size, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError(f"{path}: damaged record length")
    body = stream.read(size + TAIL.size)
    if len(body) != size + TAIL.size or masked(body[:size]) != TAIL.unpack(body[size:])[0]:
        raise ValueError(f"{path}: damaged record")
    return body[:size]


class RecordFile:
    """Writes one data file and its index; both appear under their names when complete."""

    def __init__(self, uri: str, width: int):
        self.files, self.path = fs.FileSystem.from_uri(uri)
        self.uri, self.dtype = uri, np.dtype(f"<u{width}")
        self.out = self.files.open_output_stream(f"{self.path}.tmp")
        self.offset = self.tokens = self.records = 0
        self.index = bytearray()

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        record = frame(ids.astype(self.dtype).tobytes())
        self.out.write(record)
        self.index += ENTRY.pack(doc or 0, doc is not None, self.offset, self.tokens, len(ids))
        self.records += 1
        self.offset += len(record)
        self.tokens += len(ids)

    def close(self) -> None:
        self.out.close()
        with self.files.open_output_stream(f"{self.path}.idx.tmp") as out:
            out.write(bytes(self.index))
        self.files.move(f"{self.path}.idx.tmp", f"{self.path}.idx")
        self.files.move(f"{self.path}.tmp", self.path)


def write_records(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    file_bytes: int = 1 << 28,
    file_records: int = 1 << 20,
    special_tokens: bool = False,
    remembered: int = 400_000,
) -> DataFrame:
    """Write all documents in ascending id order; the manifest of files, with each one's first token.

    Null ids come first; rows of one id are ordered by their texts' hash; a null or empty text is the end
    id alone; an empty table writes nothing; other columns are ignored.  ``folder`` must be shared by all
    executors and is created; by default it lies in the cluster's shared folder.  A file is closed beyond
    ``file_bytes`` or ``file_records``, whichever comes first.  With ``special_tokens`` their strings in a
    text are those tokens, else ordinary text.  ``remembered`` bounds a worker's memory of encoded chunks.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = encoder(tokenizer_path, remembered, special_tokens)
        width = 2 if tokens.vocabulary_size <= 1 << 16 and end_id < 1 << 16 else 4
        end = np.array([end_id], dtype=ID).tobytes()
        files, path = fs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        task, out, done = TaskContext.get(), None, []
        part = task.partitionId()

        def finish(f: RecordFile) -> None:
            f.close()
            done.append((part, len(done), f.uri, width, f.records, f.tokens, f.offset))

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                if out is None:
                    out = RecordFile(f"{folder}/{part:06d}-{task.taskAttemptId()}-{len(done):04d}.rec", width)
                ids = tokens.encode(text.as_py() or "") + end
                out.add(doc.as_py(), np.frombuffer(ids, dtype=ID))
                if out.offset >= file_bytes or out.records >= file_records:
                    finish(out)
                    out = None
        if out is not None:
            finish(out)
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        kinds = [pa.string() if n == "path" else pa.int32() if n == "width" else pa.int64() for n in names]
        columns = list(zip(*done, strict=True)) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = stage(rows.mapInArrow(run, MANIFEST), "manifest")
    # One row for each file.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_records(manifest: DataFrame, seed: int | None = None) -> DataFrame:
    """All records of the files in a manifest, lengths and checksums verified.

    ``ids`` is little-endian unsigned 32-bit.  With a ``seed`` each file's records are read in a random
    order by their offsets, and the files are dealt out at random; else in the order they were written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

        for batch in batches:
            for uri, width, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, path = fs.FileSystem.from_uri(uri)
                with files.open_input_stream(f"{path}.idx") as f:
                    index = np.frombuffer(f.read(), dtype=INDEX)
                rows, held = [], 0
                if seed is None:
                    stream = files.open_input_stream(path, buffer_size=1 << 20)
                else:
                    stream = files.open_input_file(path)
                    index = np.random.default_rng([seed, first]).permutation(index)
                with stream:
                    for doc, known, offset, start, n in index.tolist():
                        if seed is not None:
                            stream.seek(offset)
                        ids = np.frombuffer(unframe(stream, path), dtype=f"<u{width}")
                        if len(ids) != n:
                            raise ValueError(f"{path}: the index disagrees with a record")
                        rows.append((doc if known else None, first + start, n, ids.astype(ID).tobytes()))
                        held += n
                        if held >= 1 << 20:
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)

    files = manifest.select("path", "width", "first_token")
    # A number of its own for each file, and a task for each number: adaptive execution leaves those apart.
    tasks = max(1, files.count())
    order = F.col("path") if seed is None else F.xxhash64(F.lit(seed), "path")
    dealt = files.withColumn("n", F.row_number().over(Window.orderBy(order)))
    return dealt.repartitionByRange(tasks, "n").drop("n").mapInArrow(run, RECORDS)
