"""Token ids in binary files, with Elias-Fano encoded document boundaries.

A file holds the ids of consecutive documents one after another, then two rising sequences: where each document begins
and ends, and the documents' ids. Any document is found by two lookups, without a table of 64-bit offsets.

    magic | ids, 2 or 4 bytes each | boundaries | document ids | trailer

Tasks write the files, each under a name of its own attempt; which of them count says the list that Spark commits, so
a task that is run again leaves at most a file that nobody reads. Files hold about `file_ids` ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tradelake.llm import eliasfano
from tradelake.llm.bytepairs import coder_of
from tradelake.llm.common import ship_package, texts
from tradelake.llm.shared import place
from tradelake.session import materialize

MAGIC = b"TLTOKEN1"
# ids, documents, documents without an id, smallest document id, bytes per id, check sum of the ids, size of the boundaries.
_TRAILER = struct.Struct("<QQQqIIQ8s")
FILE_IDS = 1 << 26
# Ids read at a time, unless a document has more.
READ_IDS = 1 << 20
FILES = "part int, number int, file string, docs long, ids long"


class Writer:
    """Writes one file; ids go out as they come, only the lengths and ids of its documents are held."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.lengths, self.keys, self.ids, self.check = array("Q"), array("q"), 0, 0
        out.write(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(f"<u{self.width}").tobytes()
        self.out.write(raw)
        self.check = zlib.crc32(raw, self.check)
        self.lengths.append(len(ids))
        if key is not None:
            self.keys.append(key)
        self.ids += len(ids)

    def close(self) -> None:
        known = np.array(self.keys, np.int64)
        smallest = int(known[0]) if len(known) else 0
        boundaries = eliasfano.encode(np.concatenate([[0], np.cumsum(self.lengths)]))
        # In unsigned numbers the distance of any two 64-bit ids is right.
        keys = eliasfano.encode(known.astype(np.uint64) - np.uint64(smallest % 2**64))
        self.out.write(boundaries)
        self.out.write(keys)
        self.out.write(
            _TRAILER.pack(self.ids, len(self.lengths), len(self.lengths) - len(known), smallest, self.width, self.check, len(boundaries), MAGIC)
        )
        self.out.close()


class Reader:
    """Reads one file. Boundaries and document ids stay encoded in memory, ids are read when asked for."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        trailer = file.read_at(_TRAILER.size, size - _TRAILER.size)
        self.ids, self.docs, self.nulls, self.smallest, self.width, self.check, bounds, magic = _TRAILER.unpack(trailer)
        if magic != MAGIC or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of token ids")
        at = len(MAGIC) + self.ids * self.width
        self.boundaries = eliasfano.Sequence(file.read_at(bounds, at))
        self.keys = eliasfano.Sequence(file.read_at(size - _TRAILER.size - at - bounds, at + bounds))

    def key(self, i: int) -> int | None:
        """Id of the i-th document."""
        return self.keys_of(i, i + 1)[0]

    def keys_of(self, first: int, last: int) -> list[int | None]:
        none = max(min(self.nulls, last) - first, 0)
        known = self.keys.slice(max(first - self.nulls, 0), max(last - self.nulls, 0))
        return [None] * none + [int(k) + self.smallest for k in known]

    def tokens(self, first: int, last: int) -> np.ndarray:
        """Ids first to before last of the whole file."""
        raw = self.file.read_at((last - first) * self.width, len(MAGIC) + first * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, with the end id."""
        first, last = (int(x) for x in self.boundaries.slice(i, i + 2))
        return self.tokens(first, last)

    def runs(self):
        """All documents in runs of about READ_IDS ids: first document, its boundaries and one more, ids. Checks the sum."""
        at, check = 0, 0
        while at < self.docs:
            step = at + 4096
            ends = self.boundaries.slice(at, min(step, self.docs) + 1)
            n = max(int(np.searchsorted(ends, int(ends[0]) + READ_IDS, "right")) - 1, 1)
            ends = ends[: n + 1].astype(np.int64)
            ids = self.tokens(int(ends[0]), int(ends[-1]))
            check = zlib.crc32(ids.tobytes(), check)
            yield at, ends, ids
            at += n
        if check != self.check:
            raise ValueError("the ids of a file are not those that were written")


def write(docs: DataFrame, spec: str, folder: str, end: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes all texts as token ids, `end` after each, in ascending order of doc_id; returns the list of files.

    `spec` is a byte-level vocabulary. The list has a row per file in order (part, number) with its documents and ids.
    doc_id is a whole number; rows without one come first, rows that share one are ordered by their texts, repeated
    rows are written as often as they occur. A null text is an empty one: the end id alone. An empty table makes no
    file. Other columns are left out. No task gathers the rows of one doc_id: equal rows are spread by their place in
    the table.
    """
    if not isinstance(docs.schema["doc_id"].dataType, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError("doc_id must be a whole number")
    rows = texts(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"), F.xxhash64(F.monotonically_increasing_id()).alias("r")
    )
    ship_package(docs.sparkSession)

    def to_files(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, coder, done, writer = TaskContext.get().partitionId(), coder_of(spec), [], None
        width = 2 if max(coder.size - 1, end) < 2**16 else 4
        system, root = place(folder)
        system.create_dir(root, recursive=True)

        def close():
            writer.close()
            done.append((part, len(done), name, len(writer.lengths), writer.ids))

        for b in batches:
            for key, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if writer is None:
                    name = f"part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.ids"
                    writer = Writer(system.open_output_stream(f"{root}/{name}"), width)
                writer.add(key, np.append(coder.encode(text), np.uint32(end)))
                if writer.ids >= file_ids:
                    close()
                    writer = None
        if writer is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["part", "number", "file", "docs", "ids"],
            )

    order = [F.col("doc_id").asc_nulls_first(), "h", "text", "r"]
    sorted_rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h", "r").sortWithinPartitions(*order)
    listed = sorted_rows.select("doc_id", "text").mapInArrow(to_files, FILES)
    # A row per file: one file of Parquet in place of one from each task. Each costs the JVM some processes that set its rights.
    return materialize(listed.repartition(1), "token-files")


def read(files: DataFrame, folder: str) -> DataFrame:
    """Every document of the listed files: doc_id, start (ids of all documents before it), n_tokens, ids.

    `ids` are little-endian unsigned 32-bit numbers. A file is read in runs of documents; the sum over the files before
    it is the only thing its task has to be told.
    """
    before = F.sum("ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    placed = files.select("file", F.coalesce(before, F.lit(0)).alias("base")).repartition("file")

    def documents(batches):
        import pyarrow as pa

        system, root = place(folder)
        for b in batches:
            for name, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist(), strict=True):
                with system.open_input_file(f"{root}/{name}") as file:
                    reader = Reader(file)
                    for first, ends, ids in reader.runs():
                        raw = ids.astype("<u4")
                        cuts = (ends - ends[0]) * 4
                        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(raw)])
                        columns = [
                            pa.array(reader.keys_of(first, first + len(ends) - 1), pa.int64()),
                            pa.array(ends[:-1] + base), pa.array(np.diff(ends)), values.cast(pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    ship_package(files.sparkSession)
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")
