"""Packing along a space-filling curve.

A document's tokens are hashed into a vector of counts, the vector is projected to three dimensions, and the point's
place on a Hilbert curve is the document's key. Documents are range-sorted by key and laid end to end along the
curve, so that a sequence holds documents of similar content. The line of tokens is cut every `length` tokens; only
the last sequence of all needs padding.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradelake.llm.common import add_columns, ship_package, texts
from tradelake.llm.words import tokenizer_of
from tradelake.session import materialize

LENGTH = 4096
END = 2
BUCKETS = 1024
DIMENSIONS = 3
BITS = 10
PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def projection() -> np.ndarray:
    """Fixed random directions, one row per hash bucket."""
    return np.random.default_rng(20240131).standard_normal((BUCKETS, DIMENSIONS))


def points(ids: list[np.ndarray]) -> np.ndarray:
    """Projected hashed vectors: square roots of bucket counts at unit length, so that long documents weigh no more."""
    directions, out = projection(), np.zeros((len(ids), DIMENSIONS))
    for i, tokens in enumerate(ids):
        hashed = (tokens.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(22)
        counts = np.sqrt(np.bincount(hashed, minlength=BUCKETS))
        out[i] = counts @ directions / max(np.sqrt((counts * counts).sum()), 1e-9)
    return out


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates below 2**bits.

    Coordinates are turned, from the coarsest bit to the finest, so that each cell's curve joins its neighbours'; what
    is then interleaved is the Gray code of the place.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            turned = (x[:, d] >> b) & 1 == 1
            x[turned, 0] ^= low
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= swap
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[:, -1] >> b) & 1 == 1, flip ^ ((1 << b) - 1), flip)
    x ^= flip[:, None]
    place = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            place = (place << 1) | ((x[:, d] >> b) & 1)
    return place


def tokenized(docs: DataFrame, spec: str) -> DataFrame:
    """row, doc_id, tokens (16-bit ids, END last), n and the projected point of each row."""

    def compute(batch: list[str]) -> list:
        found = [ids + END.to_bytes(2, "little") for ids in tokenizer_of(spec).encode(batch)]
        at = points([np.frombuffer(ids, "<u2") for ids in found])
        return [found, [len(ids) // 2 for ids in found], *at.T.tolist()]

    fields = ", ".join(f"p{d} double" for d in range(DIMENSIONS))
    rows, name = add_columns(texts(docs), compute, f"tokens binary, n long, {fields}")
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", f"{name}.*")


def placed(rows: DataFrame) -> DataFrame:
    """row and from (its tokens' place in the line of all tokens), with documents in order of Hilbert keys.

    The grid spans each dimension from the 1st to the 99th percentile of all points; points outside lie on its edge.
    Copies share a key and are ordered by a hash of their row, so that no range of the sort has to hold all of them.
    """
    spark = rows.sparkSession
    axes = [f"p{d}" for d in range(DIMENSIONS)]
    edges = rows.agg(*[F.percentile_approx(a, [0.01, 0.99], 10_000) for a in axes]).first()
    low = np.array([e[0] if e else 0.0 for e in edges])
    wide = np.array([max(e[1] - e[0], 1e-9) if e else 1.0 for e in edges])

    def keys(batches):
        import pyarrow as pa

        for b in batches:
            at = np.stack([b.column(a).to_numpy() for a in axes], 1)
            cells = np.clip((at - low) / wide * (1 << BITS), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n"), pa.array(hilbert(cells))], names=["row", "n", "key"])

    def line(batches):
        import pyarrow as pa

        total = 0
        for b in batches:
            ends = np.cumsum(b.column("n").to_numpy()) + total
            starts = ends - b.column("n").to_numpy()
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n"), pa.array(starts)], names=["row", "n", "start"])

    ship_package(spark)
    keyed = rows.select("row", "n", *axes).mapInArrow(keys, "row long, n long, key long")
    ordered = keyed.repartitionByRange("key", F.xxhash64("row")).sortWithinPartitions("key", F.xxhash64("row"), "row")
    parted = ordered.mapInArrow(line, "row long, n long, start long").withColumn("part", F.spark_partition_id())
    parted = materialize(parted, "packing-line")
    sizes = parted.groupBy("part").agg(F.sum("n").alias("n"))  # one row per partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = F.broadcast(sizes.select("part", F.coalesce(before, F.lit(0)).alias("base")))
    return parted.join(bases, "part").select("row", (F.col("start") + F.col("base")).alias("from"))


def pack(docs: DataFrame, spec: str, length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences of `length` tokens.

    A null text is a document of the end token alone. Repeated rows are packed as often as they occur. Pieces of a
    document follow each other in consecutive sequences; an empty table has no sequences.
    """
    rows = materialize(tokenized(docs, spec), "packing-tokens")
    laid = rows.select("row", "doc_id", "tokens").join(placed(rows), "row")
    pieces = StructType.fromDDL(PIECES.format(id=docs.schema["doc_id"].dataType.simpleString()))

    def cut(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(pieces)
        for b in batches:
            out = []
            for doc_id, tokens, start in zip(*[b.column(c).to_pylist() for c in ("doc_id", "tokens", "from")], strict=True):
                ids = np.frombuffer(tokens, "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    sequence, offset = divmod(start + at, length)
                    n = min(length - offset, len(ids) - at)
                    out.append((doc_id, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids), sequence, offset))
                    at += n
            columns = list(zip(*out, strict=True)) or [[]] * len(schema)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return laid.mapInArrow(cut, pieces)
