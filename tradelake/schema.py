"""Column layouts shared by every module."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Canonical curated trade. ingest_ts is optional: sources that do not record it leave it null.
TRADE = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_id", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("trade_ts", T.TimestampType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

# Columns a trade table must have; ingest_ts stays optional.
REQUIRED_COLUMNS = ("exchange", "symbol", "trade_id", "side", "price", "quantity", "trade_ts")

PRODUCT = ("exchange", "symbol")
TRADE_KEY = ("exchange", "symbol", "trade_id")

CORRUPT = "_corrupt_record"

# Raw JSON lines. Every scalar is read as text so that "1.5" and 1.5 both load; typing happens later.
RAW_FIELDS = (
    "id", "trade_id", "product_id", "product-id", "side", "price", "size", "qty", "time", "timestamp",
    "bid", "ask", "_source", "_source_ingest_ts", "_raw_payload",
)


def raw_schema(names: Iterable[str] = ()) -> T.StructType:
    """The fields every source may have, and `names`, the raw fields of a mapping."""
    every = dict.fromkeys((*RAW_FIELDS, *names))
    return T.StructType([T.StructField(name, T.StringType()) for name in (*every, CORRUPT)])


# Exchange API payload, embedded as text in a raw record.
PAYLOAD = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("bid", T.StringType()),
        T.StructField("ask", T.StringType()),
    ]
)

WATERMARK = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("cursor", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

PROCESSED_FILE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_read", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("records_transformed", T.LongType()),
        T.StructField("records_written", T.LongType()),
        T.StructField("duplicates_found", T.LongType()),
        T.StructField("batch_size", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("issues", T.ArrayType(T.StringType())),
        T.StructField("stale_products", T.LongType()),
        T.StructField("broken_invariants", T.ArrayType(T.StringType())),
    ]
)

# What must hold after a run, with what its jobs counted while writing and what was read back.
INVARIANT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("invariant", T.StringType()),
        T.StructField("expected", T.LongType()),
        T.StructField("actual", T.LongType()),
        T.StructField("holds", T.BooleanType()),
    ]
)

REPLAY = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("old_version", T.LongType()),
        T.StructField("new_version", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)

PUBLISHED = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)

# Which folder holds a date's trades in a version; a date may have several.
LAYOUT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("written", T.LongType()),
    ]
)
