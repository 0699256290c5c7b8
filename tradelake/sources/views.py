"""Trade-shaped views over the test tables: trades, call log, log lines and raw JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
AS_OF_BIG = "2001-11-05 00:00:00"

_STALE_FROM = "2024-01-25 00:00:00Z"
_QUIET_FROM = "2024-01-30 18:00:00Z"


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _utc(name: str):
    """A zone-less column as an instant; the session's zone has to be UTC."""
    return F.col(name).cast("timestamp")


def _symbol():
    return F.concat(F.lit("SYM"), (F.col("event_id") % 7).cast("string"), F.lit("-USD"))


def event_stream(spark: SparkSession, root: str) -> DataFrame:
    """The events table as a stream."""
    schema = _table(spark, root, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(root)


def trades(spark: SparkSession, root: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trades made from events, with missing, stale and repeated rows; `keep` adds event columns."""
    return trades_of(_table(spark, root, "events"), keep)


def trades_of(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    lane = F.col("event_id") % 7
    ts = F.col("ts_utc")
    present = (
        ~((F.col("event_type") == "error") & (lane < 3))
        & ~((lane == 5) & (ts >= F.lit(_STALE_FROM).cast("timestamp")))
        & ~((lane == 6) & (ts >= F.lit(_QUIET_FROM).cast("timestamp")))
    )
    # Every fiftieth trade comes twice, the second time one second later.
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    late = (F.col("event_id") % 120).cast("int") + F.col("copy")
    return (
        events.withColumn("ts_utc", _utc("ts"))
        .where(present)
        .withColumn("copy", F.explode(copies))
        .select(
            F.lit("coinbase").alias("exchange"),
            _symbol().alias("symbol"),
            F.expr("event_id div 7").cast("string").alias("trade_id"),
            F.when(F.col("event_type").isin("click", "view"), "sell").otherwise("buy").alias("side"),
            F.col("value").alias("price"),
            (F.lit(1.0) + (F.col("event_id") % 10)).alias("quantity"),
            (ts + F.make_dt_interval(secs=F.col("copy"))).alias("trade_ts"),
            (ts + F.make_dt_interval(secs=late)).alias("ingest_ts"),
            *keep,
        )
    )


def trades_big(spark: SparkSession, root: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trades made from lineitem: sparse ids, day-grained times, many repeated keys."""
    return _table(spark, root, "lineitem").select(
        F.lit("coinbase").alias("exchange"),
        F.concat(F.lit("SUPP-"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_orderkey").cast("string").alias("trade_id"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        _utc("l_shipdate").alias("trade_ts"),
        F.lit(None).cast("timestamp").alias("ingest_ts"),
        *keep,
    )


def call_log(spark: SparkSession, root: str, errors: bool = False) -> DataFrame:
    """API calls made from events: source, id, ts, ok, latency_ms, and the text of errors, of very different lengths."""
    calls = calls_of(_table(spark, root, "events"))
    text = F.repeat(F.concat(F.lit("error "), F.col("id").cast("string"), F.lit(". ")), (F.col("id") % 100 + 1).cast("int"))
    return calls.withColumn("error", F.when(~F.col("ok"), text)) if errors else calls


def calls_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("source"),
        F.col("event_id").alias("id"),
        _utc("ts").alias("ts"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("latency_ms"),
    )


def log_lines(spark: SparkSession, root: str) -> DataFrame:
    """Pipeline log lines: ts, message."""
    done = F.concat(
        F.lit("INFO product_id="), F.col("symbol"), F.lit(" trades written "), F.col("trade_id")
    )
    failed = F.col("trade_id").cast("bigint") % 10 == 0
    return trades(spark, root).select(
        F.col("trade_ts").alias("ts"),
        F.when(failed, "ERROR timeout").otherwise(done).alias("message"),
    )


def raw_json(spark: SparkSession, root: str) -> DataFrame:
    """Raw JSON texts of the trades in all spellings the sources use, some of them unusable."""
    variant = F.col("event_id") % 10
    broken = F.col("event_id") % 101
    iso = F.concat(F.date_format("trade_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    epoch = (F.unix_micros("trade_ts").cast("decimal(19,0)") / 1000000).cast("decimal(20,6)").cast("string")
    price = F.when(broken == 2, "abc").otherwise(F.col("price").cast("string"))
    text = F.to_json(
        F.struct(
            F.when(variant != 1, F.col("trade_id")).alias("id"),
            F.when(variant == 1, F.col("trade_id")).alias("trade_id"),
            F.when(variant != 2, F.col("symbol")).alias("product_id"),
            F.when(variant == 2, F.col("symbol")).alias("product-id"),
            F.upper("side").alias("side"),
            price.alias("price"),
            F.when(variant != 3, F.col("quantity").cast("string")).alias("size"),
            F.when(variant == 3, F.col("quantity").cast("string")).alias("qty"),
            F.when((variant != 4) & (broken != 1), iso).alias("time"),
            F.when((variant == 4) & (broken != 1), epoch).alias("timestamp"),
        )
    )
    # Variant 5 has the price as a JSON number.
    text = F.when(
        (variant == 5) & (broken != 2), F.regexp_replace(text, r'"price":"([^"]*)"', r'"price":$1')
    ).otherwise(text)
    return trades(spark, root, keep=("event_id",)).select(
        "event_id", F.when(broken == 3, "not json").otherwise(text).alias("value")
    )
