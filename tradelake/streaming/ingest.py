"""Structured Streaming: raw files to curated trades, bounded de-duplication, metric roll-ups."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions.scalars import numeric_id
from tradelake.operators.calls import metric_rollup
from tradelake.operators.dedupe import dedupe_newest, with_known_time
from tradelake.operators.mapping import COINBASE, Mapping
from tradelake.operators.normalize import accepted, normalize, rejected
from tradelake.schema import TRADE, TRADE_KEY
from tradelake.session import materialize
from tradelake.sources import state
from tradelake.sources.raw import GLOB, raw_reader

OVERLAP = "90 minutes"


def stream_raw(
    spark: SparkSession, path: str, files_per_batch: int | None = None, glob: str = GLOB, mapping: Mapping = COINBASE
) -> DataFrame:
    """Raw records of files not seen before; the query's checkpoint remembers the files."""
    reader = raw_reader(spark.readStream, glob, mapping)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


# Consecutive ids of a product that share a bucket, and the number of buckets.
BLOCK, BUCKETS = 100_000, 4096


def key_bucket() -> Column:
    """The bucket of a key. Ids near each other share one, so that a batch of new trades touches few buckets."""
    block = F.coalesce(F.floor(numeric_id(F.col("trade_id")) / BLOCK).cast("string"), F.col("trade_id"))
    return F.pmod(F.xxhash64("exchange", "symbol", block), F.lit(BUCKETS)).cast("int")


def _written(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """What earlier batches wrote, all or of some buckets only, with the query and the batch that did; empty before the first.

    Folders of other buckets are neither listed nor read.
    """
    extra = {"bucket": T.IntegerType(), "query": T.StringType(), "batch_id": T.LongType()}
    schema = T.StructType([*TRADE.fields, *[T.StructField(n, t) for n, t in extra.items()]])
    if buckets == []:
        return spark.createDataFrame([], schema)
    some = path if buckets is None else f"{path}/bucket={{{','.join(map(str, buckets))}}}"
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(some)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def known_trades(batch: DataFrame, root: str) -> DataFrame:
    """Streamed trades and corrections in the buckets of a batch's keys; every row with one of these keys is among them."""
    spark = batch.sparkSession
    buckets = sorted(r.b for r in batch.select(key_bucket().alias("b")).distinct().collect())  # at most BUCKETS numbers
    return _written(spark, f"{root}/trades", buckets).unionByName(_written(spark, f"{root}/corrections", buckets))


def _write_buckets(rows: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Writes trades below the buckets of their keys, in place of what this batch wrote there before."""
    (
        rows.withColumns({"bucket": key_bucket(), "query": F.lit(query), "batch_id": F.lit(batch_id).cast("long")})
        .hint("rebalance", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "query", "batch_id")
        .parquet(path)
    )


def curate(
    raw: DataFrame, root: str, checkpoint: str, mapping: Mapping = COINBASE, mode: str = "strict"
) -> StreamingQuery:
    """Write each micro-batch's new trades under their keys' buckets and its batch id, rejected records beside them.

    Of what is written already, a batch reads the buckets of its own keys only. Keys already written by another batch are left out, so overlapping files add nothing, however late they
    come. A newer row of a known key goes to the corrections, which `settled` applies. A batch repeated after
    a failure replaces its own folders; a query begun anew with another checkpoint has folders of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The id that the checkpoint keeps for its query, whatever number of times that is started.
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        rows = materialize(normalize(batch, mapping, mode), "stream-rows")
        usable = materialize(dedupe_newest(accepted(rows)), "stream-usable")
        known = known_trades(usable, root)
        compared = materialize(with_known_time(usable, known.where((F.col("query") != query) | (F.col("batch_id") != batch_id))), "stream-compared")
        parts = {"trades": ~F.col("known"), "corrections": F.col("trade_ts") > F.col("known_ts")}
        for name, which in parts.items():
            _write_buckets(compared.where(which).select(*TRADE.fieldNames()), f"{root}/{name}", query, batch_id)
        rejected(rows).write.mode("overwrite").parquet(f"{root}/rejected/query={query}/batch_id={batch_id}")
        state.save_watermarks(state.batch_watermarks(usable), root, f"stream-{query}-{batch_id}")

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settled(spark: SparkSession, root: str) -> DataFrame:
    """Streamed trades with the newest row of every key, corrections applied."""
    both = _written(spark, f"{root}/trades").unionByName(_written(spark, f"{root}/corrections"))
    return dedupe_newest(both.drop("bucket", "query", "batch_id"))


def drop_repeats(trades: DataFrame, overlap: str = OVERLAP) -> DataFrame:
    """Streaming de-duplication with bounded state. Rows later than the watermark are dropped: use `curate`
    where old trades may still arrive."""
    return trades.withWatermark("trade_ts", overlap).dropDuplicatesWithinWatermark([*TRADE_KEY])


def rollup(points: DataFrame, period: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Streaming form of metric_rollup; a period is emitted once, when it can no longer change."""
    return metric_rollup(points.withWatermark("ts", delay), period)


def closed_rollup(emitted: DataFrame, points: DataFrame, by: tuple[str, ...], period: str = "5 minutes") -> DataFrame:
    """What the stream has emitted, and the periods it still held back when it stopped, from the points themselves.

    A batch run over the tail: only points from the last emitted period on are read again, and periods already
    emitted stay as they are.
    """
    last = emitted.agg(F.coalesce(F.max("period_start"), F.lit("0001-01-01 00:00:00").cast("timestamp")).alias("t"))
    tail = metric_rollup(points.where(F.col("ts") >= last.scalar()), period, by)
    return emitted.unionByName(tail.join(emitted, ["period_start", *by], "left_anti").select(*emitted.columns))


def write_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to a Parquet folder, then stop."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
