"""Pipeline state as append-only Parquet tables: processed files, runs, replays, watermarks, versions.

Each write goes to its own folder `batch=<id>` and replaces it when retried, so a run that is repeated
after a lost executor or driver does not count twice.

A table is a snapshot and the folders written since. `compact` writes all rows, with the batch of each, as the snapshot
of the next generation; it counts from the moment it is complete, and later writes go to that generation's folders. A
reader opens one snapshot and the newer folders, however many runs there have been. A batch that is written again after
a compaction takes the place of its rows in the snapshot. Earlier generations stay for readers that have begun; they may
be deleted. As for the curated table, one writer per table is an operating rule.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tradelake.functions.scalars import as_of_column, numeric_id
from tradelake.schema import INVARIANT, LAYOUT, PRODUCT, PROCESSED_FILE, PUBLISHED, REPLAY, RUN, WATERMARK

TABLES: dict[str, T.StructType] = {
    "processed_files": PROCESSED_FILE,
    "run_history": RUN,
    "replays": REPLAY,
    "watermarks": WATERMARK,
    "published": PUBLISHED,
    "layout": LAYOUT,
    "invariants": INVARIANT,
}

# Fixed value: first id asked for from a product that has no watermark yet.
COLD_START_ID = 1000
MAX_DUPLICATE_RATIO = 0.05
RECENT_RUNS = 5
FAILURES_TO_REPLAY = 2


# Folders of a table that are written before the next compaction of a run.
COMPACT_AFTER = 50


def _found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, from the file system's listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or []]


def generation(spark: SparkSession, root: str, table: str) -> int:
    """Number of the newest complete snapshot; 0 before the first."""
    done = _found(spark, f"{root}/state/{table}/snapshot=*/_SUCCESS")
    return max((int(path.split("/")[-2].removeprefix("snapshot=")) for path in done), default=0)


def _tail(root: str, table: str, number: int) -> str:
    """The folder that a generation's batches are written to."""
    return f"{root}/state/{table}" + (f"/gen={number}" if number else "")


def _read(spark: SparkSession, path: str, schema: T.StructType, base: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _with_batch(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of a state table with the batch that wrote them."""
    number, schema = generation(spark, root, table), TABLES[table]
    tail = _tail(root, table, number)
    newer = _read(spark, f"{tail}/batch=*", T.StructType([*schema.fields, T.StructField("batch", T.StringType())]), tail)
    if not number:
        return newer
    path = f"{root}/state/{table}/snapshot={number}"
    old = _read(spark, path, T.StructType([*schema.fields, T.StructField("_batch", T.StringType())]), path)
    again = newer.select("batch").distinct()  # folder names alone
    kept = old.join(again, F.col("_batch") == F.col("batch"), "left_anti").withColumnRenamed("_batch", "batch")
    return kept.unionByName(newer)


def load(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A state table; empty if nothing was written yet."""
    return _with_batch(spark, root, table).drop("batch")


def append(rows: DataFrame, root: str, table: str, batch: str | None = None) -> None:
    schema = TABLES[table]
    tail = _tail(root, table, generation(rows.sparkSession, root, table))
    rows.select([F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("overwrite").parquet(f"{tail}/batch={batch or uuid.uuid4().hex}")


def compact(spark: SparkSession, root: str, table: str) -> int:
    """Write a table's rows as the next snapshot; returns its generation."""
    number = generation(spark, root, table) + 1
    rows = _with_batch(spark, root, table).withColumnRenamed("batch", "_batch").hint("rebalance")
    # Only its completion makes a snapshot count, so one that a crash left unfinished is written over.
    rows.write.mode("overwrite").parquet(f"{root}/state/{table}/snapshot={number}")
    return number


def compact_if_long(spark: SparkSession, root: str, tables: list[str], most: int = COMPACT_AFTER) -> None:
    """Compact the tables that have had more than `most` writes since their last snapshot."""
    for table in tables:
        tail = _tail(root, table, generation(spark, root, table))
        if len(_found(spark, f"{tail}/batch=*")) > most:
            compact(spark, root, table)


# --- watermarks ---------------------------------------------------------------------------------------


def batch_watermarks(trades: DataFrame, at: Column | None = None) -> DataFrame:
    """Highest numeric id per product."""
    return (
        trades.groupBy(*PRODUCT)
        .agg(F.max(numeric_id(F.col("trade_id"))).alias("cursor"))
        .where(F.col("cursor").isNotNull())
        .withColumn("updated_at", F.current_timestamp() if at is None else at)
    )


def merge_watermarks(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new watermarks together; a cursor never goes back, and its time is that of its last advance."""
    o = old.select(*PRODUCT, F.col("cursor").alias("old_cursor"), F.col("updated_at").alias("old_at"))
    n = new.select(*PRODUCT, F.col("cursor").alias("new_cursor"), F.col("updated_at").alias("new_at"))
    advanced = F.col("old_cursor").isNull() | (F.col("new_cursor") > F.col("old_cursor"))
    return o.join(n, [*PRODUCT], "full_outer").select(
        *PRODUCT,
        F.greatest("old_cursor", "new_cursor").alias("cursor"),
        F.when(F.coalesce(advanced, F.lit(False)), F.col("new_at")).otherwise(F.col("old_at")).alias("updated_at"),
    )


def load_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """Highest cursor per product, with the time it was first reached."""
    earliest = F.max(F.struct("cursor", -F.unix_micros("updated_at"))).alias("top")
    return (
        load(spark, root, "watermarks")
        .groupBy(*PRODUCT)
        .agg(earliest)
        .select(*PRODUCT, F.col("top.cursor").alias("cursor"), F.timestamp_micros(-F.col("top.col2")).alias("updated_at"))
    )


def save_watermarks(new: DataFrame, root: str, batch: str) -> None:
    """Record a batch's watermarks; as the highest cursor counts, they cannot take a product back."""
    append(new, root, "watermarks", batch)


def backlog(watermarks: DataFrame, targets: DataFrame) -> DataFrame:
    """What is left to fetch per product; `targets` has exchange, symbol, start_id and target_id.

    The cursor is the next id to fetch, so a product is caught up once it is past the target.
    """
    cursor = F.coalesce(F.col("cursor"), F.lit(COLD_START_ID))
    expected = F.greatest(F.lit(0), F.col("target_id") - F.col("start_id"))
    done = F.greatest(F.lit(0), cursor - F.col("start_id"))
    share = F.when(expected == 0, 100.0).otherwise(F.least(F.lit(100.0), 100.0 * done / F.nullif(expected, F.lit(0))))
    return (
        targets.join(watermarks.select(*PRODUCT, "cursor"), [*PRODUCT], "left")
        .select(
            *PRODUCT,
            cursor.alias("cursor"),
            "target_id",
            F.greatest(F.lit(0), F.col("target_id") - cursor).alias("remaining"),
            F.round(share, 2).alias("pct_done"),
            (cursor > F.col("target_id")).alias("caught_up"),
        )
        .orderBy("pct_done", *PRODUCT)
    )


# --- product list -------------------------------------------------------------------------------------


def read_products(spark: SparkSession, path: str, exchange: str = "coinbase") -> DataFrame:
    """Product list from JSON: documents with a `product_ids` array, or one {"symbol": ...} per line."""
    schema = "product_ids array<string>, exchange string, symbol string"
    listed = spark.read.schema(schema).option("multiLine", path.endswith(".json")).json(path)
    names = F.coalesce("product_ids", F.array("symbol"))
    return listed.select(F.coalesce("exchange", F.lit(exchange)).alias("exchange"), F.explode(names).alias("symbol"))


def write_products(products: DataFrame, path: str) -> None:
    products.select(*PRODUCT).write.mode("overwrite").json(path)


def update_products(existing: DataFrame, found: DataFrame, pattern: str | None = None, merge: bool = True) -> DataFrame:
    """Distinct product names found (optionally only those matching a pattern), with the ones already listed."""
    names = found.where(F.col("symbol").isNotNull() & (F.col("symbol") != "")).select(*PRODUCT)
    if pattern:
        names = names.where(F.col("symbol").rlike(pattern))
    if merge:
        names = names.unionByName(existing.select(*PRODUCT))
    return names.distinct().orderBy(*PRODUCT)


# --- runs ---------------------------------------------------------------------------------------------


def consecutive_failures(history: DataFrame) -> DataFrame:
    """Failed runs since the last passed one, as one row."""
    last_pass = history.where("passed").agg(F.max("ts")).scalar()
    since = F.coalesce(last_pass, F.lit("0001-01-01 00:00:00").cast("timestamp"))
    return history.where(~F.col("passed") & (F.col("ts") > since)).agg(
        F.count(F.lit(1)).alias("consecutive_failures")
    )


def recent_duplicate_ratio(history: DataFrame, runs: int = RECENT_RUNS) -> DataFrame:
    """Highest share of duplicates among the last runs, as one row; runs over no rows do not count."""
    return (
        history.orderBy(F.col("ts").desc(), *[F.col(c).desc() for c in ("run_id",) if c in history.columns])
        .limit(runs)
        .where(F.col("batch_size") > 0)
        .agg(F.max(F.col("duplicates_found") / F.col("batch_size")).alias("max_duplicate_ratio"))
    )


def run_health(history: DataFrame) -> DataFrame:
    """Current health from the run history, as one row."""
    last_ok = F.max(F.when(F.col("passed"), F.col("ts"))).alias("last_successful_transform")
    counts = history.agg(F.count(F.lit(1)).alias("runs"), last_ok)
    return counts.select(
        "*",
        consecutive_failures(history).scalar().alias("consecutive_failures"),
        recent_duplicate_ratio(history).scalar().alias("max_duplicate_ratio"),
    )


def replay_decision(history: DataFrame, flagged: bool = False) -> DataFrame:
    """Whether the data should be rebuilt into a new version, and why."""
    reason = (
        F.when(F.lit(flagged), "replay_flag")
        .when(F.col("consecutive_failures") >= FAILURES_TO_REPLAY, "consecutive_failures")
        .when(F.col("max_duplicate_ratio") > MAX_DUPLICATE_RATIO, "duplicate_ratio")
        .otherwise("")
    )
    return run_health(history).select(
        (reason != "").alias("should_replay"), reason.alias("reason"), "consecutive_failures", "max_duplicate_ratio"
    )


def since_replay(spark: SparkSession, root: str) -> DataFrame:
    """Runs that count for the next replay decision: those of the version the last replay made, and later ones."""
    last = load(spark, root, "replays").agg(F.coalesce(F.max("new_version"), F.lit(0)).alias("last"))
    runs = load(spark, root, "run_history")
    return runs.where(F.coalesce("version", F.lit(0)) >= last.scalar())


def mark_replay(spark: SparkSession, root: str, old: int, new: int, reason: str, at=None) -> None:
    row = spark.range(1).select(
        as_of_column(at).alias("ts"),
        F.lit(old).alias("old_version"),
        F.lit(new).alias("new_version"),
        F.lit(reason).alias("reason"),
    )
    append(row, root, "replays", f"{old}-to-{new}")
