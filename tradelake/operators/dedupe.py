"""Removal and marking of repeated trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.schema import PRODUCT, TRADE_KEY


def full_key() -> Column:
    """Whether a row has all parts of its key; rows that lack one, or have an empty id, repeat no other row."""
    return F.col("exchange").isNotNull() & F.col("symbol").isNotNull() & (F.coalesce("trade_id", F.lit("")) != "")


# Keys meet also where a part of them is null, as they do in a grouping.
def _same_key() -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TRADE_KEY]


def _other(df: DataFrame) -> DataFrame:
    """`df` with its key columns renamed for a join on _same_key."""
    return df.withColumnsRenamed({c: f"_{c}" for c in TRADE_KEY})


def _order_of_rest(df: DataFrame, first: list[Column], names: list[str]) -> list[Column]:
    """`first`, then every other column, so that the winner does not depend on partitioning."""
    rest = [c for c in df.columns if c not in names]
    return first + [F.col(c).asc_nulls_last() for c in rest]


def _keep_one(trades: DataFrame, order: list[Column]) -> DataFrame:
    # Spark cuts each key to its first row before the shuffle too, so a key with very many copies
    # sends at most one row per task. Each row without a full key is a key of its own.
    alone = F.when(~full_key(), F.monotonically_increasing_id()).alias("_alone")
    rank = F.row_number().over(Window.partitionBy(*TRADE_KEY, "_alone").orderBy(*order))
    return trades.select("*", alone).withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_alone")


def dedupe_newest(trades: DataFrame) -> DataFrame:
    """The newest row of every key; among equal times the smallest remaining values win."""
    newest = F.col("trade_ts").desc_nulls_last()
    return _keep_one(trades, _order_of_rest(trades, [newest], [*TRADE_KEY, "trade_ts"]))


def dedupe_first(trades: DataFrame, arrival: tuple[str, ...] = ("ingest_ts",)) -> DataFrame:
    """The first row of every key by arrival, given by columns such as ingest time and file name."""
    order = [F.col(c).asc_nulls_last() for c in arrival]
    return _keep_one(trades, _order_of_rest(trades, order, [*TRADE_KEY, *arrival]))


def duplicate_members(trades: DataFrame) -> DataFrame:
    """Every row whose key occurs more than once.

    The repeated keys are found by an aggregate and joined back; a key with very many rows is split by
    the adaptive skew join, where a window over the key would not be.
    """
    repeated = trades.groupBy(*TRADE_KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return trades.join(_other(repeated), _same_key(), "left_semi")


def with_known_time(batch: DataFrame, target: DataFrame) -> DataFrame:
    """`batch` with `known` (its key is in `target`) and `known_ts` (the newest time there).

    Whether the few keys of a batch are broadcast or both sides are shuffled is left to adaptive execution. Rows
    without a full key are never known.
    """
    keys = batch.where(full_key()).select(*TRADE_KEY).distinct()
    old = target.select(*TRADE_KEY, "trade_ts").join(_other(keys), _same_key(), "left_semi")
    old = _other(old.groupBy(*TRADE_KEY).agg(F.max("trade_ts").alias("known_ts"), F.lit(True).alias("known")))
    joined = batch.join(old, _same_key(), "left")
    return joined.select(*batch.columns, "known_ts", F.coalesce("known", F.lit(False)).alias("known"))


def unseen(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of `batch` whose key is not in `target`."""
    return with_known_time(batch, target).where(~F.col("known")).select(*batch.columns)


def restrict_to_products(trades: DataFrame, products: DataFrame) -> DataFrame:
    """Trades of the listed products."""
    return trades.join(products.select(*PRODUCT).distinct(), [*PRODUCT], "left_semi")


def sorted_by_id(trades: DataFrame) -> DataFrame:
    """Trades in id order within each output file, spread evenly however busy a product is."""
    number = F.col("trade_id").try_cast("bigint")
    return (
        trades.withColumn("_id", number)
        .repartitionByRange(*PRODUCT, "_id", "trade_id", "trade_ts")
        .sortWithinPartitions(*PRODUCT, "_id", "trade_id", "trade_ts")
        .drop("_id")
    )
