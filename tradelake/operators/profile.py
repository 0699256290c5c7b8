"""One roll-up per product, from which most reports are derived.

Counting distinct trade ids is the costly part: it must shuffle by id. Numeric ids are therefore folded
into 64-id words first (one bit per id, combined with bit_or). The fold is an ordinary hash aggregate:
it runs before the shuffle, collapses any number of copies of a trade, and spreads one busy product over
as many groups as it has words. Ids that are not plain numbers are grouped by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.scalars import notional, numeric_id
from tradelake.schema import PRODUCT

WORD_BITS = 6


def with_words(trades: DataFrame) -> DataFrame:
    """Add id_number, id_word (64 ids each), id_bit (the id's bit in its word) and id_text (other ids)."""
    number = F.col("id_number")
    return trades.withColumn("id_number", numeric_id(F.col("trade_id"))).withColumns(
        {
            "id_word": F.shiftright(number, WORD_BITS),
            "id_bit": F.expr(f"shiftleft(1L, cast(id_number & {2**WORD_BITS - 1} as int))"),
            "id_text": F.when(number.isNull(), F.col("trade_id")),
        }
    )


def id_words(trades: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Roll trades up to one row per (exchange, symbol, id_word, id_text).

    `extra` names further sums. Aggregates a report does not use are pruned from its plan.
    """
    extra = extra or {}
    return (
        with_words(trades)
        .groupBy(*PRODUCT, "id_word", "id_text")
        .agg(
            F.bit_or("id_bit").alias("id_bits"),
            F.min("id_number").alias("min_id"),
            F.max("id_number").alias("max_id"),
            F.count(F.lit(1)).alias("trades"),
            F.min("trade_ts").alias("first_ts"),
            F.max("trade_ts").alias("last_ts"),
            F.sum(notional()).alias("volume"),
            F.sum("price").alias("price_sum"),
            F.count("price").alias("price_count"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            *[F.sum(value).alias(name) for name, value in extra.items()],
        )
    )


def distinct_in_row() -> Column:
    """Distinct ids held by one row of id_words."""
    return (
        F.when(F.col("id_word").isNotNull(), F.bit_count("id_bits"))
        .when(F.col("id_text").isNotNull(), 1)
        .otherwise(0)
    )


def product_profile(trades: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per (exchange, symbol): counts, distinct ids, id range, time range, volume, prices."""
    numeric = F.col("id_word").isNotNull()
    return (
        id_words(trades, extra)
        .groupBy(*PRODUCT)
        .agg(
            F.sum("trades").alias("trades"),
            F.sum(distinct_in_row()).cast("bigint").alias("distinct_ids"),
            F.sum(F.when(numeric, F.bit_count("id_bits")).otherwise(0)).cast("bigint").alias("numeric_ids"),
            F.sum(F.when(numeric, 0).otherwise(F.col("trades"))).alias("unparsed_id_rows"),
            F.min("min_id").alias("min_id"),
            F.max("max_id").alias("max_id"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("volume").alias("volume"),
            (F.sum("price_sum") / F.nullif(F.sum("price_count"), F.lit(0))).alias("avg_price"),
            F.min("min_price").alias("min_price"),
            F.max("max_price").alias("max_price"),
            *[F.sum(name).alias(name) for name in extra or {}],
        )
        # Ids at the far ends of the 64-bit range would overflow; they give null instead of an error.
        .withColumn("expected_ids", F.try_add(F.try_subtract("max_id", "min_id"), F.lit(1)))
    )


def product_totals(trades: DataFrame) -> DataFrame:
    """As product_profile but without ids, so it only shuffles one row per product and task."""
    return trades.groupBy(*PRODUCT).agg(
        F.count(F.lit(1)).alias("trades"),
        F.min("trade_ts").alias("first_ts"),
        F.max("trade_ts").alias("last_ts"),
        F.sum(notional()).alias("volume"),
        F.avg("price").alias("avg_price"),
        F.max(numeric_id(F.col("trade_id"))).alias("max_id"),
    )


def between(trades: DataFrame, since: Column, before: Column | None = None) -> DataFrame:
    """Trades from `since` on (and before `before`); of a table laid out by trade_date only those dates are read."""
    kept = trades.where(F.col("trade_ts") >= since)
    if before is not None:
        kept = kept.where(F.col("trade_ts") < before)
    if "trade_date" in trades.columns:
        kept = kept.where(F.col("trade_date") >= F.to_date(since))
        if before is not None:
            kept = kept.where(F.col("trade_date") <= F.to_date(before))
    return kept
