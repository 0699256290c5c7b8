"""Questions answered from log lines (ts, message)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What marks a line about a product, and how the product is written in it.
ACTIVITY = r"product_id|trades written|Ingested"
PRODUCT_IN_LINE = r"""product[_]?id[=:\s"']+([A-Z0-9]+-[A-Z]+)"""


def product_last_seen(lines: DataFrame, n: int = 30) -> DataFrame:
    """The products most recently named in the log."""
    return (
        lines.where(F.col("message").rlike(ACTIVITY))
        .select("ts", F.regexp_extract("message", PRODUCT_IN_LINE, 1).alias("product"))
        .where(F.col("product") != "")
        .groupBy("product")
        .agg(F.max("ts").alias("last_seen"))
        .orderBy(F.col("last_seen").desc(), F.col("product"))
        .limit(n)
    )


def log_counts(lines: DataFrame, period: str = "1 hour") -> DataFrame:
    """Errors, and trades reported by INFO lines that end in a count, per period."""
    count = F.regexp_extract("message", r"INFO\b.*trades.*\s(\d+)\s*$", 1).try_cast("bigint")
    return (
        lines.groupBy(F.window("ts", period).alias("w"))
        .agg(
            F.count_if(F.col("message").contains("ERROR")).alias("error_count"),
            F.sum(F.coalesce(count, F.lit(0))).alias("trades_ingested"),
        )
        .select(F.col("w.start").alias("period_start"), "error_count", "trades_ingested")
    )
