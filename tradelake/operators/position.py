"""Row positions within a key, also when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.session import materialize


def with_position(df: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row within its key, by `order`.

    A row_number over the key would sort a busy key in one task. Here the rows are range-partitioned by
    (keys, order), which splits a busy key over many tasks, and numbered in place; the number of earlier
    rows of the key is then added per partition. The numbered rows are written out, because two
    computations of a range partitioning need not cut at the same rows. `order` should identify a row
    within its key: rows equal in all of it stay in one partition.
    """
    by = [*keys, *order]
    numbered = materialize(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        "positions",
    )
    pieces = numbered.groupBy(*keys, "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # One row per key and partition that holds it.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("_part").alias("_piece"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_part") == F.col("_piece")]
    return numbered.join(shifts, same).select(
        *df.columns, (F.col("_row") + F.col("_shift")).alias(name)
    )
