"""The first rows of each key, also when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALTS = 256


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows of each key by `order`, with their rank.

    Spark limits each key to n rows per task before it shuffles. With very many tasks even that is a lot of
    rows for one key, so rows first compete within one of several groups of their key, and the groups'
    winners then with each other.
    """
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys]), F.lit(_SALTS))
    heat = Window.partitionBy(*keys, "_salt").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    winners = (
        df.withColumn("_salt", salt).withColumn("_heat", F.row_number().over(heat)).where(F.col("_heat") <= n)
    )
    return winners.drop("_salt", "_heat").withColumn(rank, F.row_number().over(final)).where(F.col(rank) <= n)
