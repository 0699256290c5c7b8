"""Shards through fixed virtual slots.

A record is hashed by its id into one of a fixed number of virtual slots. Bytes are summed per slot, and a
table maps each slot to a shard. Moving data means editing that table: each edit is a new version, and a record
never needs to be hashed again. The map is made so that shards hold nearly equal bytes. All of it is SQL; the
only grouped data is one row per slot, of which there are `slots` whatever the size of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.llm.common import texts
from tradelake.session import materialize

SLOTS = 4096
# Rows of one numbered group; more rows make more groups, so that no task has to sort a whole slot.
GROUP_ROWS = 50_000


def slot_of(*columns: str, slots: int = SLOTS):
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of each row; a null text has no bytes and CRC 0, a null id is an id."""
    return texts(docs).select(
        "doc_id",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        slot_of("doc_id", slots=slots).alias("virtual_slot"),
    )


def slot_totals(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """virtual_slot, bytes, rows of every slot, also of empty ones."""
    totals = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(totals, "virtual_slot", "left").fillna(0, ["bytes", "rows"])


def first_map(totals: DataFrame, shards: int) -> DataFrame:
    """version 1: slots in falling order of bytes, each to the shard with the fewest bytes so far."""
    loads = F.col("acc.loads")
    in_order = totals.agg(F.sort_array(F.collect_list(F.struct("bytes", "virtual_slot")), asc=False).alias("todo"))

    def give(acc, slot):
        to = F.array_position(acc.loads, F.array_min(acc.loads)).cast("int") - 1
        return F.struct(
            F.transform(acc.loads, lambda x, i: F.when(i == to, x + slot.bytes).otherwise(x)).alias("loads"),
            F.concat(acc.given, F.array(F.struct(slot.virtual_slot.alias("virtual_slot"), to.alias("shard")))).alias("given"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)").alias("given"),
    )
    given = in_order.select(F.explode(F.aggregate("todo", start, give, lambda acc: acc.given)).alias("x"))
    return given.select(F.lit(1).alias("version"), "x.virtual_slot", "x.shard")


def grow_map(current: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version, with one shard more than `shards`: slots move only into the new one.

    Each old shard gives slots, in a fixed random order, as long as it keeps its equal share of the bytes.
    """
    loaded = current.join(totals, "virtual_slot")
    share = totals.agg((F.sum("bytes") / (shards + 1)).alias("share"))
    by_shard = Window.partitionBy("shard")
    moving = by_shard.orderBy(F.xxhash64("virtual_slot", F.lit(shards)), "virtual_slot")
    marked = loaded.withColumn("load", F.sum("bytes").over(by_shard)).withColumn("gone", F.sum("bytes").over(moving))
    moves = (F.col("load") - F.col("gone") >= F.col("share")) & (F.col("bytes") > 0)
    return marked.join(F.broadcast(share)).select(  # one row
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.when(moves, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"),
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the map table; versions already there stay as they are."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map table, by default the newest."""
    table = spark.read.parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def place(rows: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds shard and slot, the row's place in its shard: 0, 1, 2, ... without gaps, in an order of virtual slots.

    Rows are numbered within small groups of a virtual slot, groups by a sum over the table of groups.
    """
    most = totals.agg(F.max("rows")).first()[0] or 0
    parts = max(1, -(-most // GROUP_ROWS))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(parts)), F.lit(parts)))
    group = ["virtual_slot", "part"]
    sizes = dealt.groupBy(*group).count().join(F.broadcast(slot_map), "virtual_slot")  # one row per slot
    before = Window.partitionBy("shard").orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "shard", "version", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*group).orderBy("doc_id", "text_crc32", "size")
    numbered = dealt.withColumn("nth", F.row_number().over(inside))
    return numbered.join(starts, group).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"), "virtual_slot", "version"
    )


def shard(docs: DataFrame, shards: int, map_path: str, slots: int = SLOTS) -> DataFrame:
    """Every row with its shard and place, through a slot map stored as version 1 at `map_path`.

    Rows with equal ids share a virtual slot; equal rows are told apart only by their place. An empty table gives
    an empty result and a map that spreads empty slots.
    """
    rows = materialize(records(docs, slots), "shard-records")
    totals = materialize(slot_totals(rows, slots), "slot-totals")
    save_map(first_map(totals, shards), map_path)
    return place(rows, totals, load_map(docs.sparkSession, map_path))
