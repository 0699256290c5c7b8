"""Raw JSON-lines files: listing, reading, choosing the unprocessed ones, writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.operators.mapping import COINBASE, Mapping
from tradelake.schema import CORRUPT, raw_schema

GLOB = "*.{json,jsonl}"
MAX_RECORDS_PER_FILE = 500_000


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder as (file, bytes). Their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    )


def unprocessed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files that are not in the processed-files table."""
    return files.join(processed.select("file").distinct(), "file", "left_anti")


def new_files(spark: SparkSession, path: str, processed: DataFrame, glob: str = GLOB) -> DataFrame:
    """Raw files that are not in the processed-files table, in name order."""
    return unprocessed(list_files(spark, path, glob), processed).orderBy("file")


def raw_reader(reader, glob: str = GLOB, mapping: Mapping = COINBASE):
    """Batch or stream reader of raw files with the fields the mapping reads. A line that is no JSON object keeps only its text."""
    return (
        reader.schema(raw_schema(mapping.raw_names))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
    )


def read_raw(spark: SparkSession, paths: str | list[str], glob: str = GLOB, mapping: Mapping = COINBASE) -> DataFrame:
    """All raw records below the paths, with the file each came from."""
    records = raw_reader(spark.read, glob, mapping).json(paths)
    return records.select("*", F.col("_metadata.file_path").alias("source_file"))


def write_raw(records: DataFrame, root: str, run_id: str) -> str:
    """Write raw records as JSON lines, one folder per product; a retry of the run replaces its files.

    Times are ISO-8601 and null fields are kept. Rows are spread by product, and a busy product over
    several files; within a file they are in order of their ids.
    """
    path = f"{root}/run_id={run_id}"
    (
        records.withColumn("product", F.col("product_id"))
        .hint("rebalance", "product")
        .sortWithinPartitions("product", F.col("trade_id").try_cast("bigint"), "trade_id")
        .write.mode("overwrite")
        .partitionBy("product")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timeZone", "UTC")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .json(path)
    )
    return path
