"""The curated trade table: Parquet folders per date, which of them make up a version, and the current version.

A version is a list of (date, folder). Writing one adds a folder with the dates that change; all other dates keep the
files they have. Readers see the version before until the one-row pointer is there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradelake.schema import TRADE
from tradelake.sources import state
from tradelake.sources.raw import list_files

MAX_RECORDS_PER_FILE = 500_000


class IncompleteWrite(RuntimeError):
    """What was read back is not what a job wrote; the version was not published."""

    def __init__(self, sent: int, kept: int):
        super().__init__(f"{sent} rows were written, {kept} are there")
        self.sent, self.kept = sent, kept


def write_trades(trades: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write trades by date, in files of even size; a busy date is split over several tasks.

    Rows are sorted by product and time inside a file, so that filters on them skip row groups. Returns how many rows
    the trades had, counted by the job that writes them before they are dealt to files.
    """
    sent = Observation()
    (
        trades.select([F.col(f.name).cast(f.dataType) for f in TRADE.fields])
        .observe(sent, F.count(F.lit(1)).alias("rows"))
        .withColumn("trade_date", F.to_date("trade_ts"))
        .hint("rebalance", "trade_date")
        .sortWithinPartitions("trade_date", "exchange", "symbol", "trade_ts")
        .write.mode(mode)
        .partitionBy("trade_date")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "snappy")
        .parquet(path)
    )
    return sent.get.get("rows", 0)


def read_trades(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """All trade files below the folders as one table.

    Folders may differ in their columns; `merge_schema` also finds columns only some files of a folder have.
    """
    tables = [spark.read.option("mergeSchema", merge_schema).parquet(path) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def version_path(root: str, version: int) -> str:
    """The folder with what was written for a version."""
    return f"{root}/trades/written={version}"


def current_version(spark: SparkSession, root: str) -> int:
    """The version last published; 0 before the first."""
    newest = state.load(spark, root, "published").agg(F.max("version").alias("version")).first()
    return int(newest.version or 0)


def publish(spark: SparkSession, root: str, version: int) -> None:
    """Make a fully written version current. Readers see the old one until this one row is there."""
    row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    state.append(row, root, "published")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The trades of a version. Its folders, a few per date, are named on the driver."""
    layout = state.load(spark, root, "layout").where(F.col("version") == version).select("trade_date", "written")
    folders = [
        f"{version_path(root, r.written)}/trade_date={r.trade_date or '__HIVE_DEFAULT_PARTITION__'}"
        for r in layout.distinct().collect()
    ]
    if not folders:
        return spark.createDataFrame([], TRADE).withColumn("trade_date", F.lit(None).cast("date"))
    rows = spark.read.option("basePath", f"{root}/trades").parquet(*folders).drop("written")
    return rows.withColumn("trade_date", F.col("trade_date").cast("date"))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The trades of the current version; an empty table before the first."""
    return read_version(spark, root, current_version(spark, root))


def write_version(trades: DataFrame, root: str, replaced: list | None = None) -> int:
    """Write trades into a fresh folder and publish the version they make; returns its number.

    `replaced` names the dates whose earlier folders the new one takes the place of; other dates keep theirs, next to
    what is written now. Without it the trades are the whole version. Earlier versions stay as they are. If the folder
    does not hold as many rows as were written, IncompleteWrite is raised and nothing is published.
    """
    spark = trades.sparkSession
    old = current_version(spark, root)
    version = old + 1
    sent = write_trades(trades, version_path(root, version))
    written = written_trades(spark, root, version)
    kept = written.count() if written is not None else 0  # from the files' footers
    if sent != kept:
        raise IncompleteWrite(sent, kept)
    rows = spark.createDataFrame([], "trade_date date, written long")
    if written is not None:
        dates = written.select(F.col("trade_date").cast("date").alias("trade_date")).distinct()
        rows = dates.withColumn("written", F.lit(version).cast("long"))
    if replaced is not None:
        before = state.load(spark, root, "layout").where(F.col("version") == old)
        if replaced:
            date = F.col("trade_date")
            gone = date.isin([d for d in replaced if d]) if any(replaced) else F.lit(False)
            before = before.where(~F.coalesce(gone, F.lit(None in replaced)))
        rows = before.select("trade_date", "written").unionByName(rows)
    state.append(rows.withColumn("version", F.lit(version)), root, "layout", f"v{version}")
    publish(spark, root, version)
    return version


def written_trades(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """What was written for a version, read from its own folder; None if that has no files."""
    path = version_path(root, version)
    return read_trades(spark, path) if _has_dates(spark, path) else None


def _has_dates(spark: SparkSession, path: str) -> bool:
    """Whether a written folder has any data; an empty table leaves none to read."""
    return not list_files(spark, path, "*.parquet").isEmpty()


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Catalog table over a trade folder, with its partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRADE.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, trade_date date) USING parquet PARTITIONED BY (trade_date) LOCATION '{path}'"
    )
    refresh_table(spark, name)


def refresh_table(spark: SparkSession, name: str) -> None:
    """Pick up partitions and files added since."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def storage_footprint(spark: SparkSession, path: str) -> DataFrame:
    """Files and GiB of data below a folder, from the file listing alone."""
    data = ~(F.col("file").endswith(".json") | F.col("file").endswith(".keep"))
    return (
        list_files(spark, path)
        .where(data)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        )
        .withColumn("size_gb", F.round(F.col("bytes") / F.lit(2.0**30), 3))
    )
