"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tradelake.session import materialize, scratch_path as scratch_name

MIN_LONG = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text (null as empty) and the named columns; anything else the caller's table holds is left behind."""
    return docs.select("doc_id", *extra, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` uses it inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their Python can import it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        to = tempfile.mkdtemp(prefix="package-")  # of the driver, which serves the archive to the executors
        spark.sparkContext.addPyFile(shutil.make_archive(f"{to}/tradelake", "zip", root, "tradelake"))
        _shipped.add(app)


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores behind it, so that no column of `docs` has it in any spelling of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Rows whose texts are Python strings at a time.
ROWS = 1000


def add_columns(
    docs: DataFrame, compute: Callable, fields: str, finish: Callable[[], None] | None = None, keep: list[str] | None = None
) -> tuple[DataFrame, str]:
    """`docs` with one more struct column of `fields`, and that column's name, which no column of `docs` has.

    `compute` gets the texts of some rows (None where null) and returns one list per field; `finish` is called when a
    task has no more rows. It runs on Arrow batches and so never holds more than a batch; every other column passes
    through as it is, or those in `keep` only.
    """
    ship_package(docs.sparkSession)
    name = free_name(docs, "_added")
    added = StructType.fromDDL(fields)
    passed = [i for i, c in enumerate(docs.columns) if keep is None or c in keep]
    schema = StructType([*(docs.schema.fields[i] for i in passed), StructField(name, added)])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            values = compute(batch.column("text").to_pylist())
            arrays = [pa.array(v, type=to_arrow_type(f.dataType)) for v, f in zip(values, added.fields, strict=True)]
            struct = pa.StructArray.from_arrays(arrays, names=added.fieldNames())
            others = batch.select(passed)
            yield pa.RecordBatch.from_arrays([*others.columns, struct], names=[*others.schema.names, name])
        if finish:
            finish()

    return docs.mapInArrow(run, schema), name


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """As `materialize`, and the shuffle files of the write are removed as soon as it has ended."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def drop(df: DataFrame) -> None:
    """Deletes the files of a table written by `stage` that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.rpartition("/")[0])
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
