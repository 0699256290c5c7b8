"""Pipeline runs: raw payloads to raw files, and raw files to the curated trade table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.operators.dedupe import dedupe_newest, full_key, with_known_time
from tradelake.operators.mapping import COINBASE, Mapping
from tradelake.operators.normalize import REASON, normalize, raw_record
from tradelake.plans.quality import batch_validation, full_validation, quality_gates
from tradelake.plans.reports import dedupe_precheck
from tradelake.schema import CORRUPT, INVARIANT, PRODUCT, RUN, TRADE, TRADE_KEY, raw_schema
from tradelake.session import materialize
from tradelake.sources import curated, state
from tradelake.sources.raw import GLOB, list_files, new_files, read_raw, write_raw


def ingest(
    payloads: DataFrame, product: Column, raw_root: str, root: str, run_id: str, source: str = "coinbase"
) -> str:
    """Write API payloads as raw files, then advance the watermarks: in that order, so a failed write is redone."""
    path = write_raw(raw_record(payloads, product, F.current_timestamp(), source), raw_root, run_id)
    written = payloads.select(
        F.lit(source).alias("exchange"), product.alias("symbol"), F.col("trade_id").cast("string").alias("trade_id")
    )
    state.save_watermarks(state.batch_watermarks(written), root, f"ingest-{run_id}")
    return path


def stage(raw: DataFrame, path: str, mapping: Mapping, mode: str) -> tuple[DataFrame, dict[str, int]]:
    """Normalize raw records and write usable and rejected rows in one pass; returns them with the pass's own counts.

    Rejected rows keep their raw text and the file they came from. Counted are the records as they are read, and the
    usable and rejected rows as they are written.
    """
    seen, sent = Observation(), Observation()
    raw = raw.observe(seen, F.count(F.lit(1)).alias("records"))
    text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[F.col(f"`{n}`") for n in raw_schema(mapping.raw_names).names if n != CORRUPT])))
    rows = normalize(raw.withColumn("raw_text", text), mapping, mode, keep=("source_file", "raw_text"))
    usable = F.col(REASON).isNull()
    (
        rows.withColumn("raw_text", F.when(~usable, F.col("raw_text")))
        .withColumn("rejected", F.when(usable, 0).otherwise(1))
        .observe(sent, F.count_if(F.col("rejected") == 0).alias("usable"), F.count_if(F.col("rejected") == 1).alias("rejected"))
        .write.mode("overwrite")
        .partitionBy("rejected")
        .parquet(path)
    )
    return raw.sparkSession.read.schema(STAGED).parquet(path), {**seen.get, **sent.get}


# What staging writes: the trade columns, why a row was rejected, where it came from.
STAGED = T.StructType(
    [
        *TRADE.fields,
        *[T.StructField(n, T.StringType()) for n in (REASON, "source_file", "raw_text")],
        T.StructField("rejected", T.IntegerType()),
    ]
)


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rejected rows of all runs."""
    return spark.read.parquet(f"{root}/staging").where(F.col("rejected") == 1)


Check = tuple[str, int, int]


def _merge(batch: DataFrame, root: str, rebuild: bool) -> tuple[int, int, list[Check]]:
    """Bring de-duplicated rows into the curated table; returns (rows written, version, invariants).

    Rows with new keys go into a folder of their own next to those of their dates. Dates with a known key that comes
    with a newer time, and the dates that key had before, are written anew with the newest row of each key. All other
    dates keep their files, and the version before stays readable.
    """
    spark = batch.sparkSession
    version = curated.current_version(spark, root)
    if rebuild or version == 0:
        version = curated.write_version(batch, root)
        rows = curated.read_current(spark, root).count()
        return rows, version, _written_checks(spark, root, version)
    current = curated.read_current(spark, root)
    compared = materialize(with_known_time(materialize(batch, "batch"), current), "compared")
    newer = F.coalesce(F.col("known") & (F.col("trade_ts") > F.col("known_ts")), F.lit(False))
    counts = compared.agg(F.count_if(~F.col("known")).alias("new"), F.count_if(newer).alias("newer")).first()
    checks = []
    if counts.new + counts.newer:
        rows = current.count()  # from the files' footers, as below
        fresh = compared.where(~F.col("known") | newer).select(*TRADE.fieldNames())
        dates = []
        if counts.newer:
            both = F.array(F.to_date("trade_ts"), F.to_date("known_ts"))
            dates = [r.d for r in compared.where(newer).select(F.explode(both).alias("d")).distinct().collect()]
            old = current.where(F.col("trade_date").isin(dates)).select(*TRADE.fieldNames())
            fresh = dedupe_newest(old.unionByName(fresh))
        version = curated.write_version(fresh, root, replaced=dates)
        checks = [
            ("rows of the version = rows before + new keys", rows + counts.new, curated.read_current(spark, root).count()),
            *_written_checks(spark, root, version),
        ]
    return counts.new + counts.newer, version, checks


def _written_checks(spark: SparkSession, root: str, version: int) -> list[Check]:
    """No key is twice in what a run has written; only the run's own folder is read."""
    written = curated.written_trades(spark, root, version)
    if written is None:
        return []
    keys = written.where(full_key()).groupBy(*TRADE_KEY).agg(F.count(F.lit(1)).alias("n"))
    found = keys.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    return [("written rows = distinct keys", found.keys, found.rows)]


def _watermark_checks(before: DataFrame, after: DataFrame, batch: DataFrame) -> list[Check]:
    """Products whose cursor went back, and products whose cursor is below an id of the batch: none of either."""
    was = before.select(*PRODUCT, F.col("cursor").alias("least"))
    least = was.unionByName(batch.select(*PRODUCT, F.col("cursor").alias("least")))
    joined = least.join(after.select(*PRODUCT, "cursor"), [*PRODUCT], "left")
    low = F.coalesce(F.col("cursor") < F.col("least"), F.lit(True))
    return [("no watermark goes back or stays behind", 0, joined.agg(F.count_if(low)).first()[0])]


def invariants(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, invariant, expected, actual, holds) of all runs."""
    return state.load(spark, root, "invariants")


def _save_invariants(spark: SparkSession, root: str, run_id: str, checks: list[Check]) -> list[str]:
    """Writes a run's invariants; returns the names of those that do not hold."""
    rows = [(run_id, name, expected, actual, expected == actual) for name, expected, actual in checks]
    state.append(spark.createDataFrame(rows, INVARIANT), root, "invariants", run_id)
    return [name for name, expected, actual in checks if expected != actual]


def deduplicate(spark: SparkSession, root: str) -> DataFrame:
    """Keep the newest row of every key of the current version, in a new version; returns the outcome as one row.

    One aggregate looks first whether there is anything to do.
    """
    current = curated.read_current(spark, root)
    before = dedupe_precheck(current).first()
    version, after = curated.current_version(spark, root), before.total
    if not before.skip_dedupe:
        version = curated.write_version(dedupe_newest(current.select(*TRADE.fieldNames())), root)
        after = curated.read_current(spark, root).count()
    return spark.range(1).select(
        F.lit("skipped" if before.skip_dedupe else "success").alias("status"),
        F.lit(before.total).alias("records_before"),
        F.lit(after).alias("records_after"),
        F.lit(before.total - after).alias("duplicates_removed"),
        F.lit(version).alias("version"),
    )


def transform(
    spark: SparkSession,
    raw_root: str,
    root: str,
    mapping: Mapping = COINBASE,
    mode: str = "strict",
    rebuild: bool = False,
    full_scan: bool = False,
    run_id: str | None = None,
    as_of=None,
    glob: str = GLOB,
) -> DataFrame:
    """Bring the unprocessed raw files (all of them, to rebuild) into the curated table.

    Returns the run's record as one row. State is written after the data, so a run that fails halfway is
    repeated in full; since rows are compared by key, that adds nothing twice.

    A run checks its invariants: what its jobs counted while they wrote is compared with what is read back. All are
    in the table that `invariants` reads; the record names those that do not hold. Such a run has not passed, its files
    stay unprocessed, and rows that are not all there are not published.
    """
    run_id = run_id or uuid.uuid4().hex
    if rebuild:
        files = list_files(spark, raw_root, glob)
    else:
        files = new_files(spark, raw_root, state.load(spark, root, "processed_files"), glob)
    # The list is written down: what is staged now and what is marked as done later is the same. Its names pass
    # through the driver, as Spark's own index of the files to read does; the streaming form needs no such list.
    files = materialize(files.select("file"), "run-files")
    names = [row.file for row in files.toLocalIterator()]
    if not names:
        return _record(spark, run_id, as_of, status="no_new_files")
    raw = read_raw(spark, names, glob, mapping)
    staged, sent = stage(raw, f"{root}/staging/run_id={run_id}", mapping, mode)
    counts = staged.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("rejected") == 0).alias("usable")).first()
    checks = [
        ("records read = transformed + rejected", sent.get("records", 0), counts.read),
        ("records transformed = staged", sent.get("usable", 0), counts.usable),
    ]
    usable = staged.where(F.col("rejected") == 0)
    written, version, stale, issues = 0, curated.current_version(spark, root), 0, []
    result = {"status": "no_data" if not counts.read else "transformation_failed", "passed": False}
    if any(expected != actual for _, expected, actual in checks):
        result["status"] = "invariant_broken"  # nothing is merged
    elif counts.usable:
        batch = usable.select([F.col(f.name) for f in TRADE.fields])
        try:
            written, version, more = _merge(dedupe_newest(batch), root, rebuild)
            checks += more
        except curated.IncompleteWrite as lost:
            checks.append(("rows written = rows there", lost.sent, lost.kept))
            result["status"] = "invariant_broken"  # nothing was published
        else:
            full = full_validation(curated.read_current(spark, root), as_of) if full_scan else None
            # A rebuild is judged by what it left: the repeats of the raw files were to be expected.
            judged = curated.read_current(spark, root) if rebuild else batch
            before = materialize(state.load_watermarks(spark, root), "watermarks")
            new = materialize(state.batch_watermarks(batch, state.as_of_column(as_of)), "watermarks")
            state.save_watermarks(new, root, f"transform-{run_id}")
            after = state.load_watermarks(spark, root)
            checks += _watermark_checks(before, after, new)
            updates = after.select(*PRODUCT, F.col("updated_at").alias("last_update_ts"))
            found = materialize(batch_validation(judged, updates, as_of), "validation")
            verdict = quality_gates(found, full).first()
            stale = int(found.where("check = 'stale_products'").first().value)
            issues = list(verdict.reasons)
            result = {"status": "success", "duplicates_found": verdict.duplicates, "passed": verdict.passed}
    broken = _save_invariants(spark, root, run_id, checks)
    if broken:
        result |= {"status": "invariant_broken", "passed": False}
    record = _record(
        spark,
        run_id,
        as_of,
        records_read=counts.read,
        records_rejected=counts.read - counts.usable,
        records_transformed=counts.usable,
        records_written=written,
        batch_size=counts.usable,
        version=version,
        files=len(names),
        stale_products=stale,
        issues=issues,
        broken_invariants=broken,
        **result,
    )
    state.append(record, root, "run_history", run_id)
    if result["status"] == "success":
        done = files.select(
            "file", F.lit(run_id).alias("run_id"), F.current_timestamp().alias("processed_at")
        )
        state.append(done, root, "processed_files", run_id)
    state.compact_if_long(spark, root, ["run_history", "processed_files", "watermarks", "invariants", "published"])
    return record


def _record(spark: SparkSession, run_id: str, as_of, **values) -> DataFrame:
    now = state.as_of_column(as_of)
    row = {"run_id": run_id, "records_read": 0, "records_rejected": 0, "records_transformed": 0, "records_written": 0,
           "duplicates_found": 0, "batch_size": 0, "files": 0, "passed": True, "stale_products": 0, "issues": [],
           "broken_invariants": [], **values}
    cell = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    cells = [cell(row.get(f.name)).cast(f.dataType).alias(f.name) for f in RUN.fields if f.name != "ts"]
    return spark.range(1).select(now.alias("ts"), *cells).select(*RUN.fieldNames())


def replay_if_needed(
    spark: SparkSession, raw_root: str, root: str, flagged: bool = False, **options
) -> DataFrame:
    """Rebuild into a new version when the run history calls for it; returns the decision."""
    decision = materialize(
        state.replay_decision(state.since_replay(spark, root), flagged), "decision"
    )
    verdict = decision.first()
    if verdict.should_replay:
        old = curated.current_version(spark, root)
        transform(spark, raw_root, root, rebuild=True, **options)
        new = curated.current_version(spark, root)
        if new > old:
            state.mark_replay(spark, root, old, new, verdict.reason)
    return decision
