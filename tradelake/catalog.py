"""Every query by name, as fn(spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions import scalars
from tradelake.operators import calls, dedupe, gaps, logs, normalize
from tradelake.operators.mapping import Mapping
from tradelake.plans import quality, reports, runs
from tradelake.schema import PRODUCT, TRADE_KEY
from tradelake.session import materialize, scratch_path
from tradelake.sources import curated, raw, state, views
from tradelake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

_SPLIT = "2024-01-20 00:00:00"


def _at(text: str):
    return F.lit(text + "Z").cast("timestamp")


def _report(fn, dated: bool = False, **options) -> Query:
    """A report over the trades made from events."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        extra = {"as_of": views.AS_OF, **options} if dated else options
        return fn(views.trades(spark, root), **extra)

    return run


def _big(fn, **options) -> Query:
    """A report over the larger trade table made from lineitem."""
    return lambda spark, root: fn(views.trades_big(spark, root), **options)


def _calls(fn, **options) -> Query:
    return lambda spark, root: fn(views.call_log(spark, root), **options)


# --- small tables derived from the trades ---------------------------------------------------------------


def _history(trades: DataFrame) -> DataFrame:
    """One run per day; it passes with at most 2% duplicates."""
    return materialize(
        trades.groupBy(F.date_trunc("day", "trade_ts").alias("ts"))
        .agg(F.count(F.lit(1)).alias("batch_size"), F.count_distinct(*TRADE_KEY).alias("keys"))
        .withColumn("duplicates_found", F.col("batch_size") - F.col("keys"))
        .withColumn("passed", F.col("duplicates_found") * 50 <= F.col("batch_size")),
        "history",
    )


def _before(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("trade_ts") < _at(_SPLIT))


def _since(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("trade_ts") >= _at(_SPLIT))


# --- operators ------------------------------------------------------------------------------------------


def _normalized(spark: SparkSession, root: str) -> DataFrame:
    return normalize.normalize(normalize.parse_lines(views.raw_json(spark, root)))


def normalized_trades(spark: SparkSession, root: str) -> DataFrame:
    return normalize.accepted(_normalized(spark, root)).drop("ingest_ts")


def rejected_trades(spark: SparkSession, root: str) -> DataFrame:
    return (
        normalize.rejected(_normalized(spark, root))
        .groupBy(normalize.REASON)
        .agg(F.count(F.lit(1)).alias("rejected"))
    )


def _payloads(trades: DataFrame) -> DataFrame:
    return trades.select(
        F.col("trade_id").cast("bigint").alias("trade_id"),
        F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("size"),
        F.concat(F.date_format("trade_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("time"),
        "side",
        "symbol",
        "ingest_ts",
    )


def raw_records(spark: SparkSession, root: str) -> DataFrame:
    """API payloads as raw records, with two fields read back from the embedded payload."""
    records = normalize.raw_record(_payloads(views.trades(spark, root)), F.col("symbol"), F.col("ingest_ts"))
    return records.select(
        *[c for c in records.columns if c != "_raw_payload"],
        F.get_json_object("_raw_payload", "$.trade_id").alias("payload_id"),
        F.get_json_object("_raw_payload", "$.price").alias("payload_price"),
    )


def _damaged(spark: SparkSession, root: str) -> DataFrame:
    """Trades of which some lost a value or got a bad one."""
    n = F.col("trade_id").cast("bigint")
    return views.trades(spark, root).withColumns(
        {
            "price": F.when(n % 13 == 0, -F.col("price")).otherwise(F.col("price")),
            "quantity": F.when(n % 17 != 0, F.col("quantity")),
            "side": F.when(n % 19 == 0, "hold").otherwise(F.col("side")),
        }
    )


def rule_violations(spark: SparkSession, root: str) -> DataFrame:
    return normalize.rule_violations(_damaged(spark, root))


def invalid_sides(spark: SparkSession, root: str) -> DataFrame:
    return quality.invalid_sides(_damaged(spark, root))


def watermark_merge(spark: SparkSession, root: str) -> DataFrame:
    trades = views.trades(spark, root)
    old = state.batch_watermarks(_before(trades), _at(_SPLIT))
    new = state.batch_watermarks(_since(trades), _at(views.AS_OF))
    return state.merge_watermarks(old, new)


def backlog(spark: SparkSession, root: str) -> DataFrame:
    trades = views.trades(spark, root)
    targets = trades.groupBy(*PRODUCT).agg(
        F.lit(0).cast("bigint").alias("start_id"), F.max(F.col("trade_id").cast("bigint")).alias("target_id")
    )
    even = F.substring("symbol", 4, 1).cast("int") % 2 == 0
    marks = state.batch_watermarks(_before(trades)).where(even)  # odd products have no watermark yet
    return state.backlog(marks, targets)


def unprocessed_files(spark: SparkSession, root: str) -> DataFrame:
    """One raw file per product and day; those before the split are done."""
    name = F.concat_ws("/", "symbol", F.date_format("trade_ts", "yyyy-MM-dd"))
    trades = views.trades(spark, root)
    files = trades.select(name.alias("file")).distinct()
    return raw.unprocessed(files, _before(trades).select(name.alias("file")))


def listed_symbols(spark: SparkSession, root: str) -> DataFrame:
    """Trades per product of a product list (the products that traded on the last day)."""
    trades = views.trades(spark, root)
    last_day = trades.where(F.col("trade_ts") >= _at("2024-01-30 00:00:00"))
    listed = materialize(last_day.select(*PRODUCT).distinct(), "listed")
    kept = dedupe.restrict_to_products(trades, listed)
    return kept.groupBy(*PRODUCT).agg(F.count(F.lit(1)).alias("trades"))


def product_list_update(spark: SparkSession, root: str) -> DataFrame:
    trades = views.trades(spark, root)
    existing = trades.where(F.col("trade_ts") >= _at("2024-01-30 00:00:00")).select(*PRODUCT)
    return state.update_products(existing, trades, r"^SYM[456]-")


def product_coverage(spark: SparkSession, root: str) -> DataFrame:
    return quality.product_list(views.trades(spark, root)).select(
        "products", F.array_join("symbols", ",").alias("symbols")
    )


def run_outcomes(spark: SparkSession, root: str) -> DataFrame:
    health = state.run_health(_history(views.trades(spark, root)))
    return health.withColumn("max_duplicate_ratio", F.round("max_duplicate_ratio", 6))


def replay_decision(spark: SparkSession, root: str) -> DataFrame:
    decision = state.replay_decision(_history(views.trades(spark, root)))
    return decision.withColumn("max_duplicate_ratio", F.round("max_duplicate_ratio", 6))


def batch_validation(spark: SparkSession, root: str) -> DataFrame:
    """The last day's trades as the batch, all products' last times as the update times."""
    trades = views.trades(spark, root)
    updates = trades.groupBy(*PRODUCT).agg(F.max("trade_ts").alias("last_update_ts"))
    return quality.batch_validation(
        trades.where(F.col("trade_ts") >= _at("2024-01-30 00:00:00")), updates, views.AS_OF
    )


def quality_gates(spark: SparkSession, root: str) -> DataFrame:
    trades = views.trades(spark, root)
    gates = quality.quality_gates(
        quality.batch_validation(trades), quality.full_validation(trades, views.AS_OF)
    )
    return gates.select("passed", F.array_join("reasons", ",").alias("reasons"))


def gauge_tiers(spark: SparkSession, root: str) -> DataFrame:
    return quality.gauge_tiers(quality.quality_metrics(views.trades(spark, root), views.AS_OF))


def rate_limit_tiers(spark: SparkSession, root: str) -> DataFrame:
    """Failed calls taken as rate-limit errors of one source, ten for each."""
    errors = views.call_log(spark, root).where(~F.col("ok"))
    return quality.rate_limit_tiers(
        errors.select("ts", F.lit("coinbase").alias("source"), F.lit(10.0).alias("value"))
    )


def run_invariants(spark: SparkSession, root: str) -> DataFrame:
    lines = normalize.parse_lines(views.raw_json(spark, root))
    normalized = materialize(normalize.normalize(lines), "normalized")
    trades = normalize.accepted(normalized)
    old = state.batch_watermarks(_before(trades))
    new = state.merge_watermarks(old, state.batch_watermarks(_since(trades)))
    return quality.run_invariants(lines, normalized, dedupe.dedupe_newest(trades), old, new)


def liveness(spark: SparkSession, root: str) -> DataFrame:
    trades = views.trades(spark, root)
    marks = trades.groupBy(*PRODUCT).agg(F.max("trade_ts").alias("updated_at"))
    return quality.liveness(trades.select(*PRODUCT).distinct(), trades, marks, views.AS_OF)


def metric_rollup(spark: SparkSession, root: str) -> DataFrame:
    points = calls.call_points(views.call_log(spark, root))
    return _round_points(calls.metric_rollup(points, "5 minutes", ("metric",)))


def _round_points(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn("sum_value", F.round("sum_value", 4)).withColumn(
        "avg_value", F.round("avg_value", 8)
    )


def metric_alarms(spark: SparkSession, root: str) -> DataFrame:
    points = calls.call_points(views.call_log(spark, root)).where(F.col("metric") == "APIErrorCount")
    return calls.metric_alarms(points, 2, "1 hour", ("metric",))


def rolling_error_rate(spark: SparkSession, root: str) -> DataFrame:
    rates = calls.rolling_error_rate(views.call_log(spark, root))
    return rates.withColumn("error_rate", F.round("error_rate", 6))


def source_health(spark: SparkSession, root: str) -> DataFrame:
    health = calls.source_health(views.call_log(spark, root))
    return health.withColumn("error_rate", F.round("error_rate", 6))


def latency_ema(spark: SparkSession, root: str) -> DataFrame:
    ema = calls.latency_ema(views.call_log(spark, root))
    return ema.withColumn("avg_response_ms", F.round("avg_response_ms", 6)).withColumn(
        "avg_response_s", F.round("avg_response_s", 8)
    )


# --- sources and sinks: through files in the shared folder ------------------------------------------------


def _write_raw(spark: SparkSession, trades: DataFrame, name: str) -> str:
    folder = scratch_path(spark, name)
    records = normalize.raw_record(_payloads(trades), F.col("symbol"), F.col("ingest_ts"))
    raw.write_raw(records, folder, "run")
    return folder


def raw_files(spark: SparkSession, root: str) -> DataFrame:
    """Raw records written as JSON lines, read back and normalized."""
    folder = _write_raw(spark, views.trades(spark, root), "raw")
    return normalize.accepted(normalize.normalize(raw.read_raw(spark, folder)))


def curated_version(spark: SparkSession, root: str) -> DataFrame:
    """De-duplicated trades published as a version and read back through the pointer."""
    folder = scratch_path(spark, "curated")
    curated.write_version(dedupe.dedupe_newest(views.trades(spark, root)), folder)
    return curated.read_current(spark, folder).drop("trade_date")


def storage_footprint(spark: SparkSession, root: str) -> DataFrame:
    """What SQL can know of a written table's files: that every date has some, and no date more than its rows."""
    folder = scratch_path(spark, "footprint")
    curated.write_trades(views.trades(spark, root), folder)
    whole = curated.storage_footprint(spark, folder)
    rows = curated.read_trades(spark, folder).groupBy("trade_date").agg(F.count(F.lit(1)).alias("rows"))
    return rows.agg(F.count(F.lit(1)).alias("dates"), F.sum("rows").alias("rows")).select(
        "dates",
        "rows",
        ((whole.select("files").scalar() >= F.col("dates")) & (whole.select("files").scalar() <= F.col("rows"))).alias("files_fit"),
        (whole.select("bytes").scalar() > 0).alias("has_bytes"),
    )


def _curated(fn, **options) -> Query:
    """A report over the trades as a table laid out by date."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        folder = scratch_path(spark, "dated")
        curated.write_trades(views.trades(spark, root), folder)
        return fn(curated.read_trades(spark, folder), as_of=views.AS_OF, **options)

    return run


def liveness_curated(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_path(spark, "dated")
    curated.write_trades(views.trades(spark, root), folder)
    trades = curated.read_trades(spark, folder)
    marks = trades.groupBy(*PRODUCT).agg(F.max("trade_ts").alias("updated_at"))
    return quality.liveness(trades.select(*PRODUCT).distinct(), trades, marks, views.AS_OF)


def catalog_table(spark: SparkSession, root: str) -> DataFrame:
    """Rows per date of a table registered in the catalog."""
    folder, name = scratch_path(spark, "table"), f"trades_{uuid.uuid4().hex}"
    curated.write_trades(views.trades(spark, root), folder)
    curated.register_table(spark, name, folder)
    return spark.table(name).groupBy("trade_date").agg(F.count(F.lit(1)).alias("trades"))


def rebuilt(spark: SparkSession, root: str) -> DataFrame:
    """An incremental run over half of the raw files, then a rebuild from all of them."""
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    lines = views.raw_json(spark, root)
    lines.where("event_id % 2 = 0").select("value").write.text(f"{raw_root}/first")
    runs.transform(spark, raw_root, lake, run_id="first", as_of=views.AS_OF, glob="*.txt")
    lines.where("event_id % 2 = 1").select("value").write.text(f"{raw_root}/second")
    runs.transform(spark, raw_root, lake, rebuild=True, run_id="second", as_of=views.AS_OF, glob="*.txt")
    return curated.read_current(spark, lake).drop("trade_date", "ingest_ts")


def raw_files_again(spark: SparkSession, root: str) -> DataFrame:
    """A run's raw files written twice: the second time replaces the first."""
    folder = scratch_path(spark, "raw")
    records = normalize.raw_record(_payloads(views.trades(spark, root)), F.col("symbol"), F.col("ingest_ts"))
    for _ in range(2):
        raw.write_raw(records, folder, "run")
    return normalize.accepted(normalize.normalize(raw.read_raw(spark, folder)))


def product_list_file(spark: SparkSession, root: str) -> DataFrame:
    """Trades per product of a product list kept in a file."""
    trades, path = views.trades(spark, root), scratch_path(spark, "products")
    state.write_products(trades.where(F.col("trade_ts") >= _at("2024-01-30 00:00:00")).select(*PRODUCT).distinct(), path)
    kept = dedupe.restrict_to_products(trades, state.read_products(spark, path))
    return kept.groupBy(*PRODUCT).agg(F.count(F.lit(1)).alias("trades"))


def normalized_compat(spark: SparkSession, root: str) -> DataFrame:
    """Records without price or side, which the lenient mode fills in."""
    trades = views.trades(spark, root, keep=("event_id",))
    gone = lambda n, c: F.when(F.col("event_id") % n != 0, F.col(c).cast("string"))
    fields = {"id": F.col("trade_id"), "product_id": F.col("symbol"), "side": gone(3, "side"), "price": gone(5, "price"), "size": F.col("quantity").cast("string")}
    time = F.concat(F.date_format("trade_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("time")
    lines = trades.select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()], time)).alias("value"))
    return normalize.accepted(normalize.normalize(normalize.parse_lines(lines), mode="compat")).drop("ingest_ts")


_OTHER = Mapping(
    fields={"symbol": ["pair"], "trade_id": ["tid"], "side": ["dir"], "price": ["px"], "quantity": ["vol"], "trade_ts": ["at"]},
    constants={"exchange": "elsewhere"},
    casts={"side": "lower", "price": "double", "quantity": "double", "trade_ts": "timestamp"},
    required=("trade_id", "symbol", "side", "price", "quantity", "trade_ts"),
)


def _other_lines(spark: SparkSession, root: str) -> DataFrame:
    names = {"pair": "symbol", "tid": "trade_id", "dir": "side", "px": "price", "vol": "quantity"}
    time = F.concat(F.date_format("trade_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("at")
    cells = [F.col(c).cast("string").alias(n) for n, c in names.items()]
    return views.trades(spark, root).select(F.to_json(F.struct(*cells, time)).alias("value"))


def normalized_other_source(spark: SparkSession, root: str) -> DataFrame:
    """A source with field names of its own."""
    lines = normalize.parse_lines(_other_lines(spark, root), mapping=_OTHER)
    return normalize.accepted(normalize.normalize(lines, _OTHER)).drop("ingest_ts")


def stream_other_source(spark: SparkSession, root: str) -> DataFrame:
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "stream")
    _other_lines(spark, root).write.text(raw_root)
    rows = ingest.stream_raw(spark, raw_root, glob="*.txt", mapping=_OTHER)
    ingest.curate(rows, lake, f"{lake}/checkpoint", _OTHER).awaitTermination()
    return ingest.settled(spark, lake).drop("ingest_ts")


def mixed_folders(spark: SparkSession, root: str) -> DataFrame:
    """Two trade folders, of which one lacks a column."""
    old, new = scratch_path(spark, "old"), scratch_path(spark, "new")
    trades = views.trades(spark, root)
    _before(trades).drop("ingest_ts").write.parquet(old)
    curated.write_trades(_since(trades), new)
    return curated.read_trades(spark, old, new).drop("trade_date")


def failed_calls(spark: SparkSession, root: str) -> DataFrame:
    """Error texts cut to 500 characters, by length."""
    text = F.repeat(F.col("event_type"), (F.col("event_id") % 200 + 1).cast("int"))
    events = spark.read.parquet(f"{root}/events.parquet").where("event_type = 'error'")
    return events.select("event_id", F.length(scalars.shorten_error(text)).alias("length"))


def dedupe_null_keys(spark: SparkSession, root: str) -> DataFrame:
    """Some trades lose their id: they all stay, the others keep their newest row."""
    lost = F.col("event_id") % 11 == 0
    trades = views.trades(spark, root, keep=("event_id",))
    trades = trades.withColumn("trade_id", F.when(~lost, F.col("trade_id"))).drop("event_id")
    folder = scratch_path(spark, "lake")
    curated.write_version(trades, folder)
    for _ in range(2):  # the second time there is nothing to do
        runs.deduplicate(spark, folder)
    version = curated.current_version(spark, folder)
    return curated.read_current(spark, folder).drop("trade_date").withColumn("version", F.lit(version))


def replay_after_rebuild(spark: SparkSession, root: str) -> DataFrame:
    """A batch with many repeats leads to one rebuild; asked again, there is nothing to do."""
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    lines = views.raw_json(spark, root).select("value")
    lines.union(lines).write.text(f"{raw_root}/first")
    runs.transform(spark, raw_root, lake, run_id="first", as_of=views.AS_OF, glob="*.txt")
    asked = [runs.replay_if_needed(spark, raw_root, lake, as_of=views.AS_OF, glob="*.txt").first().reason for _ in range(3)]
    kept = curated.read_current(spark, lake).agg(F.count(F.lit(1)).alias("trades"))
    return kept.select("trades", F.lit(curated.current_version(spark, lake)).alias("version"), F.lit(",".join(asked)).alias("reasons"))


def _one_source(spark: SparkSession, root: str) -> DataFrame:
    """All calls as those of one source; latency is zero but for the first and the last call."""
    calls = views.call_log(spark, root)
    ends = calls.where("ok").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    zero = (F.col("id") != ends.select("a").scalar()) & (F.col("id") != ends.select("b").scalar())
    return calls.withColumns({"source": F.lit("all"), "latency_ms": F.when(zero, 0.0).otherwise(F.col("latency_ms"))})


def latency_ema_zeros(spark: SparkSession, root: str) -> DataFrame:
    ema = calls.latency_ema(_one_source(spark, root))
    return ema.withColumn("avg_response_ms", F.round("avg_response_ms", 6)).withColumn("avg_response_s", F.round("avg_response_s", 8))


def latency_ema_each(spark: SparkSession, root: str) -> DataFrame:
    return _each(calls.latency_ema_each(views.call_log(spark, root)))


def latency_ema_each_busy(spark: SparkSession, root: str) -> DataFrame:
    """One source makes all calls; blocks are short, so that averages are carried over several."""
    busy = views.call_log(spark, root).withColumn("source", F.lit("all"))
    return _each(calls.latency_ema_each(busy, block=50))


def latency_ema_each_zeros(spark: SparkSession, root: str) -> DataFrame:
    """An average that falls to exactly zero and is seeded anew."""
    return _each(calls.latency_ema_each(_one_source(spark, root), alpha=0.5))


def _each(averages: DataFrame) -> DataFrame:
    return averages.withColumn("avg_response_ms", F.round("avg_response_ms", 6))


def metric_rollup_merged(spark: SparkSession, root: str) -> DataFrame:
    """Summaries by minute and source, added up to hours of all sources."""
    points = calls.call_points(views.call_log(spark, root))
    hours = calls.widen_summary(calls.metric_summary(points), "1 hour", ("metric",))
    rollup = _round_points(calls.summary_rollup(hours, ("metric",)))
    return rollup.withColumns({c: F.round(c, 6) for c in ("p50_value", "p99_value")})


def rolling_error_rate_wide(spark: SparkSession, root: str) -> DataFrame:
    """A window of more calls than a chunk was asked to hold, over one source."""
    rates = calls.rolling_error_rate(_one_source(spark, root), size=250, chunk=100)
    return rates.withColumn("error_rate", F.round("error_rate", 6))


def incremental_transform(spark: SparkSession, root: str) -> DataFrame:
    """Two pipeline runs over raw files that share a third of their trades; the curated table after both."""
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    lines = views.raw_json(spark, root)
    third = F.col("event_id") % 3
    for run, part in (("first", lines.where(third < 2)), ("second", lines.where(third > 0))):
        part.select("value").write.option("compression", "none").text(f"{raw_root}/{run}")
        runs.transform(spark, raw_root, lake, run_id=run, as_of=views.AS_OF, glob="*.txt")
    return curated.read_current(spark, lake).drop("trade_date", "ingest_ts")


def _two_runs(spark: SparkSession, root: str) -> str:
    """Two pipeline runs on different days over raw files that share a third of their trades, and a third without new files."""
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    lines, third = views.raw_json(spark, root), F.col("event_id") % 3
    parts = (("first", lines.where(third < 2), "2024-01-30 00:00:00"), ("second", lines.where(third > 0), views.AS_OF))
    for run, part, as_of in parts:
        part.select("value").write.option("compression", "none").text(f"{raw_root}/{run}")
        runs.transform(spark, raw_root, lake, run_id=run, as_of=as_of, glob="*.txt")
    return lake


def transform_invariants(spark: SparkSession, root: str) -> DataFrame:
    """What two runs have counted while writing and read back afterwards."""
    return runs.invariants(spark, _two_runs(spark, root))


def run_records(spark: SparkSession, root: str) -> DataFrame:
    """The records of two runs, with the products that had no news for two hours when they ran."""
    history = state.load(spark, _two_runs(spark, root), "run_history")
    counts = [c for c in history.columns if c.startswith(("records", "batch", "duplicates")) or c in ("version", "stale_products")]
    return history.select("run_id", "status", "passed", *counts, F.array_join("issues", ",").alias("issues"), F.size("broken_invariants").alias("broken"))


def _stream_curated(spark: SparkSession, root: str) -> str:
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "stream")
    views.raw_json(spark, root).select("value").write.text(raw_root)
    query = ingest.curate(ingest.stream_raw(spark, raw_root, glob="*.txt"), lake, f"{lake}/checkpoint")
    query.awaitTermination()
    return lake


def stream_curate(spark: SparkSession, root: str) -> DataFrame:
    return ingest.settled(spark, _stream_curated(spark, root)).drop("ingest_ts")


def _plain_lines(trades: DataFrame) -> DataFrame:
    """Trades as raw JSON texts."""
    cells = {"id": "trade_id", "product_id": "symbol", "side": "side", "price": "price", "size": "quantity"}
    time = F.concat(F.date_format("trade_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("time")
    return trades.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(n) for n, c in cells.items()], time)).alias("value"))


def stream_corrections(spark: SparkSession, root: str) -> DataFrame:
    """A stream that ends and goes on: first all trades, then some of them again, a part of these a day later at twice the price."""
    raw_root, lake = scratch_path(spark, "raw"), scratch_path(spark, "stream")
    trades = views.trades(spark, root, keep=("event_id",))
    again = trades.where("event_id % 3 = 0").withColumns(
        {
            "price": F.when(F.col("event_id") % 9 == 0, F.col("price") * 2).otherwise(F.col("price")),
            "trade_ts": F.when(F.col("event_id") % 9 == 0, F.col("trade_ts") + F.expr("interval 1 day")).otherwise(F.col("trade_ts")),
        }
    )
    for name, part in (("first", trades), ("second", again)):
        _plain_lines(part).write.text(f"{raw_root}/{name}")
        ingest.curate(ingest.stream_raw(spark, raw_root, glob="*.txt"), lake, f"{lake}/checkpoint").awaitTermination()
    return ingest.settled(spark, lake).drop("ingest_ts")


def state_after_many_runs(spark: SparkSession, root: str) -> DataFrame:
    """Watermarks of 50 runs, compacted after every 20 and written once more by 5 of them; rows kept and cursor per product."""
    lake, part = scratch_path(spark, "state"), F.pmod(F.col("event_id"), F.lit(50))
    trades = views.trades(spark, root, keep=("event_id",)).withColumn("part", part)
    tops = trades.groupBy("part", *PRODUCT).agg(F.max(F.col("trade_id").cast("bigint")).alias("cursor"))
    tops = materialize(tops.withColumn("updated_at", _at(views.AS_OF)), "tops")
    for i in [*range(50), 0, 10, 19, 20, 49]:
        state.save_watermarks(tops.where(F.col("part") == i).select(*PRODUCT, "cursor", "updated_at"), lake, f"run-{i}")
        state.compact_if_long(spark, lake, ["watermarks"], most=20)
    rows = state.load(spark, lake, "watermarks").groupBy(*PRODUCT).agg(F.count(F.lit(1)).alias("rows"))
    return state.load_watermarks(spark, lake).select(*PRODUCT, "cursor").join(rows, [*PRODUCT])


def quality_metrics_stored(spark: SparkSession, root: str) -> DataFrame:
    """The metric set of a stored table, with the size of its files."""
    folder = scratch_path(spark, "stored")
    curated.write_trades(views.trades(spark, root), folder)
    stored = curated.read_trades(spark, folder)
    return quality.quality_metrics(stored, views.AS_OF, curated.storage_footprint(spark, folder))


def source_status(spark: SparkSession, root: str) -> DataFrame:
    return calls.source_status(views.call_log(spark, root, errors=True))


def stream_watermarks(spark: SparkSession, root: str) -> DataFrame:
    return state.load_watermarks(spark, _stream_curated(spark, root)).select(*PRODUCT, "cursor")


def stream_drop_repeats(spark: SparkSession, root: str) -> DataFrame:
    """Keys left after bounded streaming de-duplication."""
    out = scratch_path(spark, "repeats")
    kept = ingest.drop_repeats(views.trades_of(views.event_stream(spark, root))).select(*TRADE_KEY)
    ingest.write_available(kept, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Five-minute roll-ups of the call log as a stream, with the last periods from the closing batch run."""
    out = scratch_path(spark, "rollup")
    points = calls.call_points(views.calls_of(views.event_stream(spark, root)))
    rollup = ingest.rollup(points.withColumn("source", F.lit("all")))
    ingest.write_available(rollup, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    batch = calls.call_points(views.call_log(spark, root)).withColumn("source", F.lit("all"))
    return _round_points(ingest.closed_rollup(spark.read.parquet(f"{out}/rows"), batch, ("metric", "source"))).drop("source")


# --- the list -------------------------------------------------------------------------------------------

_QUERIES: dict[str, Query] = {
    "overview_by_symbol": _report(reports.overview_by_symbol),
    "overview_totals": _report(reports.overview_totals),
    "freshness_by_symbol": _report(reports.freshness_by_symbol, dated=True),
    "freshness_totals": _report(reports.freshness_totals, dated=True),
    "stale_symbols": _report(reports.stale_symbols, dated=True),
    "time_gap_anomalies": _report(reports.time_gap_anomalies),
    "time_gap_summary": _report(reports.time_gap_summary),
    "duplicate_keys": _report(reports.duplicate_keys),
    "duplicates_by_symbol": _report(reports.duplicates_by_symbol),
    "duplicate_totals": _report(reports.duplicate_totals),
    "id_gaps": _report(reports.id_gap_list),
    "id_gap_summary": _report(reports.id_gap_summary),
    "completeness": _report(reports.completeness),
    "freshness_histogram": _report(reports.freshness_histogram, dated=True),
    "id_gap_totals": _report(reports.id_gap_totals),
    "completeness_totals": _report(reports.completeness_totals),
    "top_symbols_by_volume": _report(reports.top_symbols_by_volume, dated=True),
    "problem_symbols": _report(reports.problem_symbols, dated=True),
    "symbol_health": _report(reports.symbol_health, dated=True),
    "symbol_health_joined": _report(reports.symbol_health_joined, dated=True),
    "hourly_bars": _report(reports.hourly_bars, dated=True),
    "low_activity_periods": _report(reports.low_activity_periods, dated=True, grain="day"),
    "low_activity_hours": _report(reports.low_activity_periods, dated=True, grain="hour", z_max=-1),
    "daily_summary": _report(reports.daily_summary, dated=True),
    "ingest_latency": _report(reports.ingest_latency, dated=True),
    "latest_trades": _report(reports.latest_trades, symbol="SYM3-USD"),
    "hourly_volume_one_symbol": _report(reports.hourly_volume_one_symbol, symbol="SYM3-USD"),
    "dq_overview": _report(reports.dq_overview),
    "dq_freshness": _report(reports.dq_freshness, dated=True),
    "dq_duplicates": _report(reports.dq_duplicates),
    "records_since_yesterday": _report(reports.records_since_yesterday, dated=True),
    "dedupe_precheck": _report(reports.dedupe_precheck),
    "dedupe": _report(dedupe.dedupe_newest),
    "product_last_seen": lambda spark, root: logs.product_last_seen(views.log_lines(spark, root)),
    # Parts of the reports, and the other operators.
    "time_gap_list": _report(gaps.time_gaps),
    "id_gap_runs": _report(gaps.id_gaps),
    "dedupe_first": _report(dedupe.dedupe_first),
    "duplicate_members": _report(dedupe.duplicate_members),
    "normalized_trades": normalized_trades,
    "normalized_compat": normalized_compat,
    "normalized_other_source": normalized_other_source,
    "rejected_trades": rejected_trades,
    "raw_records": raw_records,
    "rule_violations": rule_violations,
    "invalid_sides": invalid_sides,
    "product_list_update": product_list_update,
    "product_coverage": product_coverage,
    "listed_symbols": listed_symbols,
    "unprocessed_files": unprocessed_files,
    "watermark_merge": watermark_merge,
    "backlog": backlog,
    # Quality.
    "batch_validation": batch_validation,
    "full_validation": _report(quality.full_validation, dated=True),
    "validation_offenders": _report(quality.validation_offenders, dated=True),
    "quality_gates": quality_gates,
    "health_score": _report(quality.health_score, dated=True),
    "quality_metrics": _report(quality.quality_metrics, dated=True),
    "gauge_tiers": gauge_tiers,
    "rate_limit_tiers": rate_limit_tiers,
    "bucketed_metrics": _report(quality.bucketed_metrics, dated=True, top=("SYM0-USD", "SYM3-USD")),
    "run_invariants": run_invariants,
    "run_outcomes": run_outcomes,
    "replay_decision": replay_decision,
    "liveness": liveness,
    # Call log and logs.
    "rolling_error_rate": rolling_error_rate,
    "source_health": source_health,
    "failure_runs": _calls(calls.failure_runs, at_least=3),
    "rolling_error_rate_wide": rolling_error_rate_wide,
    "latency_ema": latency_ema,
    "latency_ema_zeros": latency_ema_zeros,
    "latency_ema_each": latency_ema_each,
    "latency_ema_each_busy": latency_ema_each_busy,
    "latency_ema_each_zeros": latency_ema_each_zeros,
    "metric_rollup_merged": metric_rollup_merged,
    "failed_calls": failed_calls,
    "metric_rollup": metric_rollup,
    "metric_alarms": metric_alarms,
    "log_counts": lambda spark, root: logs.log_counts(views.log_lines(spark, root)),
    # The larger trade table.
    "big_completeness": _big(reports.completeness),
    "big_id_gap_totals": _big(reports.id_gap_totals),
    "big_time_gap_summary": _big(reports.time_gap_summary),
    "big_duplicate_keys": _big(reports.duplicate_keys),
    "big_overview": _big(reports.overview_by_symbol),
    "big_dedupe": _big(dedupe.dedupe_newest),
    # Files and streams.
    "raw_files": raw_files,
    "curated_version": curated_version,
    "storage_footprint": storage_footprint,
    "incremental_transform": incremental_transform,
    "transform_invariants": transform_invariants,
    "run_records": run_records,
    "stream_curate": stream_curate,
    "stream_corrections": stream_corrections,
    "state_after_many_runs": state_after_many_runs,
    "quality_metrics_stored": quality_metrics_stored,
    "source_status": source_status,
    "stream_watermarks": stream_watermarks,
    "stream_drop_repeats": stream_drop_repeats,
    "stream_rollup": stream_rollup,
    "stream_other_source": stream_other_source,
    "catalog_table": catalog_table,
    "rebuilt": rebuilt,
    "raw_files_again": raw_files_again,
    "product_list_file": product_list_file,
    "mixed_folders": mixed_folders,
    "replay_after_rebuild": replay_after_rebuild,
    "dedupe_null_keys": dedupe_null_keys,
    # Reports over a table laid out by date, of which only the asked dates are read.
    "hourly_bars_curated": _curated(reports.hourly_bars),
    "low_activity_periods_curated": _curated(reports.low_activity_periods, grain="day"),
    "daily_summary_curated": _curated(reports.daily_summary),
    "ingest_latency_curated": _curated(reports.ingest_latency),
    "records_since_yesterday_curated": _curated(reports.records_since_yesterday),
    "liveness_curated": liveness_curated,
}


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times, which read the same in every client."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(query(spark, root))

    return run


def all_queries() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in _QUERIES.items()}
