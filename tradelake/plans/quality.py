"""Data-quality checks, gates, scores and metric sets. All stay DataFrames; no rows reach the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.scalars import (
    TOP_PRODUCTS,
    as_of_column,
    bucket_product,
    gauge_tier,
    percent,
    ratio,
    score_tier,
    whole_units,
)
from tradelake.operators.gaps import longest_gaps
from tradelake.operators.normalize import REASON
from tradelake.operators.profile import between, product_profile, product_totals
from tradelake.schema import PRODUCT, REQUIRED_COLUMNS, TRADE
from tradelake.session import materialize

SIDES = ("buy", "sell")
MAX_DUPLICATE_PCT = 5
MAX_AGE_HOURS = 4
STALE_PRODUCT_MINUTES = 360


def _rows(one: DataFrame, cells: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """Turn one row of results into (check, severity, value, issue) rows."""
    structs = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(severity).alias("severity"),
            value.cast("double").alias("value"),
            F.coalesce(issue, F.lit(False)).alias("issue"),
        )
        for check, severity, value, issue in cells
    ]
    return one.select(F.explode(F.array(*structs)).alias("_c")).select("_c.*")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def invalid_sides(trades: DataFrame) -> DataFrame:
    """Distinct side values other than buy and sell."""
    return trades.where(~F.col("side").isin(*SIDES) | F.col("side").isNull()).select("side").distinct()


def product_list(trades: DataFrame) -> DataFrame:
    """Number of products and their sorted names, as one row; there is one name per listed product."""
    names = trades.select(*PRODUCT).distinct()
    return names.agg(
        F.count(F.lit(1)).alias("products"), F.sort_array(F.collect_set("symbol")).alias("symbols")
    )


def batch_validation(batch: DataFrame, last_updates: DataFrame | None = None, as_of=None) -> DataFrame:
    """Checks of one batch as (check, severity, value, issue); value counts failed rows.

    `last_updates` (exchange, symbol, last_update_ts) adds the number of products without news for 2 hours.
    """
    missing = [c for c in REQUIRED_COLUMNS if c not in batch.columns]
    full = batch.withColumns({c: F.lit(None).cast(TRADE[c].dataType) for c in missing}) if missing else batch
    rules = {
        # Neither null nor NaN is a positive number; a column that is missing as a whole is its own check.
        "bad_price": F.coalesce(F.isnan("price") | (F.col("price") <= 0), F.lit("price" not in missing)),
        "bad_quantity": F.coalesce(F.isnan("quantity") | (F.col("quantity") <= 0), F.lit("quantity" not in missing)),
        "bad_side": F.coalesce(~F.col("side").isin(*SIDES), F.lit("side" not in missing)),
    }
    one = product_profile(full, {name: _flag(broken) for name, broken in rules.items()}).agg(
        F.coalesce(F.sum("trades"), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.col("trades") - F.col("distinct_ids")), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
    )
    duplicates = F.lit(0) if "trade_id" in missing else F.col("duplicates")
    cells = [
        ("records_checked", "info", F.col("records"), F.lit(False)),
        ("missing_columns", "error", F.lit(len(missing)), F.lit(bool(missing))),
        ("duplicate_keys", "warning", duplicates, duplicates > 0),
        ("price_not_positive", "warning", F.col("bad_price"), F.col("bad_price") > 0),
        ("quantity_not_positive", "warning", F.col("bad_quantity"), F.col("bad_quantity") > 0),
        ("invalid_side", "warning", F.col("bad_side"), F.col("bad_side") > 0),
    ]
    checks = _rows(one, cells)
    if last_updates is None:
        return checks
    old = _hours_between(F.col("last_update_ts"), as_of_column(as_of)) > 2
    stale = last_updates.agg(F.count_if(old).alias("n"))
    return checks.unionByName(_rows(stale, [("stale_products", "info", F.col("n"), F.lit(False))]))


def full_validation(trades: DataFrame, as_of=None) -> DataFrame:
    """Checks of the whole table as (check, severity, value, issue)."""
    now = as_of_column(as_of)
    longest = longest_gaps(trades).withColumn("gap_minutes", F.col("gap_micros") / F.lit(6e7))
    one = (
        product_profile(trades)
        .select(*PRODUCT, "trades", "distinct_ids", "last_ts")
        .join(longest, [*PRODUCT], "left")
        .agg(
            F.coalesce(F.sum("trades"), F.lit(0)).alias("records"),
            F.count(F.lit(1)).alias("products"),
            F.coalesce(F.sum(F.col("trades") - F.col("distinct_ids")), F.lit(0)).alias("duplicates"),
            _hours_between(F.max("last_ts"), now).alias("age_hours"),
            F.count_if(F.col("gap_minutes") > 60).alias("gapped"),
            F.max(F.when(F.col("gap_minutes") > 60, F.col("gap_minutes"))).alias("max_gap"),
            F.count_if(_hours_between(F.col("last_ts"), now) > 2).alias("stale"),
        )
    )
    return _rows(
        one,
        [
            ("total_records", "info", F.col("records"), F.lit(False)),
            ("products", "info", F.col("products"), F.lit(False)),
            ("age_hours", "warning", F.round("age_hours", 4), F.col("age_hours") > 1),
            ("duplicate_keys", "warning", F.col("duplicates"), F.col("duplicates") > 0),
            ("products_with_long_gaps", "warning", F.col("gapped"), F.col("gapped") > 3),
            ("max_gap_minutes", "info", F.round(F.coalesce("max_gap", F.lit(0.0)), 4), F.lit(False)),
            ("stale_products", "warning", F.col("stale"), F.col("stale") > 5),
        ],
    )


def validation_offenders(trades: DataFrame, as_of=None) -> DataFrame:
    """Which products fail the checks of the whole table, as (check, exchange, symbol, value).

    long_gap: longest gap in minutes, above 60. stale: hours without a trade, above 2. duplicate_keys: surplus rows.
    """
    longest = longest_gaps(trades).withColumn("gap_minutes", F.col("gap_micros") / F.lit(6e7))
    age = _hours_between(F.col("last_ts"), as_of_column(as_of))
    surplus = F.col("trades") - F.col("distinct_ids")
    found = [
        F.when(F.col("gap_minutes") > 60, F.struct(F.lit("long_gap").alias("check"), F.round("gap_minutes", 4).alias("value"))),
        F.when(age > 2, F.struct(F.lit("stale").alias("check"), F.round(age, 4).alias("value"))),
        F.when(surplus > 0, F.struct(F.lit("duplicate_keys").alias("check"), surplus.cast("double").alias("value"))),
    ]
    return (
        product_profile(trades)
        .select(*PRODUCT, "trades", "distinct_ids", "last_ts")
        .join(longest, [*PRODUCT], "left")
        .select(*PRODUCT, F.explode(F.array_compact(F.array(*found))).alias("f"))
        .select("f.check", *PRODUCT, "f.value")
    )


def quality_gates(batch_checks: DataFrame, full_checks: DataFrame | None = None) -> DataFrame:
    """One row (passed, reasons, duplicates). Exactly 5% duplicates and exactly 4 hours still pass."""
    checks = batch_checks.withColumn("scope", F.lit("batch"))
    if full_checks is not None:
        checks = checks.unionByName(full_checks.withColumn("scope", F.lit("full")))

    def of(scope: str, check: str) -> Column:
        hit = (F.col("scope") == scope) & (F.col("check") == check)
        return F.max(F.when(hit, F.col("value")))

    one = checks.agg(
        of("batch", "missing_columns").alias("missing"),
        of("batch", "duplicate_keys").alias("duplicates"),
        of("batch", "records_checked").alias("records"),
        of("full", "age_hours").alias("age"),
    )
    reasons = F.array_compact(
        F.array(
            F.when(F.col("missing") > 0, "missing_columns"),
            F.when(
                (F.col("records") > 0) & (F.col("duplicates") * 100 > F.col("records") * MAX_DUPLICATE_PCT),
                "duplicates",
            ),
            F.when(F.col("age") > MAX_AGE_HOURS, "freshness"),
        )
    )
    return one.select(
        (F.size(reasons) == 0).alias("passed"),
        reasons.alias("reasons"),
        F.col("duplicates").cast("bigint").alias("duplicates"),
    )


def _per_product(trades: DataFrame, as_of) -> DataFrame:
    now = as_of_column(as_of)
    yesterday = F.date_trunc("day", now) - F.expr("interval 1 day")
    return product_profile(trades, {"recent": _flag(F.col("trade_ts") >= yesterday)}).select(
        *PRODUCT,
        "trades",
        "volume",
        "first_ts",
        "last_ts",
        "recent",
        (F.col("trades") - F.col("distinct_ids")).alias("duplicates"),
        (F.col("expected_ids") - F.col("numeric_ids")).alias("missing"),
        F.coalesce(percent(F.col("numeric_ids"), F.col("expected_ids"), 2), F.lit(100.0)).alias("pct"),
        whole_units("MINUTE", F.col("last_ts"), now).alias("minutes"),
    )


def _totals(products: DataFrame) -> DataFrame:
    return products.agg(
        F.coalesce(F.sum("trades"), F.lit(0)).alias("records"),
        F.count(F.lit(1)).alias("products"),
        F.coalesce(F.round(F.sum("volume"), 2), F.lit(0.0)).alias("volume"),
        F.coalesce(whole_units("DAY", F.min("first_ts"), F.max("last_ts")), F.lit(0)).alias("span_days"),
        F.coalesce(F.sum("recent"), F.lit(0)).alias("recent"),
        F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates"),
        F.count_if(F.col("duplicates") > 0).alias("products_with_duplicates"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
        F.coalesce(F.min("pct"), F.lit(100.0)).alias("min_pct"),
        F.coalesce(F.avg("pct"), F.lit(0.0)).alias("avg_pct"),
        F.avg("minutes").alias("avg_minutes"),
        F.max("minutes").alias("max_minutes"),
        F.count_if(F.col("minutes") > STALE_PRODUCT_MINUTES).alias("stale"),
    )


def _score() -> Column:
    """100 minus points for duplicates, incompleteness, missing trades and stale products; at least 0."""
    duplicates = F.least(F.lit(20), F.col("duplicates"))
    incomplete = F.when(F.col("min_pct") < 99, F.least(F.lit(30.0), (100 - F.col("min_pct")) * 3)).otherwise(0.0)
    missing = F.when(F.col("missing") > 100, F.least(F.lit(20), F.expr("missing div 100"))).otherwise(0)
    stale_pct = 100 * ratio(F.col("stale"), F.col("products"))
    stale = F.when(F.col("products") > 0, F.least(F.lit(30.0), stale_pct)).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.lit(100.0) - duplicates - incomplete - missing - stale)


def health_score(trades: DataFrame, as_of=None) -> DataFrame:
    """The data set's health score with the figures it comes from, as one row."""
    return _totals(_per_product(trades, as_of)).select(
        "duplicates",
        F.col("missing").alias("missing_trades"),
        F.col("min_pct").alias("min_completeness_pct"),
        F.col("stale").alias("stale_products"),
        "products",
        F.round(_score(), 4).alias("health_score"),
    )


def quality_metrics(trades: DataFrame, as_of=None, footprint: DataFrame | None = None) -> DataFrame:
    """The quality metric set as (metric, dimension, value); dimension is "exchange:symbol" or empty.

    `footprint` is the result of storage_footprint.
    """
    products = materialize(_per_product(trades, as_of), "products")
    growth = F.col("records") / F.greatest(F.col("span_days"), F.lit(1))
    single = {
        "TotalRecords": F.col("records"),
        "ProductCount": F.col("products"),
        "TotalVolumeUSD": F.col("volume"),
        "DataSpanDays": F.col("span_days"),
        "AvgDailyGrowth": F.round(growth, 4),
        "AvgDataFreshnessMinutes": F.round("avg_minutes", 4),
        "MaxDataFreshnessMinutes": F.col("max_minutes"),
        "StaleProductCount": F.col("stale"),
        "MissingTradesTotal": F.col("missing"),
        "MinCompletenessPct": F.col("min_pct"),
        "AvgCompletenessPct": F.round("avg_pct", 4),
        "DuplicateTradesTotal": F.col("duplicates"),
        "ProductsWithDuplicates": F.col("products_with_duplicates"),
        "DailyRecordsWritten": F.col("recent"),
        "OverallHealthScore": F.round(_score(), 4),
    }
    each = {"RecordsPerProduct": F.col("trades"), "FreshnessMinutes": F.col("minutes")}
    metrics = _metric_rows(_totals(products), single, F.lit("")).unionByName(
        _metric_rows(products, each, F.concat_ws(":", *PRODUCT))
    )
    if footprint is not None:
        metrics = metrics.unionByName(_metric_rows(footprint, {"ParquetSizeGB": F.col("size_gb")}, F.lit("")))
    # Freshness figures do not exist without products.
    return metrics.where(F.col("value").isNotNull())


def _metric_rows(rows: DataFrame, values: dict[str, Column], dimension: Column) -> DataFrame:
    cells = [
        F.struct(
            F.lit(name).alias("metric"), dimension.alias("dimension"), value.cast("double").alias("value")
        )
        for name, value in values.items()
    ]
    return rows.select(F.explode(F.array(*cells)).alias("_m")).select("_m.*")


def gauge_tiers(metrics: DataFrame) -> DataFrame:
    """Tier of every gauge that has thresholds, and the data span in years."""
    value, metric = F.col("value"), F.col("metric")
    tier = (
        F.when(metric == "OverallHealthScore", score_tier(value))
        .when(metric == "StaleProductCount", F.when(value >= 5, "YELLOW").otherwise("GREEN"))
        .when(metric == "MissingTradesTotal", gauge_tier(value, 10, 100))
    )
    years = metrics.where(metric == "DataSpanDays").select(
        F.lit("DataSpanYears").alias("metric"),
        F.round(value / 365, 4).alias("value"),
        F.lit(None).cast("string").alias("tier"),
    )
    return metrics.select("metric", "value", tier.alias("tier")).where(F.col("tier").isNotNull()).unionByName(years)


def rate_limit_tiers(errors: DataFrame) -> DataFrame:
    """Minutes with rate-limit errors (ts, source, value) and their tier: 10 and 50 per minute."""
    return (
        errors.groupBy(F.window("ts", "1 minute").alias("w"), "source")
        .agg(F.sum("value").alias("errors"))
        .select(F.col("w.start").alias("minute"), "source", "errors", gauge_tier(F.col("errors"), 10, 50).alias("tier"))
    )


def bucketed_metrics(trades: DataFrame, as_of=None, top: tuple[str, ...] = TOP_PRODUCTS) -> DataFrame:
    """Trades and data age of the named products, all others together."""
    return (
        product_totals(trades)
        .groupBy("exchange", bucket_product(F.col("symbol"), top).alias("product"))
        .agg(
            F.sum("trades").alias("trades"),
            F.count(F.lit(1)).alias("symbols"),
            whole_units("MINUTE", F.max("last_ts"), as_of_column(as_of)).alias("min_age_minutes"),
            whole_units("MINUTE", F.min("last_ts"), as_of_column(as_of)).alias("max_age_minutes"),
        )
    )


def run_invariants(
    raw: DataFrame,
    normalized: DataFrame,
    curated: DataFrame,
    old_watermarks: DataFrame,
    new_watermarks: DataFrame,
) -> DataFrame:
    """What must hold after every run, as (invariant, expected, actual, holds)."""
    usable = F.col(REASON).isNull()
    counts = normalized.agg((F.count_if(usable) + F.count_if(~usable)).alias("actual")).withColumn(
        "expected", raw.agg(F.count(F.lit(1))).scalar()
    )
    keys = product_profile(curated).agg(
        F.coalesce(F.sum("distinct_ids"), F.lit(0)).alias("expected"),
        F.coalesce(F.sum("trades"), F.lit(0)).alias("actual"),
    )
    before = old_watermarks.select(*PRODUCT, F.col("cursor").alias("before"))
    lower = F.coalesce(F.col("cursor"), F.lit(-1)) < F.col("before")
    back = before.join(new_watermarks.select(*PRODUCT, "cursor"), [*PRODUCT], "left").agg(
        F.lit(0).cast("bigint").alias("expected"), F.count_if(lower).alias("actual")
    )
    named = {
        "read = transformed + rejected": counts,
        "curated rows = distinct keys": keys,
        "no watermark goes back": back,
    }
    parts = [df.select(F.lit(name).alias("invariant"), "expected", "actual") for name, df in named.items()]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.withColumn("holds", F.col("expected") == F.col("actual"))


def liveness(products: DataFrame, trades: DataFrame, watermarks: DataFrame, as_of=None, baseline_days: int = 7) -> DataFrame:
    """Signs that a listed product has silently stopped.

    No rows for 24 hours; hourly rate of those hours less than half of that of the days before; watermark
    unchanged for more than 4 hours. A single run without trades is no sign.
    """
    now = as_of_column(as_of)
    day_ago = now - F.expr("interval 1 day")
    start = day_ago - F.expr(f"interval {int(baseline_days)} days")
    recent = F.col("trade_ts") >= day_ago
    seen = (
        between(trades, start, now)
        .groupBy(*PRODUCT)
        .agg(F.count_if(recent).alias("recent"), F.count_if(~recent).alias("before"))
    )
    rate, usual = F.col("recent_rows") / 24.0, F.col("baseline_rows") / (24.0 * baseline_days)
    return (
        products.select(*PRODUCT)
        .join(seen, [*PRODUCT], "left")
        .join(watermarks.select(*PRODUCT, "updated_at"), [*PRODUCT], "left")
        .withColumn("recent_rows", F.coalesce("recent", F.lit(0)))
        .withColumn("baseline_rows", F.coalesce("before", F.lit(0)))
        .select(
            *PRODUCT,
            "recent_rows",
            F.round(rate, 4).alias("recent_per_hour"),
            F.round(usual, 4).alias("baseline_per_hour"),
            (F.col("recent_rows") == 0).alias("no_rows_24h"),
            (rate < usual * 0.5).alias("rate_halved"),
            F.coalesce(_hours_between(F.col("updated_at"), now) > 4, F.lit(True)).alias("watermark_stuck"),
        )
        .orderBy(*PRODUCT)
    )
