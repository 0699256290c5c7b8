"""Report queries over curated trades.

Every report is `fn(trades, as_of=None, ...) -> DataFrame`. Reports run when the caller acts; only those
that read an intermediate result several times write that result to the shared folder first. A product is an (exchange, symbol) pair. Sums and means of doubles are rounded (to four and eight digits), because their
last bits depend on the order of addition. Sorted reports end with the product as tie-breaker, so a limit
always keeps the same rows. Sorting puts nulls last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions.scalars import (
    FRESH_MINUTES,
    OLD_MINUTES,
    STALE_MINUTES,
    as_of_column,
    freshness_tier,
    gap_severity,
    health_label,
    health_priority,
    notional,
    numeric_id,
    percent,
    quantile_of_counts,
    ratio,
    whole_units,
)
from tradelake.operators.gaps import (
    gap_lengths,
    id_gap_sums,
    length_quantile,
    longest_id_gaps,
    rolled_seconds,
    scored_lengths,
    time_gaps_of_seconds,
    written_seconds,
    written_words,
)
from tradelake.operators.profile import (
    between,
    distinct_in_row,
    product_profile,
    product_totals,
)
from tradelake.schema import PRODUCT, TRADE_KEY
from tradelake.session import materialize

SUM_DIGITS, MEAN_DIGITS = 4, 8


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _desc(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def _sum(value: Column) -> Column:
    return F.round(value, SUM_DIGITS)


def _mean(value: Column) -> Column:
    return F.round(value, MEAN_DIGITS)


def _minutes(as_of: Column, since: str = "last_ts") -> Column:
    return whole_units("MINUTE", F.col(since), as_of)


def _count_if(condition: Column) -> Column:
    """Number of rows that meet the condition; 0, not null, for no rows."""
    return F.coalesce(F.count_if(condition), F.lit(0))


# --- overview -----------------------------------------------------------------------------------------


def overview_by_symbol(trades: DataFrame) -> DataFrame:
    return (
        product_profile(trades)
        .select(
            *PRODUCT,
            F.col("trades").alias("total_trades"),
            F.col("distinct_ids").alias("unique_trade_ids"),
            F.col("first_ts").alias("earliest_trade"),
            F.col("last_ts").alias("latest_trade"),
            whole_units("DAY", F.col("first_ts"), F.col("last_ts")).alias("days_of_data"),
            _sum(F.col("volume")).alias("total_volume_usd"),
            _mean(F.col("avg_price")).alias("avg_price"),
            "min_price",
            "max_price",
        )
        .orderBy(*_desc("total_trades"), *_asc(*PRODUCT))
    )


def overview_totals(trades: DataFrame) -> DataFrame:
    """Totals of the whole table. An id used by several products counts once."""
    words = written_words(trades, "first_ts", "last_ts", "volume")
    products = (
        words.groupBy(*PRODUCT)
        .agg(
            F.sum("trades").alias("trades"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("volume").alias("volume"),
        )
        .agg(
            F.coalesce(F.sum("trades"), F.lit(0)).alias("total_records"),
            F.count(F.lit(1)).alias("unique_products"),
            F.min("first_ts").alias("earliest_data"),
            F.max("last_ts").alias("latest_data"),
            F.sum("volume").alias("volume"),
        )
    )
    ids = (
        words.groupBy("id_word", "id_text")
        .agg(F.bit_or("id_bits").alias("id_bits"))
        .agg(F.coalesce(F.sum(distinct_in_row()), F.lit(0)).cast("bigint").alias("unique_trade_ids"))
    )
    # Two one-row results side by side: stack them, then fold the stack into one row.
    both = products.unionByName(ids, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "total_records",
        "unique_products",
        "unique_trade_ids",
        "earliest_data",
        "latest_data",
        whole_units("DAY", F.col("earliest_data"), F.col("latest_data")).alias("total_days_span"),
        _sum(F.col("volume")).alias("total_volume_usd"),
    )


def top_symbols_by_volume(trades: DataFrame, as_of=None, n: int = 10) -> DataFrame:
    return (
        product_totals(trades)
        .select(
            *PRODUCT,
            F.col("trades").alias("trade_count"),
            F.round("volume", 2).alias("volume_usd"),
            F.round("avg_price", 4).alias("avg_price"),
            F.col("first_ts").alias("first_trade"),
            F.col("last_ts").alias("last_trade"),
            _minutes(as_of_column(as_of)).alias("minutes_stale"),
        )
        .orderBy(*_desc("volume_usd"), *_asc(*PRODUCT))
        .limit(n)
    )


def latest_trades(trades: DataFrame, symbol: str, n: int = 100, exchange: str | None = None) -> DataFrame:
    """The newest trades of one product; only its rows reach the top-n."""
    wanted = F.col("symbol") == symbol
    if exchange is not None:
        wanted = wanted & (F.col("exchange") == exchange)
    return (
        trades.where(wanted)
        .select(
            *TRADE_KEY, "price", "quantity", "side", "trade_ts", _sum(notional()).alias("volume_usd")
        )
        .orderBy(*_desc("trade_ts"), numeric_id(F.col("trade_id")).desc_nulls_last(), *_desc("trade_id"))
        .limit(n)
    )


# --- freshness ----------------------------------------------------------------------------------------


def freshness_by_symbol(trades: DataFrame, as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    return (
        product_totals(trades)
        .select(
            *PRODUCT,
            F.col("last_ts").alias("latest_trade_time"),
            F.col("max_id").alias("latest_trade_id"),
            _minutes(now).alias("minutes_since_last_trade"),
            whole_units("HOUR", F.col("last_ts"), now).alias("hours_since_last_trade"),
            freshness_tier(_minutes(now)).alias("freshness_status"),
            F.col("trades").alias("total_trades"),
        )
        .orderBy(*_asc("minutes_since_last_trade", *PRODUCT))
    )


def _staleness(trades: DataFrame, as_of) -> DataFrame:
    return product_totals(trades).select(*PRODUCT, _minutes(as_of_column(as_of)).alias("minutes"))


def freshness_totals(trades: DataFrame, as_of=None) -> DataFrame:
    """Staleness over all products, in three tiers."""
    m = F.col("minutes")
    return _staleness(trades, as_of).agg(
        F.count(F.lit(1)).alias("total_products"),
        _mean(F.avg(m)).alias("avg_minutes_stale"),
        F.min(m).alias("min_minutes_stale"),
        F.max(m).alias("max_minutes_stale"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY minutes)").alias("median_minutes_stale"),
        _count_if(m < FRESH_MINUTES).alias("fresh_products"),
        _count_if((m >= FRESH_MINUTES) & (m < STALE_MINUTES)).alias("stale_products"),
        _count_if(m >= STALE_MINUTES).alias("old_products"),
    )


def freshness_histogram(trades: DataFrame, as_of=None) -> DataFrame:
    """Staleness over all products, in four tiers."""
    m = F.col("minutes")
    return _staleness(trades, as_of).agg(
        F.count(F.lit(1)).alias("total_products"),
        _count_if(m < FRESH_MINUTES).alias("fresh_lt_1h"),
        _count_if((m >= FRESH_MINUTES) & (m < STALE_MINUTES)).alias("stale_1h_3h"),
        _count_if((m >= STALE_MINUTES) & (m < OLD_MINUTES)).alias("old_3h_24h"),
        _count_if(m >= OLD_MINUTES).alias("very_old_gt_24h"),
        F.round(F.avg(m), 2).alias("avg_minutes_stale"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY minutes)").alias("median_minutes_stale"),
    )


def stale_symbols(trades: DataFrame, as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    return (
        product_totals(trades)
        .where(_minutes(now) > STALE_MINUTES)
        .select(
            *PRODUCT,
            F.col("last_ts").alias("latest_trade_time"),
            whole_units("HOUR", F.col("last_ts"), now).alias("hours_stale"),
            F.col("trades").alias("total_trades"),
            F.col("max_id").alias("latest_trade_id"),
        )
        .orderBy(*_desc("hours_stale"), *_asc(*PRODUCT))
    )


# --- gaps in time -------------------------------------------------------------------------------------


def time_gap_anomalies(trades: DataFrame, z_min: float = 3, n: int = 100) -> DataFrame:
    """Gaps far longer than usual for their product, most unusual first.

    Within a product the z-score grows with the gap, so the first n overall are among the n longest of each
    product. Only those are joined to the statistics.
    """
    seconds = written_seconds(trades)
    gaps = time_gaps_of_seconds(seconds)
    longest = Window.partitionBy(*PRODUCT).orderBy(*_desc("gap_seconds"), *_asc("gap_end"))
    candidates = gaps.withColumn("rank", F.row_number().over(longest)).where(F.col("rank") <= n)
    stats = (
        scored_lengths(gap_lengths(seconds))
        .groupBy(*PRODUCT)
        .agg(F.first("avg_gap").alias("avg_gap"), F.first("std_gap").alias("std_gap"))
    )
    z = ratio(F.col("gap_seconds") - F.col("avg_gap"), F.col("std_gap"))
    return (
        candidates.join(stats, [*PRODUCT])
        .withColumn("z", z)
        .where(F.col("z") > z_min)
        .orderBy(*_desc("z"), *_asc(*PRODUCT, "gap_end"))
        .limit(n)
        .select(
            *PRODUCT,
            "gap_start",
            "gap_end",
            F.round(F.col("gap_seconds") / 60.0, 2).alias("gap_minutes"),
            F.round(F.col("gap_seconds") / 3600.0, 2).alias("gap_hours"),
            F.round(F.col("avg_gap") / 60.0, 2).alias("avg_gap_minutes"),
            F.round("z", 2).alias("z_score"),
            gap_severity(F.col("z")).alias("gap_severity"),
        )
    )


def time_gap_summary(trades: DataFrame) -> DataFrame:
    """Gap statistics per product with the number of anomalous (3 sigma) and extreme (5 sigma) gaps."""

    def outliers(sigma: int) -> Column:
        return F.sum(F.when(F.col("z") > sigma, F.col("n")).otherwise(0))

    return (
        scored_lengths(gap_lengths(rolled_seconds(trades)))
        .groupBy(*PRODUCT)
        .agg(
            F.first("intervals").alias("total_intervals"),
            F.first("avg_gap").alias("avg_gap"),
            length_quantile(0.5).alias("median_gap"),
            length_quantile(0.95).alias("p95_gap"),
            length_quantile(0.99).alias("p99_gap"),
            F.first("max_gap").alias("max_gap"),
            outliers(3).alias("anomalous_gap_count"),
            outliers(5).alias("extreme_gap_count"),
        )
        .orderBy(*_desc("max_gap"), *_asc(*PRODUCT))
        .select(
            *PRODUCT,
            "total_intervals",
            F.round(F.col("avg_gap") / 60.0, 2).alias("avg_gap_minutes"),
            F.round(F.col("median_gap") / 60.0, 2).alias("median_gap_minutes"),
            F.round(F.col("p95_gap") / 60.0, 2).alias("p95_gap_minutes"),
            F.round(F.col("p99_gap") / 60.0, 2).alias("p99_gap_minutes"),
            F.round(F.col("max_gap") / 3600.0, 2).alias("max_gap_hours"),
            "anomalous_gap_count",
            "extreme_gap_count",
        )
    )


def low_activity_periods(
    trades: DataFrame, as_of=None, days: int = 30, grain: str = "hour", z_max: float = -2, n: int = 50
) -> DataFrame:
    """Periods with unusually few trades for their product."""
    since = as_of_column(as_of) - F.expr(f"interval {int(days)} days")
    periods = (
        between(trades, since)
        .groupBy(*PRODUCT, F.date_trunc(grain, "trade_ts").alias("period"))
        .agg(F.count(F.lit(1)).alias("trade_count"))
    )
    # A product has at most one row per period of the looked-at days here.
    product = Window.partitionBy(*PRODUCT)
    mean, deviation = F.avg("trade_count").over(product), F.stddev_samp("trade_count").over(product)
    return (
        periods.select("*", mean.alias("mean"), deviation.alias("deviation"))
        .withColumn("z", ratio(F.col("trade_count") - F.col("mean"), F.col("deviation")))
        .where(F.col("z") < z_max)
        .orderBy(*_asc("z", *PRODUCT, "period"))
        .limit(n)
        .select(
            *PRODUCT,
            "period",
            "trade_count",
            F.round("mean", 2).alias("avg_trades"),
            F.round("z", 2).alias("z_score"),
        )
    )


# --- duplicates ---------------------------------------------------------------------------------------


def duplicate_keys(trades: DataFrame, n: int = 100) -> DataFrame:
    """The n most repeated trade keys.

    One shuffle finds the keys; their distinct times are then counted by a second scan against at most n
    broadcast rows, which spares shuffling every (key, time) pair.
    """
    repeated = materialize(
        trades.groupBy(*TRADE_KEY)
        .agg(
            F.count(F.lit(1)).alias("occurrence_count"),
            F.min("trade_ts").alias("first_occurrence"),
            F.max("trade_ts").alias("last_occurrence"),
        )
        .where(F.col("occurrence_count") > 1)
        .orderBy(*_desc("occurrence_count"), *_asc(*TRADE_KEY))
        .limit(n),
        "repeated",
    )
    top = repeated.select([F.col(c).alias(f"top_{c}") for c in TRADE_KEY])
    same_key = [F.col(c).eqNullSafe(F.col(f"top_{c}")) for c in TRADE_KEY]
    times = (
        trades.select(*TRADE_KEY, "trade_ts")
        .join(F.broadcast(top), same_key, "left_semi")
        .groupBy(*[F.col(c).alias(f"top_{c}") for c in TRADE_KEY])
        .agg(F.count_distinct("trade_ts").alias("unique_timestamps"))
    )
    return (
        repeated.join(F.broadcast(times), same_key)
        .select(*TRADE_KEY, "occurrence_count", "first_occurrence", "last_occurrence", "unique_timestamps")
        .orderBy(*_desc("occurrence_count"), *_asc(*TRADE_KEY))
    )


def duplicates_by_symbol(trades: DataFrame) -> DataFrame:
    duplicates = F.col("trades") - F.col("distinct_ids")
    return (
        product_profile(trades)
        .where(duplicates > 0)
        .select(
            *PRODUCT,
            F.col("trades").alias("total_records"),
            F.col("distinct_ids").alias("unique_trade_ids"),
            duplicates.alias("duplicate_count"),
            percent(duplicates, F.col("trades"), 4).alias("duplicate_percentage"),
        )
        .orderBy(*_desc("duplicate_count"), *_asc(*PRODUCT))
    )


def duplicate_totals(trades: DataFrame) -> DataFrame:
    totals = product_profile(trades).agg(
        F.coalesce(F.sum("trades"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("distinct_ids"), F.lit(0)).alias("unique_records"),
    )
    duplicates = F.col("total_records") - F.col("unique_records")
    return totals.select(
        "*",
        duplicates.alias("total_duplicates"),
        percent(duplicates, F.col("total_records"), 4).alias("duplicate_pct"),
    )


# --- gaps in trade ids --------------------------------------------------------------------------------


def id_gap_list(trades: DataFrame, n: int = 100) -> DataFrame:
    """The n longest runs of missing ids, with the newest time of the last id seen before each."""
    top = longest_id_gaps(trades, n)
    numbered = trades.withColumn("last_seen_id", numeric_id(F.col("trade_id")))
    # At most n rows are broadcast; the trades are read once more but not shuffled.
    return (
        numbered.join(F.broadcast(top), [*PRODUCT, "last_seen_id"])
        .groupBy(*PRODUCT, "last_seen_id", "next_seen_id", F.col("missing").alias("missing_trade_count"))
        .agg(F.max("trade_ts").alias("last_seen_time"))
        .orderBy(*_desc("missing_trade_count"), *_asc(*PRODUCT, "last_seen_id"))
    )


def id_gap_summary(trades: DataFrame) -> DataFrame:
    """Missing ids per product; only products that miss some."""
    return (
        id_gap_sums(trades)
        .where(F.col("missing") > 0)
        .select(
            *PRODUCT,
            F.col("trades").alias("total_trades"),
            F.col("missing").alias("total_missing_trades"),
            F.col("occurrences").alias("gap_occurrences"),
            F.col("largest").alias("largest_gap"),
            percent(F.col("missing"), F.try_subtract("max_id", "min_id"), 4).alias("estimated_missing_pct"),
        )
        .orderBy(*_desc("total_missing_trades"), *_asc(*PRODUCT))
    )


def id_gap_totals(trades: DataFrame) -> DataFrame:
    """Missing ids over all products. Without a gap the largest is 0, or -1 if ids only repeat."""
    # The lead of an id that has a successor is at least 0; that of a repeated row is -1.
    largest = F.when(F.col("ids") > 1, F.col("largest")).when(F.col("trades") > F.col("ids"), -1)
    return id_gap_sums(trades).agg(
        F.count(F.lit(1)).alias("products_analyzed"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("total_missing_trades"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("gap_occurrences"),
        F.max(largest).alias("largest_single_gap"),
        F.coalesce(F.sum("over_10"), F.lit(0)).alias("gaps_over_10"),
        F.coalesce(F.sum("over_100"), F.lit(0)).alias("gaps_over_100"),
    )


def completeness(trades: DataFrame) -> DataFrame:
    """Expected, actual and missing ids per product. Rows whose id is no number are counted apart."""
    return (
        product_profile(trades)
        .select(
            *PRODUCT,
            F.col("min_id").alias("min_trade_id"),
            F.col("max_id").alias("max_trade_id"),
            F.col("expected_ids").alias("expected_trades"),
            F.col("numeric_ids").alias("actual_trades"),
            (F.col("expected_ids") - F.col("numeric_ids")).alias("missing_trades"),
            _completeness_pct().alias("completeness_pct"),
            "unparsed_id_rows",
        )
        .orderBy(*_asc("completeness_pct", *PRODUCT))
    )


def _completeness_pct() -> Column:
    return percent(F.col("numeric_ids"), F.col("expected_ids"), 2)


def completeness_totals(trades: DataFrame) -> DataFrame:
    pct = F.col("pct")
    return (
        product_profile(trades)
        .select(_completeness_pct().alias("pct"))
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.round(F.avg(pct), 2).alias("avg_completeness_pct"),
            F.min(pct).alias("min_completeness_pct"),
            _count_if(pct >= 99).alias("products_99_plus_pct"),
            _count_if((pct >= 95) & (pct < 99)).alias("products_95_99_pct"),
            _count_if(pct < 95).alias("products_below_95_pct"),
        )
    )


# --- health -------------------------------------------------------------------------------------------


def _health(trades: DataFrame, as_of) -> DataFrame:
    return product_profile(trades).select(
        *PRODUCT,
        "trades",
        F.col("last_ts").alias("last_trade"),
        _minutes(as_of_column(as_of)).alias("minutes_stale"),
        _completeness_pct().alias("completeness_pct"),
    )


def _by_priority() -> list[Column]:
    rank = health_priority(F.col("minutes_stale"), F.col("completeness_pct"))
    return [rank.asc(), *_desc("minutes_stale"), *_asc(*PRODUCT)]


def problem_symbols(trades: DataFrame, as_of=None) -> DataFrame:
    """Products that are stale or incomplete, worst first."""
    minutes, pct = F.col("minutes_stale"), F.col("completeness_pct")
    return (
        _health(trades, as_of)
        .where((minutes > STALE_MINUTES) | (pct < 95))
        .withColumn("health_status", health_label(minutes, pct))
        .orderBy(*_by_priority())
    )


def symbol_health(trades: DataFrame, as_of=None) -> DataFrame:
    """Freshness and completeness of every product, worst first.

    Both come from one roll-up, which saves joining two aggregates of the same table.
    """
    return (
        _health(trades, as_of)
        .select(*PRODUCT, "minutes_stale", "completeness_pct")
        .withColumn("health_status", health_label(F.col("minutes_stale"), F.col("completeness_pct")))
        .orderBy(*_by_priority())
    )


def symbol_health_joined(trades: DataFrame, as_of=None) -> DataFrame:
    """As symbol_health, written as the join of a freshness and a completeness table."""
    fresh = _staleness(trades, as_of).withColumnRenamed("minutes", "minutes_stale")
    complete = product_profile(trades).select(*PRODUCT, _completeness_pct().alias("completeness_pct"))
    return (
        fresh.join(complete, [*PRODUCT])
        .withColumn("health_status", health_label(F.col("minutes_stale"), F.col("completeness_pct")))
        .orderBy(*_by_priority())
    )


# --- activity -----------------------------------------------------------------------------------------


def hourly_bars(trades: DataFrame, as_of=None, days: int = 7, from_midnight: bool = False) -> DataFrame:
    """Count, volume and price range per product and hour of the last days."""
    end = as_of_column(as_of)
    if from_midnight:
        end = F.date_trunc("day", end)
    return (
        between(trades, end - F.expr(f"interval {int(days)} days"))
        .groupBy(*PRODUCT, F.date_trunc("hour", "trade_ts").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            _sum(F.sum(notional())).alias("volume_usd"),
            _mean(F.avg("price")).alias("avg_price"),
            F.min("price").alias("low"),
            F.max("price").alias("high"),
        )
        .orderBy(*_asc(*PRODUCT), *_desc("hour"))
    )


def hourly_volume_one_symbol(trades: DataFrame, symbol: str) -> DataFrame:
    return (
        trades.where(F.col("symbol") == symbol)
        .groupBy(F.date_trunc("hour", "trade_ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("trades"), _sum(F.sum(notional())).alias("volume"))
        .orderBy(*_desc("hour"))
    )


def daily_summary(trades: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Active products, trades and volume per day; counted per product and day first."""
    since = as_of_column(as_of) - F.expr(f"interval {int(days)} days")
    return (
        between(trades, since)
        .groupBy(F.to_date("trade_ts").alias("date"), *PRODUCT)
        .agg(F.count(F.lit(1)).alias("trades"), F.sum(notional()).alias("volume"))
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("active_products"),
            F.sum("trades").alias("total_trades"),
            _sum(F.sum("volume")).alias("total_volume_usd"),
        )
        .withColumn("avg_trades_per_product", F.expr("total_trades div active_products"))
        .orderBy(*_desc("date"))
    )


def ingest_latency(trades: DataFrame, as_of=None, days: int = 7, n: int = 20) -> DataFrame:
    """Seconds between trade and ingestion per product, slowest first.

    Rows are counted per product and lag first; mean and exact quantiles then come from one row per
    distinct lag, where quantile sketches would be shipped from every task for every product.
    """
    since = as_of_column(as_of) - F.expr(f"interval {int(days)} days")
    lag, rows = F.col("lag"), F.col("n")
    product = Window.partitionBy(*PRODUCT)
    running = product.orderBy("lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        between(trades, since)
        .where(F.col("ingest_ts").isNotNull())
        .groupBy(*PRODUCT, whole_units("SECOND", F.col("trade_ts"), F.col("ingest_ts")).alias("lag"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("*", F.sum("n").over(running).alias("seen"), F.sum("n").over(product).alias("total"))
    )
    return (
        counted.groupBy(*PRODUCT)
        .agg(
            _mean(F.sum(rows * lag) / F.sum(rows)).alias("avg_latency_seconds"),
            F.min(lag).alias("min_latency_seconds"),
            F.max(lag).alias("max_latency_seconds"),
            quantile_of_counts(lag, F.col("seen"), F.col("total"), 0.5).alias("median_latency_seconds"),
            quantile_of_counts(lag, F.col("seen"), F.col("total"), 0.95).alias("p95_latency_seconds"),
        )
        .orderBy(*_desc("avg_latency_seconds"), *_asc(*PRODUCT))
        .limit(n)
    )


# --- inputs of the quality job ------------------------------------------------------------------------


def dq_overview(trades: DataFrame) -> DataFrame:
    return (
        product_totals(trades)
        .select(
            *PRODUCT,
            F.col("trades").alias("total_records"),
            _sum(F.col("volume")).alias("total_volume"),
            F.col("first_ts").alias("earliest_trade"),
            F.col("last_ts").alias("latest_trade"),
        )
        .orderBy(*_desc("total_records"), *_asc(*PRODUCT))
    )


def dq_freshness(trades: DataFrame, as_of=None) -> DataFrame:
    return (
        product_totals(trades)
        .select(
            *PRODUCT,
            F.col("last_ts").alias("last_trade_time"),
            _minutes(as_of_column(as_of)).alias("minutes_since_last_trade"),
        )
        .orderBy(*_desc("minutes_since_last_trade"), *_asc(*PRODUCT))
    )


def dq_duplicates(trades: DataFrame) -> DataFrame:
    duplicates = F.col("trades") - F.col("distinct_ids")
    return (
        product_profile(trades)
        .where(duplicates > 0)
        .select(*PRODUCT, duplicates.alias("duplicate_count"))
        .orderBy(*_asc(*PRODUCT))
    )


def records_since_yesterday(trades: DataFrame, as_of=None) -> DataFrame:
    since = F.date_trunc("day", as_of_column(as_of)) - F.expr("interval 1 day")
    return between(trades, since).agg(F.count(F.lit(1)).alias("records_today"))


def dedupe_precheck(trades: DataFrame) -> DataFrame:
    """Rows, distinct keys and rows without a full key, which a de-duplication leaves alone.

    It has nothing to do when the other rows are as many as the keys.
    """
    complete = F.col("exchange").isNotNull() & F.col("symbol").isNotNull()
    no_id = F.when(F.col("trade_id").isNull() | (F.col("trade_id") == ""), 1).otherwise(0)
    empty_id = F.when(F.col("trade_id") == "", 1).otherwise(0)
    profile = product_profile(trades, {"no_id": no_id, "empty_id": empty_id})
    keys = F.when(complete, F.col("distinct_ids") - F.least(F.col("empty_id"), F.lit(1)))
    return (
        profile.agg(
            F.coalesce(F.sum("trades"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(keys), F.lit(0)).alias("unique_count"),
            F.coalesce(F.sum(F.when(complete, F.col("no_id")).otherwise(F.col("trades"))), F.lit(0)).alias("incomplete_keys"),
        )
        .withColumn("skip_dedupe", F.col("total") - F.col("incomplete_keys") == F.col("unique_count"))
    )
