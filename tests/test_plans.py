"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tradelake.operators import calls, dedupe, gaps
from tradelake.plans import quality, reports

NOW = "2024-01-31 00:00:00"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trades")
    spark.range(3000).select(
        F.lit("coinbase").alias("exchange"),
        F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("symbol"),
        F.col("id").cast("string").alias("trade_id"),
        F.lit("buy").alias("side"),
        F.lit(1.5).alias("price"),
        F.lit(2.0).alias("quantity"),
        F.timestamp_seconds(F.lit(1706000000) + F.col("id") * 60).alias("trade_ts"),
        F.timestamp_seconds(F.lit(1706000001) + F.col("id") * 60).alias("ingest_ts"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SINGLE_SCAN = {
    "overview_by_symbol": reports.overview_by_symbol,
    "completeness": reports.completeness,
    "id_gap_summary": reports.id_gap_summary,
    "id_gap_totals": reports.id_gap_totals,
    "time_gap_summary": reports.time_gap_summary,
    "duplicates_by_symbol": reports.duplicates_by_symbol,
    "symbol_health": lambda t: reports.symbol_health(t, NOW),
    "daily_summary": lambda t: reports.daily_summary(t, NOW),
    "hourly_bars": lambda t: reports.hourly_bars(t, NOW),
    "ingest_latency": lambda t: reports.ingest_latency(t, NOW),
    "batch_validation": quality.batch_validation,
    "health_score": lambda t: quality.health_score(t, NOW),
    "longest_gaps": gaps.longest_gaps,
    "dedupe": dedupe.dedupe_newest,
}


@pytest.mark.parametrize("name", sorted(SINGLE_SCAN))
def test_one_scan_and_no_costly_nodes(table, name):
    text = plan(SINGLE_SCAN[name](table))
    assert text.count("FileScan") == 1
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Python"):
        assert node not in text


@pytest.mark.parametrize("name", sorted(SINGLE_SCAN))
def test_no_window_over_raw_rows_of_a_product(table, name):
    """Every window sorts rows that were aggregated before, or is cut to its first rows before the shuffle."""
    text = plan(SINGLE_SCAN[name](table))
    for line_number, line in enumerate(text.splitlines()):
        if re.search(r"\bWindow \[", line):
            below = "\n".join(text.splitlines()[line_number:])
            assert "HashAggregate" in below or "WindowGroupLimit" in below


def test_filters_and_columns_reach_the_scan(table):
    text = plan(reports.hourly_bars(table, NOW))
    assert "GreaterThanOrEqual(trade_ts" in text
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "ingest_ts" not in schema and "side" not in schema and "trade_id" not in schema
    text = plan(reports.latest_trades(table, "S1"))
    assert "EqualTo(symbol,S1)" in text and "TakeOrderedAndProject" in text


def test_latest_rows_are_cut_before_every_shuffle(table):
    log = table.select(
        F.col("symbol").alias("source"), F.col("trade_id").cast("long").alias("id"), F.col("trade_ts").alias("ts"),
        F.lit(True).alias("ok"), F.col("price").alias("latency_ms"),
    )
    assert plan(calls.source_health(log)).count("WindowGroupLimit") == 4


def test_product_totals_shuffle_no_ids(table):
    text = plan(reports.dq_freshness(table, NOW))
    assert "trade_id" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_reports_of_the_last_days_read_only_their_dates(spark, table, tmp_path):
    from tradelake.plans import reports
    from tradelake.sources import curated

    curated.write_trades(table, str(tmp_path))
    dated = curated.read_trades(spark, str(tmp_path))
    for report in (reports.hourly_bars, reports.low_activity_periods, reports.daily_summary, reports.ingest_latency, reports.records_since_yesterday):
        text = report(dated, as_of="2024-01-31 00:00:00")._jdf.queryExecution().executedPlan().toString()
        filters = [part.split("]")[0] for part in text.split("PartitionFilters: [")[1:]]
        assert filters and all("trade_date" in f for f in filters), text
