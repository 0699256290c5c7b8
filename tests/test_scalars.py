from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradelake.functions import scalars


def evaluate(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


def test_parse_ts(spark):
    values = [
        "2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00.123456", "1704067200",
        "1704067200.5", "yesterday", "T12:00", "2024-01-01", "1e300", None, "-1",
    ]
    micros = evaluate(spark, values, lambda c: F.unix_micros(scalars.parse_ts(c)))
    base = 1704067200_000000
    assert micros == [base, base, base + 123456, base, base + 500000, None, None, None, None, None, -1_000000]


def test_parse_double(spark):
    values = ["1.5", " 2 ", "1e3", ".5", "5.", "12f", "1_0", "nan", "inf", "", "abc", "0x10", "-3", None]
    assert evaluate(spark, values, scalars.parse_double) == [
        1.5, 2.0, 1000.0, 0.5, 5.0, None, None, None, None, None, None, None, -3.0, None,
    ]
    loose = evaluate(spark, ["1_0", "inf", "-Infinity", "12f"], lambda c: scalars.parse_double(c, loose=True))
    assert loose == [10.0, float("inf"), float("-inf"), None]


def test_numeric_id_is_the_exact_text(spark):
    values = ["7", "007", "-5", " 7", "1.0", "A-1", "9223372036854775807", "9223372036854775808", None]
    assert evaluate(spark, values, scalars.numeric_id) == [
        7, None, -5, None, None, None, 9223372036854775807, None, None,
    ]


def test_tiers_at_their_boundaries(spark):
    minutes = [0, 59, 60, 179, 180, 1439, 1440]
    tiers = evaluate(spark, minutes, scalars.freshness_tier, "bigint")
    assert tiers == ["FRESH", "FRESH", "STALE", "STALE", "OLD", "OLD", "VERY_OLD"]
    z = evaluate(spark, [3.0, 3.1, 4.0, 4.1, 5.0, 5.1], scalars.gap_severity, "double")
    assert z == ["NORMAL", "WARNING", "WARNING", "SEVERE", "SEVERE", "EXTREME"]
    rates = evaluate(spark, [0.0, 0.099, 0.1, 0.299, 0.3], scalars.error_tier, "double")
    assert rates == ["healthy", "healthy", "degraded", "degraded", "unhealthy"]
    assert evaluate(spark, [80.0, 79.9, 50.0, 49.9], scalars.score_tier, "double") == ["GREEN", "YELLOW", "YELLOW", "RED"]
    assert evaluate(spark, [9, 10, 99, 100], lambda c: scalars.gauge_tier(c, 10, 100), "int") == [
        "GREEN", "YELLOW", "YELLOW", "RED",
    ]


@pytest.mark.parametrize(
    "minutes, pct, label",
    [
        (60, 99.0, "HEALTHY"), (61, 100.0, "ATTENTION"), (0, 98.99, "ATTENTION"), (180, 95.0, "ATTENTION"),
        (181, 100.0, "WARNING"), (0, 94.99, "WARNING"), (1440, 90.0, "WARNING"), (1441, 100.0, "CRITICAL"),
        (0, 89.99, "CRITICAL"), (0, None, "HEALTHY"),
    ],
)
def test_health_label(spark, minutes, pct, label):
    row = spark.createDataFrame([(minutes, pct)], "m bigint, p double")
    assert row.select(scalars.health_label(F.col("m"), F.col("p"))).first()[0] == label


def test_whole_units(spark):
    row = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1))], "a timestamp, b timestamp"
    )
    assert row.select(scalars.whole_units("MINUTE", F.col("a"), F.col("b"))).first()[0] == 0
    assert row.select(scalars.whole_units("SECOND", F.col("a"), F.col("b"))).first()[0] == 2


def test_small_helpers(spark):
    assert evaluate(spark, ["BTC-USD", "ABT-USD"], scalars.bucket_product) == ["BTC-USD", "other"]
    assert [len(x) for x in evaluate(spark, ["x" * 600, "y"], scalars.shorten_error)] == [500, 1]
    assert evaluate(spark, [0.0, 4.0], lambda c: scalars.ratio(F.lit(2), c), "double") == [None, 0.5]
    one = spark.range(1)
    assert one.select(scalars.first_text(F.lit(""), F.lit(None), F.lit("b"))).first()[0] == "b"
    assert one.select(F.unix_seconds(scalars.as_of_column("2024-01-01 00:00:00"))).first()[0] == 1704067200
    assert one.select(F.unix_seconds(scalars.as_of_column(datetime(2024, 1, 1)))).first()[0] == 1704067200
