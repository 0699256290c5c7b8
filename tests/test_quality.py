from datetime import datetime, timedelta

import pytest

from tradelake.operators.normalize import normalize, parse_lines
from tradelake.plans import quality
from tradelake.sources import state

NOW = datetime(2024, 1, 2)


def at(**back):
    return (NOW - timedelta(**back)).isoformat(sep=" ")


def checks(df):
    return {r.check: (r.value, r.issue) for r in df.collect()}


def test_batch_checks(trades):
    ids = [1, 2, 3, 3, 4, 5, 5, 6, 7, 8]
    rows = [("A", str(i), at(minutes=n), "buy", 1.0, 1.0) for n, i in enumerate(ids)]
    rows += [("A", "20", at(hours=1), "invalid", -100.0, 1.0), ("A", "21", at(hours=1), None, 0.0, 0.0)]
    got = checks(quality.batch_validation(trades(rows)))
    assert got == {
        "records_checked": (12.0, False),
        "missing_columns": (0.0, False),
        "duplicate_keys": (2.0, True),
        "price_not_positive": (2.0, True),
        "quantity_not_positive": (1.0, True),
        "invalid_side": (2.0, True),
    }
    assert sorted(str(r.side) for r in quality.invalid_sides(trades(rows)).collect()) == ["None", "invalid"]


def test_missing_columns_fail_the_gate(trades):
    batch = trades([("A", "1", at(hours=1))]).drop("side", "price")
    result = quality.batch_validation(batch)
    got = checks(result)
    assert got["missing_columns"] == (2.0, True) and got["invalid_side"] == (0.0, False)
    verdict = quality.quality_gates(result).first()
    assert not verdict.passed and verdict.reasons == ["missing_columns"]


def test_stale_products_of_a_batch(trades, spark):
    updates = spark.createDataFrame(
        [("c", "A", NOW - timedelta(hours=2)), ("c", "B", NOW - timedelta(hours=2, seconds=1))],
        "exchange string, symbol string, last_update_ts timestamp",
    )
    got = checks(quality.batch_validation(trades([("A", "1", at(hours=1))]), updates, NOW))
    assert got["stale_products"] == (1.0, False)


def _duplicated(trades, total, copies):
    rows = [("A", str(i), at(minutes=5)) for i in range(total - copies)] + [("A", "0", at(minutes=5))] * copies
    return trades(rows)


@pytest.mark.parametrize("copies, passed", [(5, True), (6, False)])
def test_five_percent_duplicates_pass(trades, copies, passed):
    verdict = quality.quality_gates(quality.batch_validation(_duplicated(trades, 100, copies))).first()
    assert verdict.passed is passed
    assert verdict.reasons == ([] if passed else ["duplicates"])


def test_empty_batch_passes(trades):
    empty = trades([("A", "1", at(hours=1))]).where("false")
    verdict = quality.quality_gates(quality.batch_validation(empty)).first()
    assert verdict.passed


@pytest.mark.parametrize("seconds, passed", [(0, True), (1, False)])
def test_four_hours_old_passes(trades, seconds, passed):
    df = trades([("A", "1", at(hours=4, seconds=seconds))])
    verdict = quality.quality_gates(quality.batch_validation(df), quality.full_validation(df, NOW)).first()
    assert verdict.passed is passed


def test_full_checks(trades):
    times = [timedelta(hours=5), timedelta(hours=4), timedelta(hours=3), timedelta(minutes=30), timedelta(minutes=20),
             timedelta(minutes=10), timedelta(0)]
    rows = [("A", str(i), (NOW - t).isoformat(sep=" ")) for i, t in enumerate(times)]
    got = checks(quality.full_validation(trades(rows), NOW))
    # Gaps of exactly an hour are not long.
    assert got["max_gap_minutes"] == (150.0, False) and got["products_with_long_gaps"] == (1.0, False)
    assert got["age_hours"] == (0.0, False) and got["stale_products"] == (0.0, False)


def test_issue_thresholds_of_the_full_check(trades):
    gapped = [(s, i, t) for s in "ABCD" for i, t in (("1", at(hours=9)), ("2", at(hours=7)))]
    got = checks(quality.full_validation(trades(gapped), NOW))
    assert got["products_with_long_gaps"] == (4.0, True) and got["stale_products"] == (4.0, False)
    got = checks(quality.full_validation(trades([(s, "1", at(hours=3)) for s in "ABCDEF"]), NOW))
    assert got["stale_products"] == (6.0, True) and got["products_with_long_gaps"] == (0.0, False)


def score(df):
    return quality.health_score(df, NOW).first().health_score


def test_health_score_parts(trades):
    clean = [("A", str(i), at(minutes=5)) for i in range(10)]
    assert score(trades(clean)) == 100.0
    # Three duplicates cost three points, thirty cost twenty.
    assert score(trades(clean + clean[:3])) == 97.0
    assert score(trades(clean + [clean[0]] * 30)) == 80.0
    # 9 of 10 ids: 90% complete, (100 - 90) * 3 points.
    assert score(trades(clean[:5] + clean[6:])) == 70.0
    # Exactly 360 minutes is not stale; one of two stale products costs at most 30.
    assert score(trades(clean + [("B", "1", at(minutes=360))])) == 100.0
    assert score(trades(clean + [("B", "1", at(minutes=361))])) == 70.0
    # 1,000,000 missing: 30 for completeness, 20 for the missing trades.
    assert score(trades(clean + [("A", "1000000", at(minutes=5))])) == 50.0


def test_health_score_without_products(trades):
    empty = trades([("A", "1", at(hours=1))]).where("false")
    assert score(empty) == 100.0
    metrics = {r.metric: r.value for r in quality.quality_metrics(empty, NOW).collect()}
    assert metrics["TotalRecords"] == 0.0 and "AvgDataFreshnessMinutes" not in metrics


def test_footprint_joins_the_metrics(trades, spark):
    size = spark.createDataFrame([(1, 10, 0.125)], "files int, bytes int, size_gb double")
    rows = quality.quality_metrics(trades([("A", "1", at(hours=1))]), NOW, size).collect()
    assert {r.metric: r.value for r in rows}["ParquetSizeGB"] == 0.125


def test_invariants_report_a_watermark_that_goes_back(trades, spark):
    lines = parse_lines(spark.createDataFrame([("x",)], "value string"))
    old = state.batch_watermarks(trades([("A", "9", at(hours=1))]))
    new = state.batch_watermarks(trades([("A", "8", at(hours=1))]))
    rows = quality.run_invariants(lines, normalize(lines), trades([("A", "1", at(hours=1))] * 2), old, new).collect()
    assert {r.invariant: r.holds for r in rows} == {
        "read = transformed + rejected": True,
        "curated rows = distinct keys": False,
        "no watermark goes back": False,
    }


def test_liveness(trades, spark):
    steady = [("A", str(h), at(hours=h)) for h in range(1, 190)]
    fallen = [("B", str(h), at(hours=h)) for h in (2, *range(24, 190))]
    gone = [("C", "1", at(days=3))]
    listed = spark.createDataFrame([("coinbase", s) for s in "ABCD"], "exchange string, symbol string")
    marks = spark.createDataFrame(
        [("coinbase", "A", NOW - timedelta(hours=4)), ("coinbase", "B", NOW - timedelta(hours=5))],
        "exchange string, symbol string, updated_at timestamp",
    )
    rows = {r.symbol: r for r in quality.liveness(listed, trades(steady + fallen + gone), marks, NOW).collect()}
    flags = {s: (r.no_rows_24h, r.rate_halved, r.watermark_stuck) for s, r in rows.items()}
    assert flags == {
        "A": (False, False, False), "B": (False, True, True), "C": (True, True, True), "D": (True, False, True),
    }
