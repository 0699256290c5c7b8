"""Call-log operators against plain loops, with one source holding most calls."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tradelake.operators import calls, position

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        source = "hot" if rng.random() < 0.7 else f"s{rng.randrange(5)}"
        # Few distinct times, so that ties are common.
        ts = BASE + timedelta(seconds=rng.randrange(300))
        rows.append((source, i, ts, rng.random() > 0.4, rng.choice([0.0, rng.uniform(1, 500)])))
    return spark.createDataFrame(rows, "source string, id long, ts timestamp, ok boolean, latency_ms double"), rows


def by_source(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        groups[row[0]].append(row)
    return groups


def test_position(log):
    df, rows = log
    expected = {r[1]: n for group in by_source(rows).values() for n, r in enumerate(group, 1)}
    got = {r.id: r.position for r in position.with_position(df, ["source"], ["ts", "id"]).collect()}
    assert got == expected


def test_position_with_a_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, o int")
    got = sorted((str(r.k), r.o, r.position) for r in position.with_position(df, ["k"], ["o"]).collect())
    assert got == [("None", 1, 1), ("None", 2, 2), ("a", 1, 1)]


@pytest.mark.parametrize(("chunk", "size"), [(150, 100), (50_000, 100), (40, 130)])
def test_rolling_error_rate(log, chunk, size):
    df, rows = log
    expected = {}
    for group in by_source(rows).values():
        for n, row in enumerate(group):
            window = group[max(0, n - size + 1): n + 1]
            expected[row[1]] = sum(not r[3] for r in window) / len(window)
    got = {r.id: r.error_rate for r in calls.rolling_error_rate(df, size, chunk).collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in got)


def test_source_health_is_the_last_rolling_rate(log):
    df, rows = log
    for r in calls.source_health(df).collect():
        last = by_source(rows)[r.source][-100:]
        assert r.recent_calls == len(last)
        assert abs(r.error_rate - sum(not x[3] for x in last) / len(last)) < 1e-12


def test_failure_runs(log):
    df, rows = log
    expected = []
    for source, group in by_source(rows).items():
        run = []
        for row in [*group, (source, -1, None, True, 0.0)]:
            if row[3]:
                if len(run) >= 3:
                    expected.append((source, run[0][2], run[-1][2], len(run)))
                run = []
            else:
                run.append(row)
    got = [(r.source, r.run_start, r.run_end, r.failures) for r in calls.failure_runs(df, 3).collect()]
    assert sorted(got) == sorted(expected)


def ema(values):
    average = 0.0
    for v in values:
        average = v if average == 0 else 0.8 * average + 0.2 * v
    return average


def test_latency_ema(log):
    df, rows = log
    for r in calls.latency_ema(df).collect():
        values = [x[4] for x in by_source(rows)[r.source] if x[3]]
        assert abs(r.avg_response_ms - ema(values)) < 1e-9


def test_latency_ema_seeds_and_long_histories(spark):
    rows = [("z", i, BASE, True, 0.0) for i in range(3)]
    rows += [("a", 0, BASE, True, 0.0), ("a", 1, BASE, True, 100.0), ("a", 2, BASE, True, 200.0)]
    rows += [("long", i, BASE, True, float(i % 7 + 1)) for i in range(3000)]
    apart = [100.0, *[0.0] * 1000, 50.0]
    rows += [("apart", i, BASE, True, x) for i, x in enumerate(apart)]
    df = spark.createDataFrame(rows, "source string, id long, ts timestamp, ok boolean, latency_ms double")
    got = {r.source: r.avg_response_ms for r in calls.latency_ema(df).collect()}
    assert abs(got["apart"] - ema(apart)) < 1e-9 and abs(got["apart"] - 10.0) < 1e-9
    assert got["z"] == 0.0 and abs(got["a"] - 120.0) < 1e-9
    assert abs(got["long"] - ema([float(i % 7 + 1) for i in range(3000)])) < 1e-9


def averages(values, alpha):
    average, out = 0.0, []
    for v in values:
        average = v if average == 0 else (1 - alpha) * average + alpha * v
        out.append(average)
    return out


CALL_LOG = "source string, id long, ts timestamp, ok boolean, latency_ms double"


@pytest.mark.parametrize(("alpha", "block"), [(0.2, 50_000), (0.2, 7), (0.5, 3), (0.01, 50), (0.97, 50_000), (1.0, 10)])
def test_latency_ema_of_each_call(log, alpha, block):
    df, rows = log
    got = {r.id: r.avg_response_ms for r in calls.latency_ema_each(df, alpha, block).collect()}
    expected = {}
    for group in by_source(rows).values():
        done = [r for r in group if r[3]]
        expected |= dict(zip([r[1] for r in done], averages([r[4] for r in done], alpha), strict=True))
    assert got.keys() == expected.keys()
    assert all(got[i] == pytest.approx(expected[i], rel=1e-11, abs=1e-300) for i in got)


def test_latency_ema_is_seeded_anew_at_zero(spark):
    assert averages([1.0, *[0.0] * 10_000], 0.2)[-1] > 0, "at 0.2 a double never falls to zero"
    values = [0.0, 64.0, *[0.0] * 900, 8.0, *[0.0] * 1500, 24.0, 0.0, 40.0]
    for alpha in (0.2, 0.5, 0.8):
        df = spark.createDataFrame([("s", i, BASE, True, v) for i, v in enumerate(values)], CALL_LOG)
        expected = averages(values, alpha)
        got = [r.avg_response_ms for r in calls.latency_ema_each(df, alpha, 100).orderBy("id").collect()]
        assert got == pytest.approx(expected, rel=1e-11, abs=1e-300)
        assert calls.latency_ema(df, alpha).first().avg_response_ms == pytest.approx(expected[-1], rel=1e-11)
    assert averages(values, 0.5)[-3] == 24.0 and averages(values, 0.2)[-3] < 5


def test_latency_ema_of_odd_rows(spark):
    rows = [(None, 0, BASE, True, 5.0), (None, 1, BASE, True, 10.0), ("a", 2, BASE, None, 1.0), ("a", 3, BASE, True, None)]
    rows += [("a", 4, BASE, True, float("nan")), ("a", 5, BASE, False, 9.0), ("a", 6, BASE, True, 2.0)]
    df = spark.createDataFrame(rows, CALL_LOG)
    got = {r.id: r.avg_response_ms for r in calls.latency_ema_each(df, 0.2, 1).collect()}
    assert got == pytest.approx({0: 5.0, 1: 6.0, 6: 2.0})
    assert calls.latency_ema_each(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        calls.latency_ema_each(df, 0.0)


def test_summaries_add_up_within_their_error(spark):
    rng = random.Random(5)
    points = [(BASE + timedelta(seconds=rng.randrange(7200)), "m", f"s{i % 3}", rng.choice([0.0, rng.lognormvariate(0, 4), -rng.lognormvariate(3, 2)])) for i in range(3000)]
    points += [(BASE, "m", "s0", None), (BASE, "m", "s0", float("nan"))]
    df = spark.createDataFrame(points, "ts timestamp, metric string, source string, value double")
    for error in (0.01, 0.1):
        minutes = calls.metric_summary(df, error=error)
        halves = minutes.where("source = 's0'").union(minutes.where("source <> 's0'"))
        hours = calls.widen_summary(calls.widen_summary(halves, "5 minutes"), "1 hour", ("metric",))
        direct = calls.metric_summary(df, "1 hour", ("metric",), error)
        assert sorted(hours.drop("sum_value").collect()) == sorted(direct.drop("sum_value").collect())
        for r in calls.summary_rollup(hours, ("metric",), error).collect():
            values = sorted(p[3] for p in points[:3000] if r.period_start <= p[0] < r.period_start + timedelta(hours=1))
            assert r.points == len(values) and r.max_value == values[-1] and r.sum_value == pytest.approx(sum(values))
            assert r.p50_value == pytest.approx(values[-(-len(values) // 2) - 1], rel=error * 1.0001)
            assert r.p99_value == pytest.approx(values[-(-len(values) * 99 // 100) - 1], rel=error * 1.0001)
    with pytest.raises(ValueError):
        calls.metric_summary(df, error=1)


def test_alarm_needs_more_than_the_threshold(spark):
    points = [(BASE + timedelta(minutes=m), "IngestFailure", "x", 1.0) for m in (0, 10, 60, 61, 62)]
    df = spark.createDataFrame(points, "ts timestamp, metric string, source string, value double")
    alarms = calls.metric_alarms(df).collect()
    assert [(a.period_start, a.sum_value) for a in alarms] == [(BASE + timedelta(hours=1), 3.0)]
