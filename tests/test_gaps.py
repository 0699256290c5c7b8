"""Gap operators against plain loops."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tradelake.operators import gaps, profile
from tradelake.plans import reports

BASE = datetime(2024, 1, 1)


def brute_id_gaps(rows):
    ids = defaultdict(set)
    for symbol, trade_id, *_ in rows:
        ids[symbol].add(int(trade_id))
    found = []
    for symbol, seen in ids.items():
        ordered = sorted(seen)
        found += [(symbol, a, b, b - a - 1) for a, b in zip(ordered, ordered[1:]) if b - a > 1]
    return sorted(found)


def spark_id_gaps(df):
    return sorted((r.symbol, r.last_seen_id, r.next_seen_id, r.missing) for r in gaps.id_gaps(df).collect())


@pytest.mark.parametrize("spread", [40, 5_000, 3_000_000, 2**45, 2**62])
def test_id_gaps_match_a_loop(trades, spread):
    rng = random.Random(spread)
    rows = [(f"S{rng.randrange(3)}", str(rng.randrange(-spread, spread)), "2024-01-01 00:00:00") for _ in range(400)]
    rows += rows[:50]
    assert spark_id_gaps(trades(rows)) == brute_id_gaps(rows)


@pytest.mark.parametrize("spread", [40, 5_000, 3_000_000, 2**45, 2**62])
def test_id_gap_sums_match_a_loop(trades, spread):
    rng = random.Random(spread + 1)
    rows = [(f"S{rng.randrange(3)}", str(rng.randrange(-spread, spread)), "2024-01-01 00:00:00") for _ in range(200)]
    # Runs of every length within a word.
    rows += [("RUNS", str(x), "2024-01-01 00:00:00") for x in [sum(range(i + 1)) for i in range(70)]]
    expected = defaultdict(list)
    for symbol, _, _, missing in brute_id_gaps(rows):
        expected[symbol].append(missing)
    got = {r.symbol: r for r in gaps.id_gap_sums(trades(rows)).collect()}
    for symbol, lengths in expected.items():
        row = got[symbol]
        assert (row.missing, row.occurrences, row.largest) == (sum(lengths), len(lengths), max(lengths))
        assert (row.over_10, row.over_100) == (sum(m > 10 for m in lengths), sum(m > 100 for m in lengths))
        ids = {int(r[1]) for r in rows if r[0] == symbol}
        assert (row.ids, row.min_id, row.max_id) == (len(ids), min(ids), max(ids))


def test_every_pattern_of_a_short_word(trades):
    rows = []
    for bits in range(1, 2**7):
        rows += [(f"P{bits}", str(60 + i), "2024-01-01 00:00:00") for i in range(7) if bits >> i & 1]
    assert spark_id_gaps(trades(rows)) == brute_id_gaps(rows)
    largest = {r.symbol: r.largest for r in gaps.id_gap_sums(trades(rows)).collect()}
    for symbol in largest:
        assert largest[symbol] == max([g[3] for g in brute_id_gaps([r for r in rows if r[0] == symbol])], default=0)


@pytest.mark.parametrize("n", [1, 3, 25, 1000])
def test_longest_id_gaps_are_the_first_of_all_gaps(trades, n):
    rng = random.Random(n)
    rows = [(f"S{rng.randrange(3)}", str(rng.randrange(900)), "2024-01-01 00:00:00") for _ in range(400)]
    got = [(r.symbol, r.last_seen_id, r.next_seen_id, r.missing) for r in gaps.longest_id_gaps(trades(rows), n).collect()]
    assert got == sorted(brute_id_gaps(rows), key=lambda g: (-g[3], g[0], g[1]))[:n]


def test_id_gaps_at_word_and_block_edges(trades):
    ids = [0, 63, 64, 127, 129, 2**26 - 1, 2**26, 2**26 + 65, 2**46 - 1, 2**46, 2**46 + 1]
    rows = [("A", str(i), "2024-01-01 00:00:00") for i in ids]
    assert spark_id_gaps(trades(rows)) == brute_id_gaps(rows)


def test_other_ids_are_left_out_of_id_gaps_and_counted(trades):
    rows = [("A", i, "2024-01-01 00:00:00") for i in ("1", "3", "x-2", "007", "x-2", None)]
    assert spark_id_gaps(trades(rows)) == [("A", 1, 3, 1)]
    row = reports.completeness(trades(rows)).first()
    assert (row.expected_trades, row.actual_trades, row.missing_trades, row.unparsed_id_rows) == (3, 2, 1, 4)
    # count(DISTINCT trade_id) ignores nulls.
    overview = reports.overview_by_symbol(trades(rows)).first()
    assert (overview.total_trades, overview.unique_trade_ids) == (6, 4)


def test_extreme_ids_do_not_fail(trades):
    rows = [("A", str(i), "2024-01-01 00:00:00") for i in (-(2**63), 2**63 - 1)]
    row = reports.completeness(trades(rows)).first()
    assert row.expected_trades is None and row.actual_trades == 2


def test_id_gap_totals_without_gaps(trades):
    at = "2024-01-01 00:00:00"
    assert reports.id_gap_totals(trades([("A", "1", at), ("A", "2", at)])).first().largest_single_gap == 0
    assert reports.id_gap_totals(trades([("A", "1", at), ("A", "1", at)])).first().largest_single_gap == -1
    assert reports.id_gap_totals(trades([("A", "1", at)])).first().largest_single_gap is None


def test_profile_equals_a_loop_with_one_hot_product(trades):
    rng = random.Random(7)
    rows = [("HOT", str(rng.randrange(200)), "2024-01-01 00:00:00") for _ in range(900)]
    rows += [("COLD", str(i), "2024-01-01 00:00:00") for i in range(10)]
    got = {r.symbol: (r.trades, r.distinct_ids) for r in profile.product_profile(trades(rows)).collect()}
    assert got == {"HOT": (900, len({r[1] for r in rows if r[0] == "HOT"})), "COLD": (10, 10)}


def brute_time_gaps(times):
    ordered = sorted(times)
    pairs = [(a, b, int((b - a) / timedelta(seconds=1))) for a, b in zip(ordered, ordered[1:])]
    return [p for p in pairs if p[2] > 0]


def test_time_gaps_match_a_loop(trades):
    rng = random.Random(3)
    times = [BASE + timedelta(seconds=rng.random() * 10) for _ in range(60)]
    times += [BASE + timedelta(days=rng.randrange(40), seconds=rng.random() * 86400) for _ in range(200)]
    times += [BASE] * 50
    rows = [("A", str(i), t.isoformat(sep=" ")) for i, t in enumerate(times)]
    got = sorted((r.gap_start, r.gap_end, r.gap_seconds) for r in gaps.time_gaps(trades(rows)).collect())
    assert got == sorted(brute_time_gaps(times))
    counted = {r.gap_seconds: r.n for r in gaps.gap_lengths(gaps.rolled_seconds(trades(rows))).collect()}
    expected = [g[2] for g in brute_time_gaps(times)]
    assert counted == {length: expected.count(length) for length in set(expected)}
    longest = max((b - a) / timedelta(microseconds=1) for a, b, _ in brute_time_gaps(times))
    assert gaps.longest_gaps(trades(rows)).first().gap_micros == longest


def test_gap_of_a_week_is_scored_but_not_in_the_statistics(trades):
    times = [BASE + timedelta(seconds=s) for s in (0, 10, 20, 30, 41)] + [BASE + timedelta(days=8)]
    df = trades([("A", str(i), t.isoformat(sep=" ")) for i, t in enumerate(times)])
    row = reports.time_gap_summary(df).first()
    assert row.total_intervals == 4 and row.extreme_gap_count == 1
    only = reports.time_gap_anomalies(df).collect()
    assert len(only) == 1 and only[0].gap_severity == "EXTREME" and only[0].gap_end == times[-1]


def test_equal_gaps_have_no_score(trades):
    df = trades([("A", str(i), (BASE + timedelta(seconds=10 * i)).isoformat(sep=" ")) for i in range(5)])
    assert reports.time_gap_anomalies(df).count() == 0
    assert reports.time_gap_summary(df).first().anomalous_gap_count == 0
