import random

from pyspark.sql import functions as F

from tradelake.operators import dedupe
from tradelake.operators.topk import first_per_key
from tradelake.plans.reports import dedupe_precheck

ROWS = [
    ("A", "1", "2024-01-01 00:00:00", "buy", 1.0, 1.0, "2024-01-01 00:00:09"),
    ("A", "1", "2024-01-01 00:00:05", "buy", 2.0, 1.0, "2024-01-01 00:00:08"),
    ("A", "1", "2024-01-01 00:00:05", "sell", 3.0, 1.0, "2024-01-01 00:00:07"),
    ("B", "1", "2024-01-01 00:00:00", "buy", 4.0, 1.0, "2024-01-01 00:00:01"),
    ("A", "2", "2024-01-01 00:00:00", "buy", 5.0, 1.0, None),
]


def prices(df):
    return sorted(r.price for r in df.collect())


def test_newest_wins_and_ties_are_settled(trades):
    rows = list(ROWS)
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert prices(dedupe.dedupe_newest(trades(rows).repartition(seed + 1))) == [2.0, 4.0, 5.0]


def test_first_arrival_wins(trades):
    assert prices(dedupe.dedupe_first(trades(ROWS))) == [3.0, 4.0, 5.0]


def test_same_id_of_another_product_is_no_duplicate(trades):
    assert prices(dedupe.duplicate_members(trades(ROWS))) == [1.0, 2.0, 3.0]


def test_dedupe_cuts_copies_before_the_shuffle(trades):
    plan = dedupe.dedupe_newest(trades(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unseen(trades):
    target = trades([("A", "1", "2024-01-01"), ("A", "1", "2024-01-02"), ("Z", "9", "2024-01-01")])
    assert prices(dedupe.unseen(trades(ROWS), target)) == [4.0, 5.0]
    compared = dedupe.with_known_time(trades(ROWS), target)
    assert compared.count() == len(ROWS)
    assert {str(r.known_ts) for r in compared.where("known").collect()} == {"2024-01-02 00:00:00"}


def test_restrict_to_products(trades):
    listed = trades([("B", "1", "2024-01-01")]).select("exchange", "symbol")
    assert prices(dedupe.restrict_to_products(trades(ROWS), listed)) == [4.0]


def test_sorted_by_id_is_sorted_by_number_within_partitions(trades):
    rows = [("HOT", str(i), "2024-01-01") for i in range(300)] + [("B", str(i), "2024-01-01") for i in range(5)]
    random.Random(1).shuffle(rows)
    out = dedupe.sorted_by_id(trades(rows)).withColumn("p", F.spark_partition_id()).collect()
    assert len(out) == len(rows)
    for part in {r.p for r in out}:
        keys = [(r.symbol, int(r.trade_id)) for r in out if r.p == part]
        assert keys == sorted(keys)


def test_first_per_key_equals_a_sort(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else "cold", i, rng.randrange(50)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    got = first_per_key(df, ["k"], [F.col("v").desc(), F.col("i")], 20).collect()
    for key in ("hot", "cold"):
        expected = [r[1] for r in sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1]))[:20]]
        assert [r.i for r in sorted((r for r in got if r.k == key), key=lambda r: r["rank"])] == expected


def test_rows_without_a_full_key_repeat_no_other_row(trades):
    rows = [(None, "1", "2024-01-01", "buy", 1.0), (None, "1", "2024-01-02", "buy", 2.0), ("A", None, "2024-01-01", "buy", 3.0)]
    rows += [("A", "", "2024-01-01", "buy", 4.0), ("A", "", "2024-01-01", "buy", 5.0), ("A", "7", "2024-01-01", "buy", 6.0)]
    assert prices(dedupe.dedupe_newest(trades(rows + rows[5:]))) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert prices(dedupe.unseen(trades(rows), trades(rows))) == [1.0, 2.0, 3.0, 4.0, 5.0]
    check = dedupe_precheck(trades(rows)).first()
    assert (check.total, check.unique_count, check.incomplete_keys, check.skip_dedupe) == (6, 1, 5, True)
    assert not dedupe_precheck(trades(rows + rows[5:])).first().skip_dedupe
