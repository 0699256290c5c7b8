from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradelake.sources import state

T0 = datetime(2024, 1, 1)


def history(spark, runs):
    """Runs given oldest first as (passed, duplicates, size)."""
    rows = [(T0 + timedelta(hours=i), *run) for i, run in enumerate(runs)]
    return spark.createDataFrame(rows, "ts timestamp, passed boolean, duplicates_found long, batch_size long")


OK, BAD = (True, 0, 100), (False, 0, 100)


@pytest.mark.parametrize(
    "runs, failures, replay, reason",
    [
        ([], 0, False, ""),
        ([OK, OK], 0, False, ""),
        ([BAD, OK], 0, False, ""),
        ([OK, BAD], 1, False, ""),
        ([OK, BAD, BAD], 2, True, "consecutive_failures"),
        ([BAD, BAD], 2, True, "consecutive_failures"),
        ([(True, 5, 100)], 0, False, ""),
        ([(True, 6, 100)], 0, True, "duplicate_ratio"),
        ([(True, 6, 0)], 0, False, ""),
        ([(True, 9, 100), OK, OK, OK, OK], 0, True, "duplicate_ratio"),
        ([(True, 9, 100), OK, OK, OK, OK, OK], 0, False, ""),
    ],
)
def test_replay_decision(spark, runs, failures, replay, reason):
    row = state.replay_decision(history(spark, runs)).first()
    assert (row.consecutive_failures, row.should_replay, row.reason) == (failures, replay, reason)


def test_replay_flag(spark):
    assert state.replay_decision(history(spark, [OK]), flagged=True).first().reason == "replay_flag"


def marks(spark, rows):
    return spark.createDataFrame(rows, "exchange string, symbol string, cursor long, updated_at timestamp")


def test_merged_watermarks_never_go_back(spark):
    later = T0 + timedelta(hours=1)
    old = marks(spark, [("c", "A", 10, T0), ("c", "B", 10, T0), ("c", "D", 10, T0)])
    new = marks(spark, [("c", "A", 12, later), ("c", "B", 9, later), ("c", "C", 1, later)])
    got = {r.symbol: (r.cursor, r.updated_at) for r in state.merge_watermarks(old, new).collect()}
    assert got == {"A": (12, later), "B": (10, T0), "C": (1, later), "D": (10, T0)}


def test_saved_watermarks(spark, tmp_path):
    root, later = str(tmp_path), T0 + timedelta(hours=1)
    assert state.load_watermarks(spark, root).count() == 0
    state.save_watermarks(marks(spark, [("c", "A", 10, T0), ("c", "B", 10, T0)]), root, "1")
    state.save_watermarks(marks(spark, [("c", "A", 12, later), ("c", "B", 9, later)]), root, "2")
    # A repeated batch changes nothing.
    state.save_watermarks(marks(spark, [("c", "A", 12, later), ("c", "B", 9, later)]), root, "2")
    got = {r.symbol: (r.cursor, r.updated_at) for r in state.load_watermarks(spark, root).collect()}
    assert got == {"A": (12, later), "B": (10, T0)}


def test_backlog(spark):
    targets = spark.createDataFrame(
        [("c", "done", 0, 99), ("c", "half", 0, 200), ("c", "new", 1000, 2000), ("c", "none", 50, 50), ("c", "over", 0, 10)],
        "exchange string, symbol string, start_id long, target_id long",
    )
    cursors = marks(spark, [("c", "done", 100, T0), ("c", "half", 100, T0), ("c", "none", 50, T0), ("c", "over", 500, T0)])
    rows = state.backlog(cursors, targets).collect()
    got = {r.symbol: (r.cursor, r.remaining, r.pct_done, r.caught_up) for r in rows}
    assert got == {
        "done": (100, 0, 100.0, True),
        "half": (100, 100, 50.0, False),
        "new": (1000, 1000, 0.0, False),
        "none": (50, 0, 100.0, False),
        "over": (500, 0, 100.0, True),
    }
    assert [r.symbol for r in rows][:2] == ["new", "half"]


def test_update_products(spark):
    found = spark.createDataFrame([("c", "BTC-USD"), ("c", "ETH-EUR"), ("c", None), ("c", "BTC-USD"), ("c", "")], "exchange string, symbol string")
    existing = spark.createDataFrame([("c", "ADA-USD"), ("c", "BTC-USD")], "exchange string, symbol string")
    names = [r.symbol for r in state.update_products(existing, found, "-USD$").collect()]
    assert names == ["ADA-USD", "BTC-USD"]
    assert [r.symbol for r in state.update_products(existing, found, merge=False).collect()] == ["BTC-USD", "ETH-EUR"]


def test_state_tables_start_empty_and_keep_one_copy_per_batch(spark, tmp_path):
    root = str(tmp_path)
    for table in state.TABLES:
        assert state.load(spark, root, table).count() == 0
    rows = spark.range(1).select(F.lit("f").alias("file"), F.lit("r").alias("run_id"), F.current_timestamp().alias("processed_at"))
    for batch in ("a", "a", "b"):
        state.append(rows, root, "processed_files", batch)
    assert state.load(spark, root, "processed_files").count() == 2


def test_product_list_files(spark, tmp_path):
    document = tmp_path / "seed.json"
    document.write_text('{\n "product_ids": ["B-USD", "A-USD"],\n "metadata": {"source": "x"}\n}')
    listed = state.read_products(spark, str(document))
    assert sorted(r.symbol for r in listed.collect()) == ["A-USD", "B-USD"]
    state.write_products(listed, str(tmp_path / "saved"))
    again = state.read_products(spark, str(tmp_path / "saved"))
    assert sorted(map(tuple, again.collect())) == [("coinbase", "A-USD"), ("coinbase", "B-USD")]


def test_compaction_reads_one_snapshot_and_newer_folders(spark, tmp_path):
    root = str(tmp_path)
    row = lambda i: spark.createDataFrame([(f"f{i}", f"r{i}", T0)], "file string, run_id string, processed_at timestamp")
    for i in range(4):
        state.append(row(i), root, "processed_files", f"r{i}")
    assert state.generation(spark, root, "processed_files") == 0
    assert state.compact(spark, root, "processed_files") == 1
    state.append(row(4), root, "processed_files", "r4")
    state.append(row(2), root, "processed_files", "r2")  # a run repeated after the compaction
    table = state.load(spark, root, "processed_files")
    assert sorted(r.file for r in table.collect()) == [f"f{i}" for i in range(5)]
    places = {f.split("/processed_files/")[1].split("/part")[0] for f in table.inputFiles()}
    assert places == {"snapshot=1", "gen=1/batch=r4", "gen=1/batch=r2"}
    # A snapshot that a crash left without its end does not count, and is written over.
    (tmp_path / "state/processed_files/snapshot=2").mkdir()
    assert state.generation(spark, root, "processed_files") == 1
    state.compact_if_long(spark, root, ["processed_files"], most=1)
    assert state.generation(spark, root, "processed_files") == 2
    assert sorted(r.file for r in state.load(spark, root, "processed_files").collect()) == [f"f{i}" for i in range(5)]
    assert state.load(spark, root, "run_history").count() == 0
