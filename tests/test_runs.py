"""Pipeline runs over files: incremental, repeated, corrected, rebuilt."""

import json
import os

from pyspark.sql import functions as F

from tradelake.operators.normalize import accepted, normalize
from tradelake.plans import runs
from tradelake.sources import curated, raw, state
from tradelake.streaming import ingest


def line(trade_id, time="2024-01-01T00:00:00Z", symbol="BTC-USD", price="1.5"):
    return json.dumps({"id": str(trade_id), "product_id": symbol, "side": "BUY", "price": price, "size": "2", "time": time})


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def ids(df):
    return sorted((r.symbol, r.trade_id, r.price) for r in df.collect())


def test_incremental_runs(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(1), line(2), "", "oops", line(2)])
    put(raw_root, "ignored.txt", [line(99)])
    first = runs.transform(spark, raw_root, root, run_id="r1").first()
    assert (first.status, first.records_read, first.records_rejected, first.records_transformed, first.records_written) == (
        "success", 4, 1, 3, 2)
    assert (first.duplicates_found, first.version, first.files, first.passed) == (1, 1, 1, False)
    assert ids(curated.read_current(spark, root)) == [("BTC-USD", "1", 1.5), ("BTC-USD", "2", 1.5)]

    assert runs.transform(spark, raw_root, root, run_id="r2").first().status == "no_new_files"

    # A later file that overlaps: the known trade is not written again.
    put(raw_root, "b.jsonl", [line(2), line(3)])
    third = runs.transform(spark, raw_root, root, run_id="r3").first()
    assert (third.records_written, third.version, third.passed) == (1, 2, True)

    # A correction makes a new version; the old one is still there.
    put(raw_root, "c.jsonl", [line(3, "2024-01-02T00:00:00Z", price="9")])
    fourth = runs.transform(spark, raw_root, root, run_id="r4").first()
    assert (fourth.records_written, fourth.version) == (1, 3)
    current = curated.read_current(spark, root)
    assert ids(current) == [("BTC-USD", "1", 1.5), ("BTC-USD", "2", 1.5), ("BTC-USD", "3", 9.0)]
    assert ids(curated.read_version(spark, root, 2)) == [("BTC-USD", "1", 1.5), ("BTC-USD", "2", 1.5), ("BTC-USD", "3", 1.5)]

    rejected = runs.quarantine(spark, root).collect()
    assert [(r.reject_reason, r.raw_text, r.source_file.endswith("a.jsonl")) for r in rejected] == [("malformed_json", "oops", True)]
    assert state.load_watermarks(spark, root).first().cursor == 3
    assert state.load(spark, root, "run_history").count() == 3
    assert state.load(spark, root, "processed_files").count() == 3


def test_a_run_repeated_after_a_crash_adds_nothing(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(i) for i in range(5)])
    runs.transform(spark, raw_root, root, run_id="r1")
    put(raw_root, "b.jsonl", [line(i) for i in range(5, 8)])
    # The data of run r2 was written, its state was not.
    batch = accepted(normalize(raw.read_raw(spark, raw_root))).where(F.col("trade_id") >= 5)
    curated.write_version(batch, root, replaced=[])
    again = runs.transform(spark, raw_root, root, run_id="r2").first()
    assert again.records_written == 0
    assert curated.read_current(spark, root).count() == 8


def test_replay_rebuilds_everything_once(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(1)] * 2 + [line(2)])
    runs.transform(spark, raw_root, root, run_id="r1")
    decision = runs.replay_if_needed(spark, raw_root, root, run_id="replay").first()
    assert decision.should_replay and decision.reason == "duplicate_ratio"
    assert curated.current_version(spark, root) == 2
    mark = state.load(spark, root, "replays").first()
    assert (mark.old_version, mark.new_version, mark.reason) == (1, 2, "duplicate_ratio")
    assert not runs.replay_if_needed(spark, raw_root, root, run_id="again").first().should_replay
    assert curated.current_version(spark, root) == 2
    assert curated.read_current(spark, root).count() == 2


def test_deduplicate_the_current_version(spark, tmp_path, trades):
    root = str(tmp_path)
    rows = [("A", "1", "2024-01-01", "buy", 1.0), ("A", "1", "2024-01-02", "buy", 2.0), ("A", "2", "2024-01-01", "buy", 3.0)]
    curated.write_version(trades(rows), root)
    outcome = runs.deduplicate(spark, root).first()
    assert tuple(outcome) == ("success", 3, 2, 1, 2)
    assert ids(curated.read_current(spark, root)) == [("A", "1", 2.0), ("A", "2", 3.0)]
    # Nothing left to do: the version stays.
    assert tuple(runs.deduplicate(spark, root).first()) == ("skipped", 2, 2, 0, 2)


def test_nothing_usable(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", ["oops"])
    row = runs.transform(spark, raw_root, root, run_id="r1").first()
    assert (row.status, row.records_read, row.records_rejected, row.passed) == ("transformation_failed", 1, 1, False)
    # The file stays unprocessed.
    assert raw.new_files(spark, raw_root, state.load(spark, root, "processed_files")).count() == 1


def test_full_scan_gate(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(1, "2024-01-01T00:00:00Z")])
    row = runs.transform(spark, raw_root, root, run_id="r1", full_scan=True, as_of="2024-01-01 05:00:00").first()
    assert (row.passed, row.issues) == (False, ["freshness"])


def test_ingest_then_transform(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    payloads = spark.createDataFrame(
        [(i, "1.5", "2", f"2024-01-01T00:00:0{i}Z", "buy", s) for i in range(1, 4) for s in ("A-USD", "B-USD")],
        "trade_id long, price string, size string, time string, side string, product string",
    )
    for _ in range(2):
        runs.ingest(payloads, F.col("product"), raw_root, root, "i1")
    assert raw.read_raw(spark, raw_root).count() == 6
    assert {r.symbol: r.cursor for r in state.load_watermarks(spark, root).collect()} == {"A-USD": 3, "B-USD": 3}
    text = spark.read.text(raw_root).first().value
    assert json.loads(text)["_source"] == "coinbase" and json.loads(text)["time"].endswith("Z")
    row = runs.transform(spark, raw_root, root).first()
    assert (row.records_read, row.records_written, row.passed) == (6, 6, True)
    assert curated.read_current(spark, root).where("ingest_ts is null").count() == 0


def test_catalog_table_and_footprint(spark, tmp_path, trades):
    path = str(tmp_path / "t")
    curated.write_trades(trades([("A", "1", "2024-01-01"), ("A", "2", "2024-01-02")]), path)
    curated.register_table(spark, "trades_table", path)
    assert spark.table("trades_table").where("trade_date = date'2024-01-02'").count() == 1
    curated.write_trades(trades([("A", "3", "2024-01-03")]), path, mode="append")
    curated.refresh_table(spark, "trades_table")
    assert spark.table("trades_table").count() == 3
    other = str(tmp_path / "u")
    extra = trades([("A", "4", "2024-01-04")]).withColumn("venue", F.lit("x"))
    extra.withColumn("trade_date", F.to_date("trade_ts")).write.partitionBy("trade_date").parquet(other)
    both = curated.read_trades(spark, path, other, merge_schema=True)
    assert both.count() == 4 and "venue" in both.columns
    (tmp_path / "t" / "notes.json").write_text("{}")
    listed = curated.storage_footprint(spark, path).first()
    on_disk = [p for p in (tmp_path / "t").rglob("*.parquet")]
    assert (listed.files, listed.bytes) == (len(on_disk), sum(p.stat().st_size for p in on_disk))
    spark.sql("DROP TABLE trades_table")


def test_rows_per_file_are_limited(spark, tmp_path, trades, monkeypatch):
    monkeypatch.setattr(curated, "MAX_RECORDS_PER_FILE", 10)
    curated.write_trades(trades([("A", str(i), "2024-01-01") for i in range(35)]), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) >= 4
    assert curated.read_trades(spark, str(tmp_path / "t")).count() == 35


def stream(spark, raw_root, root):
    query = ingest.curate(ingest.stream_raw(spark, raw_root, files_per_batch=1), root, f"{root}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{root}/trades")


def test_stream_takes_only_new_files_and_new_keys(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "stream")
    put(raw_root, "a.jsonl", [line(1), line(2), "oops"])
    assert stream(spark, raw_root, root).count() == 2
    # Old trades may come late, and known ones again.
    put(raw_root, "b.jsonl", [line(2), line(3, "2001-01-01T00:00:00Z")])
    assert ids(stream(spark, raw_root, root)) == [("BTC-USD", str(i), 1.5) for i in (1, 2, 3)]
    assert ids(stream(spark, raw_root, root)) == [("BTC-USD", str(i), 1.5) for i in (1, 2, 3)]
    # A correction waits until the table is settled.
    put(raw_root, "c.jsonl", [line(1, "2024-01-03T00:00:00Z", price="7")])
    assert ids(stream(spark, raw_root, root)) == [("BTC-USD", str(i), 1.5) for i in (1, 2, 3)]
    assert ids(ingest.settled(spark, root)) == [("BTC-USD", "1", 7.0), ("BTC-USD", "2", 1.5), ("BTC-USD", "3", 1.5)]
    assert spark.read.parquet(f"{root}/rejected").count() == 1
    assert state.load_watermarks(spark, root).first().cursor == 3


def test_a_lost_checkpoint_keeps_what_was_written(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "stream")
    put(raw_root, "a.jsonl", [line(1), line(2)])
    stream(spark, raw_root, root)
    # With another checkpoint the files come again, under the same batch numbers.
    put(raw_root, "b.jsonl", [line(3)])
    again = ingest.curate(ingest.stream_raw(spark, raw_root, files_per_batch=1), root, f"{root}/second")
    again.awaitTermination()
    assert ids(spark.read.parquet(f"{root}/trades")) == [("BTC-USD", str(i), 1.5) for i in (1, 2, 3)]


def test_a_correction_leaves_other_dates_their_files(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(i, f"2024-01-0{i}T00:00:00Z") for i in range(1, 6)])
    runs.transform(spark, raw_root, root, run_id="r1")

    def files():
        rows = curated.read_current(spark, root).select("trade_date", F.col("_metadata.file_path").alias("f")).distinct().collect()
        return {str(r.trade_date): r.f for r in rows}

    before = files()
    # Trade 2 moves from the 2nd to the 4th; trade 9 is new on the 5th.
    put(raw_root, "b.jsonl", [line(2, "2024-01-04T12:00:00Z", price="9"), line(9, "2024-01-05T01:00:00Z")])
    runs.transform(spark, raw_root, root, run_id="r2")
    after = files()
    assert set(after) == {"2024-01-01", "2024-01-03", "2024-01-04", "2024-01-05"}
    assert all(after[d] == before[d] for d in ("2024-01-01", "2024-01-03")) and after["2024-01-04"] != before["2024-01-04"]
    assert [i for _, i, _ in ids(curated.read_current(spark, root))] == ["1", "2", "3", "4", "5", "9"]


def test_a_run_reports_its_invariants(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(1), line(2), "oops", line(2)])
    first = runs.transform(spark, raw_root, root, run_id="r1", as_of="2024-01-01 00:00:00").first()
    put(raw_root, "b.jsonl", [line(3, symbol="ETH-USD"), line(2, "2024-01-03T00:00:00Z", price="9")])
    second = runs.transform(spark, raw_root, root, run_id="r2", as_of="2024-01-01 03:00:00").first()
    assert first.broken_invariants == second.broken_invariants == []
    # BTC-USD got no higher id three hours later.
    assert (first.stale_products, second.stale_products) == (0, 1)
    found = {(r.run_id, r.invariant): (r.expected, r.actual, r.holds) for r in runs.invariants(spark, root).collect()}
    assert all(holds for *_, holds in found.values())
    assert found["r1", "records read = transformed + rejected"][:2] == (4, 4)
    assert found["r1", "records transformed = staged"][:2] == (3, 3)
    assert found["r2", "rows of the version = rows before + new keys"][:2] == (3, 3)


def test_a_write_that_loses_rows_is_not_published(spark, tmp_path, monkeypatch):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(i) for i in range(6)])
    whole = curated.write_trades
    monkeypatch.setattr(curated, "write_trades", lambda trades, path: whole(trades, path) and whole(trades.where("trade_id <> '3'"), path) + 1)
    broken = runs.transform(spark, raw_root, root, run_id="r1").first()
    assert (broken.status, broken.passed, broken.broken_invariants) == ("invariant_broken", False, ["rows written = rows there"])
    row = runs.invariants(spark, root).where("NOT holds").first()
    assert (row.run_id, row.expected, row.actual) == ("r1", 6, 5)
    assert curated.current_version(spark, root) == 0 and state.load(spark, root, "processed_files").count() == 0
    # The files are still to be done, and the next run does them.
    monkeypatch.undo()
    assert runs.transform(spark, raw_root, root, run_id="r2").first().passed
    assert curated.read_current(spark, root).count() == 6


def test_staging_that_loses_rows_merges_nothing(spark, tmp_path, monkeypatch):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    put(raw_root, "a.jsonl", [line(i) for i in range(6)])
    whole = runs.stage
    monkeypatch.setattr(runs, "stage", lambda *args: (lambda rows, sent: (rows.where("trade_id <> '3'"), sent))(*whole(*args)))
    broken = runs.transform(spark, raw_root, root, run_id="r1").first()
    assert broken.status == "invariant_broken" and len(broken.broken_invariants) == 2
    assert curated.current_version(spark, root) == 0


def test_keys_written_twice_and_watermarks_behind_are_found(spark, tmp_path, trades):
    root = str(tmp_path)
    rows = [("A", "1", "2024-01-01"), ("A", "1", "2024-01-02"), ("A", "2", "2024-01-01")]
    version = curated.write_version(trades(rows), root)
    assert runs._written_checks(spark, root, version) == [("written rows = distinct keys", 2, 3)]
    marks = lambda **cursors: spark.createDataFrame([("x", s, c) for s, c in cursors.items()], "exchange string, symbol string, cursor long")
    broken = runs._watermark_checks(marks(A=5, B=7, C=1), marks(A=4, B=7, D=2), marks(B=8, D=2))
    assert broken == [("no watermark goes back or stays behind", 0, 3)]


def test_a_micro_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "stream")
    far = [i * ingest.BLOCK for i in range(1, 30)]
    put(raw_root, "a.jsonl", [line(i) for i in (1, 2, *far)] + [line("x-1"), line("x-2", symbol="ETH-USD")])
    stream(spark, raw_root, root)
    batch = accepted(normalize(raw.read_raw(spark, raw_root))).where("trade_id IN ('2', '4') OR trade_id = 'x-1'")
    known = ingest.known_trades(batch, root)
    assert known.where("trade_id = '2'").count() == 1
    buckets = {int(f.split("/bucket=")[1].split("/")[0]) for f in known.inputFiles()}
    wanted = {r.b for r in batch.select(ingest.key_bucket().alias("b")).collect()}
    assert buckets == wanted and len(wanted) == 2
    everything = spark.read.parquet(f"{root}/trades").select("bucket").distinct().count()
    assert everything > 20  # keys far apart lie in other buckets


def test_a_micro_batch_run_again_replaces_itself(spark, tmp_path, trades):
    path = str(tmp_path / "t")
    first = trades([("A", "1", "2024-01-01"), ("A", "900000", "2024-01-01")])
    for _ in range(2):
        ingest._write_buckets(first, path, "q", 7)
    ingest._write_buckets(first, path, "q", 8)
    assert [r.n for r in ingest._written(spark, path).groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect()] == [2, 2]
