import json

import pytest
from pyspark.sql import functions as F

from tradelake.operators import mapping, normalize

GOOD = {"id": "1", "product_id": "BTC-USD", "side": "BUY", "price": "1.5", "size": "2", "time": "2024-01-01T00:00:00Z"}


def run(spark, records, mode="strict", spec=mapping.COINBASE):
    texts = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    lines = spark.createDataFrame(texts, "i int, value string")
    return normalize.normalize(normalize.parse_lines(lines), spec, mode, keep=("i",)).orderBy("i").collect()


def test_spellings(spark):
    variants = [
        GOOD,
        {**{k: v for k, v in GOOD.items() if k != "id"}, "trade_id": "1"},
        {**{k: v for k, v in GOOD.items() if k != "product_id"}, "product-id": "BTC-USD"},
        {**{k: v for k, v in GOOD.items() if k != "size"}, "qty": 2},
        {**{k: v for k, v in GOOD.items() if k != "time"}, "timestamp": 1704067200},
        {**GOOD, "price": 1.5, "id": 1},
        {**GOOD, "id": "", "trade_id": "1"},
        {**GOOD, "time": "2024-01-01T01:00:00+01:00"},
    ]
    rows = run(spark, variants)
    assert {(r.exchange, r.symbol, r.trade_id, r.side, r.price, r.quantity, str(r.trade_ts), r.reject_reason) for r in rows} == {
        ("coinbase", "BTC-USD", "1", "buy", 1.5, 2.0, "2024-01-01 00:00:00", None)
    }


def test_reasons(spark):
    bad = [
        "not json", "[1]", {**GOOD, "price": "abc"}, {**GOOD, "time": None}, {**GOOD, "time": "soon"},
        {k: v for k, v in GOOD.items() if k != "id"}, {**GOOD, "product_id": None}, {**GOOD, "size": "12f"},
        {**GOOD, "side": ""},
    ]
    assert [r.reject_reason for r in run(spark, bad)] == [
        "malformed_json", "malformed_json", "bad_price", "missing_trade_ts", "bad_trade_ts", "missing_trade_id",
        "missing_symbol", "bad_quantity", "missing_side",
    ]


def test_compat_defaults(spark):
    rows = run(spark, [{"time": "1704067200"}, {**GOOD, "price": "abc"}, {"id": "1"}, {**GOOD, "size": "1_0"}], "compat")
    assert [r.reject_reason for r in rows] == [None, "bad_price", "missing_trade_ts", None]
    assert (rows[0].price, rows[0].quantity, rows[0].trade_id, rows[0].side, rows[0].symbol) == (0.0, 0.0, "", "", None)
    assert rows[3].quantity == 10.0


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        run(spark, [GOOD], "lax")


def test_no_row_is_lost(spark):
    records = [GOOD, "x", {**GOOD, "price": "?"}] * 20
    lines = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")
    rows = normalize.normalize(normalize.parse_lines(lines))
    assert (normalize.accepted(rows).count(), normalize.rejected(rows).count()) == (20, 40)


DOCUMENT = {
    "source": "coinbase",
    "field_mappings": {"id": "trade_id", "product_id": "symbol", "side": "side", "price": "price", "size": "quantity",
                       "time": "trade_ts", "_exchange": "Coinbase"},
    "transformations": {"side": {"type": "lowercase"}, "price": {"type": "float"}, "quantity": {"type": "float"},
                        "trade_ts": {"type": "timestamp", "format": "iso8601"}},
    "defaults": {"exchange": "coinbase", "ingest_ts": "now"},
    "validation": {"required_fields": ["trade_id", "symbol"],
                   "numeric_checks": {"price": {"minimum": 0, "allow_zero": False}},
                   "enum_checks": {"side": {"allowed_values": ["buy", "sell"]}}},
}


def test_mapping_document(spark, tmp_path):
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps(DOCUMENT))
    spec = mapping.load_mapping(str(path))
    row = run(spark, [GOOD], spec=spec)[0]
    assert (row.exchange, row.symbol, row.side, row.quantity) == ("coinbase", "BTC-USD", "buy", 2.0)
    assert row.ingest_ts is not None
    assert set(normalize.rule_failures(spec)) == {"required:trade_id", "required:symbol", "positive:price", "allowed:side"}


def test_flat_mapping_document(spark):
    spec = mapping.mapping_from_document(
        {"mappings": {"trade_id": "trade_id", "product_id": "symbol", "price": "price", "size": "quantity", "time": "trade_ts"},
         "constants": {"exchange": "COINBASE"},
         "transforms": {"trade_ts": "iso8601", "price": "to_double", "quantity": "to_double"}}
    )
    row = run(spark, [{**GOOD, "trade_id": "9"}], spec=spec)[0]
    assert (row.exchange, row.trade_id, row.price, row.side) == ("coinbase", "9", 1.5, None)
    with pytest.raises(ValueError):
        mapping.mapping_from_document({"transforms": {"price": "to_money"}})


def test_another_exchange_is_only_data(spark):
    spec = mapping.Mapping(
        fields={"symbol": ["product_id"], "trade_id": ["id"], "price": ["price"], "quantity": ["qty"], "trade_ts": ["timestamp"], "side": ["side"]},
        constants={"exchange": "other"},
        casts={"price": "double", "quantity": "double", "trade_ts": "timestamp", "side": "lower"},
        required=("trade_id",),
    )
    mapping.register("other", spec)
    row = run(spark, [{**GOOD, "qty": "3", "timestamp": "1704067200"}], spec=mapping.REGISTRY["other"])[0]
    assert (row.exchange, row.quantity, row.reject_reason) == ("other", 3.0, None)


def test_raw_record_and_back(spark):
    payload = spark.createDataFrame(
        [(7, "1.50", "2", "2024-01-01T00:00:00Z", "buy", None, "9.9")],
        "trade_id long, price string, size string, time string, side string, bid string, ask string",
    )
    record = normalize.raw_record(payload, F.lit("BTC-USD"), F.lit("2024-01-02").cast("timestamp"))
    row = record.first()
    assert (row.trade_id, row.product_id, row.price, row.side, row._source) == ("7", "BTC-USD", 1.5, "BUY", "coinbase")
    assert json.loads(row._raw_payload)["bid"] is None
    assert normalize.unpack_payload(record).first() == payload.first()


def test_rules(trades):
    df = trades([("A", "1", "2024-01-01", "buy", 0.0, 1.0), ("A", "2", "2024-01-01", "hold", -1.0, 1.0), ("A", None, "2024-01-01")])
    failed = {r.rule: r.failed_rows for r in normalize.rule_violations(df).collect()}
    assert failed["positive:price"] == 2 and failed["allowed:side"] == 1 and failed["required:trade_id"] == 1
