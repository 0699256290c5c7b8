from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Builds a trade table from (symbol, id, 'YYYY-MM-DD HH:MM:SS[.f]') and optional values."""

    def build(rows, exchange="coinbase"):
        full = []
        for row in rows:
            symbol, trade_id, ts, *rest = row
            side, price, quantity, ingest = (*rest, *("buy", 10.0, 1.0, None)[len(rest):])
            full.append((exchange, symbol, trade_id, side, price, quantity, ts, ingest))
        flat = spark.createDataFrame(
            full,
            "exchange string, symbol string, trade_id string, side string, price double, quantity double, "
            "trade_ts string, ingest_ts string",
        )
        return flat.withColumn("trade_ts", flat.trade_ts.cast("timestamp")).withColumn(
            "ingest_ts", flat.ingest_ts.cast("timestamp")
        )

    return build
