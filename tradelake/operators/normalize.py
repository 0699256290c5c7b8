"""Raw trade records to the trade columns, with a reason for every record that cannot be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.scalars import first_text, parse_double, parse_ts
from tradelake.operators.mapping import COINBASE, Mapping
from tradelake.schema import CORRUPT, PAYLOAD, TRADE, raw_schema

REASON = "reject_reason"


def _evaluate_once(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Select costly columns so that they are computed once per row.

    Without the generator, a later filter on one of them is pushed below this step and repeats the parsing.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def parse_lines(lines: DataFrame, column: str = "value", mapping: Mapping = COINBASE) -> DataFrame:
    """JSON texts to raw records with the fields the mapping reads. A text that is no JSON object only fills the
    corrupt-record column."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in lines.columns if c != column]
    return lines.select(*others, F.inline(F.array(F.from_json(column, raw_schema(mapping.raw_names), options))))


def _raw(columns: list[str], names: list[str]) -> Column:
    found = [F.col(f"`{n}`").cast("string") for n in names if n in columns]
    return first_text(*found) if found else F.lit(None).cast("string")


def _typed(text: Column, kind: str, loose: bool) -> Column:
    if kind == "double":
        return parse_double(text, loose)
    if kind == "timestamp":
        return parse_ts(text)
    if kind in ("lower", "upper"):
        return getattr(F, kind)(text)
    return text


def normalize(raw: DataFrame, mapping: Mapping = COINBASE, mode: str = "strict", keep=()) -> DataFrame:
    """Raw records to trade columns plus `reject_reason`, which is null for usable rows.

    mode "strict" rejects records that lack a required field. mode "compat" gives a missing price or
    quantity 0, a missing id or side an empty text and a missing product null, and rejects only what cannot
    be read. No row is dropped: usable and rejected rows add up to the rows read.
    """
    if mode not in ("strict", "compat"):
        raise ValueError(f"mode must be strict or compat, not {mode!r}")
    loose = mode == "compat"
    names = {target: f"_text_{target}" for target in mapping.fields}
    kinds = {target: mapping.casts.get(target, "text") for target in mapping.fields}
    texts = raw.select("*", *[_raw(raw.columns, raws).alias(names[t]) for t, raws in mapping.fields.items()])
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    ingested = F.col("_source_ingest_ts").cast("string") if "_source_ingest_ts" in raw.columns else F.lit(None)
    parsed = _evaluate_once(
        texts,
        [
            *[F.col(k) for k in keep],
            corrupt.alias("_corrupt"),
            parse_ts(ingested.cast("string")).alias("_ingested"),
            *[F.col(text).isNull().alias(f"_missing_{target}") for target, text in names.items()],
            *[_typed(F.col(text), kinds[t], loose).alias(t) for t, text in names.items()],
        ],
    )
    columns: dict[str, Column] = {}
    missing: list[Column] = []
    unreadable: list[Column] = []
    for target, kind in kinds.items():
        value, absent = F.col(target), F.col(f"_missing_{target}")
        if kind in ("double", "timestamp"):
            unreadable.append(F.when(~absent & value.isNull(), F.lit(f"bad_{target}")))
        if target in mapping.required if mode == "strict" else kind == "timestamp":
            missing.append(F.when(absent, F.lit(f"missing_{target}")))
        elif kind == "double":
            value = F.when(absent, F.lit(0.0)).otherwise(value)
        elif target in ("trade_id", "side"):
            value = F.coalesce(value, F.lit(""))
        columns[target] = value
    columns.setdefault("ingest_ts", F.col("_ingested"))
    for target, default in mapping.defaults.items():
        value = F.current_timestamp() if default == "now" else F.lit(default)
        columns[target] = F.coalesce(columns[target], value) if target in columns else value
    for target, text in mapping.constants.items():
        columns[target] = F.lit(text)
    reason = F.coalesce(F.when(F.col("_corrupt"), F.lit("malformed_json")), *missing, *unreadable)
    return parsed.select(
        *keep,
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRADE.fields],
        reason.alias(REASON),
    )


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col(REASON).isNull()).drop(REASON)


def rejected(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col(REASON).isNotNull())


def rule_failures(mapping: Mapping = COINBASE) -> dict[str, Column]:
    """The mapping's rules as conditions that hold for rows breaking them."""
    rules = {f"required:{c}": F.col(c).isNull() for c in mapping.required}
    rules |= {f"positive:{c}": F.coalesce(F.col(c) <= 0, F.lit(False)) for c in mapping.positive}
    rules |= {
        f"allowed:{c}": F.coalesce(~F.col(c).isin(*values), F.lit(False))
        for c, values in mapping.allowed.items()
    }
    return rules


def rule_violations(trades: DataFrame, mapping: Mapping = COINBASE) -> DataFrame:
    """Rows broken per rule, all counted in one pass: (rule, failed_rows)."""
    rules = rule_failures(mapping)
    counted = trades.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    pairs = [F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("failed_rows")) for i, rule in enumerate(rules)]
    return counted.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def raw_record(payloads: DataFrame, product: Column, ingest_ts: Column, source: str = "coinbase") -> DataFrame:
    """API payloads (trade_id, price, size, time, side, bid, ask) to raw records with the payload embedded."""
    present = [f.name for f in PAYLOAD.fields if f.name in payloads.columns]
    return payloads.select(
        F.col("trade_id").cast("string").alias("trade_id"),
        product.alias("product_id"),
        parse_double(F.col("price").cast("string")).alias("price"),
        parse_double(F.col("size").cast("string")).alias("size"),
        parse_ts(F.col("time")).alias("time"),
        F.upper("side").alias("side"),
        F.lit(source).alias("_source"),
        ingest_ts.alias("_source_ingest_ts"),
        F.to_json(F.struct(*present), {"ignoreNullFields": "false"}).alias("_raw_payload"),
    )


def unpack_payload(raw: DataFrame) -> DataFrame:
    """The API payload embedded in raw records, as columns."""
    return raw.select(F.from_json("_raw_payload", PAYLOAD).alias("p")).select("p.*")
