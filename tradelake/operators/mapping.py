"""Mappings from a source's raw fields to the trade columns. Adding an exchange adds data, not code."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Mapping:
    """How to build each trade column.

    fields: target column -> raw fields to try in turn. constants: target -> fixed text.
    casts: target -> text | lower | upper | double | timestamp. defaults: target -> value, or "now".
    """

    fields: dict[str, list[str]]
    constants: dict[str, str] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def raw_names(self) -> list[str]:
        """Raw fields the mapping reads."""
        return [name for names in self.fields.values() for name in names]


# Field names, constants and rules of the built-in source.
COINBASE = Mapping(
    fields={
        "symbol": ["product_id", "product-id"],
        "trade_id": ["id", "trade_id"],
        "side": ["side"],
        "price": ["price"],
        "quantity": ["size", "qty"],
        "trade_ts": ["time", "timestamp"],
    },
    constants={"exchange": "coinbase"},
    casts={"side": "lower", "price": "double", "quantity": "double", "trade_ts": "timestamp"},
    required=("trade_id", "symbol", "side", "price", "quantity", "trade_ts"),
    positive=("price", "quantity"),
    allowed={"side": ("buy", "sell")},
)

REGISTRY: dict[str, Mapping] = {"coinbase": COINBASE}

# Names of cast types in mapping documents.
_CASTS = {
    "lowercase": "lower", "uppercase": "upper", "float": "double", "to_double": "double",
    "timestamp": "timestamp", "iso8601": "timestamp", "string": "text",
}


def register(name: str, mapping: Mapping) -> None:
    REGISTRY[name] = mapping


def mapping_from_document(doc: dict[str, Any]) -> Mapping:
    """A mapping from its document form, with either set of section names in use.

    Renames run from raw field to column; a renamed "_column" states a constant.
    """
    fields: dict[str, list[str]] = {}
    constants = {k: str(v) for k, v in doc.get("constants", {}).items()}
    for raw, target in {**doc.get("mappings", {}), **doc.get("field_mappings", {})}.items():
        if raw.startswith("_"):
            constants[raw[1:]] = str(target)
        else:
            fields.setdefault(target, []).append(raw)
    # Exchanges are lower case in the trade table.
    if "exchange" in constants:
        constants["exchange"] = constants["exchange"].lower()
    casts = {}
    for target, how in {**doc.get("transforms", {}), **doc.get("transformations", {})}.items():
        kind = how.get("type", "string") if isinstance(how, dict) else how
        if kind not in _CASTS:
            raise ValueError(f"unknown cast {kind!r} for {target}")
        casts[target] = _CASTS[kind]
    rules = doc.get("validation", {})
    for target, rule in rules.get("numeric_checks", {}).items():
        if rule.get("minimum", 0) != 0 or rule.get("allow_zero", False):
            raise ValueError(f"only a minimum above zero is supported, not {rule} for {target}")
    return Mapping(
        fields=fields,
        constants=constants,
        casts=casts,
        defaults={k: v for k, v in doc.get("defaults", {}).items() if k not in constants},
        required=tuple(rules.get("required_fields", ())),
        positive=tuple(rules.get("numeric_checks", {})),
        allowed={k: tuple(v["allowed_values"]) for k, v in rules.get("enum_checks", {}).items()},
    )


def load_mapping(path: str, spark: SparkSession | None = None) -> Mapping:
    """Read a mapping document: JSON, or YAML where a YAML reader is installed. With a session, from any store it reads."""
    if spark:
        text = spark.read.text(path, wholetext=True).first()[0]
    else:
        with open(path, encoding="utf-8") as source:
            text = source.read()
    if path.endswith(".json"):
        return mapping_from_document(json.loads(text))
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading a YAML mapping needs the yaml package; use JSON instead") from missing
    return mapping_from_document(yaml.safe_load(text))
