"""Native column expressions: parsing, labels and small arithmetic."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Products that keep their own metric series.
TOP_PRODUCTS = ("BTC-USD", "ETH-USD", "SOL-USD", "DOGE-USD", "XRP-USD")
OTHER_PRODUCTS = "other"

# Minutes since the last trade.
FRESH_MINUTES, STALE_MINUTES, OLD_MINUTES = 60, 180, 1440

# Completeness percentages.
PCT_GOOD, PCT_FAIR, PCT_POOR = 99, 95, 90

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NUMBER_LOOSE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)$"
# First second of year 1 and last second of year 9999.
_MIN_EPOCH, _MAX_EPOCH = -62135596800, 253402300799


def as_of_column(as_of: datetime | str | Column | None) -> Column:
    """The moment a report looks back from; the current time unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat(sep=" ")
    text = str(as_of)
    return F.lit(text if text.endswith("Z") else text + "Z").cast("timestamp")


def first_text(*columns: Column) -> Column:
    """The first value that is neither null nor an empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def parse_double(text: Column, loose: bool = False) -> Column:
    """Text to double; null unless the text is a plain number.

    `loose` also takes inf, nan and single underscores between digits.
    """
    if loose:
        text = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    pattern = _NUMBER_LOOSE if loose else _NUMBER
    return F.when(text.rlike(pattern), F.trim(text).try_cast("double"))


def parse_ts(text: Column) -> Column:
    """ISO-8601 (contains a T; no zone means UTC) or epoch seconds; null if it is neither."""
    zoned = F.when(text.rlike(_ZONE), text).otherwise(F.concat(text, F.lit("Z")))
    iso = F.when(text.rlike(_ISO), zoned.try_cast("timestamp"))
    seconds = parse_double(text)
    epoch = F.when(
        seconds.between(_MIN_EPOCH, _MAX_EPOCH),
        F.timestamp_micros(F.round(seconds * 1000000).cast("bigint")),
    )
    return F.when(text.contains("T"), iso).otherwise(epoch)


def numeric_id(trade_id: Column) -> Column:
    """A trade id as a number, or null if its text is not exactly that number."""
    number = trade_id.try_cast("bigint")
    return F.when(number.cast("string") == trade_id, number)


def whole_units(unit: str, start: Column, end: Column) -> Column:
    """Complete units between two timestamps (59 seconds are 0 minutes)."""
    return F.timestamp_diff(unit, start, end)


def notional() -> Column:
    return F.col("price") * F.col("quantity")


def ratio(top: Column, bottom: Column) -> Column:
    """Division in double; null when the divisor is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def percent(top: Column, bottom: Column, digits: int) -> Column:
    return F.round(ratio(F.lit(100.0) * top, bottom), digits)


def quantile_of_counts(value: Column, seen: Column, total: Column, share: float) -> Column:
    """Exact discrete quantile, as an aggregate over distinct values with running counts.

    It is the smallest value with at least that share of the `total` rows at or below it; `seen` counts the
    rows up to and including each value.
    """
    rank = F.greatest(F.lit(1), total - F.floor(total - total * F.lit(share)))
    return F.min(F.when(seen >= rank, value))


def freshness_tier(minutes: Column) -> Column:
    return (
        F.when(minutes < FRESH_MINUTES, "FRESH")
        .when(minutes < STALE_MINUTES, "STALE")
        .when(minutes < OLD_MINUTES, "OLD")
        .otherwise("VERY_OLD")
    )


def gap_severity(z: Column) -> Column:
    return F.when(z > 5, "EXTREME").when(z > 4, "SEVERE").when(z > 3, "WARNING").otherwise("NORMAL")


def health_label(minutes: Column, completeness: Column) -> Column:
    return (
        F.when((minutes > OLD_MINUTES) | (completeness < PCT_POOR), "CRITICAL")
        .when((minutes > STALE_MINUTES) | (completeness < PCT_FAIR), "WARNING")
        .when((minutes > FRESH_MINUTES) | (completeness < PCT_GOOD), "ATTENTION")
        .otherwise("HEALTHY")
    )


def health_priority(minutes: Column, completeness: Column) -> Column:
    """Sort rank of the health label: critical first, then warning, then the rest."""
    label = health_label(minutes, completeness)
    return F.when(label == "CRITICAL", 1).when(label == "WARNING", 2).otherwise(3)


def error_tier(rate: Column) -> Column:
    """Health of a source by its recent share of failed calls."""
    return F.when(rate < 0.1, "healthy").when(rate < 0.3, "degraded").otherwise("unhealthy")


def bucket_product(symbol: Column, top: Iterable[str] = TOP_PRODUCTS) -> Column:
    return F.when(symbol.isin(*top), symbol).otherwise(OTHER_PRODUCTS)


def gauge_tier(value: Column, warn: float, alarm: float) -> Column:
    """Tier of a gauge where more is worse."""
    return F.when(value >= alarm, "RED").when(value >= warn, "YELLOW").otherwise("GREEN")


def score_tier(value: Column) -> Column:
    """Tier of the health score, where more is better."""
    return F.when(value >= 80, "GREEN").when(value >= 50, "YELLOW").otherwise("RED")


def shorten_error(text: Column, length: int = 500) -> Column:
    return F.substring(text, 1, length)
