"""Quality rules with verdicts on hosts.

Base rules look at one text. Failures are then counted per host; a host's failure rate is shrunk towards the
rates of all hosts by a beta prior that is fitted to them, so that a host with few documents is not judged by
chance. Documents of a host whose shrunk rate is above `max_rate` are rejected with it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import add_columns, free_name
from tradelake.session import materialize

MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words in repeated windows
WINDOW = 5
MAX_RATE = 0.5
# Weight of the prior in documents, between these bounds; many hosts with nearly equal rates would make it endless.
PRIOR_WEIGHT = (2.0, 1000.0)

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
# White space between words, and characters counted as symbols.
SPACE, SYMBOLS = b"\x20\x09\x0a\x0b\x0c\x0d", b"#*$%&|<>"
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five words that occur twice or more, each word counted once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for i, odd in enumerate(_ODD):
        keys += (codes[i : i + n] ^ (codes[i : i + n] >> np.uint64(29))) * odd
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(inside, at, 1)
    np.add.at(inside, at + WINDOW, -1)
    return int((np.cumsum(inside)[:-1] > 0).sum())


def count_text(text: str | None) -> tuple[int, int, int, int, int]:
    raw = (text or "").encode()
    words = raw.split()  # splits bytes at the six characters of SPACE
    spaces = len(raw) - len(raw.translate(None, SPACE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text or "") - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _count(texts: list[str | None]) -> list[tuple]:
    return list(zip(*map(count_text, texts), strict=True))


def base_failed(counts: Column) -> Column:
    return (counts.n_words < MIN_WORDS) | (100 * counts.n_repeat_words > MAX_REPEATED * counts.n_words)


def host_rates(rows: DataFrame) -> DataFrame:
    """host, n, failures, rate: the mean of each host's beta posterior, from rows (host, failed).

    The prior is fitted by moments to the hosts' raw rates. Equal rates give it the largest weight, and a single
    host keeps its own rate.
    """
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("failures"))
    raw = F.col("failures") / F.col("n")
    moments = hosts.agg(F.avg(raw).alias("mean"), F.coalesce(F.var_pop(raw), F.lit(0.0)).alias("spread"))
    fitted = F.when(F.col("spread") > 0, F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1)
    low, high = map(F.lit, PRIOR_WEIGHT)
    weight = F.least(F.greatest(F.coalesce(fitted, high), low), high)
    prior = moments.select((F.col("mean") * weight).alias("alpha"), weight.alias("weight"))
    shrunk = (F.col("failures") + F.col("alpha")) / (F.col("n") + F.col("weight"))
    return hosts.join(F.broadcast(prior)).select("host", "n", "failures", shrunk.alias("rate"))  # one row


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All rows of `docs` with one more struct column, and its name: the counts, base_failed, host_rate, kept.

    A null text has no words. A null host is the host "". Every repeated row is a document of its own. The result has
    all columns of `docs`, or those in `keep` only: texts that nobody asks for are not written with the counts.
    """
    of = free_name(docs, "_host")
    hosted = docs.withColumn(of, F.coalesce(F.col(host).cast("string"), F.lit("")))
    columns = [c for c in docs.columns if keep is None or c in keep]
    counted, name = add_columns(hosted, _count, FIELDS, keep=[*columns, of])
    verdicts = materialize(counted, "word-counts")
    rate = free_name(verdicts, "_rate")
    failed = base_failed(F.col(name))
    rates = host_rates(verdicts.select(F.col(of).alias("host"), failed.alias("failed")))
    # Written first, so that the join can split a host with many documents or broadcast the rates if they are few.
    rates = materialize(rates.select(F.col("host").alias(of), F.col("rate").alias(rate)), "host-rates")
    extra = [failed.alias("base_failed"), F.col(rate).alias("host_rate"), (~failed & (F.col(rate) <= max_rate)).alias("kept")]
    judged = verdicts.join(rates, of)
    struct = F.struct(F.col(f"{name}.*"), *extra).alias(name)
    return judged.select(*columns, struct), name
