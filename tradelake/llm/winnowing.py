"""Document fingerprints by winnowing.

A text is read as units: the runs between white space of any script, and of a run longer than SPAN characters all its
stretches of SPAN characters, one starting at each character. Every `k` consecutive units give a hash, and of every
`window` consecutive hashes the smallest is chosen, the rightmost among equal ones. The chosen hashes with their
positions are the fingerprint. Two texts that share `k + window - 1` consecutive units share a chosen hash inside them;
the positions say where. Such a passage is as many words, or `SPAN + k + window - 2` characters inside long runs,
wherever it starts in them.
All of it is SQL on one row at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import MIN_LONG, let, shuffle_partitions, texts

K = 4
WINDOW = 4
SPAN = 16
# At each character of a long run that has SPAN characters after it, and else to the end of the run; the group is the unit.
_UNIT = r"(?=(\P{IsWhite_Space}{1,%d}+))(?:\P{IsWhite_Space}(?=\P{IsWhite_Space}{%d})|\P{IsWhite_Space}++)" % (SPAN, SPAN)
# Ranges of ids per shuffle partition when neighbours are brought together.
RANGES_PER_PARTITION = 16


def _upto(last: Column) -> Column:
    """0, 1, ..., last; none if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.expr("cast(array() as array<int>)"))


def winnow(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """struct(hashes, positions) of the chosen k-grams; positions count units from 0.

    Fewer than `k` units are one k-gram, fewer than `window` k-grams one window; no unit gives empty arrays.
    """

    def grams(units: Column) -> Column:
        return let(
            F.transform(units, lambda u: F.xxhash64(u)),
            lambda h: F.when(
                F.size(units) > 0,
                F.transform(
                    _upto(F.greatest(F.size(units) - k, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])
                ),
            ).otherwise(F.expr("cast(array() as array<bigint>)")),
        )

    def positions(g: Column) -> Column:
        smallest = F.when(
            F.size(g) > 0,
            F.transform(
                _upto(F.greatest(F.size(g) - window, F.lit(0))), lambda i: F.least(*[F.get(g, i + j) for j in range(window)])
            ),
        ).otherwise(F.expr("cast(array() as array<bigint>)"))

        def rightmost(least: Column, i: Column) -> Column:
            found = F.when(F.get(g, i + (window - 1)) == least, i + (window - 1))
            for j in range(window - 2, -1, -1):
                found = found.when(F.get(g, i + j) == least, i + j)
            return found

        return let(smallest, lambda s: F.array_distinct(F.transform(s, rightmost)))

    units = F.regexp_extract_all(text, F.lit(_UNIT))
    return let(
        let(units, grams),
        lambda g: let(
            positions(g),
            lambda p: F.struct(F.transform(p, lambda i: F.get(g, i)).alias("hashes"), p.alias("positions")),
        ),
    )


def digest(chosen: Column) -> Column:
    """128 bits as hex of all chosen hashes with their positions."""
    return F.lower(
        F.concat(
            F.lpad(F.hex(F.xxhash64(chosen.hashes, chosen.positions)), 16, "0"),
            F.lpad(F.hex(F.xxhash64(chosen.positions, F.lit(1), chosen.hashes)), 16, "0"),
        )
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the chosen hashes; two empty fingerprints are alike."""
    both = F.size(F.array_union(a.hashes, b.hashes))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a.hashes, b.hashes)) / both)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes, positions of each row; a null text counts as empty, repeated rows give repeated results."""
    chosen = texts(docs).select("doc_id", winnow(F.col("text"), k, window).alias("chosen"))
    return chosen.select("doc_id", "chosen.hashes", "chosen.positions")


def with_next(rows: DataFrame, key: str, *tie: str) -> DataFrame:
    """Brings every row next to its follower by `key`, the last row next to the first.

    Rows are dealt to ranges of keys; the first rows of a range are also sent to the range before, marked `ghost`.
    Returns the rows with `range` and `ghost`; a window over `next_window(key, *tie)` then sees each follower.
    A null key comes first, tied keys are ordered by `tie`. Bounds are quantiles of the keys, a few per partition.
    """
    spark = rows.sparkSession
    ranges = RANGES_PER_PARTITION * shuffle_partitions(spark)
    known = F.coalesce(F.col(key), F.lit(MIN_LONG))
    keyed = rows.withColumn("range_key", known)
    low, cuts = rows.select(known.alias("x")).agg(
        F.min("x"), F.percentile_approx("x", [i / ranges for i in range(1, ranges)], 20 * ranges)
    ).first()
    bounds = sorted({low, *(cuts or [])}) if low is not None else [MIN_LONG]
    step = max(1, int(len(bounds) ** 0.5))
    every = F.lit(bounds).cast("array<bigint>")
    coarse = F.lit(bounds[::step]).cast("array<bigint>")
    # The range is the number of bounds not above the key, less one: first among every step-th bound, then within the step.
    block = let(
        F.size(F.filter(coarse, lambda b: b <= F.col("range_key"))) - 1,
        lambda c: c * step + F.size(F.filter(F.slice(every, c * step + 1, F.lit(step)), lambda b: b <= F.col("range_key"))) - 1,
    )
    n = len(bounds)
    placed = keyed.withColumn("range", block)
    first = F.element_at(every, F.col("range") + 1) == F.col("range_key")
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.pmod(F.col("range") - 1, F.lit(n)).alias("range"), F.lit(1).alias("ghost"))
    dealt = placed.withColumn("to", F.explode(F.when(first, F.array(own, ghost)).otherwise(F.array(own))))
    return dealt.drop("range").select("*", "to.range", "to.ghost").drop("to")


def next_window(*tie: str):
    return Window.partitionBy("range").orderBy("ghost", "range_key", *tie)


def edit_and_compare(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document are.

    The edited text has the last floor(n/2) code points replaced by the first as many of the next document. A null
    text counts as empty; rows with one id follow each other in order of their texts; a lone row follows itself.
    """
    together = with_next(texts(docs), "doc_id", "text")
    following = next_window("text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - half), F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), half)
    )
    chosen = (
        together.withColumn("next_text", F.lead("text").over(following))
        .select("range", "ghost", "range_key", "doc_id", "text", edited.alias("edited"))
        .withColumn("own", winnow(F.col("text"), k, window))
        .withColumn("next", F.lead("own").over(following))
        .where("ghost = 0")
        .withColumn("other", winnow(F.col("edited"), k, window))
    )
    return chosen.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        digest(F.col("own")).alias("fingerprint"),
        digest(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
        F.size("own.hashes").alias("n_chosen"),
    )
