"""Gaps between neighbours: in time (lag) and in trade ids (lead).

A window over a whole product would put all rows of a busy product into one task. Here rows are first
folded into cells of fixed width (one second, or 64 ids); neighbours are then compared within a block of
cells, and after that at the edges of neighbouring blocks. A block holds a fixed number of cells at most,
so no window group grows with the data. A gap needs nothing but the two rows at its ends, so every gap is
found on exactly one level.

Sums over gaps (`id_gap_sums`, `gap_lengths`) run in one pass. Lists of gaps (`id_gaps`, `time_gaps`) unite
the levels, and write the folded rows to the shared folder first, because every level reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions.scalars import quantile_of_counts, ratio, whole_units
from tradelake.operators.profile import id_words
from tradelake.schema import PRODUCT
from tradelake.session import materialize

# A block is 2**20 cells. 64-bit ids are 2**58 words, so two levels of blocks leave 2**18 per product.
_BLOCK_BITS, _LEVELS = 20, 2

WEEK = 7 * 86400


def _ahead(column: str, group: list[str], order: str) -> Column:
    return F.lead(column).over(Window.partitionBy(*PRODUCT, *group).orderBy(order))


# --- time ---------------------------------------------------------------------------------------------


def rolled_seconds(trades: DataFrame) -> DataFrame:
    """First and last trade of every second in which a product traded."""
    return (
        trades.where(F.col("trade_ts").isNotNull())
        .groupBy(*PRODUCT, F.date_trunc("second", "trade_ts").alias("second"))
        .agg(F.min("trade_ts").alias("first_ts"), F.max("trade_ts").alias("last_ts"))
    )


def _day() -> Column:
    return F.date_trunc("day", "second")


def time_gaps(trades: DataFrame) -> DataFrame:
    """Every gap of a whole second or more between consecutive trades of a product.

    Columns: exchange, symbol, gap_start, gap_end, gap_seconds (complete seconds). Shorter gaps count as 0
    seconds and are left out; a product with n trades has n - 1 gaps in all.
    """
    return time_gaps_of_seconds(written_seconds(trades))


def written_seconds(trades: DataFrame) -> DataFrame:
    """The roll-up by second as a table: at most 86,400 rows per product and day."""
    return materialize(rolled_seconds(trades), "seconds")


def time_gaps_of_seconds(seconds: DataFrame) -> DataFrame:
    seconds = seconds.withColumn("day", _day())
    days = seconds.groupBy(*PRODUCT, "day").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )

    def pairs(cells: DataFrame, group: list[str], order: str) -> DataFrame:
        return cells.select(
            *PRODUCT, F.col("last_ts").alias("gap_start"), _ahead("first_ts", group, order).alias("gap_end")
        ).where(F.col("gap_end").isNotNull())

    return (
        pairs(seconds, ["day"], "second")
        .unionByName(pairs(days, [], "day"))
        .withColumn("gap_seconds", whole_units("SECOND", F.col("gap_start"), F.col("gap_end")))
        .where(F.col("gap_seconds") > 0)
    )


def longest_gaps(trades: DataFrame) -> DataFrame:
    """Length in microseconds of each product's longest gap of at least a second."""
    micros = F.unix_micros("next_ts") - F.unix_micros("last_ts")
    days = (
        rolled_seconds(trades)
        .withColumn("day", _day())
        .withColumn("next_ts", _ahead("first_ts", ["day"], "second"))
        .groupBy(*PRODUCT, "day")
        .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.max(micros).alias("inner"))
    )
    return (
        days.withColumn("next_ts", _ahead("first_ts", [], "day"))
        .groupBy(*PRODUCT)
        .agg(F.greatest(F.max("inner"), F.max(micros)).alias("gap_micros"))
    )


def gap_lengths(seconds: DataFrame) -> DataFrame:
    """Number `n` of gaps per product and length in whole seconds, from the roll-up by second.

    The last second of a day has its neighbour on another day. Such rows become one edge row per day, which
    goes through the count by length beside the gaps inside the days, and meets its neighbour after it.
    """
    block = Window.partitionBy(*PRODUCT, "day")
    cells = seconds.withColumn("day", _day()).select(
        *PRODUCT,
        "day",
        "last_ts",
        _ahead("first_ts", ["day"], "second").alias("next_ts"),
        F.min("first_ts").over(block).alias("day_first"),
    )
    edge = F.col("next_ts").isNull()
    counted = (
        cells.select(
            *PRODUCT,
            whole_units("SECOND", F.col("last_ts"), F.col("next_ts")).alias("gap_seconds"),
            F.when(edge, F.col("day")).alias("day"),
            F.when(edge, F.col("day_first")).alias("first_ts"),
            F.when(edge, F.col("last_ts")).alias("last_ts"),
        )
        .where(F.col("gap_seconds").isNull() | (F.col("gap_seconds") > 0))
        .groupBy(*PRODUCT, "gap_seconds", "day")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
        )
    )
    # From here a product has one row per length and one per day.
    across = whole_units("SECOND", F.col("last_ts"), _ahead("first_ts", [], "day"))
    return (
        counted.select(*PRODUCT, "n", F.coalesce("gap_seconds", F.when(F.col("day").isNotNull(), across)).alias("gap_seconds"))
        .where(F.col("gap_seconds") > 0)
        .groupBy(*PRODUCT, "gap_seconds")
        .agg(F.sum("n").alias("n"))
    )


def scored_lengths(lengths: DataFrame) -> DataFrame:
    """Gap lengths with the product's statistics and the z-score of each length.

    The statistics leave out gaps of a week or more (edges of the data), but every length is scored. A
    product has at most 604,799 shorter lengths and one row per longer gap, so its rows fit one task
    whatever the number of trades. `seen` counts the gaps up to each length.
    """
    n, length = F.col("n"), F.col("gap_seconds")
    short = length < WEEK
    product = Window.partitionBy(*PRODUCT)
    running = product.orderBy("gap_seconds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = lengths.select(
        "*",
        F.sum("n").over(running).alias("seen"),
        F.sum(F.when(short, n)).over(product).alias("intervals"),
        F.sum(F.when(short, n * length)).over(product).alias("seconds"),
        F.max(F.when(short, length)).over(product).alias("max_gap"),
    ).withColumn("avg_gap", F.col("seconds") / F.col("intervals"))
    squares = F.sum(F.when(short, n * F.pow(length - F.col("avg_gap"), 2))).over(product)
    return (
        totals.where(F.col("intervals").isNotNull())
        .withColumn("std_gap", F.sqrt(squares / F.nullif(F.col("intervals") - 1, F.lit(0))))
        .withColumn("z", ratio(length - F.col("avg_gap"), F.col("std_gap")))
    )


def length_quantile(share: float) -> Column:
    """Discrete quantile of a product's shorter gaps, as an aggregate over scored_lengths."""
    short = F.when(F.col("gap_seconds") < WEEK, F.col("gap_seconds"))
    return quantile_of_counts(short, F.col("seen"), F.col("intervals"), share)


# --- ids ----------------------------------------------------------------------------------------------


def _with_holes(words: DataFrame) -> DataFrame:
    """Numeric words with `holes`: one bit per id that is missing between the word's first and last id.

    Bit i stands for id min_id + i. The first and the last id are present, so bit 0 is never set.
    """
    span = "max_id - min_id"
    return words.where(F.col("id_word").isNotNull()).withColumn(
        "holes",
        F.expr(
            f"case when {span} < 2 then 0L else "
            f"shiftrightunsigned(~id_bits, cast(min_id & 63 as int)) & "
            f"shiftrightunsigned(-1L, cast(64 - ({span}) as int)) end"
        ),
    )


def _with_hole_sums(words: DataFrame) -> DataFrame:
    """Add number and length of the runs of missing ids inside each word, from its bits alone.

    h<k> has a bit where a run of at least k missing ids starts.
    """
    steps = {
        "h1": "holes",
        "h2": "h1 & shiftrightunsigned(h1, 1)",
        "h4": "h2 & shiftrightunsigned(h2, 2)",
        "h8": "h4 & shiftrightunsigned(h4, 4)",
        "h16": "h8 & shiftrightunsigned(h8, 8)",
        "h32": "h16 & shiftrightunsigned(h16, 16)",
        "h11": "h8 & shiftrightunsigned(h8, 3)",
        "at": "-1L",
        "largest": "0",
    }
    for name, value in steps.items():
        words = words.withColumn(name, F.expr(value))
    # Length of the longest run, found bit by bit from 32 down.
    for k in (32, 16, 8, 4, 2, 1):
        words = (
            words.withColumn("longer", F.expr(f"at & shiftrightunsigned(h{k}, largest)"))
            .withColumn("largest", F.expr(f"largest + case when longer <> 0 then {k} else 0 end"))
            .withColumn("at", F.expr("case when longer <> 0 then longer else at end"))
        )

    def runs(bits: str) -> Column:
        return F.expr(f"cast(bit_count({bits} & ~shiftrightunsigned({bits}, 1)) as bigint)")

    return words.select(
        *PRODUCT,
        "id_word",
        "min_id",
        "max_id",
        "trades",
        F.bit_count("id_bits").cast("bigint").alias("ids"),
        F.bit_count("holes").cast("bigint").alias("missing"),
        runs("h1").alias("occurrences"),
        F.col("largest").cast("bigint").alias("largest"),
        runs("h11").alias("over_10"),
        F.lit(0).cast("bigint").alias("over_100"),
    )


def id_gap_sums(trades: DataFrame) -> DataFrame:
    """Per product: rows and distinct ids (numeric ones), id range, and the runs of missing ids.

    Columns: trades, ids, min_id, max_id, missing, occurrences, largest, over_10, over_100. Each level adds
    the gaps between the cells of a block and makes the block a cell of the next level; the sum by block
    needs no further shuffle, as the rows already lie together.
    """
    sums = ["trades", "ids", "missing", "occurrences", "over_10", "over_100"]
    cells = _with_hole_sums(_with_holes(id_words(trades))).withColumnRenamed("id_word", "cell")
    for level in range(_LEVELS + 1):
        group = ["block"] if level < _LEVELS else []
        if group:
            cells = cells.withColumn("block", F.shiftright("cell", _BLOCK_BITS))
        step = F.try_subtract(_ahead("min_id", group, "cell"), F.col("max_id"))
        gap = F.try_subtract(step, F.lit(1))
        cells = cells.withColumn("gap", F.greatest(F.lit(0), F.coalesce(gap, F.lit(0))))
        found = {
            "missing": F.col("gap"),
            "occurrences": (F.col("gap") > 0).cast("bigint"),
            "over_10": (F.col("gap") > 10).cast("bigint"),
            "over_100": (F.col("gap") > 100).cast("bigint"),
        }
        cells = cells.groupBy(*PRODUCT, *group).agg(
            F.min("min_id").alias("min_id"),
            F.max("max_id").alias("max_id"),
            F.greatest(F.max("largest"), F.max("gap")).alias("largest"),
            *[F.sum(F.col(c) + found[c] if c in found else F.col(c)).alias(c) for c in sums],
        )
        if group:
            cells = cells.withColumnRenamed("block", "cell")
    return cells


def written_words(trades: DataFrame, *extra: str) -> DataFrame:
    """The id roll-up as a table: at most one row per 64 ids and other id text of a product.

    Holds the id columns, the row count and the named further columns of id_words.
    """
    kept = [*PRODUCT, "id_word", "id_text", "id_bits", "min_id", "max_id", "trades", *extra]
    return materialize(id_words(trades).select(*kept), "words")


def _gaps_inside(holed: DataFrame) -> DataFrame:
    """The runs of missing ids inside words, one row each."""
    starts = F.expr("shiftright(holes, i) & 1 = 1 and shiftright(holes, i - 1) & 1 = 0")
    # The run is the trailing ones of the shifted bits; x ^ (x + 1) sets them and one more.
    length = F.expr("bit_count(shiftright(holes, i) ^ (shiftright(holes, i) + 1)) - 1")
    return (
        holed.select(*PRODUCT, "min_id", "holes", F.explode(F.expr("sequence(1, cast(max_id - min_id as int) - 1)")).alias("i"))
        .where(starts)
        .select(
            *PRODUCT,
            (F.col("min_id") + F.col("i") - 1).alias("last_seen_id"),
            (F.col("min_id") + F.col("i") + length).alias("next_seen_id"),
            length.cast("bigint").alias("missing"),
        )
    )


def _gaps_between(words: DataFrame) -> DataFrame:
    """The runs of missing ids between words, one row each."""
    cells = words.where(F.col("id_word").isNotNull()).select(
        *PRODUCT, F.col("id_word").alias("cell"), "min_id", "max_id"
    )
    found = None
    for level in range(_LEVELS + 1):
        group = ["block"] if level < _LEVELS else []
        if group:
            cells = cells.withColumn("block", F.shiftright("cell", _BLOCK_BITS))
        pairs = cells.select(
            *PRODUCT,
            F.col("max_id").alias("last_seen_id"),
            _ahead("min_id", group, "cell").alias("next_seen_id"),
        )
        found = pairs if found is None else found.unionByName(pairs)
        if group:
            cells = (
                cells.groupBy(*PRODUCT, "block")
                .agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"))
                .withColumnRenamed("block", "cell")
            )
    step = F.try_subtract("next_seen_id", "last_seen_id")
    return found.withColumn("missing", F.try_subtract(step, F.lit(1))).where(F.col("missing") > 0)


def id_gaps(trades: DataFrame) -> DataFrame:
    """Every run of missing ids between two consecutive numeric ids of a product.

    Columns: exchange, symbol, last_seen_id, next_seen_id, missing. Repeated ids open no gap.
    """
    words = written_words(trades)
    holed = _with_holes(words).where("holes <> 0")
    return _gaps_inside(holed).unionByName(_gaps_between(words))


def longest_id_gaps(trades: DataFrame, n: int) -> DataFrame:
    """The n longest runs of missing ids, as id_gaps; equal ones by product and id.

    A gap among the n longest lies in one of the n words with the longest gap (equal ones in the same order),
    so only those words are unpacked.
    """
    words = written_words(trades)
    place = [F.col(c).asc() for c in PRODUCT]
    holed = _with_holes(words).where("holes <> 0")
    ranked = _with_hole_sums(holed).select(*PRODUCT, "id_word", "largest")
    top = ranked.orderBy(F.col("largest").desc(), *place, "id_word").limit(n).select(*PRODUCT, "id_word")
    inside = _gaps_inside(holed.join(F.broadcast(top), [*PRODUCT, "id_word"], "left_semi"))
    both = inside.unionByName(_gaps_between(words))
    return both.orderBy(F.col("missing").desc(), *place, "last_seen_id").limit(n)
