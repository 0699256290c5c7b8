"""Health of API sources from their call log (source, id, ts, ok, latency_ms), and metric roll-ups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions.scalars import error_tier, shorten_error
from tradelake.operators.position import with_position
from tradelake.operators.topk import first_per_key

ROLLING_CALLS = 100
EMA_ALPHA = 0.2
CHUNK = 50_000
# Natural logarithm of the smallest positive double, rounded up: weights below it are zero.
_SMALLEST = 746.0
# Weights within a block of calls differ by e to this power at most, far from what a double can hold.
_BLOCK_RANGE = 230.0
# With this alpha or a larger one an average of zeros falls to exactly zero; with a smaller one it never does.
_REACHES_ZERO = 0.5


def _failed() -> Column:
    return F.when(F.col("ok"), 0).otherwise(1)


def _newest(calls: DataFrame, n: int) -> DataFrame:
    """The newest n calls of each source, with `age` 1 for the newest."""
    return first_per_key(calls, ["source"], [F.col("ts").desc(), F.col("id").desc()], n, "age")


def rolling_error_rate(calls: DataFrame, size: int = ROLLING_CALLS, chunk: int = CHUNK) -> DataFrame:
    """Share of failures among each call and the `size` - 1 calls of its source before it.

    Rows are numbered per source and cut into chunks, which hold `size` rows at least; each chunk also gets the
    last rows of the one before it, so no task holds more than two chunks, however many calls a source has.
    """
    length = max(chunk, size)
    numbered = with_position(calls.select("source", "id", "ts", "ok"), ["source"], ["ts", "id"])
    index = F.col("position") - 1
    home = F.floor(index / length)
    chunks = F.when(index % length >= length - (size - 1), F.array(home, home + 1)).otherwise(F.array(home))
    recent = Window.partitionBy("source", "chunk").orderBy("position").rowsBetween(1 - size, 0)
    return (
        numbered.withColumn("home", home)
        .withColumn("chunk", F.explode(chunks))
        .withColumn("error_rate", F.avg(_failed()).over(recent))
        .where(F.col("chunk") == F.col("home"))
        .select("source", "id", "ts", "ok", "error_rate", error_tier(F.col("error_rate")).alias("status"))
    )


def source_health(calls: DataFrame, size: int = ROLLING_CALLS) -> DataFrame:
    """Each source's state now: error rate of its last `size` calls, tier, last success and failure."""
    recent = (
        _newest(calls, size)
        .groupBy("source")
        .agg(F.avg(_failed()).alias("error_rate"), F.count(F.lit(1)).alias("recent_calls"))
    )
    ever = calls.groupBy("source").agg(
        F.count(F.lit(1)).alias("requests"),
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_success_ts"),
        F.max(F.when(~F.col("ok"), F.col("ts"))).alias("last_failure_ts"),
    )
    return recent.join(ever, "source").select(
        "source",
        "requests",
        "recent_calls",
        "error_rate",
        error_tier(F.col("error_rate")).alias("status"),
        "last_success_ts",
        "last_failure_ts",
    )


def source_status(calls: DataFrame, error_length: int = 500) -> DataFrame:
    """Each source's calls in a row that ended as its last one did, and its last error, cut to `error_length`.

    One of consecutive_failures and consecutive_successes is 0. Both come from the places of the last success and the
    last failure, in aggregates that are combined per task before anything is moved.
    """
    at = F.struct("ts", "id")
    last = calls.groupBy("source").agg(
        F.max(F.when(F.col("ok"), at)).alias("last_ok"),
        F.max(F.when(~F.col("ok"), at)).alias("last_failed"),
        shorten_error(F.max_by("error", F.when(~F.col("ok"), at)), error_length).alias("last_error"),
    )
    after = lambda place: F.count_if(F.col(place).isNull() | (at > F.col(place)))
    counted = calls.join(last.select("source", "last_ok", "last_failed"), "source").groupBy("source").agg(
        after("last_ok").alias("consecutive_failures"), after("last_failed").alias("consecutive_successes")
    )
    return counted.join(last.select("source", "last_error"), "source")


def failure_runs(calls: DataFrame, at_least: int = 5) -> DataFrame:
    """Runs of consecutive failures of a source: start, end, length.

    Within a run, position among all calls and position among the failures grow together, so their
    difference names the run. Both positions are computed without gathering a source in one task.
    """
    log = calls.select("source", "id", "ts", "ok")
    failures = with_position(log, ["source"], ["ts", "id"], "among_all").where(~F.col("ok"))
    numbered = with_position(failures, ["source"], ["ts", "id"], "among_failures")
    return (
        numbered.groupBy("source", (F.col("among_all") - F.col("among_failures")).alias("run"))
        .agg(
            F.min("ts").alias("run_start"),
            F.max("ts").alias("run_end"),
            F.min("id").alias("first_id"),
            F.count(F.lit(1)).alias("failures"),
        )
        .where(F.col("failures") >= at_least)
        .drop("run")
    )


def latency_ema(calls: DataFrame, alpha: float = EMA_ALPHA) -> DataFrame:
    """Exponential moving average of the latency of each source's successful calls, as of its last one.

    The first value other than zero seeds the average, wherever it lies. Written out, the average is a sum of
    latencies with weights that fall by 1 - alpha per call. Calls so old that their weight is zero in a double
    add nothing, so the newest calls of a source are enough, and their number follows from `alpha`.

    From `alpha` 0.5 on, zeros halve the average down to zero, after which the next call seeds it anew; see
    `latency_ema_each`. Below, the smallest double times 1 - alpha is rounded to itself, so only the first call seeds.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    done = calls.where("ok")
    steps_left = 1 if alpha == 1 else math.ceil(_SMALLEST / -math.log1p(-alpha)) + 1
    if _REACHES_ZERO <= alpha < 1:
        # Whether a call seeds depends on as many calls before it.
        each = latency_ema_each(_newest(done, 4 * steps_left).select(*calls.columns), alpha)
        last = _newest(each, 1).select("source", "avg_response_ms")
        return last.withColumn("avg_response_s", F.col("avg_response_ms") / 1000)
    first = done.where("latency_ms <> 0").groupBy("source").agg(F.min(F.struct("ts", "id")).alias("seed"))
    aged = _newest(done, steps_left).join(first, "source", "left")
    steps = F.col("age") - 1
    decay = F.pow(F.lit(1 - alpha), steps)
    at = F.struct("ts", "id")
    weight = F.when(at == F.col("seed"), decay).otherwise(decay * alpha)
    averages = aged.groupBy("source").agg(F.sum(F.col("latency_ms") * weight).alias("avg_response_ms"))
    return averages.withColumn("avg_response_s", F.col("avg_response_ms") / 1000)


def latency_ema_each(calls: DataFrame, alpha: float = EMA_ALPHA, block: int = CHUNK) -> DataFrame:
    """The moving average after each successful call: source, id, ts, latency_ms, avg_response_ms.

    The rule is the plain recursion's: a call moves the average by `alpha` of the way to its latency, and where the
    average is zero the call's latency becomes the average. Failed calls and calls without a latency change nothing.

    Each step is an affine map x -> ax + b, and so are all steps of a block of calls together. Blocks have at most
    `block` calls, and so few that their weights fit a double. The average at the start of a block is the sum of what
    the blocks before it leave; blocks whose weight is zero in a double leave nothing, so every block looks back
    over a fixed number of others and no source's blocks are gathered anywhere.

    Calls that seed the average weigh 1 instead of `alpha`. They are the first call other than zero, and from `alpha`
    0.5 on every such call before which a first pass finds zero. That pass takes `alpha` as every weight and so
    may find zero a call earlier than the recursion.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    latency = F.col("latency_ms")
    done = calls.where(F.col("ok") & latency.isNotNull() & ~F.isnan(latency)).select("source", "id", "ts", "latency_ms")
    if alpha == 1:
        return done.withColumn("avg_response_ms", latency)
    fall = -math.log1p(-alpha)
    size = max(1, min(block, int(_BLOCK_RANGE / fall)))
    index = F.col("position") - 1
    # The struct is never null, so calls of a null source meet in joins too.
    rows = with_position(done, ["source"], ["ts", "id"]).withColumns(
        {"of": F.struct("source"), "block": F.floor(index / size), "step": index % size}
    )
    if alpha < _REACHES_ZERO:
        first = rows.where(latency != 0).groupBy("of").agg(F.min("position").alias("seed"))
        # Only the block with the seed meets it, so a busy source's rows are not joined on the source.
        first = first.withColumn("block", F.floor((F.col("seed") - 1) / size))
        rows = rows.join(first, ["of", "block"], "left")
        seeds = F.coalesce(F.col("position") == F.col("seed"), F.lit(False))
    else:
        rows = _averages(rows.withColumn("weight", F.lit(alpha)), 1 - alpha, size)
        seeds = (F.col("before") == 0) & (latency != 0)
    weighed = rows.withColumn("weight", F.when(seeds, 1.0).otherwise(alpha))
    return _averages(weighed, 1 - alpha, size).select(*done.columns, F.col("after").alias("avg_response_ms"))


def _averages(rows: DataFrame, kept: float, size: int) -> DataFrame:
    """`rows` with the average before and after each, by source (`of`), `block`, `step` and `weight`."""
    power = lambda exponent: F.pow(F.lit(kept), exponent)
    step = F.col("step")
    value = F.col("weight") * F.col("latency_ms")
    # The last block of a source may be shorter, but nothing follows it.
    left = rows.groupBy("of", "block").agg(F.sum(value * power(size - 1 - step)).alias("left"))
    reach = math.ceil(_SMALLEST / (size * -math.log(kept))) + 1
    ahead = left.select("of", "block", "left", F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("j"))
    start = ahead.groupBy("of", (F.col("block") + F.col("j")).alias("block")).agg(
        F.sum(F.col("left") * power((F.col("j") - 1) * size)).alias("start")
    )
    so_far = Window.partitionBy("of", "block").orderBy("step")
    until = lambda end: F.coalesce(F.sum(value * power(-step)).over(so_far.rowsBetween(Window.unboundedPreceding, end)), F.lit(0.0))
    begun = F.coalesce("start", F.lit(0.0))
    return (
        rows.drop("before", "after")
        .join(start, ["of", "block"], "left")
        .withColumns(
            {"before": begun * power(step) + until(-1) * power(step - 1), "after": begun * power(step + 1) + until(0) * power(step)}
        )
        .drop("start")
    )


def metric_rollup(
    points: DataFrame, period: str = "5 minutes", by: tuple[str, ...] = ("metric", "source"), ts: str = "ts"
) -> DataFrame:
    """Sum, mean, median, p99, maximum and count of metric points per period.

    Works on a stream too, when `points` has a watermark on `ts`.
    """
    value = F.col("value")
    return (
        points.groupBy(F.window(ts, period).alias("w"), *by)
        .agg(
            F.sum(value).alias("sum_value"),
            F.avg(value).alias("avg_value"),
            F.percentile_approx(value, 0.5, 10000).alias("p50_value"),
            F.percentile_approx(value, 0.99, 10000).alias("p99_value"),
            F.max(value).alias("max_value"),
            F.count(F.lit(1)).alias("points"),
        )
        .select(
            F.col("w.start").alias("period_start"),
            *by,
            "sum_value",
            "avg_value",
            "p50_value",
            "p99_value",
            "max_value",
            "points",
        )
    )


def metric_summary(
    points: DataFrame, period: str = "1 minute", by: tuple[str, ...] = ("metric", "source"), error: float = 0.01
) -> DataFrame:
    """Metric points per period as counts that add up: a row per period, `by` and range of values.

    A range (`sign`, `bucket`) holds the values between two neighbouring powers of (1 + error) / (1 - error), so that
    one value within it stands for all with a relative error of at most `error`; zero has a range of its own. Summaries
    of one `error` and period, of other files or days, may be put together with a union. Points that are null or NaN
    are left out. Aggregated per task before the shuffle, however many points a period has.
    """
    if not 0 < error < 1:
        raise ValueError("error must be above 0 and below 1")
    value = F.col("value")
    bucket = F.when(value == 0, 0).otherwise(F.ceil(F.log(F.abs(value)) / math.log((1 + error) / (1 - error)))).cast("int")
    return (
        points.where(value.isNotNull() & ~F.isnan(value))
        .groupBy(F.window("ts", period).alias("w"), *by, F.signum(value).cast("int").alias("sign"), bucket.alias("bucket"))
        .agg(F.sum(value).alias("sum_value"), F.max(value).alias("max_value"), F.count(F.lit(1)).alias("points"))
        .select(F.col("w.start").alias("period_start"), *by, "sign", "bucket", "sum_value", "max_value", "points")
    )


def widen_summary(summary: DataFrame, period: str, by: tuple[str, ...] = ("metric", "source")) -> DataFrame:
    """A summary for a longer period, a multiple of the summary's own, or by fewer columns."""
    return (
        summary.groupBy(F.window("period_start", period).alias("w"), *by, "sign", "bucket")
        .agg(F.sum("sum_value").alias("sum_value"), F.max("max_value").alias("max_value"), F.sum("points").alias("points"))
        .select(F.col("w.start").alias("period_start"), *by, "sign", "bucket", "sum_value", "max_value", "points")
    )


def summary_rollup(summary: DataFrame, by: tuple[str, ...] = ("metric", "source"), error: float = 0.01) -> DataFrame:
    """The columns of `metric_rollup` from a summary made with `error`; median and p99 are off by that share at most.

    A quantile is the discrete one: the smallest value that at least that share of the points does not exceed. A task
    holds the ranges of one period, of which there are as many as orders of magnitude allow, not its points.
    """
    keys = ["period_start", *by]
    growth = (1 + error) / (1 - error)
    ordered = Window.partitionBy(*keys).orderBy("sign", F.col("sign") * F.col("bucket"))
    ranked = summary.withColumns(
        {
            "upto": F.sum("points").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
            "all": F.sum("points").over(Window.partitionBy(*keys)),
            "stands": F.col("sign") * 2 * F.pow(F.lit(growth), F.col("bucket")) / (growth + 1),
        }
    )
    quantile = lambda q: F.min_by("stands", F.when(F.col("upto") >= F.col("all") * q, F.col("upto")))
    return (
        ranked.groupBy(*keys)
        .agg(
            F.sum("sum_value").alias("sum_value"),
            (F.sum("sum_value") / F.sum("points")).alias("avg_value"),
            quantile(0.5).alias("p50_value"),
            quantile(0.99).alias("p99_value"),
            F.max("max_value").alias("max_value"),
            F.sum("points").alias("points"),
        )
    )


def metric_alarms(
    points: DataFrame,
    threshold: float = 2,
    period: str = "1 hour",
    by: tuple[str, ...] = ("metric", "source"),
) -> DataFrame:
    """Periods whose sum is above the threshold. A period without points does not alarm."""
    return (
        points.groupBy(F.window("ts", period).alias("w"), *by)
        .agg(F.sum("value").alias("sum_value"))
        .where(F.col("sum_value") > threshold)
        .select(F.col("w.start").alias("period_start"), *by, "sum_value")
    )


def call_points(calls: DataFrame) -> DataFrame:
    """Call log as metric points: one success or failure count, and the response time."""
    return calls.select(
        "ts",
        "source",
        F.explode(
            F.array(
                F.struct(
                    F.when(F.col("ok"), "APISuccessCount").otherwise("APIErrorCount").alias("metric"),
                    F.lit(1.0).alias("value"),
                ),
                F.struct(
                    F.lit("ExchangeResponseTime").alias("metric"), F.col("latency_ms").alias("value")
                ),
            )
        ).alias("point"),
    ).select("ts", "source", "point.metric", "point.value")
