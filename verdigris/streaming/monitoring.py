"""Windowed monitoring of generation requests; each function takes a batch table or a stream.

On a stream rows older than the watermark are dropped. A batch table ignores the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WATERMARK = "10 minutes"
# Ten requests per client and minute.
RATE_LIMIT = 10
RATE_WINDOW = "1 minute"
# Upper bounds in seconds of the duration buckets; the last bucket has no bound.
DURATION_BOUNDS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
]


def with_event_time(df: DataFrame, ts: str, watermark: str = WATERMARK) -> DataFrame:
    """Cast the time column to a timestamp with zone, which a stream's watermark needs."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def _edges() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def rate_limit(
    requests: DataFrame,
    ts: str,
    client: str,
    limit: int = RATE_LIMIT,
    per: str = RATE_WINDOW,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Requests per client and window, whether they exceed the limit, and by how many."""
    counted = (
        with_event_time(requests, ts, watermark)
        .groupBy(F.window(ts, per), F.col(client).alias("client"))
        .agg(F.count(F.lit(1)).alias("n_requests"))
    )
    excess = F.greatest(F.col("n_requests") - limit, F.lit(0).cast("bigint"))
    return counted.select(
        *_edges(), "client", "n_requests",
        (F.col("n_requests") > limit).alias("over_limit"), excess.alias("excess"),
    )


def generation_histogram(
    requests: DataFrame,
    ts: str,
    duration: str,
    per: str = "1 hour",
    slide: str | None = None,
    bounds: Sequence[float] = DURATION_BOUNDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Generations per window, total duration in microseconds, and a cumulative count per bound.

    The total adds integers, so that it does not depend on the order of the rows.
    """
    micros = F.round(F.col(duration) * 1_000_000).cast("bigint")
    buckets = [
        F.count_if(F.col(duration) <= bound).alias(f"le_{str(bound).replace('.', '_')}")
        for bound in bounds
    ]
    return (
        with_event_time(requests, ts, watermark)
        .groupBy(F.window(ts, per, slide))
        .agg(
            F.count(F.lit(1)).alias("n_generations"),
            F.sum(micros).alias("duration_micros"),
            *buckets,
        )
        .select(*_edges(), "n_generations", "duration_micros", *[f"le_{str(b).replace('.', '_')}" for b in bounds])
    )


# Percentiles in percent.
PERCENTILES = {"p50": 50, "p95": 95, "p99": 99}
# Bounds between which latencies are counted: ten to a decade, from a thousandth to ten thousand.
LATENCY_BOUNDS = [
    step / 10 * 10**decade / 1000 for decade in range(7) for step in (10, 12, 16, 20, 25, 32, 40, 50, 63, 80)
] + [10_000.0]


def _percentile(counts: Column, n: Column, percent: int, bounds: Sequence[float], largest: Column) -> Column:
    """Least bound that ``percent`` of the values do not exceed, above all bounds the largest value."""
    rank = F.floor((n * percent + 99) / 100)
    enough = F.filter(
        F.arrays_zip(F.lit(list(bounds)).alias("bound"), counts.alias("count")), lambda c: (c["count"] >= rank) & (n > 0)
    )
    return F.coalesce(F.get(enough, F.lit(0))["bound"], F.when(n > 0, largest))


def service_metrics(
    requests: DataFrame,
    ts: str,
    latency: str,
    is_error: Column,
    is_valid: Column,
    is_cache_hit: Column,
    cost: Column,
    per: str = "1 hour",
    slide: str | None = None,
    bounds: Sequence[float] = LATENCY_BOUNDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Latency percentiles, error, validation and cache-hit rates, and cost per window.

    A percentile is the least of ``bounds`` that so many of the latencies do not exceed. That is its
    definition for tables and streams alike, at any size: a window holds one count per bound, however
    many rows it has. With the default bounds it lies at most a third above the value at that rank. Beyond
    all bounds it is the largest latency of the window, so it is null only where there is none.
    """
    observed = with_event_time(requests, ts, watermark).select(
        ts, latency, is_error.alias("_error"), is_valid.alias("_valid"),
        is_cache_hit.alias("_hit"), cost.alias("_cost"),
    )
    totals = observed.groupBy(F.window(ts, per, slide)).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count(latency).alias("n_timed"),
        F.max(F.col(latency).cast("double")).alias("_largest"),
        F.array(*[F.count_if(F.col(latency) <= bound) for bound in bounds]).alias("_latency"),
        F.count_if("_error").alias("n_errors"),
        F.count_if("_valid").alias("n_valid"),
        F.count_if("_hit").alias("n_hits"),
        F.sum("_cost").alias("total_cost"),
    )
    n = F.col("n_requests")
    return totals.select(
        *_edges(),
        "n_requests",
        *[
            _percentile(F.col("_latency"), F.col("n_timed"), percent, bounds, F.col("_largest")).alias(name)
            for name, percent in PERCENTILES.items()
        ],
        (F.col("n_errors") / n).alias("error_rate"),
        (F.col("n_valid") / n).alias("validation_rate"),
        (F.col("n_hits") / n).alias("cache_hit_rate"),
        (F.col("total_cost") / n).alias("cost_per_request"),
    )


# Significant digits that a quantile keeps: it lies within half of the last one, 0.5 % of the value at most.
DIGITS = 3


def _rounded(value: Column, digits: int) -> Column:
    """The value to so many significant digits; zero, infinities and values too small to scale stay."""
    size = F.abs(value)
    unit = F.pow(F.lit(10.0), F.floor(F.log10(size)) - (digits - 1))
    rounded = F.signum(value) * F.floor(size / unit + 0.5) * unit
    return F.when((size > 1e-290) & (size < 1e300), rounded).otherwise(value)


def latency_quantiles(
    requests: DataFrame, ts: str, value: str, percents: dict[str, int] = PERCENTILES, per: str = "1 hour", slide: str | None = None,
    digits: int = DIGITS, watermark: str = WATERMARK,
) -> DataFrame:
    """(window_start, window_end, n_values, one column per percentile): a mergeable sketch per window.

    The sketch counts values by their first ``digits`` significant digits, so two sketches merge by adding
    counts, in any order and with the same result on a table and on a stream. A percentile is the value
    at its rank, exactly that rank, to so many digits: with three within 0.5 % of it, for values of any
    size. A window holds at most 9 * 10^(digits - 1) counts for each power of ten that occurs, however many
    rows it has. Nulls and NaN are left out. On a stream the output mode is append.
    """
    timed = with_event_time(requests, ts, watermark).select(ts, F.col(value).cast("double").alias("_value"))
    timed = timed.filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    counts = timed.groupBy(F.window(ts, per, slide), _rounded(F.col("_value"), digits).alias("_bucket")).agg(F.count(F.lit(1)).alias("_count"))
    sketches = counts.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("_bucket", "_count"))).alias("_sketch"))
    total = F.aggregate("_sketch", F.lit(0).cast("long"), lambda sum_, each: sum_ + each["_count"])
    sketches = sketches.withColumn("n_values", total)

    def at(percent: int) -> Column:
        rank = F.floor((F.col("n_values") * percent + 99) / 100)
        start = F.struct(F.lit(0).cast("long").alias("passed"), F.lit(None).cast("double").alias("found"))
        walked = F.aggregate(
            "_sketch", start,
            lambda state, each: F.struct(
                (state["passed"] + each["_count"]).alias("passed"),
                F.when(state["found"].isNull() & (state["passed"] + each["_count"] >= rank), each["_bucket"]).otherwise(state["found"]).alias("found"),
            ),
        )
        return walked["found"]

    return sketches.select(*_edges(), "n_values", *[at(percent).alias(name) for name, percent in percents.items()])


def first_requests(
    requests: DataFrame, ts: str, question: str, context: str, watermark: str = WATERMARK
) -> DataFrame:
    """First of equal requests within the watermark delay: what a cache would pass on to the model.

    Stream only. The state of a request expires with the watermark.
    """
    keyed = with_event_time(requests, ts, watermark).withColumns(
        {"question_md5": F.md5(question), "context_md5": F.md5(context)}
    )
    return keyed.dropDuplicatesWithinWatermark(["question_md5", "context_md5"])
