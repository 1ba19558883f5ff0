"""One decision per request: admitted or denied by a limit, answered from a cache or passed on.

Each has a form for tables, made of window functions, and one for streams, made of keyed state with
event-time timers, which agree row by row. Both look at requests in the order they came in, given by a
column that names a row; event times may be out of that order. A stream drops rows older than its
watermark, like every monitor. Its state store must be the one that keyed state needs (RocksDB).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from verdigris.streaming.monitoring import RATE_LIMIT, RATE_WINDOW, WATERMARK, with_event_time

# Fixed value: how long an answer that nobody asks for stays in the cache.
CACHE_IDLE = "1 hour"


def _together(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    """What a key got in one micro-batch, in order of arrival. The source's trigger options bound it."""
    return pd.concat(list(rows)).sort_values(order, kind="stable")


class _Limiter(StatefulProcessor):
    """Counts the requests of one client in one window; the count goes when the window can get no more."""

    def __init__(self, order: str, limit: int):
        self.order, self.limit = order, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _together(rows, self.order)
        if self.count.exists():
            before = self.count.get()[0]
        else:
            before = 0
            self.handle.registerTimer(int(found["window_end_millis"].iloc[0]))
        found["admitted"] = [number < self.limit for number in range(before, before + len(found))]
        self.count.update((before + len(found),))
        yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.count.clear()
        yield from ()

    def close(self) -> None:
        pass


def _windowed(requests: DataFrame, ts: str, per: str, watermark: str) -> DataFrame:
    timed = with_event_time(requests, ts, watermark).withColumn("_window", F.window(ts, per))
    return timed.withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}).drop("_window")


def admit_requests(
    requests: DataFrame, ts: str, client: str, order: str, limit: int = RATE_LIMIT, per: str = RATE_WINDOW,
    watermark: str = WATERMARK,
) -> DataFrame:
    """The requests with window_start, window_end, and whether each is admitted.

    A client has ``limit`` requests in a window of event time; the first ones to come in are admitted. A
    null client is a client; rows without a time are left out. ``order`` names a row.

    On a table the last admitted request of each client and window is found by a rank limit that runs
    before the shuffle, so that a client with very many requests is no task of its own. On a stream there
    is one counter per client and window until the watermark passes the window's end.
    """
    windowed = _windowed(requests, ts, per, watermark)
    if requests.isStreaming:
        # Milliseconds since the epoch, as timers count them, whatever the session's time zone.
        timed = windowed.withColumn("window_end_millis", F.unix_millis("window_end"))
        schema = StructType([*timed.schema.fields, StructField("admitted", BooleanType())])
        decided = timed.groupBy(client, "window_start").transformWithStateInPandas(
            _Limiter(order, limit), outputStructType=schema, outputMode="Append", timeMode="EventTime"
        )
        return decided.select(*windowed.columns, "admitted")
    key = [client, "window_start"]
    first = windowed.select(*key, order).withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    last = first.filter(F.col("_rank") <= limit).groupBy(*key).agg(F.max(order).alias("_last"))
    last = last.select(*[F.col(name).alias(f"_{name}") for name in key], "_last")
    # Every row has its window's last one; null clients match each other.
    same = F.col(client).eqNullSafe(F.col(f"_{client}")) & (F.col("window_start") == F.col("_window_start"))
    return windowed.join(last, same).select(*windowed.columns, (F.col(order) <= F.col("_last")).alias("admitted"))


class _Cache(StatefulProcessor):
    """Remembers for one request which row was passed on, and when it was last asked for."""

    def __init__(self, order: str, idle: int):
        self.order, self.idle = order, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "source long, last_used long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _together(rows, self.order)
        source, last = self.entry.get() if self.entry.exists() else (None, None)
        if last is not None:
            self.handle.deleteTimer(int(last + self.idle))
        hits, sources = [], []
        for row, millis in zip(found[self.order], found["seen_at_millis"]):
            hit = last is not None and millis - last <= self.idle
            source = source if hit else row
            last = max(millis, last) if hit else millis
            hits.append(hit)
            sources.append(source)
        self.entry.update((int(source), int(last)))
        self.handle.registerTimer(int(last + self.idle))
        found["hit"], found["answered_by"] = hits, sources
        yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.entry.clear()
        yield from ()

    def close(self) -> None:
        pass


def cached_requests(
    requests: DataFrame, ts: str, order: str, key: list[str], idle: str = CACHE_IDLE, watermark: str = WATERMARK
) -> DataFrame:
    """The requests with ``hit`` and ``answered_by``: the row whose answer this one gets, itself on a miss.

    Rows that are not hits are what goes to the model; joining their answers on ``answered_by`` answers all.
    An entry that was not used for ``idle`` of event time is gone, which bounds the cache by recency. Time
    goes in whole milliseconds and an entry's last use never goes back. Null keys are keys. ``order`` is a
    whole number that names a row. Rows without a time are left out.

    On a table a key's rows pass one task in order and are never held. On a stream there is one entry per
    key until the watermark passes the end of its idle time, when no row on time could hit it any more.
    """
    idle_millis = int(pd.Timedelta(idle).total_seconds() * 1000)
    timed = with_event_time(requests, ts, watermark).filter(F.col(ts).isNotNull())
    if requests.isStreaming:
        counted = timed.withColumn("seen_at_millis", F.unix_millis(ts))
        schema = StructType([*counted.schema.fields, StructField("hit", BooleanType()), StructField("answered_by", LongType())])
        return counted.groupBy(*key).transformWithStateInPandas(
            _Cache(order, idle_millis), outputStructType=schema, outputMode="Append", timeMode="EventTime"
        ).select(*timed.columns, "hit", "answered_by")
    arrival = Window.partitionBy(*key).orderBy(order)
    before = arrival.rowsBetween(Window.unboundedPreceding, -1)
    # The entry is gone once a row comes more than the idle time behind all before it, so the largest time so
    # far is that of the last use.
    marked = timed.withColumn("_last", F.max(F.unix_millis(ts)).over(before))
    marked = marked.withColumn("hit", F.coalesce(F.unix_millis(ts) - F.col("_last") <= idle_millis, F.lit(False)))
    source = F.last(F.when(~F.col("hit"), F.col(order)), ignorenulls=True).over(arrival)
    return marked.withColumn("answered_by", source.cast("long")).select(*timed.columns, "hit", "answered_by")


def cache_hit_rate(cached: DataFrame, ts: str, per: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """(window_start, window_end, n_requests, n_hits, hit_rate) per window, of a table or a stream."""
    counted = with_event_time(cached, ts, watermark).groupBy(F.window(ts, per)).agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if("hit").alias("n_hits")
    )
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_requests", "n_hits",
        (F.col("n_hits") / F.col("n_requests")).alias("hit_rate"),
    )
