"""Attempts at requests as they come in: the first valid one, when to try again, and what failed for good.

Attempts are looked at in the order of their numbers. One that fails the parse screen is tried again
after a pause that doubles; the first that passes ends the request, and so does the last one allowed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from verdigris.functions import predicates as P
from verdigris.operators.requests import MAX_ATTEMPTS
from verdigris.streaming.monitoring import WATERMARK, with_event_time

# Fixed value: the pause before attempt n + 1 is 2^(n - 1) seconds.
FIRST_PAUSE_MILLIS = 1_000
DEADLINE = "10 minutes"
RETRY, VALID, FAILED = "retry", "valid", "failed"
_OUTPUT = "request_id long, outcome string, attempt int, predicted_sql string, retry_millis long"


class _Attempts(StatefulProcessor):
    """Holds the attempts of one request that came before their turn, and whether it is decided."""

    def __init__(self, most: int, deadline: int):
        self.most, self.deadline = most, deadline

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("request", "decided boolean, next int, held string")

    def _advance(self, request, next_: int, held: dict, closing: bool) -> tuple[bool, int, list[tuple]]:
        """(decided, next number, rows): what the attempts at hand decide; ``closing`` skips missing ones."""
        rows, last = [], 0
        for number in sorted(map(int, held)):
            if number != next_ and not closing:
                return False, next_, rows
            valid, sql, millis = held.pop(str(number))
            last, next_ = number, number + 1
            if valid:
                return True, next_, [*rows, (request, VALID, number, sql, None)]
            if number < self.most:
                rows.append((request, RETRY, number, None, millis + FIRST_PAUSE_MILLIS * 2 ** (number - 1)))
        if closing or next_ > self.most:
            return True, next_, [*rows, (request, FAILED, last or next_ - 1, None, None)]
        return False, next_, rows

    def _frame(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            found = pd.DataFrame(rows, columns=["request_id", "outcome", "attempt", "predicted_sql", "retry_millis"])
            yield found.astype({"retry_millis": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        decided, next_, held = self.state.get() if self.state.exists() else (False, 1, None)
        held = json.loads(held or "{}")
        found = pd.concat(list(rows)).sort_values(["attempt", "millis"], kind="stable")
        if not self.state.exists():
            self.handle.registerTimer(int(found["millis"].min() + self.deadline))
        if not decided:
            for number, valid, sql, millis in zip(found["attempt"], found["valid"], found["predicted_sql"], found["millis"]):
                if next_ <= number <= self.most:
                    held.setdefault(str(int(number)), [bool(valid), sql, int(millis)])
            decided, next_, out = self._advance(key[0], next_, held, False)
            yield from self._frame(out)
        self.state.update((bool(decided), int(next_), "{}" if decided else json.dumps(held)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        decided, next_, held = self.state.get()
        if not decided:
            yield from self._frame(self._advance(key[0], next_, json.loads(held), True)[2])
        self.state.clear()

    def close(self) -> None:
        pass


def resolve_attempts(
    attempts: DataFrame, ts: str = "ts", sql: str = "predicted_sql", most: int = MAX_ATTEMPTS, deadline: str = DEADLINE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """(request_id, outcome, attempt, predicted_sql, retry_at) from request_id, attempt, a time and a text.

    Outcomes: ``retry`` for each failed attempt before the last one allowed, with the time of the next one;
    ``valid`` for the first attempt that passes, with its text; ``failed`` where none of the first ``most``
    does, with the last number tried. Attempts beyond ``most`` or below 1 and behind the valid one play
    no part; of equal numbers the earliest counts. Rows without a request, number or time are left out.

    On a stream an outcome is out as soon as all lower numbers are in, and at the latest when the watermark
    passes the first attempt's time by ``deadline``. That is what a table gives once all attempts are in; an
    attempt that comes after its request's deadline opens the request again. State is a few attempts.
    """
    timed = with_event_time(attempts, ts, watermark).filter(
        F.col("request_id").isNotNull() & F.col("attempt").between(1, most) & F.col(ts).isNotNull()
    )
    shaped = timed.select(
        F.col("request_id").cast("long"), F.col("attempt").cast("int"), F.col(ts), P.parse_error(F.col(sql)).isNull().alias("valid"),
        F.col(sql).alias("predicted_sql"), F.unix_millis(ts).alias("millis"),
    )
    retry_at = F.timestamp_millis("retry_millis").alias("retry_at")
    if attempts.isStreaming:
        span = int(pd.Timedelta(deadline).total_seconds() * 1000)
        decided = shaped.groupBy("request_id").transformWithStateInPandas(
            _Attempts(most, span), outputStructType=_OUTPUT, outputMode="Append", timeMode="EventTime"
        )
        return decided.select("request_id", "outcome", "attempt", "predicted_sql", retry_at)
    # One struct per number, combined before the shuffle: ``most`` fields, however many rows there are.
    number = F.col("attempt")
    one = F.struct("attempt", "valid", "predicted_sql", "millis")
    firsts = [F.min_by(F.when(number == n, one), F.when(number == n, F.col("millis"))).alias(f"_{n}") for n in range(1, most + 1)]
    tried = shaped.groupBy("request_id").agg(*firsts).withColumn(
        "_tried", F.filter(F.array(*[f"_{n}" for n in range(1, most + 1)]), lambda each: each.isNotNull())
    )
    valid = F.get(F.filter("_tried", lambda each: each["valid"]), F.lit(0))
    tried = tried.select("request_id", "_tried", valid.alias("_valid"))

    def row(outcome: str, attempt: Column, text: Column, millis: Column) -> Column:
        return F.struct(
            F.lit(outcome).alias("outcome"), attempt.alias("attempt"), text.cast("string").alias("predicted_sql"), millis.cast("long").alias("retry_millis")
        )

    nothing = F.lit(None)
    before = F.filter("_tried", lambda each: (each["attempt"] < most) & (F.col("_valid").isNull() | (each["attempt"] < F.col("_valid.attempt"))))
    retries = F.transform(
        before, lambda each: row(RETRY, each["attempt"], nothing, each["millis"] + F.lit(FIRST_PAUSE_MILLIS) * F.call_function("shiftleft", F.lit(1), each["attempt"] - 1))
    )
    end = F.when(F.col("_valid").isNull(), row(FAILED, F.element_at("_tried", -1)["attempt"], nothing, nothing)).otherwise(
        row(VALID, F.col("_valid.attempt"), F.col("_valid.predicted_sql"), nothing)
    )
    return tried.select("request_id", F.inline(F.concat(retries, F.array(end)))).select("request_id", "outcome", "attempt", "predicted_sql", retry_at)
