import pytest
from pyspark.sql import functions as F

from verdigris.streaming import monitoring


def rate(df):
    return monitoring.rate_limit(df, "ts", "user_id", 2, "1 day")


def histogram(df):
    return monitoring.generation_histogram(df, "ts", "value", "1 day")


def service(df):
    return monitoring.service_metrics(
        df, "ts", "value", F.col("event_type") == "error", F.col("event_type") == "purchase",
        F.col("event_type") == "view", F.lit(1).cast("bigint"), "1 day",
    )


def run_stream(spark, df, mode, tmp_path, name):
    query = (
        df.writeStream.outputMode(mode).format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path / f"checkpoint-{name}"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert query.exception() is None
    return sorted(tuple(r) for r in spark.sql(f"SELECT * FROM {name}").collect())


@pytest.fixture(scope="module")
def event_files(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "files")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartitionByRange(4, "ts").write.parquet(path)
    return path


@pytest.mark.parametrize("make", [rate, histogram, service])
def test_stream_equals_batch(spark, event_files, tmp_path, make):
    batch_source = spark.read.parquet(event_files)
    stream_source = (
        spark.readStream.schema(batch_source.schema).option("maxFilesPerTrigger", 2).parquet(event_files)
    )
    batch = sorted(tuple(r) for r in make(batch_source).collect())
    complete = run_stream(spark, make(stream_source), "complete", tmp_path, f"complete_{make.__name__}")
    assert complete == batch
    appended = run_stream(spark, make(stream_source), "append", tmp_path, f"append_{make.__name__}")
    last = batch_source.agg(F.max(F.col("ts").cast("timestamp"))).collect()[0][0]
    assert set(appended) <= set(batch)
    assert all(row[1].date() >= last.date() for row in set(batch) - set(appended))


def test_rate_limit_flags(spark):
    rows = [("2024-01-01 00:00:01", 1)] * 12 + [("2024-01-01 00:01:00", 1), ("2024-01-01 00:00:59", 2)]
    events = spark.createDataFrame(rows, "ts string, client int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {(str(r.window_start), r.client): (r.n_requests, r.over_limit, r.excess)
           for r in monitoring.rate_limit(events, "ts", "client").collect()}
    assert got == {
        ("2024-01-01 00:00:00", 1): (12, True, 2),
        ("2024-01-01 00:01:00", 1): (1, False, 0),
        ("2024-01-01 00:00:00", 2): (1, False, 0),
    }


def test_histogram_bounds_are_cumulative(spark):
    rows = [("2024-01-01 00:00:01", d) for d in (0.005, 0.3, 2.5, 11.0)]
    events = spark.createDataFrame(rows, "ts string, d double").withColumn("ts", F.col("ts").cast("timestamp"))
    got = monitoring.generation_histogram(events, "ts", "d").collect()[0]
    assert (got.n_generations, got.le_0_005, got.le_0_5, got.le_2_5, got.le_10_0) == (4, 1, 2, 3, 3)
    assert got.duration_micros == 13_805_000


def test_first_requests_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "requests")
    rows = [(f"2024-01-01 00:00:{s:02d}", q, "c") for s in range(30) for q in ("a", "b", "a")]
    spark.createDataFrame(rows, "ts string, question string, context string").withColumn(
        "ts", F.col("ts").cast("timestamp")
    ).write.parquet(path)
    source = spark.readStream.schema("ts timestamp, question string, context string").parquet(path)
    firsts = monitoring.first_requests(source, "ts", "question", "context")
    got = run_stream(spark, firsts, "append", tmp_path, "firsts")
    assert sorted(row[1] for row in got) == ["a", "b"]


def test_percentiles_hold_at_size(spark):
    """66,700 values in a window: the least bound that so many of them do not exceed, exactly."""
    import math
    import random

    pick = random.Random(1)
    values = [round(pick.expovariate(0.03), 3) for _ in range(66_700)]
    events = spark.createDataFrame([(v,) for v in values], "d double").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    no = F.lit(False)
    got = monitoring.service_metrics(events, "ts", "d", no, no, no, F.lit(1)).first()
    for name, percent in monitoring.PERCENTILES.items():
        at_rank = sorted(values)[math.ceil(len(values) * percent / 100) - 1]
        assert got[name] == min(b for b in monitoring.LATENCY_BOUNDS if b >= at_rank)
    beyond = monitoring.service_metrics(events.withColumn("d", F.lit(1e9)), "ts", "d", no, no, no, F.lit(1)).first()
    assert (beyond.p50, beyond.p99, beyond.n_requests) == (1e9, 1e9, 66_700)
    none = monitoring.service_metrics(events.withColumn("d", F.lit(None).cast("double")), "ts", "d", no, no, no, F.lit(1)).first()
    assert none.p50 is None and none.n_requests == 66_700


def quantiles(df):
    return monitoring.latency_quantiles(df, "ts", "value", per="1 day")


def test_sketches_of_a_stream_equal_those_of_the_table(spark, sf_dir, tmp_path):
    """Files come in the order of time, so that no row is late."""
    path = str(tmp_path / "files")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for first in (1, 9, 17, 25):
        days = F.dayofmonth("ts").between(first, first + 7)
        events.filter(days).coalesce(1).write.mode("append").parquet(path)
    stream_source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    batch = sorted(tuple(r) for r in quantiles(spark.read.parquet(path)).collect())
    appended = run_stream(spark, quantiles(stream_source), "append", tmp_path, "append_quantiles")
    assert set(appended) <= set(batch) and len(batch) - 2 <= len(appended) < len(batch)


@pytest.mark.parametrize("size", [1, 10, 1_000, 1_000_000])
def test_the_stated_error_holds_at_every_size(spark, size):
    """Ranks are exact and values lie within half of the third digit, from 1e-150 to 1e150 and below zero."""
    values = spark.range(size).select(
        F.lit("2024-01-01").cast("timestamp").alias("ts"), F.lit("x").alias("_value"),
        (F.pow(F.lit(10.0), (F.pmod(F.xxhash64("id"), F.lit(3_000)) - 1_500) / 10) * F.when(F.col("id") % 9 == 4, -1).otherwise(1)).alias("value"),
    )
    found = quantiles(values).first()
    ordered = [row.value for row in values.orderBy("value").select("value").collect()]
    assert found.n_values == size
    for name, percent in monitoring.PERCENTILES.items():
        exact = ordered[-(-size * percent // 100) - 1]
        assert abs(found[name] - exact) <= 0.005001 * abs(exact)
    with_nothing = values.select("ts", F.when(F.col("value") > 0, F.lit(float("nan"))).alias("value"))
    assert quantiles(with_nothing).count() == 0


def test_sketch_of_zeros_and_infinities(spark):
    rows = [(0.0,), (-0.0,), (float("inf"),), (float("-inf"),), (5e-324,), (1.7e308,), (None,)]
    found = quantiles(spark.createDataFrame(rows, "value double").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))).first()
    assert (found.n_values, found.p50, found.p99) == (6, 0.0, float("inf"))
