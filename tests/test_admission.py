import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from verdigris.streaming import admission, attempts

SCHEMA = "id long, ts timestamp_ntz, client string, question string, context string"


@pytest.fixture(scope="module")
def keyed_state(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def make_rows(seed, count=400, jitter=300):
    """Ids in order of arrival; event times up to ``jitter`` seconds out of it."""
    pick = random.Random(seed)
    rows = []
    for n in range(count):
        second = n * 20 + pick.randint(-jitter, jitter) + 3_600
        ts = f"2024-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"
        rows.append((n, ts, pick.choice(["a", "a", "a", "b", None]), pick.choice(["q", "q", "r", None]), pick.choice(["c", "d"])))
    return rows


def frame(spark, rows):
    texts = spark.createDataFrame(rows, SCHEMA.replace("timestamp_ntz", "string"))
    return texts.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream(spark, tmp_path, batches, make, build=frame, schema=SCHEMA):
    """Each list of rows is one file and one micro-batch of a restarted query; returns all rows put out."""
    path = str(tmp_path / "in")
    for rows in batches:
        build(spark, rows).coalesce(1).write.mode("append").parquet(path)
        query = (
            make(spark.readStream.schema(schema).parquet(path)).writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        )
        query.awaitTermination(180)
        assert query.exception() is None
    return spark.read.parquet(str(tmp_path / "out"))


def limited(df):
    return admission.admit_requests(df, "ts", "client", "id", 4, "10 minutes").select("id", "admitted")


def cached(df):
    return admission.cached_requests(df, "ts", "id", ["question", "context"], "2 minutes").select("id", "hit", "answered_by")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def admitted_by_hand(rows, limit=4):
    seen, found = defaultdict(int), []
    for n, ts, client, *_ in rows:
        seen[client, ts[:15]] += 1
        found.append((n, seen[client, ts[:15]] <= limit))
    return found


def cached_by_hand(rows, idle=120):
    entries, found = {}, []
    for n, ts, _, *key in rows:
        second = int(ts[11:13]) * 3600 + int(ts[14:16]) * 60 + int(ts[17:19])
        source, last = entries.get(tuple(key), (None, None))
        hit = last is not None and second - last <= idle
        entries[tuple(key)] = (source if hit else n, max(second, last) if hit else second)
        found.append((n, hit, source if hit else n))
    return found


def test_tables_by_hand(spark):
    rows = make_rows(1)
    assert rows_of(limited(frame(spark, rows))) == admitted_by_hand(rows)
    assert rows_of(cached(frame(spark, rows))) == cached_by_hand(rows)
    assert limited(frame(spark, [])).count() == cached(frame(spark, [])).count() == 0
    assert rows_of(limited(frame(spark, [(1, None, "a", "q", "c")]))) == []
    assert rows_of(cached(frame(spark, [(1, None, "a", "q", "c")]))) == []


@pytest.mark.parametrize("make", [limited, cached])
def test_stream_equals_table_row_by_row(spark, tmp_path, keyed_state, make):
    """Times are out of order inside a batch and across batches; each batch restarts from the checkpoint."""
    rows = make_rows(2)
    batches = [rows[:130], rows[130:260], rows[260:]]
    for batch in batches:
        random.Random(3).shuffle(batch)
    assert rows_of(stream(spark, tmp_path, batches, make)) == rows_of(make(frame(spark, rows)))


@pytest.mark.parametrize("make, want", [(limited, [(1, True), (2, True), (4, True)]), (cached, [(1, False, 1), (2, False, 2), (4, True, 2)])])
def test_late_rows_are_dropped_and_state_expires(spark, tmp_path, keyed_state, make, want):
    batches = [
        [(1, "2024-01-01 01:00:00", "a", "q", "c")], [(2, "2024-01-01 05:00:00", "a", "q", "c")],
        # Row 3 is hours behind the watermark, row 4 minutes behind the newest row.
        [(3, "2024-01-01 01:00:30", "a", "q", "c"), (4, "2024-01-01 04:58:00", "a", "q", "c")],
    ]
    assert rows_of(stream(spark, tmp_path, batches, make)) == want


def test_limit_is_found_before_the_shuffle(spark):
    rows = spark.range(50_000).select(
        "id", F.lit("2024-01-01 00:00:30").cast("timestamp_ntz").alias("ts"), F.concat(F.lit("hot"), F.col("id") % 1).alias("client"), F.lit("q").alias("question"), F.lit("c").alias("context")
    )
    decided = limited(rows)
    assert "WindowGroupLimit" in decided._jdf.queryExecution().toString()
    assert [row.id for row in decided.filter("admitted").collect()] == [0, 1, 2, 3]


def test_hit_rate(spark):
    rows = make_rows(4, 100)
    cached_rows = admission.cached_requests(frame(spark, rows), "ts", "id", ["question", "context"], "2 minutes")
    found = admission.cache_hit_rate(cached_rows, "ts", "1 day").first()
    hits = sum(hit for _, hit, _ in cached_by_hand(rows))
    assert (found.n_requests, found.n_hits, found.hit_rate) == (100, hits, hits / 100)


ATTEMPTS = "request_id long, attempt int, ts timestamp_ntz, predicted_sql string, outcome string"
FAR = (99_999, 1, "2024-01-02 00:00:00", "SELECT 1", "x")


def tries(spark, rows):
    return spark.createDataFrame(rows, ATTEMPTS.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def make_attempts(seed, requests=120):
    """Attempts of one minute per request, out of order, some repeated, missing, beyond the last or without a number."""
    pick = random.Random(seed)
    rows = []
    for request in range(requests):
        for number in pick.sample([1, 1, 2, 3, 4], k=pick.randint(1, 5)):
            second = request * 5 + pick.randint(0, 59)
            rows.append((request, number, f"2024-01-01 01:{second // 60:02d}:{second % 60:02d}", pick.choice(["no", "", None, "SELECT 1", "select b"]), "x"))
    return rows + [(None, 1, "2024-01-01 01:00:00", "SELECT 1", "x"), (1, None, "2024-01-01 01:00:00", "SELECT 1", "x"), (1, 0, "2024-01-01 01:00:00", "SELECT 1", "x")]


def resolved_by_hand(rows, most=3):
    found = []
    for request in sorted({row[0] for row in rows if row[0] is not None}):
        firsts = {}
        for _, number, ts, sql, _ in sorted((row for row in rows if row[0] == request and row[1] in range(1, most + 1)), key=lambda row: row[1:3]):
            firsts.setdefault(number, (ts, sql))
        for number, (ts, sql) in sorted(firsts.items()):
            if "select" in (sql or "").lower():
                found.append((request, "valid", number, sql, None))
                break
            if number < most:
                found.append((request, "retry", number, None, f"{ts[:17]}{int(ts[17:]) + 2 ** (number - 1):02d}"))
        else:
            if firsts:
                found.append((request, "failed", max(firsts), None, None))
    return found


def shown(df):
    return sorted(map(tuple, df.withColumn("retry_at", F.col("retry_at").cast("string")).collect()), key=str)


def distinct_times(rows):
    """One time per request and number, seconds below 56, so that the hand count needs no carry and no tie-break."""
    seen, kept = set(), []
    for row in rows:
        if (row[:3]) not in seen and int(row[2][17:]) < 56:
            seen.add(row[:3])
            kept.append(row)
    return kept


def test_attempts_of_a_table(spark):
    rows = distinct_times(make_attempts(5))
    assert shown(attempts.resolve_attempts(tries(spark, rows))) == sorted(resolved_by_hand(rows), key=str)
    assert attempts.resolve_attempts(tries(spark, [])).count() == 0


def test_attempts_of_a_stream_equal_those_of_the_table(spark, tmp_path, keyed_state):
    """Numbers come in any order over three restarts; at the end a far row brings every deadline."""
    rows = distinct_times(make_attempts(6))
    earliest = {}
    for row in rows:
        earliest[row[:2]] = min(earliest.get(row[:2], row[2]), row[2])
    rows = [row for row in rows if row[2] == earliest[row[:2]]]
    half = len(rows) // 2
    batches = [rows[:half], rows[half:], [FAR], [(99_998, 1, FAR[2], "SELECT 1", "x")]]
    found = shown(stream(spark, tmp_path, batches, attempts.resolve_attempts, tries, ATTEMPTS).filter("request_id < 99000"))
    assert found == sorted(resolved_by_hand(rows), key=str)


def test_a_valid_attempt_is_out_at_once(spark, tmp_path, keyed_state):
    found = stream(spark, tmp_path, [[(1, 1, "2024-01-01 01:00:00", "no", "x"), (1, 2, "2024-01-01 01:00:02", "SELECT 1", "x"), (2, 2, "2024-01-01 01:00:00", "SELECT 2", "x")]], attempts.resolve_attempts, tries, ATTEMPTS)
    assert [row[:4] for row in shown(found)] == [(1, "retry", 1, None), (1, "valid", 2, "SELECT 1")]
