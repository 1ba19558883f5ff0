import random
import re

from pyspark.sql import functions as F

from verdigris.operators import batching
from verdigris.operators.prediction import predict
from verdigris.verification.predictors import schema_reader


def size_class(n):
    """The least number of the form m * 2^e, m below 16, that is not below n."""
    n = max(n, 1)
    return min(m << e for e in range(40) for m in range(1, 17) if m << e >= n)


def make_prompts(spark, count=3_000, seed=1):
    pick = random.Random(seed)
    rows = [(n, "w " * int(pick.expovariate(1 / 60)), "x", 7) for n in range(count)] + [(None, None, "x", 7), (None, "", "x", 7), (5, "w", "x", 7), (9, "w " * 9_000, "x", 7)]
    return spark.createDataFrame(rows, "row_id long, prompt string, salt_ string, n int"), rows


def test_classes(spark):
    numbers = [*range(0, 300), 1_000, 1_024, 1_025, 65_535, 65_537, 2**31 - 1]
    rows = spark.createDataFrame([(n,) for n in numbers], "n int")
    assert [r[0] for r in rows.select(batching.length_class(F.col("n"))).collect()] == [size_class(n) for n in numbers]


def test_every_batch_keeps_the_budget(spark):
    frame, rows = make_prompts(spark)
    for group_rows in (100_000, 40):
        batched = batching.batches_by_length(frame, budget=512, group_rows=group_rows).collect()
        assert sorted(map(str, ((r.row_id, r.prompt, r.salt_, r.n) for r in batched))) == sorted(map(str, rows))
        groups = {}
        for r in batched:
            assert r.n_tokens == len(re.findall("w", r.prompt or ""))
            groups.setdefault((r.length_class, r.salt, r.batch), []).append(r.n_tokens)
        for (length, _, _), sizes in groups.items():
            assert max(sizes) <= length and (len(sizes) == 1 or len(sizes) * max(sizes) <= 512)
    assert batching.batches_by_length(frame.limit(0)).count() == 0


def test_hot_lengths_are_split(spark):
    """All prompts have one length: groups stay near their size, and nothing is padded."""
    frame = spark.range(20_000).select(F.col("id").alias("row_id"), F.lit("a b c").alias("prompt"))
    batched = batching.batches_by_length(frame, group_rows=500)
    assert batched.groupBy("length_class", "salt").count().agg(F.max("count")).first()[0] < 700
    report = batching.padding_report(batched).first()
    assert (report.n_prompts, report.n_tokens, report.padded_tokens, report.padding_share) == (20_000, 60_000, 60_000, 0.0)


def test_less_padding_than_in_order_of_arrival(spark):
    frame, rows = make_prompts(spark)
    report = batching.padding_report(batching.batches_by_length(frame)).first()
    lengths = [len(re.findall("w", row[1] or "")) for row in rows]
    arrival = sum(len(part) * max(part) for part in (lengths[at : at + 8] for at in range(0, len(lengths), 8)))
    assert report.n_tokens == sum(lengths) and report.padding_share < 0.1 < 0.4 < 1 - sum(lengths) / arrival
    empty = batching.padding_report(batching.batches_by_length(frame.limit(0))).first()
    assert (empty.n_batches, empty.padded_tokens, empty.padding_share) == (0, 0, None)


def test_the_same_answers(spark):
    pick = random.Random(2)
    rows = [(n, f"CREATE TABLE t{n % 7} ({'a, ' * pick.randint(0, 90)}) {'5-LOW' if n % 11 == 0 else ''}") for n in range(300)] + [(None, None)]
    frame = spark.createDataFrame(rows, "row_id long, prompt string")
    batched = batching.predict_batches(batching.batches_by_length(frame, budget=700), schema_reader)
    plain = predict(frame.withColumn("prompt", F.coalesce("prompt", F.lit(""))), schema_reader).select("row_id", "raw_text", "predict_error")
    assert sorted(map(str, batched.collect())) == sorted(map(str, plain.collect()))


def test_tokens_are_counted_once(spark, capsys):
    """Sizes of classes and batches read the same written counts; nothing behind them counts again."""
    frame = spark.createDataFrame([(k, "a b " * (k % 30)) for k in range(200)], "row_id long, prompt string")
    batching.batches_by_length(frame).explain("formatted")
    assert "regexp" not in capsys.readouterr().out
