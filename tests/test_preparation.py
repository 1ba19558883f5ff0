import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from verdigris.operators import corpus, sampling
from verdigris.operators.corpus import STRIPPED, VERBATIM
from verdigris.plans.preparation import prepare_corpus
from verdigris.sources import corpus as files
from verdigris.verification.fixtures import pairs


def expected_order(ids, seed=42, prefix=""):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}|{prefix}{i}".encode()).hexdigest())


def ids(df):
    return [r.row_id for r in df.select("row_id").collect()]


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500])
@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_sample_is_exact_and_blind_to_partitions(spark, n, partitions):
    table = spark.range(500).withColumnRenamed("id", "row_id").repartition(partitions)
    assert sorted(ids(sampling.sample_exact(table, n))) == sorted(expected_order(range(500))[:n])


def test_sample_with_few_digits_ranks_inside_buckets(spark):
    table = spark.range(3000).withColumnRenamed("id", "row_id")
    for n in (1, 1500, 2999):
        got = table.filter(sampling.before_cut(table, "row_id", n, 7, digits=1))
        assert sorted(ids(got)) == sorted(expected_order(range(3000), 7)[:n])


def test_sample_from_too_few_rows(spark):
    table = spark.range(5).withColumnRenamed("id", "row_id")
    assert sampling.sample_exact(table, 6).count() == 5
    with pytest.raises(PySparkException, match="fewer than 6 rows"):
        sampling.sample_exact(table, 6, strict=True).collect()
    with pytest.raises(ValueError):
        sampling.sample_exact(table, -1)


def test_sample_rank(spark):
    table = spark.range(1000).withColumnRenamed("id", "row_id").repartition(16)
    for digits in (1, 4):
        ranked = sampling.with_sample_rank(sampling.sample_exact(table, 100, 3), 3, digits=digits)
        got = [r.row_id for r in ranked.orderBy("sample_rank").collect()]
        assert got == expected_order(range(1000), 3)[:100]
        assert sorted(r.sample_rank for r in ranked.collect()) == list(range(1, 101))


def test_sample_needs_no_shuffle_of_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS row_id", "repeat('x', 100) AS wide").write.parquet(path)
    plan = sampling.sample_exact(spark.read.parquet(path), 10)._jdf.queryExecution().sparkPlan().toString()
    above_subquery = plan.split("Subquery")[0]
    assert "Exchange" not in above_subquery and "Sort" not in above_subquery


def test_prepare_corpus(spark, sf_dir, tmp_path):
    prepared = prepare_corpus(pairs(spark, sf_dir), 1000, 100)
    train, test = (set(ids(prepared.filter(F.col("split") == s))) for s in ("train", "test"))
    chosen = expected_order(range(1500))[:1000]
    assert (len(train), len(test)) == (900, 100) and not train & test
    assert train | test == set(chosen)
    assert test == set(expected_order(chosen, prefix="split|")[:100])

    path = str(tmp_path / "prepared")
    files.write_prepared(prepared, path)
    again = files.read_prepared(spark, path)
    assert sorted(again.select("row_id", "messages", "split").collect()) == sorted(
        prepared.select("row_id", "messages", "split").collect()
    )
    assert files.read_prepared(spark, path, "test").count() == 100


def test_conversation_styles(spark):
    row = [(1, "CREATE TABLE test (id INT);", "Select all rows", " SELECT * FROM test;\n")]
    raw = spark.createDataFrame(row, "row_id bigint, context string, question string, answer string")
    for style, answer in ((VERBATIM, " SELECT * FROM test;\n"), (STRIPPED, "SELECT * FROM test;")):
        messages = corpus.to_conversations(raw, style).collect()[0].messages
        assert [m.role for m in messages] == ["system", "user", "assistant"]
        assert messages[0].content == style.system_template.format(schema=row[0][1])
        assert [m.content for m in messages[1:]] == ["Select all rows", answer]


def test_unpack_short_records(spark):
    schema = "row_id int, messages array<struct<role: string, content: string>>"
    rows = [(1, [("system", "s"), ("user", "q"), ("assistant", "a")]), (2, [("user", "q")]), (3, [])]
    got = corpus.unpack_messages(spark.createDataFrame(rows, schema)).orderBy("row_id").collect()
    assert [(r.system, r.question, r.ground_truth) for r in got] == [
        ("s", "q", "a"), ("q", None, "q"), (None, None, None),
    ]


def test_corpus_profile(spark):
    raw = spark.createDataFrame(
        [
            (1, "CREATE TABLE b (x INT); CREATE TABLE c (y INT)", "how many b", "SELECT 1"),
            (2, "CREATE TABLE a (x INT)", "how  many\na rows", "SELECT 1"),
        ],
        "row_id bigint, context string, question string, answer string",
    )
    got = corpus.corpus_profile(corpus.to_conversations(raw)).collect()[0].asDict()
    assert got == {
        "n_rows": 2, "size_class": "n<1K", "example_schema": "CREATE TABLE a (x INT);",
        "avg_question_words": 3.5, "min_question_words": 3, "max_question_words": 4,
        "single_table_rows": 1, "multi_table_rows": 1,
    }
    empty = corpus.corpus_profile(corpus.to_conversations(raw.limit(0))).collect()[0]
    assert empty.n_rows == 0 and empty.example_schema == corpus.EXAMPLE_SCHEMA
    assert empty.avg_question_words is None


def test_size_classes(spark):
    sizes = spark.createDataFrame([(n,) for n in (0, 999, 1000, 9999, 10000, 99999, 100000)], "n bigint")
    assert [r[0] for r in sizes.select(corpus.size_class(F.col("n"))).collect()] == [
        "n<1K", "n<1K", "1K<n<10K", "1K<n<10K", "10K<n<100K", "10K<n<100K", "n>100K",
    ]


def test_read_corpus_declares_its_schema(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    pairs(spark, sf_dir).write.parquet(path)
    corpus_rows = files.read_corpus(spark, path)
    assert corpus_rows.columns == ["row_id", "context", "question", "answer"]
    assert corpus_rows.count() == 1500


def test_malformed_prepared_record_fails(spark, tmp_path):
    folder = tmp_path / "split=test"
    folder.mkdir()
    (folder / "a.json").write_text('{"row_id": 1, "messages": []}\n{"row_id": 2, "mess')
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_prepared(spark, str(tmp_path)).collect()


def test_strict_sample_fails_on_repeated_keys(spark):
    keys = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (2,)], "row_id int")
    with pytest.raises(Exception, match="repeated keys"):
        sampling.sample_exact(keys, 2, strict=True).collect()
    unique = spark.range(50).select(F.col("id").alias("row_id"))
    assert sampling.sample_exact(unique, 20, strict=True).count() == 20
    assert sampling.sample_exact(unique, 20, digits=1).count() == 20


def test_ranks_of_a_few(spark):
    keys = spark.range(3_000).select(F.col("id").alias("row_id"))
    all_ranks = {r.row_id: r.sample_rank for r in sampling.with_sample_rank(keys, 7).collect()}
    few = keys.filter("row_id % 500 = 3")
    assert {r.row_id: r.sample_rank for r in sampling.ranks_of(keys, few, 7).collect()} == {
        k: v for k, v in all_ranks.items() if k % 500 == 3
    }


def test_turns_in_order(spark):
    from verdigris.operators.corpus import group_turns

    rows = [(1, 2, "user", None), (1, 0, "system", "s"), (1, 1, "user", "q"), (2, 0, "user", "é")]
    got = {r.conv_id: [tuple(m) for m in r.messages] for r in group_turns(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()}
    assert got == {1: [("system", "s"), ("user", "q"), ("user", None)], 2: [("user", "é")]}


def test_turns_without_a_key_are_records_of_their_own(spark):
    """A third of the turns has no key: no group holds them."""
    from verdigris.operators.corpus import group_turns

    turns = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit(None).cast("string").alias("text")
    )
    sizes = group_turns(turns).groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.size("messages")).alias("most")).collect()
    assert {(r.n, r.most) for r in sizes if r.conv_id is None} == {(10_000, 1)} and len(sizes) == 101
    assert sum(r.most for r in sizes if r.conv_id is not None) == 20_000


def test_strict_split_fails_on_repeated_keys(spark):
    keys = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (2,)], "row_id int")
    with pytest.raises(Exception, match="repeated keys"):
        sampling.split_train_test(keys, 2, strict=True).collect()
    split = sampling.split_train_test(spark.range(50).select(F.col("id").alias("row_id")), 20, strict=True)
    assert split.filter("split = 'test'").count() == 20


def test_draws_with_replacement(spark):
    rows = spark.range(40).select(F.col("id").alias("row_id"), F.lit("t").alias("draw_text"))
    draws = {r.draw: r.row_id for r in sampling.draw_with_replacement(rows, 200, 7).collect()}
    assert set(draws) == set(range(1, 201)) and 30 < len(set(draws.values())) <= 40
    for other in (rows.repartition(9), rows.orderBy(F.desc("row_id")).coalesce(1)):
        assert {r.draw: r.row_id for r in sampling.draw_with_replacement(other, 200, 7, digits=1).collect()} == draws
    assert {r.draw: r.row_id for r in sampling.draw_with_replacement(rows, 200, 8).collect()} != draws
    assert sampling.draw_with_replacement(rows.limit(0), 5).count() == 0 and sampling.draw_with_replacement(rows.limit(1), 5).count() == 5
