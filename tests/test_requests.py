import json

import pytest
from pyspark.sql import functions as F

from verdigris.operators import requests
from verdigris.operators.prediction import predict
from verdigris.plans.batch_inference import answer_requests
from verdigris.sources import requests as files

RECORDS = [
    ({"question": "q1", "context": "c", "query": "s"}, ("q1", "c", "s", None)),
    ({"question": "q2"}, ("q2", "", None, None)),
    ({"question": "q3", "context": None}, ("q3", None, None, None)),
    ({"question": ""}, (None, None, None, "blank_question")),
    ({"question": " "}, (" ", "", None, None)),
    (
        {"question": None, "messages": [{"role": "user", "content": "x"}] * 2},
        (None, None, None, "blank_question"),
    ),
    ({"messages": [{"role": "user", "content": "x"}]}, (None, None, None, "too_few_messages")),
    ({"other": 1}, (None, None, None, "no_known_key")),
    (
        {"messages": [
            {"role": "system", "content": "é"}, {"role": "user", "content": "q"},
            {"role": "user", "content": "last"}, {"role": "assistant", "content": "a"},
        ]},
        ("last", "é", "a", None),
    ),
    (
        {"messages": [
            {"role": "user", "content": "### Context:\nCREATE TABLE t\n\n### Question:\nq\n\n### SQL:"},
            {"role": "assistant", "content": "a"},
        ]},
        ("q", "CREATE TABLE t", "a", None),
    ),
    (
        {"messages": [
            {"role": "system", "content": "s"},
            {"role": "user", "content": "CREATE TABLE t ### Question: a ### Question: b"},
        ]},
        ("CREATE TABLE t ### Question: a ### Question: b", "s", None, None),
    ),
    (
        {"messages": [{"role": "system", "content": "s"}, {"role": "assistant", "content": "a"}]},
        (None, None, None, "blank_question"),
    ),
]


def parse(frame):
    rows = requests.parse_requests(frame).collect()
    return [
        (None, None, None, r.reject_reason) if r.reject_reason else (*r.request, None) for r in rows
    ]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("layout", ["lines", "one_line_array", "pretty_array"])
def test_request_layouts(spark, tmp_path, layout):
    records = [record for record, _ in RECORDS]
    path = tmp_path / "requests.json"
    text = {
        "lines": "\n\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n",
        "one_line_array": json.dumps(records),
        "pretty_array": json.dumps(records, indent=2),
    }[layout]
    path.write_text(text, encoding="utf-8")
    frame = files.read_requests(spark, str(path), "array" if layout == "pretty_array" else "lines")
    assert order(parse(frame)) == order([want for _, want in RECORDS])


def test_malformed_line_fails(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"question": "a"}\n{bad\n')
    with pytest.raises(Exception):
        parse(files.read_requests(spark, str(path)))
    with pytest.raises(ValueError):
        files.read_requests(spark, str(path), "xml")


def test_reject_counts(spark):
    lines = spark.createDataFrame([(json.dumps(r),) for r, _ in RECORDS], "line string")
    parsed = requests.parse_requests(lines.select(files.parse_line(F.col("line")).alias("r")).select("r.*"))
    counts = {r.outcome: r.n_records for r in requests.reject_counts(parsed).collect()}
    assert counts == {"accepted": 7, "blank_question": 3, "too_few_messages": 1, "no_known_key": 1}
    assert requests.accepted(parsed).columns == ["question", "context", "ground_truth"]


def test_results_keep_nulls_and_text(spark, tmp_path):
    rows = [("q", "c", None, "é"), ("q2", None, "SELECT 1", None)]
    frame = spark.createDataFrame(rows, files.RESULT_SCHEMA)
    path = str(tmp_path / "out")
    files.write_results(frame, path)
    lines = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("*.json")).splitlines()
    assert sorted(lines)[0] == '{"question":"q","context":"c","predicted_sql":null,"ground_truth_sql":"é"}'
    assert order(tuple(r) for r in files.read_results(spark, path).collect()) == order(rows)


def flaky():
    def make():
        def run(prompts):
            if any("bad" in prompt for prompt in prompts):
                raise RuntimeError("no")
            return [f"```sql\nSELECT {prompt[-1]};\n```" for prompt in prompts]

        return run

    return make


def short_changed():
    return lambda: lambda prompts: prompts[1:]


def test_predict_retries_row_by_row(spark):
    prompts = spark.createDataFrame([(f"bad {i}" if i % 7 == 0 else f"p {i}",) for i in range(40)], "prompt string")
    rows = predict(prompts, flaky(), partitions=3).collect()
    assert len(rows) == 40
    for row in rows:
        if row.prompt.startswith("bad"):
            assert row.raw_text is None and row.predict_error == "RuntimeError: no"
        else:
            assert row.raw_text == f"```sql\nSELECT {row.prompt[-1]};\n```" and row.predict_error is None
    wrong = predict(prompts, short_changed()).collect()
    assert all(r.raw_text is None and r.predict_error.startswith("ValueError") for r in wrong)


def counting_calls(path):
    def make():
        def run(prompts):
            with open(path, "a") as log:
                log.writelines("call\n" for _ in prompts)
            return ["SELECT 1;" for _ in prompts]

        return run

    return make


def test_hot_request_is_answered_once_and_everywhere(spark, tmp_path):
    rows = [(i, "hot" if i % 3 == 0 else f"q{i}", None if i % 2 else "c", None) for i in range(3000)]
    asked = spark.createDataFrame(rows, "row_id bigint, question string, context string, ground_truth string")
    log = tmp_path / "calls"
    answered = answer_requests(asked, counting_calls(str(log)), "row_id", partitions=2).collect()
    assert sorted(r.row_id for r in answered) == list(range(3000))
    assert {r.predicted_sql for r in answered} == {"SELECT 1;"}
    assert len(log.read_text().splitlines()) == 2002


def test_cache_report(spark):
    rows = [("a", "c")] * 5 + [("a", "d"), ("b", "c")]
    report = requests.cache_report(spark.createDataFrame(rows, "question string, context string")).collect()[0]
    assert (report.n_requests, report.n_distinct, report.n_most_frequent, report.n_hits) == (7, 3, 5, 4)
    assert report.hit_rate == 4 / 7


def test_first_valid_attempt(spark):
    rows = [
        (1, 2, "SELECT 2"), (1, 1, ""), (1, 3, "SELECT 3"),
        (2, 1, "what"), (2, 2, "what"), (2, 3, None), (2, 4, "SELECT late"),
    ]
    frame = spark.createDataFrame(rows, "request_id bigint, attempt int, predicted_sql string")
    got = requests.first_valid_attempt(frame).orderBy("request_id").collect()
    assert [(r.attempt, r.predicted_sql, r.n_attempts, r.failed) for r in got] == [
        (2, "SELECT 2", 3, False), (None, None, 3, True),
    ]


@pytest.mark.parametrize("text", ['{"question": "a"}\n{"question": "b"}\n{"question": "c"}', '[{"question": "a"}] [{"question": "b"}]', '[{"question": "a"}] rest', '[{"question": "a"'])
def test_array_layout_fails_on_what_it_would_lose(spark, tmp_path, text):
    path = tmp_path / "requests.json"
    path.write_text(text)
    with pytest.raises(Exception, match="MALFORMED|more than one JSON value"):
        files.read_requests(spark, str(path), "array").collect()


def test_malformed_result_fails(spark, tmp_path):
    (tmp_path / "results.json").write_text('{"question": "a"}\n{"question": \n')
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_results(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    ("question", "rejected"),
    [("0", True), ("0.0", True), ("false", True), ("[]", True), ("{}", True), ('""', True), ("null", True), ('"0"', False), ('"false"', False), ("1", False), ("true", False), ('"[]"', False), ("[0]", False)],
)
def test_a_question_without_truth_is_blank(spark, question, rejected):
    lines = spark.createDataFrame([(f'{{"question": {question}}}',)], "line string")
    row = requests.parse_requests(lines.select(files.parse_line(F.col("line")).alias("r")).select("r.*")).first()
    assert (row.reject_reason == "blank_question") == rejected


def test_salts_follow_the_size_of_a_request(spark):
    """A third of the rows ask one thing, the others are many small ones: no key and salt gets more than a target."""
    rows = spark.range(60_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 2_000)).alias("question"),
        F.lit("c").alias("context"),
    )
    sizes = requests.distinct_requests(rows)
    hot = requests.hot_requests(sizes, 500)
    assert {r._salts for r in hot.collect()} == {40}
    loads = requests.salted(rows, hot, "id").groupBy("question", "_salt").count().agg(F.max("count")).first()[0]
    assert loads < 650
    answers = sizes.select(*requests.CACHE_KEY, F.col("question").alias("answer"))
    answered = requests.answer_from_cache(rows, answers, sizes, "id", 500)
    assert answered.count() == 60_000 and answered.filter("answer <> question").count() == 0
