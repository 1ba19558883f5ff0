import pytest
from pyspark.sql import functions as F

from verdigris.operators import reporting
from verdigris.operators.scoring import score

ROWS = [
    ("base", 1, "SELECT a FROM t", "SELECT a FROM t"),
    ("base", 2, "", "SELECT a FROM t"),
    ("base", 3, "SELECT b FROM t", "SELECT a FROM t"),
    ("base", 4, "SELECT a FROM t;", "SELECT a FROM t"),
    ("tuned", 1, "SELECT a FROM t", "SELECT a FROM t"),
    ("tuned", 2, "SELECT a FROM t", "SELECT a FROM t"),
    ("tuned", 3, "SELECT c FROM t", "SELECT a FROM t"),
    ("tuned", 4, "SELECT a FROM t WHERE b", "SELECT a FROM t"),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = spark.createDataFrame(
        ROWS, "model_id string, sample_rank bigint, predicted_sql string, ground_truth string"
    ).withColumn("question", F.concat(F.lit("q"), "sample_rank"))
    return score(rows).cache()


def test_model_summary(scored):
    base = reporting.model_summary(scored).filter("model_id = 'base'").collect()[0]
    assert (base.num_samples, base.num_correct, base.num_relaxed_correct, base.num_incorrect) == (4, 2, 1, 2)
    assert (base.accuracy, base.relaxed_accuracy) == (0.5, 0.25)
    assert (base.valid_sql_count, base.parsing_valid_count, base.parsing_invalid_count) == (3, 3, 1)
    assert base.avg_structural_similarity == pytest.approx((6 + 4 + 6 + 6) / 24)
    # "t;" is a table of its own in the logical form
    assert base.logical_form_exact_matches == 1
    assert base.logical_form_accuracy == pytest.approx(1 / 3)
    assert base.avg_logical_form_similarity == pytest.approx((1.0 + 0.0 + 0.8 + 0.8) / 4)


def test_empty_input_divides_nothing(scored):
    empty = scored.limit(0)
    assert reporting.model_summary(empty).count() == 0
    gain = reporting.improvement(reporting.model_summary(empty), "base", "tuned").collect()[0]
    assert gain.absolute_improvement is None and gain.relative_improvement_pct is None


def test_improvement(spark):
    summary = spark.createDataFrame(
        [("base", 0.004, 4), ("tuned", 0.016, 16), ("zero", 0.0, 0)],
        "model_id string, accuracy double, num_correct bigint",
    )
    gain = reporting.improvement(summary, "base", "tuned").collect()[0]
    assert gain.absolute_improvement == pytest.approx(0.012)
    assert gain.relative_improvement_pct == pytest.approx(300.0)
    assert gain.correct_gain == 12
    assert reporting.improvement(summary, "zero", "tuned").collect()[0].relative_improvement_pct == 0.0


def test_bands_and_ratings(spark):
    gains = spark.createDataFrame([(g,) for g in (-0.01, 0.0, 0.09, 0.1, 0.2, 0.21)], "absolute_improvement double")
    assert [r.band for r in reporting.improvement_band(gains).collect()] == [
        "negative", "small", "small", "moderate", "moderate", "large",
    ]
    shares = spark.createDataFrame([(a,) for a in (0.69, 0.7, 0.8, 0.86)], "a double")
    assert [r[0] for r in shares.select(reporting.rating(F.col("a"), "Spider")).collect()] == [
        None, "good", "excellent", "state_of_the_art",
    ]


def test_comparison_table(scored):
    summary = reporting.model_summary(scored)
    lines = {r.metric: r for r in reporting.comparison_table(summary, "base", "tuned").collect()}
    assert len(lines) == 12
    correct = lines["Correct predictions"]
    assert (correct.baseline, correct.baseline_total, correct.tuned, correct.delta) == (2.0, 4, 2.0, 0.0)
    assert lines["Parsing valid %"].delta == 25.0
    one_sided = reporting.comparison_table(summary, None, "tuned").collect()
    assert all(r.baseline is None and r.delta is None and r.tuned is not None for r in one_sided)
    older = summary.drop("logical_form_accuracy", "parsing_valid_count")
    zeros = {r.metric: r.baseline for r in reporting.comparison_table(older, "base", "tuned").collect()}
    assert zeros["Logical form accuracy"] == 0.0 and zeros["Parsing valid count"] == 0.0


def test_examples_keep_sample_order(scored):
    errors = reporting.error_examples(scored, k=1).orderBy("model_id").collect()
    assert [(r.model_id, r.sample_rank, r.parsing_error) for r in errors] == [
        ("base", 2, "Empty SQL string"), ("tuned", 3, None),
    ]
    firsts = reporting.sample_predictions(scored, k=2).orderBy("model_id", "position").collect()
    assert [(r.model_id, r.sample_rank) for r in firsts] == [
        ("base", 1), ("base", 2), ("tuned", 1), ("tuned", 2),
    ]


def test_example_limit_runs_before_the_shuffle(scored):
    plan = reporting.sample_predictions(scored)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_examples_of_unscored_rows_are_the_same(scored):
    texts = ["model_id", "sample_rank", "question", "predicted_sql", "ground_truth"]
    late = reporting.error_examples(scored.select(*texts)).orderBy("model_id", "position").collect()
    early = reporting.error_examples(scored).orderBy("model_id", "position").collect()
    assert [r.asDict() for r in late] == [r.asDict() for r in early]
    raw = scored.withColumnRenamed("predicted_sql", "raw_text").drop("strict_match")
    from_raw = reporting.sample_predictions(raw.filter("model_id = 'tuned'")).orderBy("position").collect()
    assert [r.predicted_sql for r in from_raw] == [row[2] for row in ROWS if row[0] == "tuned"]


def test_random_examples_repeat(scored):
    raw = scored.withColumnRenamed("predicted_sql", "raw_text").drop("strict_match")

    def draw(df, seed):
        rows = reporting.random_examples(df, 3, seed, ["model_id", "sample_rank"]).collect()
        return {(r.model_id, r.sample_rank, r.strict_match) for r in rows}

    assert draw(raw, 1) == draw(raw.repartition(7), 1)
    assert len(draw(raw, 1)) == 3


def test_rank_models(scored):
    ranked = reporting.rank_models(reporting.accuracy_by_model(scored), 1).collect()
    assert [(r.model_id, r.position) for r in ranked] == [("base", 1)]


def test_examples_of_the_corpus_are_those_of_its_ranking(spark, sf_dir):
    """Found by hash first and ranked afterwards, they are the first rows of the ranked corpus."""
    from verdigris.operators.sampling import with_sample_rank
    from verdigris.operators.scoring import add_prediction
    from verdigris.verification.fixtures import generations, pairs

    corpus, made = pairs(spark, sf_dir), generations(spark, sf_dir)
    ranked = add_prediction(made).join(with_sample_rank(corpus.select("row_id", "question")), "row_id")
    key = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert key(reporting.corpus_error_examples(made, corpus).collect()) == key(reporting.error_examples(ranked).collect())
    firsts = reporting.sample_predictions(ranked)
    assert key(reporting.corpus_sample_predictions(made, corpus).select(*firsts.columns).collect()) == key(firsts.collect())


def test_custom_rating(spark):
    rows = spark.createDataFrame([(0.5, 0.45), (0.61, 0.5), (0.75, 0.5), (0.85, 0.5), (None, 0.5)], "a double, b double")
    found = [r[0] for r in rows.select(reporting.custom_rating(F.col("a"), F.col("b"))).collect()]
    assert found == [None, "good", "excellent", "state_of_the_art", None]
