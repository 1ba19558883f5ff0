"""Roll scored rows up into summaries, comparisons, rankings and example rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.functions.cleaning import extract_sql
from verdigris.functions.predicates import STRUCTURE_FLAGS, strict_match
from verdigris.functions.text import md5_key
from verdigris.operators.sampling import draw_with_replacement, ranks_of
from verdigris.operators.scoring import add_prediction, score
from verdigris.sources.storage import stored


def accuracy_by_model(matched: DataFrame, by: str = "model_id") -> DataFrame:
    counted = matched.groupBy(by).agg(
        F.count(F.lit(1)).alias("num_samples"), F.count_if("strict_match").alias("num_correct")
    )
    return counted.withColumn("accuracy", F.try_divide("num_correct", "num_samples"))


def model_summary(scored: DataFrame, by: str = "model_id") -> DataFrame:
    """Fifteen figures per model from one pass; every sum is over integers.

    Logical-form accuracy is a share of the rows that pass the parse screen, its average
    similarity one of all rows.
    """
    totals = scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.count_if("strict_match").alias("num_correct"),
        F.count_if("relaxed_match").alias("num_relaxed_correct"),
        F.count_if("valid_sql").alias("valid_sql_count"),
        F.sum("structural_agreement").alias("agreements"),
        F.count_if("parsing_valid").alias("parsing_valid_count"),
        F.count_if("logical_form_exact").alias("logical_form_exact_matches"),
        F.sum("logical_form_hundredths").alias("hundredths"),
    )
    n = F.col("num_samples")
    return totals.select(
        by,
        F.try_divide("num_correct", n).alias("accuracy"),
        F.try_divide("num_relaxed_correct", n).alias("relaxed_accuracy"),
        "num_samples",
        "num_correct",
        "num_relaxed_correct",
        (n - F.col("num_correct")).alias("num_incorrect"),
        "valid_sql_count",
        F.try_divide("valid_sql_count", n).alias("valid_sql_percentage"),
        F.try_divide("agreements", n * len(STRUCTURE_FLAGS)).alias("avg_structural_similarity"),
        "parsing_valid_count",
        F.try_divide("parsing_valid_count", n).alias("parsing_valid_rate"),
        (n - F.col("parsing_valid_count")).alias("parsing_invalid_count"),
        "logical_form_exact_matches",
        F.coalesce(
            F.try_divide("logical_form_exact_matches", "parsing_valid_count"), F.lit(0.0)
        ).alias("logical_form_accuracy"),
        F.try_divide("hundredths", n * 100).alias("avg_logical_form_similarity"),
    )


def _of(model: str, value: str | Column, by: str) -> Column:
    return F.max(F.when(F.col(by) == model, F.col(value) if isinstance(value, str) else value))


def gains(before: Column, after: Column, correct_before: Column, correct_after: Column) -> dict[str, Column]:
    """Absolute gain, gain in percent of the baseline (0 when that is 0), correct gain; null without both sides."""
    gain = after - before
    relative = F.when(before > 0, gain / before * 100).otherwise(0.0)
    return {
        "absolute_improvement": gain,
        "relative_improvement_pct": F.when(gain.isNotNull(), relative),
        "correct_gain": correct_after - correct_before,
    }


def improvement(summary: DataFrame, baseline: str, tuned: str, by: str = "model_id") -> DataFrame:
    """One row: absolute gain, gain in percent of the baseline (0 when that is 0), correct gain."""
    sides = summary.filter(F.col(by).isin(baseline, tuned)).agg(
        _of(baseline, "accuracy", by).alias("before"),
        _of(tuned, "accuracy", by).alias("after"),
        _of(baseline, "num_correct", by).alias("correct_before"),
        _of(tuned, "num_correct", by).alias("correct_after"),
    )
    figures = gains(F.col("before"), F.col("after"), F.col("correct_before"), F.col("correct_after"))
    return sides.select(*[value.alias(name) for name, value in figures.items()])


def improvement_band(improved: DataFrame) -> DataFrame:
    """Add ``band`` by the absolute gain in percentage points."""
    points = F.col("absolute_improvement") * 100
    band = (
        F.when(points < 0, "negative")
        .when(points < 10, "small")
        .when(points <= 20, "moderate")
        .when(points > 20, "large")
    )
    return improved.withColumn("band", band)


# Shares that count as good, excellent and top, in percent, per public benchmark.
RATING_BANDS = {
    "Spider": (70, 80, 85),
    "WikiSQL": (85, 90, 95),
    "BIRD": (50, 65, 75),
}


def rating(accuracy: Column, benchmark: str) -> Column:
    """Rating of an accuracy on one of the public benchmarks; null below ``good``."""
    good, excellent, top = RATING_BANDS[benchmark]
    percent = accuracy * 100
    return F.when(percent >= top, "state_of_the_art").when(percent >= excellent, "excellent").when(
        percent >= good, "good"
    )


# Gains over the baseline, in percentage points, that earn the same ratings on other data.
CUSTOM_GAINS = (10, 20, 30)


def custom_rating(accuracy: Column, baseline: Column) -> Column:
    """Rating of an accuracy on data of one's own, by its gain over the baseline; null below ``good``."""
    good, excellent, top = CUSTOM_GAINS
    points = (accuracy - baseline) * 100
    return F.when(points >= top, "state_of_the_art").when(points >= excellent, "excellent").when(
        points >= good, "good"
    )


@dataclass(frozen=True)
class Metric:
    """Line of the comparison table: rates are shown in percent, counts next to their total."""

    label: str
    field: str
    is_rate: bool
    total: str | None = None


# Lines and order of the comparison table.
COMPARISON = [
    Metric("Accuracy (strict)", "accuracy", True),
    Metric("Accuracy (relaxed)", "relaxed_accuracy", True),
    Metric("Correct predictions", "num_correct", False, "num_samples"),
    Metric("Incorrect predictions", "num_incorrect", False),
    Metric("Parsing valid %", "parsing_valid_rate", True),
    Metric("Parsing valid count", "parsing_valid_count", False, "num_samples"),
    Metric("Parsing invalid count", "parsing_invalid_count", False),
    Metric("Logical form accuracy", "logical_form_accuracy", True),
    Metric("Logical form exact matches", "logical_form_exact_matches", False, "parsing_valid_count"),
    Metric("Avg logical form similarity", "avg_logical_form_similarity", True),
    Metric("Valid SQL %", "valid_sql_percentage", True),
    Metric("Avg structural similarity", "avg_structural_similarity", True),
]


def comparison_table(
    summary: DataFrame, baseline: str | None, tuned: str | None, by: str = "model_id"
) -> DataFrame:
    """(position, metric, baseline, baseline_total, tuned, tuned_total, delta), one row per metric.

    Figures that a summary lacks count as 0. A side that is not asked for stays null, and so does
    the delta.
    """

    def figure(metric: Metric) -> Column:
        value = F.coalesce(F.col(metric.field).cast("double"), F.lit(0.0)) if (
            metric.field in summary.columns
        ) else F.lit(0.0)
        return value * 100 if metric.is_rate else value

    def total(metric: Metric) -> Column:
        if metric.total is None:
            return F.lit(None).cast("bigint")
        return F.coalesce(F.col(metric.total), F.lit(0)) if (
            metric.total in summary.columns
        ) else F.lit(0).cast("bigint")

    lines = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(metric.label).alias("metric"),
                figure(metric).alias("value"),
                total(metric).alias("total"),
            )
            for position, metric in enumerate(COMPARISON, start=1)
        ]
    )
    sides = [side for side in (baseline, tuned) if side is not None]
    unpivoted = summary.filter(F.col(by).isin(*sides)).select(by, F.inline(lines))

    def side(model: str | None, field: str, kind: str) -> Column:
        return F.lit(None).cast(kind) if model is None else _of(model, field, by)

    return (
        unpivoted.groupBy("position", "metric")
        .agg(
            side(baseline, "value", "double").alias("baseline"),
            side(baseline, "total", "bigint").alias("baseline_total"),
            side(tuned, "value", "double").alias("tuned"),
            side(tuned, "total", "bigint").alias("tuned_total"),
        )
        .withColumn("delta", F.col("tuned") - F.col("baseline"))
    )


def rank_models(summary: DataFrame, k: int, by: str = "model_id") -> DataFrame:
    """The k best models by accuracy. A summary has one row per model."""
    best = summary.orderBy(F.desc("accuracy"), F.asc(by)).limit(k)
    position = F.row_number().over(Window.orderBy(F.desc("accuracy"), F.asc(by)))
    return best.select(by, "accuracy", "num_correct", "num_samples", position.alias("position"))


def first_per_model(rows: DataFrame, k: int, by: str = "model_id", order_by: str = "sample_rank") -> DataFrame:
    """First k rows per model in sample order.

    The rank filter is applied in every task before the shuffle, so at most k rows per task and
    model move, however many rows one model has.
    """
    order = Window.partitionBy(by).orderBy(order_by)
    return rows.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= k)


# Examples and samples per model.
ERROR_EXAMPLES = 5
SAMPLE_PREDICTIONS = 10
_ERROR_COLUMNS = [
    "question", "predicted_sql", "ground_truth", "structural_similarity", "parsing_valid",
    "parsing_error", "logical_form_similarity",
]


def error_examples(rows: DataFrame, k: int = ERROR_EXAMPLES, by: str = "model_id") -> DataFrame:
    """First k strict mismatches per model in sample order.

    Takes scored rows, or rows with ``predicted_sql`` only: then the measures are worked out for the
    examples alone.
    """
    if set(_ERROR_COLUMNS) <= set(rows.columns):
        wrong = rows.filter(~F.col("strict_match"))
        return first_per_model(wrong.select(by, "sample_rank", *_ERROR_COLUMNS), k, by)
    wrong = rows.filter(~strict_match(F.col("predicted_sql"), F.col("ground_truth")))
    texts = [by, "sample_rank", "question", "predicted_sql", "ground_truth"]
    examples = first_per_model(wrong.select(*texts), k, by)
    return score(examples).select(by, "sample_rank", *_ERROR_COLUMNS, "position")


def sample_predictions(
    rows: DataFrame, k: int = SAMPLE_PREDICTIONS, by: str = "model_id"
) -> DataFrame:
    """First k predictions with their truths per model in sample order.

    Takes rows with ``predicted_sql``, or with ``raw_text`` only: then no other text is cleaned.
    """
    text = "predicted_sql" if "predicted_sql" in rows.columns else "raw_text"
    firsts = first_per_model(rows.select(by, "sample_rank", text, "ground_truth"), k, by)
    return firsts if text == "predicted_sql" else add_prediction(firsts).drop("raw_text")


def _cleaned_once(rows: DataFrame) -> DataFrame:
    """Add ``predicted_sql``. A filter on it is not pushed below, so no text is cleaned twice."""
    return rows.select("*", F.inline(F.array(F.struct(extract_sql(F.col("raw_text")).alias("predicted_sql")))))


def _placed(examples: DataFrame, corpus: DataFrame, seed: int, key: str) -> DataFrame:
    """Rank in seeded order and question for the few examples; the corpus is neither ranked nor shuffled."""
    few = stored(examples, "examples")
    ranks = ranks_of(corpus, few, seed, key)
    questions = corpus.select(key, "question").join(F.broadcast(few.select(key).distinct()), key)
    return few.join(F.broadcast(ranks), key).join(F.broadcast(questions), key)


def corpus_error_examples(
    generations: DataFrame, corpus: DataFrame, k: int = ERROR_EXAMPLES, seed: int = 42, key: str = "row_id", by: str = "model_id"
) -> DataFrame:
    """First k strict mismatches per model in the seeded order of the whole corpus, with every measure.

    The order is that of a hash of the key, so the k rows are found first, in one pass over the raw
    texts, and only these get rank, question and measures.
    """
    rows = _cleaned_once(generations.select(by, key, "raw_text", "ground_truth")).drop("raw_text")
    wrong = rows.filter(~strict_match(F.col("predicted_sql"), F.col("ground_truth")))
    firsts = first_per_model(wrong.withColumn("_hash", md5_key(seed, F.col(key))), k, by, "_hash").drop("_hash")
    return score(_placed(firsts, corpus, seed, key)).select(by, "sample_rank", *_ERROR_COLUMNS, "position")


def corpus_sample_predictions(
    generations: DataFrame, corpus: DataFrame, k: int = SAMPLE_PREDICTIONS, seed: int = 42, key: str = "row_id", by: str = "model_id"
) -> DataFrame:
    """First k predictions with their truths per model in the seeded order of the whole corpus."""
    rows = generations.select(by, key, "raw_text", "ground_truth").withColumn("_hash", md5_key(seed, F.col(key)))
    firsts = _placed(first_per_model(rows, k, by, "_hash").drop("_hash"), corpus, seed, key)
    return add_prediction(firsts).select(by, "sample_rank", "predicted_sql", "ground_truth", "position")


def random_examples(rows: DataFrame, k: int, seed: int, keys: list[str]) -> DataFrame:
    """k rows in seeded order, without replacement and the same on every run, with a match flag.

    ``rows`` has ``raw_text`` and ``ground_truth``; only the rows drawn are cleaned and compared.
    """
    key = F.concat_ws("|", *[F.col(name).cast("string") for name in keys])
    drawn = rows.withColumn("_hash", md5_key(seed, key)).orderBy("_hash").limit(k).drop("_hash")
    match = strict_match(F.col("predicted_sql"), F.col("ground_truth"))
    return add_prediction(drawn).withColumn("strict_match", match)


def drawn_examples(rows: DataFrame, k: int, seed: int, keys: list[str]) -> DataFrame:
    """Rows of k draws with replacement, numbered by ``draw``, with a match flag; see ``draw_with_replacement``."""
    named = rows.withColumn("_key", F.concat_ws("|", *[F.col(name).cast("string") for name in keys]))
    drawn = draw_with_replacement(named, k, seed, "_key").drop("_key")
    match = strict_match(F.col("predicted_sql"), F.col("ground_truth"))
    return add_prediction(drawn).withColumn("strict_match", match)
