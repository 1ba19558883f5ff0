"""Score stored generations of several models against an evaluation sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.functions.rendering import CHATML, ChatTemplate
from verdigris.operators import reporting
from verdigris.operators.corpus import unpack_messages
from verdigris.operators.prediction import BATCH_SIZE
from verdigris.operators.rendering import evaluation_prompts
from verdigris.operators.sampling import sample_exact, with_sample_rank
from verdigris.operators.scoring import add_prediction, score

# Fixed value: rows of an evaluation sample.
EVAL_SAMPLES = 1_000


def evaluation_sample(
    records: DataFrame, num_samples: int = EVAL_SAMPLES, seed: int = 42, template: ChatTemplate = CHATML
) -> DataFrame:
    """(row_id, sample_rank, system, question, ground_truth, prompt), chosen once for all models."""
    ranked = with_sample_rank(sample_exact(records, num_samples, seed), seed)
    return evaluation_prompts(unpack_messages(ranked), template).drop("messages")


def score_generations(sample: DataFrame, generations: DataFrame) -> DataFrame:
    """Scored rows per model. ``generations`` has (row_id, model_id, raw_text).

    Nothing is said about which side is small; adaptive execution broadcasts the sample when it is.
    """
    stored = generations.select("row_id", "model_id", "raw_text")
    wanted = sample.select("row_id", "sample_rank", "question", "ground_truth")
    return score(add_prediction(stored.join(wanted, "row_id")).drop("raw_text"))


@dataclass(frozen=True)
class RunConfig:
    """What a result document says about its run."""

    run_id: str
    num_samples: int
    base_model: str
    adapter_path: str | None = None
    batch_size: int = BATCH_SIZE
    temperature: float = 0.0
    settings: tuple[tuple[str, str], ...] = ()

    def struct(self, num_samples: Column) -> Column:
        """``num_samples`` is what was scored; the number asked for stands in when nothing was."""
        return F.struct(
            F.coalesce(num_samples, F.lit(self.num_samples)).cast("bigint").alias("num_samples"),
            F.lit(self.batch_size).cast("bigint").alias("batch_size"),
            F.lit(self.temperature).alias("temperature"),
            F.lit(self.base_model).alias("base_model"),
            F.lit(self.adapter_path).cast("string").alias("adapter_path"),
        )

    def settings_map(self) -> Column:
        pairs = [F.lit(text) for pair in self.settings for text in pair]
        return F.create_map(*pairs).cast("map<string,string>")


def run_document(
    scored: DataFrame, config: RunConfig, baseline: str | None, tuned: str | None, timestamp: str
) -> DataFrame:
    """One nested row: configuration, summary and examples per side, improvement, settings.

    Summary, examples and samples meet per model: each has at most one row per model and a fixed
    number of examples.
    """
    sides = [side for side in (baseline, tuned) if side is not None]
    rows = scored.filter(F.col("model_id").isin(*sides))
    summary = reporting.model_summary(rows)
    example = F.struct(
        "position", "question", F.col("predicted_sql").alias("predicted"), "ground_truth",
        "structural_similarity", "parsing_valid", "parsing_error", "logical_form_similarity",
    )
    errors = reporting.error_examples(rows).groupBy("model_id").agg(
        F.array_sort(F.collect_list(example)).alias("_errors")
    )
    samples = reporting.sample_predictions(rows).groupBy("model_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "predicted_sql", "ground_truth"))).alias(
            "_samples"
        )
    )
    figures = [name for name in summary.columns if name != "model_id"]
    without_position = F.transform(
        F.coalesce("_errors", F.array().cast(errors.schema["_errors"].dataType)),
        lambda e: e.dropFields("position"),
    )
    side = F.struct(
        *figures,
        F.col("_samples.predicted_sql").alias("sample_predictions"),
        F.col("_samples.ground_truth").alias("sample_ground_truths"),
        without_position.alias("error_examples"),
        F.lit(timestamp).alias("timestamp"),
    )
    per_model = (
        summary.join(samples, "model_id").join(errors, "model_id", "left").select("model_id", side.alias("side"))
    )

    def of(model: str | None) -> Column:
        return F.any_value(F.when(F.col("model_id") == (model or ""), F.col("side")), True)

    document = per_model.agg(of(baseline).alias("baseline"), of(tuned).alias("fine_tuned"))
    figures = reporting.gains(
        F.col("baseline.accuracy"), F.col("fine_tuned.accuracy"),
        F.col("baseline.num_correct"), F.col("fine_tuned.num_correct"),
    )
    improvement = F.struct(*[value.alias(name) for name, value in figures.items()])
    return document.select(
        F.lit(config.run_id).alias("run_id"),
        config.struct(F.coalesce("baseline.num_samples", "fine_tuned.num_samples")).alias("evaluation_config"),
        "baseline",
        "fine_tuned",
        F.when(figures["absolute_improvement"].isNotNull(), improvement).alias("improvement"),
        config.settings_map().alias("config"),
    )
