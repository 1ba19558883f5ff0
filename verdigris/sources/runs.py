"""Result documents of evaluation runs: append one per run, read the history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.sources.documents import whole_values

_SUMMARY = (
    "struct<accuracy: double, relaxed_accuracy: double, num_samples: bigint, num_correct: bigint, "
    "num_relaxed_correct: bigint, num_incorrect: bigint, valid_sql_count: bigint, "
    "valid_sql_percentage: double, avg_structural_similarity: double, "
    "parsing_valid_count: bigint, parsing_valid_rate: double, parsing_invalid_count: bigint, "
    "logical_form_exact_matches: bigint, logical_form_accuracy: double, "
    "avg_logical_form_similarity: double, "
    "sample_predictions: array<string>, sample_ground_truths: array<string>, "
    "error_examples: array<struct<question: string, predicted: string, ground_truth: string, "
    "structural_similarity: double, parsing_valid: boolean, parsing_error: string, "
    "logical_form_similarity: double>>, timestamp: string>"
)
RUN_SCHEMA = (
    "evaluation_config struct<num_samples: bigint, batch_size: bigint, temperature: double, "
    "base_model: string, adapter_path: string>, "
    f"baseline {_SUMMARY}, fine_tuned {_SUMMARY}, "
    "improvement struct<absolute_improvement: double, relative_improvement_pct: double, "
    "correct_gain: bigint>, config map<string, string>"
)
# Figures that documents of older runs lack; they read as 0.
LATER_FIGURES = [
    "relaxed_accuracy", "valid_sql_percentage", "avg_structural_similarity",
    "parsing_valid_count", "parsing_valid_rate", "parsing_invalid_count",
    "logical_form_exact_matches", "logical_form_accuracy", "avg_logical_form_similarity",
]


LAYOUTS = ("lines", "document")


def append_run(document: DataFrame, path: str) -> None:
    """Add documents to the history, one folder per ``run_id``; a run that is there is replaced."""
    document.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").json(path)


def read_runs(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Documents below a path with all fields, old or new, ``run_id`` and ``source_file``.

    ``lines`` is the layout of ``append_run``: any number of documents per file, one per line.
    ``document`` is for files that hold one document over many lines, as others write them; there the
    run is null unless the folder names it. A malformed document, or more of them in a file than the
    layout allows, fails the query.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}: {layout}")
    if layout == "lines":
        documents = spark.read.schema(f"{RUN_SCHEMA}, run_id string").option("mode", "FAILFAST").json(path)
        return documents.select("*", F.col("_metadata.file_path").alias("source_file"))
    struct = spark.createDataFrame([], RUN_SCHEMA).schema.simpleString()
    folder = F.regexp_extract("source_file", "/run_id=([^/]+)/", 1)
    return whole_values(spark, path, struct).select(
        "value.*", F.when(folder != "", folder).alias("run_id"), "source_file"
    )


def improvement_history(runs: DataFrame) -> DataFrame:
    """(run_id, source_file, absolute_improvement, relative_improvement_pct, correct_gain) per run; null where it has none."""
    return runs.select("run_id", "source_file", "improvement.*")


def summary_history(runs: DataFrame, side: str) -> DataFrame:
    """Figures of one side of every run that has it; figures a run lacks read as 0."""
    present = runs.filter(F.col(side).isNotNull())
    kept = ["accuracy", "num_samples", "num_correct", "num_incorrect"]
    return present.select(
        "run_id", "source_file",
        *[F.col(f"{side}.{name}") for name in kept],
        *[F.coalesce(F.col(f"{side}.{name}"), F.lit(0)).alias(name) for name in LATER_FIGURES],
    )
