"""Run a batch predictor over prompts: the one step that leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Takes prompts, gives one raw text per prompt in the same order.
Predictor = Callable[[Sequence[str]], Sequence[str]]
# Fixed value: prompts handed to the predictor at a time.
BATCH_SIZE = 8


def _predict_batch(predictor: Predictor, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(text, error) per prompt; a failing batch is tried again prompt by prompt."""
    try:
        texts = list(predictor(prompts))
        if len(texts) != len(prompts):
            raise ValueError(f"{len(texts)} texts for {len(prompts)} prompts")
        return [(text, None) for text in texts]
    except Exception as error:
        if len(prompts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [_predict_batch(predictor, [prompt])[0] for prompt in prompts]


def predict(
    df: DataFrame,
    make_predictor: Callable[[], Predictor],
    prompt: str = "prompt",
    output: str = "raw_text",
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``output`` and ``predict_error``; a prompt that fails gets a null text and the error.

    ``make_predictor`` runs once per task, so a model is loaded once for all rows of the task. Only
    the prompt travels to Python; the other columns wait in the JVM. With ``partitions`` the rows are
    dealt out in turn first, so that neither a frequent prompt nor the coalescing of small
    partitions puts most of the slow work into one task.
    """
    if partitions is not None:
        df = df.repartition(partitions)

    @F.pandas_udf("text string, error string")
    def run(prompts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = make_predictor()
        for chunk in prompts:
            waiting = chunk.tolist()
            results: list[tuple[str | None, str | None]] = []
            for start in range(0, len(waiting), batch_size):
                results.extend(_predict_batch(predictor, waiting[start : start + batch_size]))
            yield pd.DataFrame(results, columns=["text", "error"], dtype=object)

    # Not deterministic, so that a filter on the result is never run by predicting twice.
    called = df.withColumn("_result", run.asNondeterministic()(F.col(prompt)))
    return called.withColumns(
        {output: F.col("_result.text"), "predict_error": F.col("_result.error")}
    ).drop("_result")
