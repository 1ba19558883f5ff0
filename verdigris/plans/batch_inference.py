"""Answer a table of requests: parse, score each distinct request once, clean, screen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions import predicates as P
from verdigris.functions.cleaning import extract_sql
from verdigris.functions.rendering import ChatTemplate, inference_prompt
from verdigris.operators.prediction import BATCH_SIZE, Predictor, predict
from verdigris.operators.requests import (
    CACHE_KEY, answer_from_cache, distinct_requests,
)
from verdigris.sources.storage import stored


def answer_distinct(
    distinct: DataFrame,
    make_predictor: Callable[[], Predictor],
    template: ChatTemplate | None = None,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """(question_md5, context_md5, predicted_sql, predict_error) per distinct request.

    A request on which the predictor fails has a null statement, not an empty one.
    """
    prompted = distinct.withColumn(
        "prompt", inference_prompt(F.col("question"), F.col("context"), template)
    )
    answered = predict(prompted, make_predictor, batch_size=batch_size, partitions=partitions)
    statement = F.when(F.col("raw_text").isNotNull(), extract_sql(F.col("raw_text")))
    return answered.select(*CACHE_KEY, statement.alias("predicted_sql"), "predict_error")


def answer_requests(
    requests: DataFrame,
    make_predictor: Callable[[], Predictor],
    spread_by: str,
    template: ChatTemplate | None = None,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """Requests with their statement and the screens on it.

    ``requests`` has (question, context, ground_truth) and a column to spread hot requests by. The
    distinct requests and their answers are written to shared storage on the way: both are used
    more than once, and no answer should be asked of the predictor twice.
    """
    distinct = stored(distinct_requests(requests), "distinct")
    answers = stored(
        answer_distinct(distinct, make_predictor, template, batch_size, partitions), "answers"
    )
    answered = answer_from_cache(requests, answers, distinct, spread_by)
    return answered.withColumns(
        {
            "parsing_error": P.parse_error(F.col("predicted_sql")),
            "dangerous_word": P.dangerous_word(F.col("predicted_sql")),
            "ground_truth_sql": F.col("ground_truth"),
        }
    ).drop("ground_truth", *CACHE_KEY)
