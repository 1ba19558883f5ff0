"""Score predicted SQL against its ground truth, row by row, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions import forms
from verdigris.functions import predicates as P
from verdigris.functions.cleaning import extract_sql


def add_prediction(df: DataFrame, raw: str = "raw_text", output: str = "predicted_sql") -> DataFrame:
    """Add the SQL statement found in the raw model text."""
    return df.withColumn(output, extract_sql(F.col(raw)))


def score(df: DataFrame, predicted: str = "predicted_sql", truth: str = "ground_truth") -> DataFrame:
    """Add every measure. Rows that fail the parse screen score 0 on the logical form.

    Ratios come with the integers they are made of, so that averages can add integers.
    """
    p, t = F.col(predicted), F.col(truth)
    scored = df.withColumns(
        {
            "strict_match": P.strict_match(p, t),
            "relaxed_match": P.relaxed_match(p, t),
            "valid_sql": P.looks_like_sql(p),
            "structural_agreement": P.structural_agreement(p, t),
            "parsing_error": P.parse_error(p),
        }
    )
    valid = F.col("parsing_error").isNull()
    comparison = forms.compare_sql(p, t)
    scored = scored.withColumns(
        {
            "parsing_valid": valid,
            "structural_similarity": P.structural_similarity(F.col("structural_agreement")),
            "_form": F.when(valid, comparison),
        }
    )
    return scored.withColumns(
        {
            "logical_form_exact": F.coalesce(F.col("_form.exact"), F.lit(False)),
            "logical_form_hundredths": F.coalesce(F.col("_form.hundredths"), F.lit(0)),
            "logical_form_similarity": F.coalesce(F.col("_form.hundredths"), F.lit(0)) / 100,
        }
    ).drop("_form")
