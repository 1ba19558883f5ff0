"""Read batch requests and write batch results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.sources.json_arrays import array_items

# A variant tells an absent key (null) from a key that holds null (a variant of null).
REQUEST_SCHEMA = (
    "question variant, context variant, query string, "
    "messages array<struct<role: string, content: string>>"
)
# The same fields as the members of a struct type.
REQUEST_FIELDS = (
    "question: variant, context: variant, query: string, "
    "messages: array<struct<role: string, content: string>>"
)
LAYOUTS = ("lines", "array")


def read_requests(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Requests from JSON lines, or from files that hold one JSON array each.

    Lines are read in splits, blank ones skipped; a short array on one line works too. The ``array``
    layout is for files that are one array, on one line or many, and reads these in splits as well. A
    malformed record fails the query, and so does anything around the array.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}: {layout}")
    if layout == "array":
        return array_items(spark, path, f"struct<{REQUEST_FIELDS}>").select("value.*")
    return spark.read.schema(REQUEST_SCHEMA).option("mode", "FAILFAST").json(path)


def parse_line(line: Column) -> Column:
    """Request struct of one JSON text, for lines that come from a table or a stream."""
    return F.from_json(line, REQUEST_SCHEMA, {"mode": "FAILFAST"})


def write_results(df: DataFrame, path: str) -> None:
    """One JSON object per line with all four fields; nulls are written, text is not escaped."""
    df.select("question", "context", "predicted_sql", "ground_truth_sql").write.option(
        "ignoreNullFields", "false"
    ).json(path)


RESULT_SCHEMA = "question string, context string, predicted_sql string, ground_truth_sql string"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results as written; a malformed line fails the query."""
    return spark.read.schema(RESULT_SCHEMA).option("mode", "FAILFAST").json(path)
