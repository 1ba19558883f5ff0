"""Files that hold one JSON value each, read so that nothing in them is lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def whole_values(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(value, source_file) per file; ``schema`` is the type of the value, as DDL.

    Each file is one task and one row, which is what a value spread over lines needs. The text is read
    as the only item of a list, so a second value behind the first, or a broken one, fails the query
    instead of being passed over. A blank file has no value.
    """
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    listed = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), f"array<{schema}>", {"mode": "FAILFAST"})
    counted = files.filter(F.trim("value") != "").withColumn("_values", listed)
    surplus = F.raise_error(F.concat(F.lit("more than one JSON value in "), F.col("source_file")))
    only = F.when(F.size("_values") == 1, F.col("_values")).otherwise(surplus.cast(f"array<{schema}>"))
    return counted.select(F.get(only, F.lit(0)).alias("value"), "source_file")
