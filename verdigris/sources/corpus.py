"""Read raw question-to-SQL corpora and read and write prepared chat records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORPUS_SCHEMA = "row_id bigint, context string, question string, answer string"
MESSAGES_SCHEMA = "messages array<struct<role: string, content: string>>"
PREPARED_SCHEMA = f"row_id bigint, {MESSAGES_SCHEMA}"


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rows of (row_id, context, question, answer), under a declared schema.

    ``row_id`` is a key of the source. It is never made up on reading: a generated number would
    change with the file layout, and with it every seeded sample.
    """
    options = {"mode": "FAILFAST"} if fmt == "json" else {}
    return spark.read.schema(CORPUS_SCHEMA).options(**options).format(fmt).load(path)


def write_prepared(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One chat record per line, in one folder per ``split``."""
    df.write.partitionBy("split").option("ignoreNullFields", "false").format(fmt).save(path)


def read_prepared(
    spark: SparkSession, path: str, split: str | None = None, fmt: str = "json"
) -> DataFrame:
    """Prepared records; naming a split reads the files of that folder only. A malformed line fails."""
    schema = f"{PREPARED_SCHEMA}, split string"
    options = {"mode": "FAILFAST"} if fmt == "json" else {}
    records = spark.read.schema(schema).options(**options).format(fmt).load(path)
    return records if split is None else records.filter(records.split == split)
