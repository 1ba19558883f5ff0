"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that the contracts name, and a word.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
# Rows of an Arrow batch that a Python step looks at together.
SLICE = 512


def text_of(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache(purpose: str) -> dict:
    """A dictionary that lives in the Python worker until a step asks for another purpose.

    Workers outlive their steps, so what a step remembers would else stay beside what later steps remember.
    """
    name = "_verdigris_worker_cache"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if held.get("purpose") != purpose:
        held["purpose"], held["kept"] = purpose, {}
    return held["kept"]


def release_worker_cache() -> None:
    """For steps that remember nothing: what earlier ones remembered is given back."""
    worker_cache("")


def slices(batches, size: int = SLICE):
    """The batches in pieces of ``size`` rows, so that a step's memory follows the rows it looks at."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
