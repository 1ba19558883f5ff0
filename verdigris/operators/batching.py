"""Batches of prompts of like length under a token budget.

A batch costs as many tokens as it has prompts times its longest one; what is not text is padding. Prompts
are put into classes of lengths within an eighth of each other. A class with many rows is dealt over salts,
so that no group grows with the table, and each group is cut into full batches, shortest prompts first.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.functions.cleaning import token_count
from verdigris.operators.prediction import Predictor, _predict_batch
from verdigris.sources.storage import stored

BATCH = ["length_class", "salt", "batch"]
# Tokens of a batch with padding, and the rows of a class and salt, about.
TOKEN_BUDGET = 4_096
GROUP_ROWS = 100_000


def length_class(n_tokens: Column) -> Column:
    """The least number with four leading binary digits that is not below ``n_tokens``; 1 for empty prompts."""
    n = F.greatest(n_tokens.cast("long"), F.lit(1).cast("long"))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(n)) - 4, F.lit(0)))
    return F.call_function("ceil", n / step) * step


def batches_by_length(
    prompts: DataFrame, key: str = "row_id", prompt: str = "prompt", budget: int = TOKEN_BUDGET, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """The prompts with n_tokens, length_class, salt and batch; the last three name a batch.

    No batch of several prompts costs more than ``budget`` tokens; a longer prompt is a batch of its own.
    Rows keep their columns. Null prompts count as empty; keys may be null or repeated, and rows that are
    alike may change places. Sizes of classes are broadcast: eight for each doubling of the length.
    Tokens are counted once: what is counted is written with its lengths and read back.
    """
    # Out of a generator, below which no filter is pushed: one on the class would count again.
    length = F.explode(F.array(token_count(F.coalesce(F.col(prompt), F.lit("")))))
    counted = prompts.select("*", length.alias("n_tokens"), F.xxhash64(F.col(key), F.col(prompt)).alias("_deal"))
    counted = stored(counted.withColumn("length_class", length_class(F.col("n_tokens"))), "batching-counted")
    salts = counted.groupBy("length_class").agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("_salts"))
    # Rows without a key spread by their text as well as they can.
    dealt = counted.join(F.broadcast(salts), "length_class").withColumn(
        "salt", F.pmod("_deal", F.col("_salts"))
    )
    place = F.row_number().over(Window.partitionBy("length_class", "salt").orderBy("n_tokens", key)) - 1
    size = F.greatest(F.lit(budget) / F.col("length_class"), F.lit(1)).cast("long")
    return dealt.withColumn("batch", F.floor(place / size)).select(*prompts.columns, "n_tokens", *BATCH)


def padding_report(batched: DataFrame) -> DataFrame:
    """(n_batches, n_prompts, n_tokens, padded_tokens, padding_share): what the batches cost."""
    each = batched.groupBy(*BATCH).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("n_tokens").alias("_tokens"), F.max("n_tokens").cast("long").alias("_longest")
    )
    total = each.agg(
        F.count(F.lit(1)).alias("n_batches"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_prompts"),
        F.coalesce(F.sum("_tokens"), F.lit(0)).alias("n_tokens"), F.coalesce(F.sum(F.col("_rows") * F.col("_longest")), F.lit(0)).alias("padded_tokens"),
    )
    share = (F.col("padded_tokens") - F.col("n_tokens")) / F.nullif(F.col("padded_tokens"), F.lit(0))
    return total.withColumn("padding_share", share)


def predict_batches(
    batched: DataFrame, make_predictor: Callable[[], Predictor], key: str = "row_id", prompt: str = "prompt", output: str = "raw_text"
) -> DataFrame:
    """(key, output, predict_error): each batch goes to the predictor as one; a failing one prompt by prompt.

    One group is one batch, so a task holds a budget's worth of prompts at a time. The predictor is made once
    per worker and function.
    """
    kind = batched.schema[key].dataType.simpleString()
    made: list[Predictor] = []

    def run(table: pa.Table) -> pa.Table:
        if not made:
            made.append(make_predictor())
        found = _predict_batch(made[0], table.column("prompt").to_pylist())
        texts, errors = zip(*found)
        return pa.table([table.column("key"), pa.array(texts, pa.string()), pa.array(errors, pa.string())], ["key", "text", "error"])

    rows = batched.select(F.col(key).alias("key"), F.coalesce(F.col(prompt), F.lit("")).alias("prompt"), *BATCH)
    called = rows.groupBy(*BATCH).applyInArrow(run, f"key {kind}, text string, error string")
    return called.select(F.col("key").alias(key), F.col("text").alias(output), F.col("error").alias("predict_error"))
