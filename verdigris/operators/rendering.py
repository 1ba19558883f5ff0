"""Training texts, evaluation prompts, and checks on the rendered texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.functions import text as T
from verdigris.functions.cleaning import token_count
from verdigris.functions.rendering import CHATML, ChatTemplate

# Fixed value: the sequence length that rendered texts are planned for.
MAX_SEQ_LENGTH = 2048


def training_texts(
    df: DataFrame, template: ChatTemplate = CHATML, keep: tuple[str, ...] = ("row_id",)
) -> DataFrame:
    """``text`` per chat record, never truncated; every column but ``keep`` is dropped."""
    return df.select(*keep, template.render(F.col("messages")).alias("text"))


def evaluation_prompts(df: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Add ``prompt``: system and question of an unpacked record, open for the reply."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.col("system").alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("question").alias("content")),
    )
    return df.withColumn("prompt", template.render(messages, add_generation_prompt=True))


def format_check(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``ends_open``: the stripped text ends with a bare ``assistant`` marker."""
    return df.withColumn("ends_open", F.endswith(T.strip(F.col(text)), F.lit("assistant")))


def null_parts(messages: str = "messages") -> Column:
    """Number of messages whose role or content is null, which render as empty text."""
    return F.size(F.filter(messages, lambda m: m["role"].isNull() | m["content"].isNull()))


def format_report(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: texts checked, texts that end open."""
    return format_check(df, text).agg(
        F.count(F.lit(1)).alias("n_texts"), F.count_if("ends_open").alias("n_ends_open")
    )


def length_profile(df: DataFrame, text: str = "text", limit: int = MAX_SEQ_LENGTH) -> DataFrame:
    """One row of token-length figures, exact under the approximate tokenizer.

    Texts are first counted per length, so that the percentiles work on a table with at most one
    row per distinct length.
    """
    lengths = df.groupBy(token_count(F.col(text)).alias("n_tokens")).agg(
        F.count(F.lit(1)).alias("n_texts")
    )
    over = F.when(F.col("n_tokens") > limit, F.col("n_texts")).otherwise(0)
    return lengths.agg(
        F.sum("n_texts").alias("n_texts"),
        F.sum(F.col("n_tokens") * F.col("n_texts")).alias("total_tokens"),
        F.min("n_tokens").alias("min_tokens"),
        F.percentile("n_tokens", F.lit(0.5), F.col("n_texts")).alias("p50_tokens"),
        F.percentile("n_tokens", F.lit(0.95), F.col("n_texts")).alias("p95_tokens"),
        F.percentile("n_tokens", F.lit(0.99), F.col("n_texts")).alias("p99_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        F.sum(over).alias("n_over_limit"),
    )
