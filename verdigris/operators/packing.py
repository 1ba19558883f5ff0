"""Pack rendered texts into sequences of a fixed number of tokens, as a trainer does that packs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigris.functions.cleaning import token_count
from verdigris.functions.text import md5_key
from verdigris.operators.rendering import MAX_SEQ_LENGTH

# Tokens that a shard should hold: the number of shards follows from the size of the table.
SHARD_TOKENS = 50_000_000


def pack_sequences(
    texts: DataFrame, key: str = "row_id", text: str = "text", limit: int = MAX_SEQ_LENGTH, seed: int = 42,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """(shard, pack, key, pack_offset, token_start, token_end): which tokens of a text stand where.

    Texts are dealt to shards by the hash of their key and put one after the other in hash order; every
    ``limit`` tokens a new pack begins. A text that crosses the border is cut there and goes on in the
    next pack, so no token is lost and only the last pack of a shard is short. Texts without tokens
    have no span. Tokens are those of the declared approximate tokenizer. Only (key, tokens) are
    shuffled; the number of shards grows with the table, so that a shard stays the work of one task.
    """
    counted = texts.select(F.col(key), F.coalesce(token_count(F.col(text)), F.lit(0)).cast("bigint").alias("_tokens"))
    counted = counted.filter("_tokens > 0").withColumn("_hash", md5_key(seed, F.col(key)))
    shards = F.greatest(F.ceil(counted.agg(F.sum("_tokens")).scalar() / shard_tokens), F.lit(1))
    number = F.conv(F.substring("_hash", 1, 12), 16, 10).cast("bigint")
    before = Window.partitionBy("shard").orderBy("_hash", key).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("shard", number % shards).withColumn(
        "_start", F.coalesce(F.sum("_tokens").over(before), F.lit(0))
    )
    packs = F.sequence(F.floor(F.col("_start") / limit), F.floor((F.col("_start") + F.col("_tokens") - 1) / limit))
    spans = placed.select("*", F.explode(packs).alias("pack"))
    first = F.greatest(F.col("_start"), F.col("pack") * limit)
    last = F.least(F.col("_start") + F.col("_tokens"), (F.col("pack") + 1) * limit)
    return spans.select(
        "shard", "pack", key, (first - F.col("pack") * limit).alias("pack_offset"),
        (first - F.col("_start")).alias("token_start"), (last - F.col("_start")).alias("token_end"),
    )
