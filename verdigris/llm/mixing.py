"""Mixing sources to target weights by Poisson replication, in built-in expressions only.

A document of a source whose target is r times its size is repeated Poisson(r) times. The count comes
from inverting the distribution at a number that is hashed from seed and id, so it does not depend on
partitions or retries. Copies are then dealt over all partitions by a hash, and sorted by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import text_of
from verdigris.sources.storage import stored

# Mean that is inverted in one go. A larger mean is a sum of independent counts with equal parts of it.
PART_MEAN = 8.0
# Steps of one inversion: past so many, nothing of Poisson(PART_MEAN) is left that a double can tell from 1.
STEPS = 64
# Exponent of a source's size in its default weight: below 1 small sources are raised.
TEMPER = 0.7
# Sources up to which their rates are broadcast, after counting them; beyond it they are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts: 52 bits of it."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def poisson_count(rate: Column, key: Column, seed: int) -> Column:
    """The least k at which the distribution function of Poisson(rate) exceeds the hashed number."""
    parts = F.greatest(F.ceil(rate / PART_MEAN), F.lit(1)).cast("int")
    mean = rate / parts

    def one(part: Column) -> Column:
        level = _uniform(F.lit(str(seed)), key, part.cast("string"))
        start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.lit(0).alias("k"), level.alias("level"))

        def step(state: Column, k: Column) -> Column:
            term = state["term"] * mean / k
            further = F.struct(
                term.alias("term"), (state["total"] + term).alias("total"), (state["k"] + 1).alias("k"), state["level"].alias("level")
            )
            return F.when(state["total"] > state["level"], state).otherwise(further)

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda state: state["k"])

    counts = F.transform(F.sequence(F.lit(0), parts - 1), one)
    return F.when(rate > 0, F.aggregate(counts, F.lit(0), lambda total, count: total + count)).otherwise(0)


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(source, rate): how often a document of each source should appear on average.

    A document's size is its characters plus one. ``weights`` gives shares of the mix, scaled to sum to
    one; a source without a weight gets none. By default a source weighs its size to the power
    ``TEMPER``. The mix as a whole keeps the size of the input. A null source is a source of its own.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.length(text_of(text_col)) + 1).cast("double").alias("size")
    )
    if weights is None:
        weight = F.pow("size", F.lit(TEMPER))
    else:
        pairs = [F.lit(item) for pair in weights.items() for item in pair]
        given = F.create_map(*pairs)[F.col("source")] if pairs else F.lit(None)
        weight = F.coalesce(given.cast("double"), F.lit(0.0))
    weighed = sizes.withColumn("weight", weight)
    total = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if not total.weight:
        return weighed.select("source", F.lit(0.0).alias("rate"))
    return weighed.select("source", (F.col("weight") / total.weight * total.size / F.col("size")).alias("rate"))


def replicate(
    docs: DataFrame, rates: DataFrame, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(row, copy, n_copies, shuffle_key): each copy of each document, globally shuffled.

    ``row`` is the row of ``docs``. Rows with the same id get the same count; without an id a digest
    of text and source stands for it. A source without a rate has no copies. Rates are one row per source: they are counted
    and broadcast when they are few, so that documents are not shuffled by source; otherwise adaptive
    execution splits a hot source. Copies are dealt by a hash of id and copy number, which is even
    whatever the sources are; equal rows without an id go together.
    """
    rates = stored(rates, "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    # The mark keeps a digest apart from ids that are text.
    digest = F.concat(F.lit("|"), F.md5(F.concat_ws("|", F.md5(text_of(text_col)), F.col(source_col).cast("string"))))
    key = F.coalesce(F.col(id_col).cast("string"), digest)
    keyed = docs.select(whole, key.alias("key"), F.col(source_col).alias("doc_source"))
    rated = keyed.join(rates, F.col("doc_source").eqNullSafe(F.col("source")))
    counted = rated.withColumn("n_copies", poisson_count(F.col("rate"), F.col("key"), seed))
    copies = counted.filter("n_copies > 0").select(
        "row", "key", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy")
    )
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("shuffle"), F.col("key"), F.col("copy").cast("string")))
    keyed = copies.select("row", "copy", "n_copies", order.alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = 0) -> DataFrame:
    """The columns of ``docs``, each document as often as its count says, in global random order."""
    return replicate(docs, source_rates(docs, weights), seed).select("row.*")
