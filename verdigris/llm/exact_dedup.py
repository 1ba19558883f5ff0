"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then the full hash.

Each step looks only at the groups that the step before left with two rows or more, and only the last
one reads whole texts, for the survivors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SPACE, text_of
from verdigris.sources.storage import stored

# Characters of the normalised text that the prefix hash reads.
PREFIX = 64


def normalised(column: str = "text") -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(text_of(column), SPACE, " ")


def _several(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys that two rows or more have. Counts combine before the shuffle, so no key is too hot."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1").select(*keys)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, carried columns), one row per row of ``docs``.

    Rows are equal when their normalised texts are. Of equal rows the one with the smallest id is
    kept; a null id comes after all others, and of repeated rows with the same id one is kept. Null
    and empty texts are equal to each other. ``carry`` adds expressions over the columns of ``docs``.
    An empty table gives an empty result; other columns of ``docs`` play no part.
    """
    carry = carry or {}
    carried = F.struct(*[value.alias(name) for name, value in carry.items()]) if carry else F.lit(None)
    rows = docs.select(
        F.col(id_col).alias("id"), normalised(text_col).alias("norm"), carried.alias("carried")
    ).withColumns({"chars": F.length("norm"), "head": F.xxhash64(F.substring("norm", 1, PREFIX))})

    # Step 1 and 2, on a narrow table: lengths that occur again, and in these the prefixes that do.
    prints = stored(rows.select("chars", "head"), "dedup-prints")
    same_length = prints.join(_several(prints, "chars"), "chars", "left_semi")
    same_head = _several(same_length, "chars", "head").withColumn("again", F.lit(True))

    # Step 3: the full hash, of survivors only. The tag tells repeated rows apart.
    hashed = rows.join(same_head, ["chars", "head"], "left").select(
        "id", "carried", "chars", "head",
        F.when(F.col("again"), F.sha2("norm", 256)).alias("full"),
        F.monotonically_increasing_id().alias("tag"),
    )
    hashed = stored(hashed, "dedup-hashed")
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("tag").alias("tag"))
    groups = (
        hashed.filter("full IS NOT NULL")
        .groupBy("full", "chars", "head")
        .agg(F.min(rank).alias("first"), F.count("*").alias("size"))
        .filter("size > 1")
    )
    found = hashed.join(groups, ["full", "chars", "head"], "left")
    grouped = F.col("size").isNotNull()
    columns = [
        F.col("id").alias(id_col),
        F.when(grouped, F.col("first.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, F.col("first.tag") == F.col("tag")).otherwise(True).alias("kept"),
    ]
    return found.select(*columns, *[F.col(f"carried.{name}").alias(name) for name in carry])


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    found = exact_duplicates(docs, id_col, text_col, {"whole_row": whole})
    return found.filter("kept").select("whole_row.*")
