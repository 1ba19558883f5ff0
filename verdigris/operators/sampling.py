"""Seeded shuffle, exact-size sampling and splitting without a global sort.

The order of a seeded shuffle is ``md5(seed|key)``: it depends on the seed and the key alone, not on
partitions or engines. Keys must be unique.

A sample of exactly n rows is a cut in that order. The cut is found on the key column only: a
histogram over the first hex digits of the hash (its size is fixed by the number of digits) tells
the bucket that holds the n-th row, and only that bucket is ranked. The wide rows are then read
once and filtered against the cut; they are neither sorted nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.functions.text import md5_key

# 65,536 buckets: at 10^12 rows the one bucket that is ranked holds about 15 million hashes.
PREFIX_DIGITS = 4
AFTER_EVERY_HASH = "g"


def _bucket_offsets(hashes: DataFrame, digits: int) -> DataFrame:
    """(bucket, offset, n_in_bucket): rows that come before each hash prefix, and rows in it."""
    counts = hashes.groupBy(F.substring("_hash", 1, digits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_in_bucket")
    )
    # At most 16^digits rows, whatever the size of the table.
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("offset", F.sum("n_in_bucket").over(running) - F.col("n_in_bucket"))


def _cut_hash(keys: DataFrame, key: str, n: int, seed: int, digits: int) -> DataFrame:
    """One row holding the n-th smallest hash; no row when there are fewer keys."""
    hashes = keys.select(md5_key(seed, F.col(key)).alias("_hash"))
    cut_bucket = _bucket_offsets(hashes, digits).filter(
        (F.col("offset") < n) & (F.col("offset") + F.col("n_in_bucket") >= n)
    )
    in_bucket = hashes.withColumn("bucket", F.substring("_hash", 1, digits)).join(
        F.broadcast(cut_bucket), "bucket"
    )
    ranked = in_bucket.withColumn(
        "position",
        F.col("offset") + F.row_number().over(Window.partitionBy("bucket").orderBy("_hash")),
    )
    return ranked.filter(F.col("position") == n).select("_hash")


def before_cut(
    keys: DataFrame, key: str, n: int, seed: int, strict: bool = False, digits: int = PREFIX_DIGITS
) -> Column:
    """Condition that holds for exactly n keys; for all of them when there are fewer.

    With ``strict`` a table with fewer than n keys fails the query instead, and so does a key that
    stands twice at the cut, which would make the sample larger than n.
    """
    if n < 0:
        raise ValueError(f"sample size must not be negative: {n}")
    if n == 0:
        return F.lit(False)
    cut = _cut_hash(keys.select(key), key, n, seed, digits).scalar()
    if not strict:
        return md5_key(seed, F.col(key)) <= F.coalesce(cut, F.lit(AFTER_EVERY_HASH))
    up_to = keys.filter(md5_key(seed, F.col(key)) <= F.coalesce(cut, F.lit(AFTER_EVERY_HASH)))
    found = up_to.agg(F.count(F.lit(1))).scalar()
    wrong = F.raise_error(F.concat(F.lit(f"fewer than {n} rows to sample from, or repeated keys: found "), found.cast("string")))
    return md5_key(seed, F.col(key)) <= F.when(found == n, cut).otherwise(wrong.cast("string"))


def sample_exact(
    df: DataFrame, n: int, seed: int = 42, key: str = "row_id", strict: bool = False, digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Exactly n rows, the same for every partitioning. Keys must be unique; ``strict`` fails where they are not.

    More ``digits`` make the one bucket that is ranked smaller: rows / 16^digits on average.
    """
    return df.filter(before_cut(df, key, n, seed, strict, digits))


def with_sample_rank(
    sample: DataFrame, seed: int = 42, key: str = "row_id", digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Add ``sample_rank``, the 1-based position in the seeded order.

    The rank is the number of rows in earlier hash buckets plus the rank in the own bucket, so the
    ranking is spread over the buckets.
    """
    hashed = sample.withColumn("_hash", md5_key(seed, F.col(key)))
    offsets = _bucket_offsets(hashed.select("_hash"), digits).select("bucket", "offset")
    in_bucket = F.row_number().over(Window.partitionBy("bucket").orderBy("_hash"))
    return (
        hashed.withColumn("bucket", F.substring("_hash", 1, digits))
        .join(F.broadcast(offsets), "bucket")
        .withColumn("sample_rank", F.col("offset") + in_bucket)
        .drop("bucket", "offset", "_hash")
    )


def ranks_of(
    keys: DataFrame, wanted: DataFrame, seed: int = 42, key: str = "row_id", digits: int = PREFIX_DIGITS
) -> DataFrame:
    """(key, sample_rank) of a few wanted keys in the seeded order of ``keys``.

    Only the key column is read. Rows before each hash prefix are counted, and only the prefixes that
    the wanted keys fall into are ranked. ``wanted`` is broadcast: examples of a report, not a table.
    """
    few = wanted.select(key).distinct()
    buckets = few.select(F.substring(md5_key(seed, F.col(key)), 1, digits).alias("bucket")).distinct()
    hashes = keys.select(key, md5_key(seed, F.col(key)).alias("_hash"))
    offsets = _bucket_offsets(hashes, digits).select("bucket", "offset")
    near = hashes.withColumn("bucket", F.substring("_hash", 1, digits)).join(F.broadcast(buckets), "bucket")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("_hash"))
    ranked = near.withColumn("_place", place).join(F.broadcast(offsets), "bucket")
    return ranked.join(F.broadcast(few), key).select(key, (F.col("offset") + F.col("_place")).alias("sample_rank"))


def draw_with_replacement(
    df: DataFrame, k: int, seed: int = 42, key: str = "row_id", digits: int = PREFIX_DIGITS
) -> DataFrame:
    """The rows of k draws, each from all rows, with ``draw`` from 1 to k; a row drawn twice is there twice.

    A draw is a hash of seed and number mapped to a rank in the seeded order, so it is the same for every
    partitioning. Ranks are found by the counts of hash buckets; only buckets that are hit are ranked, on
    the key alone, and the wide rows are filtered once. Keys must be unique and not null. ``k`` is for
    examples of a report: the k keys are broadcast. An empty table gives no rows.
    """
    spark = df.sparkSession
    hashes = df.select(key, md5_key(seed, F.col(key)).alias("_hash"))
    offsets = _bucket_offsets(hashes.select("_hash"), digits)
    n = df.agg(F.count(key)).scalar()
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|draw|"), F.col("draw").cast("string"))), 1, 13), 16, 10)
    # 13 hex digits are a number below 2^52: scaled to the number of rows in whole numbers.
    ranks = spark.range(1, k + 1).select(F.col("id").alias("draw")).select(
        "draw", hashed.cast("decimal(38,0)").alias("_level"), n.cast("decimal(20,0)").alias("_n")
    ).select("draw", F.expr(f"_level * _n div {1 << 52}").alias("at"))
    # The buckets in order as one array, 65,536 at most; a draw belongs to the last one that starts before it.
    buckets = offsets.agg(F.array_sort(F.collect_list(F.struct("offset", "bucket")))).scalar()
    own = ranks.withColumn("_buckets", buckets).withColumn("own", F.get(F.reverse(F.filter("_buckets", lambda each: each["offset"] <= F.col("at"))), F.lit(0)))
    wanted = own.filter("own IS NOT NULL").select("draw", "own.bucket", (F.col("at") - F.col("own.offset") + 1).alias("_place"))
    near = hashes.withColumn("bucket", F.substring("_hash", 1, digits)).join(F.broadcast(wanted.select("bucket").distinct()), "bucket")
    placed = near.withColumn("_place", F.row_number().over(Window.partitionBy("bucket").orderBy("_hash")).cast("long"))
    drawn = placed.join(F.broadcast(wanted), ["bucket", "_place"]).select(key, "draw")
    return df.join(F.broadcast(drawn), key)


def split_train_test(
    df: DataFrame, test_size: int, seed: int = 42, key: str = "row_id", digits: int = PREFIX_DIGITS, strict: bool = False
) -> DataFrame:
    """Add ``split``: exactly ``test_size`` rows are ``test``, the others ``train``.

    Keys must be unique: a key that stands twice at the cut would give one row more. ``strict`` fails
    there, and where there are fewer rows than asked for.
    The split draws with its own seed text, so that it does not repeat the order of the sample.
    """
    salted = df.select(F.concat(F.lit("split|"), F.col(key).cast("string")).alias("_key"))
    condition = before_cut(salted, "_key", test_size, seed, strict, digits)
    return (
        df.withColumn("_key", F.concat(F.lit("split|"), F.col(key).cast("string")))
        .withColumn("split", F.when(condition, "test").otherwise("train"))
        .drop("_key")
    )
