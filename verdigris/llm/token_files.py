"""Token ids in binary blocks of fixed-width bit packing.

The file format is a Parquet table with one row per block of whole documents:

=========== ==================================================================================
shard       number of the range of ids that the block belongs to, ascending
block       number of the block in its shard
first_token ids of the shard before the block
bits        width of an id: the fewest bits that hold every id of the vocabulary
doc_ids     the documents of the block, in ascending order
doc_starts  block offsets: where each document's ids begin in the block, in ids
n_ids       ids in the block
payload     the ids, ``bits`` each, lowest bit first, padded to whole bytes
=========== ==================================================================================

Id ``k`` of a block stands at bit ``k * bits``, so any id can be read alone and a whole block is
unpacked by one vectorised expression. A block is closed with the document that brings it to
``BLOCK_IDS``; a longer document has a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, shuffle_partitions, slices, text_of
from verdigris.llm.tokens import encoder_for, read_vocabulary, vocabulary_size

# Ids after which a block is closed.
BLOCK_IDS = 1 << 17
_BLOCKS = (
    "block int, first_token long, bits int, doc_ids array<{kind}>, doc_starts array<long>, n_ids long, payload binary"
)


def width_of(size: int) -> int:
    """Bits of an id when there are ``size`` of them."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest bit first."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    spread = (ids[:, None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from number ``first`` on; reads only the bytes that hold them."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", count, first * 2).astype(np.uint32)
    at = np.arange(first, first + count, dtype=np.int64) * bits
    low = int(at[0] >> 3) if count else 0
    bytes_ = np.frombuffer(payload, np.uint8)[low : ((first + count) * bits + 7) // 8]
    bytes_ = np.concatenate([bytes_, np.zeros(8, np.uint8)]).astype(np.uint64)
    place = (at >> 3) - low
    word = np.zeros(count, np.uint64)
    for step in range((bits + 14) // 8):
        word |= bytes_[place + step] << np.uint64(8 * step)
    return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def write_token_files(
    docs: DataFrame, path: str, vocabulary_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text, append ``end_id``, and write the blocks to ``path`` in ascending id order.

    Null text counts as empty: the end id alone. A null id comes first; rows with equal ids stand
    next to each other in the order of their texts' hashes. An empty table gives an empty file set. Ranges
    are cut on id and hash, so that null or repeated ids spread, and a task holds one block at a time.
    """
    spark = docs.sparkSession
    vocabulary = read_vocabulary(vocabulary_path)
    bits = width_of(max(vocabulary_size(vocabulary), end_id + 1))
    shared = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shared.value)
        block = first = 0
        ids: list = []
        parts: list[bytes] = []
        starts: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            packed = pack(np.frombuffer(b"".join(parts), "<u4"), bits)
            columns = [
                pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([bits], pa.int32()),
                pa.array([ids], pa.list_(arrow)), pa.array([starts], pa.list_(pa.int64())),
                pa.array([held], pa.int64()), pa.array([packed], pa.binary()),
            ]
            names = ["block", "first_token", "bits", "doc_ids", "doc_starts", "n_ids", "payload"]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in slices(batches, SLICE):
            encoded = encoder.encode(batch.column(1).to_pylist())
            for doc_id, found in zip(batch.column(0).to_pylist(), encoded):
                ids.append(doc_id)
                starts.append(held)
                parts += (found, end)
                held += len(found) // 4 + 1
                if held >= BLOCK_IDS:
                    yield close()
                    block, first = block + 1, first + held
                    ids, parts, starts, held = [], [], [], 0
        if ids:
            yield close()

    order = F.col("id"), F.xxhash64("text")
    ordered = (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
    )
    blocks = ordered.mapInArrow(run, _BLOCKS.format(kind=kind.simpleString()))
    blocks.withColumn("shard", F.spark_partition_id()).write.parquet(path)


def _shard_offsets(blocks: DataFrame) -> DataFrame:
    """(shard, offset): ids of all shards before. One row per shard: as many as the partitions that wrote the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    return shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))


def read_id_range(blocks: DataFrame, first: int, count: int) -> DataFrame:
    """(start, ids) per block that holds some of the ``count`` ids from number ``first`` on, counted over all files.

    ``ids`` are little-endian unsigned 32-bit integers, those asked for only, ``start`` the number of the first of
    them. Payloads of other blocks are not unpacked, nor is the rest of a block. Numbers beyond the end give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            rows = []
            for row in batch.to_pylist():
                low, high = max(first - row["start"], 0), min(first + count - row["start"], row["n_ids"])
                rows.append((row["start"] + low, unpack(row["payload"], row["bits"], high - low, low).astype("<u4").tobytes()))
            starts, ids = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["start", "ids"])

    placed = blocks.join(F.broadcast(_shard_offsets(blocks)), "shard").withColumn("start", F.col("first_token") + F.col("offset"))
    touched = placed.filter((F.col("start") < first + count) & (F.col("start") + F.col("n_ids") > first))
    return touched.select("start", "n_ids", "bits", "payload").mapInArrow(run, "start long, ids binary")


def read_documents(blocks: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of the documents whose ids ``wanted`` has, each unpacked alone.

    The block offsets say where a document lies; only blocks that hold a wanted one give their payload. An id that
    several documents have gives all of them; null ids and ids that no document has give nothing.
    """
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for row in batch.to_pylist():
                ids = [unpack(row["payload"], row["bits"], s["high"] - s["low"], s["low"]).astype("<u4").tobytes() for s in row["spots"]]
                found = pa.array([s["id"] for s in row["spots"]], batch.schema.field("spots").type.value_type.field("id").type)
                yield pa.RecordBatch.from_arrays([found, pa.array(ids, pa.binary())], ["id", "ids"])

    ends = F.concat(F.slice("doc_starts", F.lit(2), F.size("doc_starts")), F.array("n_ids"))
    spots = blocks.select(
        "shard", "block", F.inline(F.arrays_zip(F.col("doc_ids").alias("id"), F.col("doc_starts").alias("low"), ends.alias("high")))
    )
    spots = spots.join(wanted.select(F.col(id_col).alias("id")), "id", "left_semi")
    # A block's documents at most.
    gathered = spots.groupBy("shard", "block").agg(F.collect_list(F.struct("id", "low", "high")).alias("spots"))
    held = gathered.join(blocks.select("shard", "block", "bits", "payload"), ["shard", "block"]).select("spots", "bits", "payload")
    return held.mapInArrow(run, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def read_token_files(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, unpacked from the blocks.

    ``start`` counts the ids of all documents before it. The only whole-table step is a sum over
    shards, one row each.
    """
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["bits"], row["n_ids"]).astype("<u4")
                starts = row["doc_starts"]
                ends = [*starts[1:], row["n_ids"]]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                columns = [
                    pa.array([row["shard"]] * len(starts), pa.int32()),
                    pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                    pa.array([row["first_token"] + a for a in starts], pa.int64()),
                    pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "id", "start", "n_tokens", "ids_crc32"])

    documents = blocks.mapInArrow(run, f"shard int, id {kind}, start long, n_tokens long, ids_crc32 long")
    return documents.join(F.broadcast(_shard_offsets(blocks)), "shard").select(
        F.col("id").alias(id_col), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
