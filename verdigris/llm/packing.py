"""Best-fit packing in rounds: local best fit, full bins out, underfull bins merged as items.

Partitions pack their items by best fit, largest first. Bins that are nearly full leave at once. The
others travel on as single items to fewer partitions, where they are packed together, as long as the
smallest of them fits into any other. Only (id, piece, length) travel, never the tokens.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, slices, text_of
from verdigris.llm.tokens import encoder_for, read_vocabulary
from verdigris.sources.storage import stored

# Items that one task packs; the number of tasks follows from it.
ITEMS_PER_TASK = 50_000
# A bin leaves a round when at most this share of it is empty.
NEARLY_FULL = 0.01


def cut_lengths(total: int, limit: int) -> list[int]:
    """Lengths of the pieces of a document: the first may be shorter, the others are ``limit``."""
    first = total % limit
    return ([first] if first else []) + [limit] * (total // limit)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, largest first, goes to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), ascending
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[item], -1))
        if at == len(room):
            bins.append([item])
            free, chosen = capacity, len(bins) - 1
        else:
            free, chosen = room.pop(at)
            bins[chosen].append(item)
        if free > lengths[item]:
            insort(room, (free - lengths[item], chosen))
    return bins


def token_pieces(
    docs: DataFrame, vocabulary_path: str, end_id: int, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): the ids of each text and ``end_id``, cut at ``limit``.

    Null text counts as empty: the end id alone. Only texts longer than ``limit`` are cut.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shared.value)
        for batch in slices(batches, SLICE):
            rows: list[list[int]] = [[], [], [], [], []]
            for row, found in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids, start = found + end, 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, limit)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for column, value in zip(rows, (row, piece, start, length, crc)):
                        column.append(value)
                    start += length
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [batch.column(0).take(pa.array(rows[0], pa.int64()))]
            columns += [pa.array(values, kind) for values, kind in zip(rows[1:], kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col))
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def _round(items: DataFrame, number: int, tasks: int, capacity: int, last: bool) -> DataFrame:
    """One round of best fit: (done, bin, fill, members), members in place order."""
    member_type = items.schema["members"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        # The order that rows arrive in may differ when a lost task is run again.
        table = table.sort_by([("length", "descending"), ("key", "ascending")])
        lengths = table.column("length").to_pylist()
        packed = best_fit(lengths, capacity)
        order = pa.array([item for members in packed for item in members], pa.int64())
        fills = [sum(lengths[item] for item in members) for members in packed]
        lists = table.column("members").combine_chunks()
        lists = lists if isinstance(lists, pa.ListArray) else lists.chunk(0)
        taken = lists.take(order)
        per_item = np.diff(taken.offsets.to_numpy())
        ends = np.cumsum([len(members) for members in packed])
        sizes = np.concatenate([[0], np.cumsum(per_item)])[np.concatenate([[0], ends])]
        flat = taken.flatten()
        members = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)
        before = np.concatenate([[0], np.cumsum(flat.field("length").to_numpy())])
        places = before[:-1] - np.repeat(before[sizes[:-1]], np.diff(sizes))
        places = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(places, pa.int64()))
        base = (number << 54) | (TaskContext.get().partitionId() << 32)
        done = [last or fill >= capacity * (1 - NEARLY_FULL) for fill in fills]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(done, pa.bool_()), pa.array([base + n for n in range(len(packed))], pa.int64()),
                pa.array(fills, pa.int64()), members, places,
            ],
            ["done", "bin", "length", "members", "places"],
        )

    # Each round deals anew, so that bins meet others than before.
    dealt = items.select(F.xxhash64("members", F.lit(number)).alias("key"), "length", "members").repartition(tasks, "key")
    schema = f"done boolean, bin long, length long, members {member_type.simpleString()}, places array<long>"
    return dealt.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Columns of ``pieces`` with ``sequence_id`` and ``offset``, one row per piece.

    ``pieces`` has (id, piece, start, length, ids_crc32) with 0 < length <= capacity. A sequence
    holds at most ``capacity`` ids, its pieces stand without gaps from 0. A piece that fills a
    sequence alone skips the packing. Equal rows are packed each; an empty table gives an empty one.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    whole = pieces.filter(F.col("length") >= capacity)
    items = pieces.filter(F.col("length") < capacity).select(
        "length", F.array(F.struct(*pieces.columns, F.monotonically_increasing_id().alias("row"))).alias("members")
    )
    items = stored(items, "pack-items")
    waiting, number, finished = items.count(), 1, []
    while waiting:
        tasks = -(-waiting // ITEMS_PER_TASK)
        bins = stored(_round(items, number, tasks, capacity, tasks == 1), "pack-bins")
        finished.append(bins.filter("done"))
        held = bins.filter("NOT done")
        left, least = held.agg(F.count("*"), F.min("length")).first()
        # A bin goes on while the smallest one fits in; so the end is the same at every size.
        fits = held.filter(F.col("length") <= capacity - (least or 0))
        finished.append(held.filter(F.col("length") > capacity - (least or 0)))
        if left == waiting and tasks > 1:
            # No task could merge anything, so each had one bin of half or less at most. These go on, with as many
            # of the next larger ones: whoever of them fits into any bin fits into one of those.
            small = fits.filter(2 * F.col("length") <= capacity)
            large = fits.filter(2 * F.col("length") > capacity)
            taken = stored(large.orderBy("length", "bin").limit(small.count()), "pack-taken")
            finished.append(large.join(taken.select("bin"), "bin", "left_anti").select(*bins.columns))
            fits = small.unionByName(taken)
        items = fits.select("length", "members")
        waiting, number = items.count(), number + 1
    placed = [
        whole.select(*pieces.columns, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ]
    for bins in finished:
        flat = bins.select("bin", F.explode(F.arrays_zip("members", "places")).alias("m"))
        placed.append(
            flat.select(
                *[F.col(f"m.members.{name}").alias(name) for name in pieces.columns],
                F.col("bin").alias("sequence_id"), F.col("m.places").alias("offset"),
            )
        )
    result = placed[0]
    for part in placed[1:]:
        result = result.unionByName(part)
    return result
