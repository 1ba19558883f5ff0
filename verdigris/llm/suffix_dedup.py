"""Repeated passages by merging Burrows-Wheeler transforms.

Every byte that a repeated string of ``length`` bytes covers is removed. The steps:

1. *Anchors.* Of each window of ``length`` bytes the anchor is the ``ANCHOR``-byte string with the
   smallest hash, the first of equal ones. Equal windows have equal anchors at equal places, so
   windows under an anchor that occurs once cannot repeat. Neighbouring windows with the same anchor
   are one segment. Only hashes travel here.
2. *Equal segments* are collapsed: what occurs twice is repeated as a whole.
3. *Merge.* Different segments under one anchor meet in one task. They are dealt to shards; each shard
   gets a suffix order and a Burrows-Wheeler transform over blocks of ``BLOCK`` bytes, so a window of
   400 bytes is ten symbols. The shards' transforms are merged by refining the interleave (Holt and
   McMillan 2014): in round h a stable pass over the preceding symbols orders all suffixes by their
   first h symbols. Where an order first breaks gives the common prefix (Egidi and Manzini 2017); runs
   unbroken after the last round are the repeated intervals. No suffix is compared or sorted again.
4. An anchor with very many different segments is split before the merge: windows are parted by their
   distance to the anchor, which gives each part a longer string in common to deal by. In the end a
   part is one distance, its string the whole window, and all its pieces equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, shuffle_partitions, slices, worker_cache
from verdigris.sources.storage import stored

ANCHOR = 64
BLOCK = 40
# Low bits that hold a place while anchors are compared: enough for any string Spark can hold.
PLACE_BITS = 31
# Ranges that the windows under a crowded anchor are parted into, again and again.
FAN = 8
# Different segments of an anchor that are merged in one task at most; more are split first.
MERGED_SEGMENTS = 400
# Bytes of segments that are merged together, and shards they are dealt to.
MERGED_BYTES = 1 << 17
SHARDS = 4
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, and powers of the multiplier and of its inverse."""
    cache = worker_cache("passages")
    if "rolling" not in cache or len(cache["rolling"][1]) < count:
        size = max(1 << 16, 1 << (count - 1).bit_length())
        values = np.random.default_rng(20140614).integers(1, 1 << 63, 256, dtype=np.uint64)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        np.multiply.accumulate(np.full(size - 1, _MULTIPLIER, np.uint64), out=up[1:])
        np.multiply.accumulate(np.full(size - 1, _INVERSE, np.uint64), out=down[1:])
        cache["rolling"] = (values, up, down)
    return cache["rolling"]


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each string of ``width`` bytes."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    values, up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * up[:n], out=sums[1:])
    hashes = (sums[width:] - sums[:-width]) * down[: n - width + 1]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values: from running minima within blocks, forwards and backwards."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchored_segments(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first window, number of windows) of each segment of a text.

    A segment is a run of windows with the same anchor: the least upper half of a hash in the window,
    the first of equal ones. That depends on nothing but the window's own bytes.
    """
    hashes = rolling_hashes(data, ANCHOR)
    reach = length - ANCHOR + 1
    if len(hashes) < reach:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    low = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    places = (_sliding_least(ranked, reach) & low).astype(np.int64)
    new = np.ones(len(places), bool)
    new[1:] = places[1:] != places[:-1]
    first = np.flatnonzero(new)
    place = places[first]
    return hashes[place], place, first, np.diff(np.append(first, len(places)))


def _digest(data: bytes, lead: int) -> int:
    """A 63-bit number of a string and of where the anchor stands in it."""
    return xxhash.xxh3_64_intdigest(data, seed=lead) >> 1


def find_segments(texts: DataFrame, length: int) -> DataFrame:
    """(key, content, print, first, windows, place): segments of every text, by anchor. No bytes travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            found: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                keys, places, firsts, counts = anchored_segments(np.frombuffer(raw, np.uint8), length)
                if not len(keys):
                    continue
                contents = [
                    _digest(raw[first : first + count + length - 1], place - first)
                    for first, count, place in zip(firsts.tolist(), counts.tolist(), places.tolist())
                ]
                prints = np.full(len(keys), number, np.int64)
                for column, part in zip(found, ((keys >> np.uint64(1)).view(np.int64), np.array(contents), prints, firsts, counts, places)):
                    column.append(part)
            if found[0]:
                columns = [pa.array(np.concatenate(column)) for column in found]
                yield pa.RecordBatch.from_arrays(columns, ["key", "content", "print", "first", "windows", "place"])

    return texts.select("print", "text").mapInArrow(
        run, "key long, content long, print long, first long, windows long, place long"
    )


def _split(with_parts: DataFrame, length: int) -> DataFrame:
    """The parts of (print, text, parts), each cut into ``FAN`` ranges of the distance to the anchor.

    All windows of a range contain the string from the start of the nearest to the end of the farthest;
    ``group`` is a number of that string. No bytes travel.
    """
    names = ["key", "content", "n", "print", "root", "group", "piece", "first", "windows", "place", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows: list[tuple[int, ...]] = []
            for number, text, parts in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                raw = text.encode("utf-8", "surrogatepass")
                for part in parts:
                    place, wide = part["place"], part["high"] - part["low"] + 1
                    cuts = sorted({part["low"] + step * wide // FAN for step in range(FAN)})
                    for low, high in zip(cuts, [*[cut - 1 for cut in cuts[1:]], part["high"]]):
                        first = max(part["first"], place - high)
                        stop = min(part["first"] + part["windows"], place - low + 1)
                        if first < stop:
                            rows.append((
                                part["key"], part["content"], part["n"], number, part["root"],
                                _digest(raw[place - low : place - high + length], low + 1),
                                _digest(raw[first : stop + length - 1], place - first), first, stop - first, place, low, high,
                            ))
            columns = [pa.array(column, pa.int64()) for column in (zip(*rows) if rows else [[]] * len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_parts.select("print", "text", "parts").mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _with_bytes(with_parts: DataFrame, length: int) -> DataFrame:
    """The parts of (text, parts) with their bytes."""
    names = ["key", "content", "group", "piece", "lead", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows: list[tuple] = []
            for text, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for part in parts:
                    data = raw[part["first"] : part["first"] + part["windows"] + length - 1]
                    rows.append((*[part[name] for name in names], data))
            kinds = [pa.int64()] * len(names) + [pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "bytes"])

    schema = ", ".join(f"{name} long" for name in names)
    return with_parts.select("text", "parts").mapInArrow(run, f"{schema}, bytes binary")


def suffix_order(text: np.ndarray, marks: int) -> np.ndarray:
    """The suffixes of ``text`` in order, by prefix doubling. The first ``marks`` numbers are end marks, used once each."""
    rank = text.astype(np.int64)
    n, width = len(rank), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = rank[width:] + 1
        values, rank = np.unique(rank * np.int64(n + marks + int(rank.max()) + 2) + ahead, return_inverse=True)
        if len(values) == n:
            break
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class Shard:
    """Strings of block numbers, their suffix order and Burrows-Wheeler transform.

    ``strings`` holds them one after the other, 0 for the end mark of each; marks rank in their order.
    """

    def __init__(self, strings: np.ndarray):
        ends = strings == 0
        self.marks = int(ends.sum())
        numbered = strings.astype(np.int64) + self.marks - 1
        numbered[ends] = np.arange(self.marks)
        self.order = suffix_order(numbered, self.marks)
        # The symbol before each suffix; before the first of a string stands the mark of the one before it.
        self.transform = strings[self.order - 1]


def merge_transforms(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes after ``rounds`` refinements, and common prefixes.

    Returns the merged order as rows of the shards put one after the other, and for each place the
    symbols that it shares with the place before it, ``rounds`` if the order is unbroken there. Each
    round reads the transforms in the order so far and deals them to their symbols, stably; end marks
    have fixed places at the front.
    """
    sizes = [len(shard.order) for shard in shards]
    transform = np.concatenate([shard.transform for shard in shards]).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    total = int(base[-1])
    source = np.repeat(np.arange(len(shards), dtype=np.int8), sizes)
    fixed = np.repeat(np.arange(len(shards), dtype=np.int8), [shard.marks for shard in shards])
    common = np.full(total, rounds, np.int32)
    common[:1] = 0
    block = np.zeros(total, np.int64)
    bits = max(1, total.bit_length())
    for done in range(rounds):
        rows = _rows_of(source, base)
        symbols = transform[rows]
        inner = np.flatnonzero(symbols)
        dealt = np.sort((symbols[inner] << bits) | inner)
        place = dealt & ((1 << bits) - 1)
        symbol = dealt >> bits
        broken = np.ones(total, bool)
        broken[len(fixed) + 1 :] = (symbol[1:] != symbol[:-1]) | (block[place[1:]] != block[place[:-1]])
        source = np.concatenate([fixed, source[place]])
        common[broken & (common == rounds)] = done
        block = np.cumsum(broken)
    return _rows_of(source, base), common


def _rows_of(source: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Rows of the shards in merged order: within a shard they keep their own order."""
    rows = np.empty(len(source), np.int64)
    for shard in range(len(base) - 1):
        mine = np.flatnonzero(source == shard)
        rows[mine] = base[shard] + np.arange(len(mine))
    return rows


def repeated_windows(pieces: list[bytes], windows: list[int], length: int, block: int = BLOCK, shards: int = SHARDS) -> list[np.ndarray]:
    """For each piece, which of its windows occur in another piece or again in the same one."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    hashes = rolling_hashes(data, block)
    starts = np.concatenate([[0], np.cumsum([len(piece) for piece in pieces])])
    counts = [len(piece) - block + 1 for piece in pieces]
    inside = np.concatenate([hashes[start : start + count] for start, count in zip(starts, counts)])
    _, numbers = np.unique(inside, return_inverse=True)
    numbers = numbers + 1
    # Phase p of a piece is the string of blocks at p, p + block, ...: the columns of a table.
    strings, heights, at = [], [], 0
    for count in counts:
        height = -(-count // block) + 1
        grid = np.zeros(height * block, np.int64)
        grid[:count] = numbers[at : at + count]
        strings.append(grid.reshape(height, block).T.ravel())
        heights.append(height)
        at += count
    share = -(-len(pieces) // max(1, min(shards, len(pieces))))
    groups = [range(k, min(k + share, len(pieces))) for k in range(0, len(pieces), share)]
    built = [Shard(np.concatenate([strings[k] for k in group])) for group in groups]
    rows, common = merge_transforms(built, length // block)
    unbroken = common == length // block
    again = unbroken.copy()
    again[:-1] |= unbroken[1:]
    base = np.concatenate([[0], np.cumsum([len(shard.order) for shard in built])])
    place = np.concatenate([shard.order + start for shard, start in zip(built, base)])
    found = np.zeros(base[-1], bool)
    found[place[rows]] = again
    flags, at = [], 0
    for string, height, count in zip(strings, heights, windows):
        phases = found[at : at + len(string)].reshape(block, height).T.ravel()
        flags.append(phases[:count])
        at += len(string)
    return flags


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_SPANS = "array<struct<low:long,high:long>>"


def _span(low: Column, high: Column) -> Column:
    return F.array(F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))).alias("spans")


def _merge(pieces: DataFrame, length: int) -> DataFrame:
    """(key, content, spans): the repeated windows of each different piece, as ranges from the segment's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, group = 0, None

        def emit() -> pa.RecordBatch:
            flags = repeated_windows([row[6] for row in held], [row[5] for row in held], length)
            spans = [[{"low": row[4] + a, "high": row[4] + b} for a, b in _runs(flag)] for row, flag in zip(held, flags)]
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            columns = [pa.array([row[k] for row in held], pa.int64()) for k in (2, 3)] + [pa.array(spans, kind)]
            return pa.RecordBatch.from_arrays(columns, ["key", "content", "spans"])

        for batch in slices(batches, 256):
            for row in zip(*[batch.column(k).to_pylist() for k in range(7)]):
                if row[0] != group and size >= MERGED_BYTES:
                    yield emit()
                    held, size = [], 0
                group = row[0]
                held.append(row)
                size += len(row[6])
        if held:
            yield emit()

    dealt = pieces.repartition(shuffle_partitions(pieces.sparkSession), "group").sortWithinPartitions("group", "piece")
    dealt = dealt.select("group", "piece", "key", "content", "lead", "windows", "bytes")
    return dealt.mapInArrow(run, f"key long, content long, spans {_SPANS}")


def _cut(with_spans: DataFrame, length: int) -> DataFrame:
    """(print, n_removed, n_spans, kept_sha256, kept): the texts without what repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows: list[tuple] = []
            for number, text, spans in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                raw = text.encode("utf-8", "surrogatepass")
                marks = np.zeros(len(raw) + 1, np.int32)
                for span in spans:
                    marks[span["low"]] += 1
                    marks[span["high"] + length - 1] -= 1
                gone = np.cumsum(marks[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((number, int(gone.sum()), len(_runs(gone)), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["print", "n_removed", "n_spans", "kept_sha256", "kept"])

    return with_spans.select("print", "text", "spans").mapInArrow(
        run, "print long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def remove_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row, and the bytes left with ``keep_bytes``.

    A byte goes when a string of ``length`` bytes covers it that also starts anywhere else, in the same
    text or another. Texts are UTF-8 and judged as they came in, so all copies of a passage go. Null
    and empty texts have no byte; texts shorter than ``length`` stay whole. Repeated rows are copies of
    each other whatever their ids; ids may be null. Strings are compared as 64-bit hashes of blocks.
    """
    if length % BLOCK or length <= ANCHOR:
        raise ValueError(f"length must be a multiple of {BLOCK} and over {ANCHOR}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("print"))
    segments = stored(find_segments(texts.filter(F.octet_length("text") >= length), length), "repeat-segments")
    several = segments.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    segments = stored(segments.join(several, "key", "left_semi"), "repeat-candidates")
    owner = F.struct("print", "first", "windows", "place")
    contents = stored(segments.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(owner).alias("owner")), "repeat-contents")
    mixed = contents.groupBy("key").agg(F.count("*").alias("contents")).filter("contents > 1")
    mixed = stored(mixed, "repeat-mixed")

    # The texts that matter, once each: one row stands for all rows with that text.
    rep = texts.groupBy("print").agg(F.min("id").alias("rep"))
    wanted = segments.select("print").distinct().join(rep, "print")
    same = (texts["print"] == wanted["print"]) & texts["id"].eqNullSafe(wanted["rep"])
    whole = stored(texts.join(wanted, same).select(texts["print"], "text").dropDuplicates(["print"]), "repeat-texts")

    def beside_texts(rows: DataFrame, *names: str) -> DataFrame:
        """(print, text, parts): rows of pieces gathered beside the text that they stand in."""
        parts = rows.groupBy("print").agg(F.collect_list(F.struct(*names)).alias("parts"))
        return whole.join(parts, "print").select("print", "text", "parts")

    # What occurs again as a whole; of the rest, one piece of each different content goes to a merge.
    verdict = contents.filter("n > 1").select("key", "content", _span(F.lit(0), F.col("owner.windows")))
    zero = F.lit(0).cast("long")
    merged = ["print", "key", "content", "group", "piece", "lead", "first", "windows"]
    owners = contents.join(mixed, "key").select("key", "content", "n", "contents", "owner.*")
    to_merge = owners.filter(F.col("contents") <= MERGED_SEGMENTS).select(
        "print", "key", "content", F.col("key").alias("group"), F.col("content").alias("piece"), zero.alias("lead"), "first", "windows"
    )
    open_ = owners.filter(F.col("contents") > MERGED_SEGMENTS).select(
        "print", "key", "content", "n", F.col("first").alias("root"), "first", "windows", "place", zero.alias("low"),
        F.lit(length - ANCHOR).cast("long").alias("high"),
    )
    open_ = stored(open_, "repeat-crowded")
    while not open_.isEmpty():
        # Only pieces whose group is still crowded are cut again.
        cut = _split(beside_texts(open_, *[name for name in open_.columns if name != "print"]), length)
        cut = stored(cut, "repeat-pieces")
        mine = F.struct("print", "key", "content", "root", "first", "windows", "place", "low", "high")
        different = stored(cut.groupBy("group", "piece").agg(F.sum("n").alias("n"), F.min(mine).alias("owner")), "repeat-different")
        counted = different.groupBy("group").agg(F.count("*").alias("pieces"))
        again = cut.join(different.filter("n > 1").select("group", "piece"), ["group", "piece"], "left_semi")
        lead = F.col("first") - F.col("root")
        verdict = verdict.unionByName(again.select("key", "content", _span(lead, lead + F.col("windows"))))
        several = different.join(counted.filter("pieces > 1"), "group").select("group", "piece", "n", "pieces", "owner.*")
        few = several.filter(F.col("pieces") <= MERGED_SEGMENTS).withColumn("lead", lead)
        to_merge = to_merge.unionByName(few.select(*to_merge.columns))
        open_ = stored(several.filter(F.col("pieces") > MERGED_SEGMENTS).select(*open_.columns), "repeat-crowded")
    with_bytes = _with_bytes(beside_texts(to_merge, *merged[1:]), length)
    verdict = verdict.unionByName(stored(_merge(with_bytes, length), "repeat-merged"))
    verdict = verdict.filter(F.size("spans") > 0)
    covered = segments.select("print", "key", "content", "first").distinct().join(verdict, ["key", "content"]).select(
        "print", F.transform("spans", lambda s: F.struct((s["low"] + F.col("first")).alias("low"), (s["high"] + F.col("first")).alias("high"))).alias("spans")
    )
    covered = covered.groupBy("print").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    cut = stored(_cut(whole.join(covered, "print"), length), "repeat-cut")
    plain = texts.select(
        "id", "print", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"),
        *([F.col("text").cast("binary").alias("bytes")] if keep_bytes else []),
    )
    found = plain.join(cut if keep_bytes else cut.drop("kept"), "print", "left")
    return found.select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        *([F.coalesce("kept", "bytes").alias("kept")] if keep_bytes else []),
    )
