"""N-gram Jaccard join with set-relation skipping.

Sets of word n-grams that share enough must share several of their rarest (the prefix filter), so an
index lists, by n-gram, the sets that have it in their prefix. Three relations skip most of the work:

* Index level: a set with too few listed n-grams that others have leaves the index at once; places so
  late in a prefix that too little is left to share are not listed; lists are cut into blocks by set
  size, and blocks too far apart are never joined; two entries of a list meet only when what follows
  their places in both sets is enough to link.
* Pair level: leaders that meet under a crowded n-gram are told apart by signatures, short parities whose
  difference is at most that of the sets, before a row is made for them.
* Answer level: sets highly similar to a leader form a star around it, and links found so far make
  components. A list within one component is skipped, and stars of one component never meet. Leaders
  are compared; from their distance and the members' own, by the triangle inequality of 1 - Jaccard,
  follows which stars may still link. Of two such stars the larger one's members are known by what sets
  them apart from their leader: who links with one of them, but not with the leader, shares some of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, WORD, release_worker_cache, shuffle_partitions, slices, text_of, worker_cache
from verdigris.llm.components import components
from verdigris.sources.storage import stored

# N-grams that a task counts together; those found again among them add up to the count of an n-gram.
CHUNK = 2_000_000
# N-grams counted as often are common: they stand last in every set, the rarer before the more frequent.
COMMON = 16
# Common n-grams that are known at most: the size of a broadcast. It affects the order of n-grams, and
# with it the work, but not the links.
MOVED = 1 << 20
# N-grams that two sets must share in their prefixes: at least so many, or so many in a hundred of their own.
MEETINGS = 8
MEETINGS_PERCENT = 3
# Rows by set up to which they are broadcast, after counting them; beyond it the other side is shuffled by id.
BROADCAST_SETS = 500_000
# Words remembered by a worker, and leaders that a set is compared with while stars are formed.
REMEMBERED = 500_000
LEADERS = 32
# Sets of one n-gram that form stars in one task, and central sets that every such task sees first.
DEALT = 256
HUBS = 4
# Bits of a set's signature, and entries of an n-gram beyond which they are compared by it before they meet.
SIGNATURE = 1024
CROWDED = 8
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct n-grams of ``size`` words as sorted 64-bit hashes.

    Words are what ASCII white space separates, with A-Z in lower case. A shorter text is one n-gram.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = worker_cache("words").setdefault("word-hashes", _WordHashes())
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    count = max(1, len(words) - size + 1)
    mixed = np.full(count, len(words) if len(words) < size else size, np.uint64)
    for shift in range(min(size, len(words))):
        mixed = (mixed ^ hashes[shift : shift + count]) * np.uint64(_MIX[shift % 3])
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def least_shared(size: int, percent: int) -> int:
    """N-grams that a set of this size shares with any set that it links with."""
    return -(-percent * size // 100)


def prefix_length(size: int, percent: int) -> int:
    """N-grams of which a set must share its meetings with any set that it links with.

    Two sets that share s n-grams share m of the first ``size - s + m`` of each, for any m up to s.
    """
    meetings = max(MEETINGS, size * MEETINGS_PERCENT // 100)
    return min(size, size - least_shared(size, percent) + meetings) if size else 0


def _meetings(size: Column, percent: int, steps: int) -> Column:
    """Lists in which a set must meet one that links with it, when either may be ``steps`` links smaller.

    That is the meetings of the smallest size in question, or what sets of that size share if it is less.
    """
    smallest = size
    for _ in range(steps):
        smallest = F.ceil(smallest * percent / 100)
    wanted = F.greatest(F.lit(MEETINGS), F.floor(smallest * MEETINGS_PERCENT / 100))
    return F.greatest(F.least(wanted, F.ceil(smallest * percent / 100)), F.lit(1))


def _counted(size: Column, percent: int) -> Column:
    """Meetings to wait for before a pair is compared: few enough that the bound on places stays tight.

    The i-th n-gram that two sets share leaves i fewer to share, so waiting loosens the bound by as much.
    """
    return F.greatest(F.lit(1), F.least(_meetings(size, percent, 0), F.lit(1) + F.floor(size / 100)))


def _enough_left(left: Column, size: Column, other: Column, waits: Column, percent: int) -> Column:
    """Whether ``left`` n-grams, from a shared one on, are enough for one of the first meetings of a link."""
    return (100 + percent) * (left + waits - 1) >= percent * (size + other)


def _common_shingles(docs: DataFrame, size: int) -> DataFrame:
    """(token, count) of n-grams found often within a chunk of a task, summed over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def emit() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], ["token", "count"]
            )

        for batch in slices(batches, SLICE):
            for text in batch.column(0).to_pylist():
                held.append(shingles(text, size))
                total += len(held[-1])
                if total >= CHUNK:
                    yield emit()
                    held, total = [], 0
        if held:
            yield emit()

    found = docs.select("text").mapInArrow(run, "token long, count long")
    return found.groupBy("token").agg(F.sum("count").alias("count"))


def _ordered(tokens: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """N-grams that are not common by hash, then the common ones by rank: one order for all sets."""
    if not len(common):
        return tokens
    at = np.searchsorted(common, tokens)
    at[at == len(common)] = 0
    is_common = common[at] == tokens
    last = tokens[is_common][np.argsort(rank[at[is_common]])]
    return np.concatenate([tokens[~is_common], last])


def _set_number(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64)))


def _described(docs: DataFrame, common, size: int, percent: int, kind: str) -> DataFrame:
    """(id, print, n_shingles, set_id, prefix) per row; ``print`` is a hash of the text.

    A set that a task has seen before has no prefix again; of many copies each task gives one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved, rank = np.frombuffer(common.value[0], np.uint64), np.frombuffer(common.value[1], np.int32)
        seen: set[int] = set()
        for batch in slices(batches, SLICE):
            sizes, numbers, prefixes = [], [], []
            for text in batch.column(1).to_pylist():
                tokens = shingles(text, size)
                number = _set_number(tokens) if len(tokens) else None
                sizes.append(len(tokens))
                numbers.append(number)
                if number in seen:
                    prefixes.append(tokens[:0].view(np.int64))
                else:
                    prefixes.append(_ordered(tokens, moved, rank)[: prefix_length(len(tokens), percent)].view(np.int64))
                    _remember(seen, number)
            columns = [
                batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "print", "n_shingles", "set_id", "prefix"])

    return docs.mapInArrow(run, f"id {kind}, print long, n_shingles long, set_id long, prefix array<long>")


def signature(tokens: np.ndarray) -> np.ndarray:
    """Bit i says whether the set has an odd number of the n-grams that are dealt to i.

    An n-gram that two sets share is in both signatures or in neither, so these differ in no more bits than the
    sets have n-grams apart.
    """
    odd = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % SIGNATURE, minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _remember(seen: set, number: int | None) -> None:
    if len(seen) > REMEMBERED:
        seen.clear()
    seen.add(number)


def _listed(rows: DataFrame) -> DataFrame:
    """(token, set_id, pos, n, sets): the n-grams of prefixes that several sets have, with the number of these sets.

    Prefixes are shuffled once, by n-gram. The rows of an n-gram are sorted; a set that several tasks have
    described stands next to itself and is listed once.
    """
    listed = rows.select("set_id", F.col("n_shingles").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    again = F.lag("set_id").over(Window.partitionBy("token").orderBy("set_id")).eqNullSafe(F.col("set_id"))
    once = listed.withColumn("again", again).filter("NOT again")
    return once.withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("sets > 1").drop("again")


def _beside(rows: DataFrame) -> DataFrame:
    """A stored table to join by set: broadcast when it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_SETS else rows


def _only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose set_id stands in ``ids``; when these are few, nothing is shuffled for it."""
    return sets.join(_beside(stored(ids.distinct(), "jaccard-ids")), "set_id", "left_semi")


def _whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(set_id, n, tokens, signature) of the wanted (set_id, rep, print), read again from the texts.

    A row with a null or repeated id meets only the sets whose text has its hash, so no id is a group of pairs.
    Equal texts under one id are given once by a task, and once in all: only if some are left, sets are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, SLICE):
            rows: list[tuple[int, int, bytes, np.ndarray]] = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number in seen:
                    continue
                tokens = shingles(text, size)
                # Texts of one hash are told apart by the set's number.
                if len(tokens) and _set_number(tokens) == number:
                    rows.append((number, len(tokens), tokens.tobytes(), signature(tokens)))
                    _remember(seen, number)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 4, kinds)],
                ["set_id", "n", "tokens", "signature"],
            )

    meant = _beside(wanted.select("set_id", "rep", F.col("print").alias("meant")))
    joined = docs.join(meant, F.col("id").eqNullSafe(F.col("rep")) & (F.col("print") == F.col("meant")))
    read = stored(joined.select("set_id", "text").mapInArrow(run, "set_id long, n long, tokens binary, signature array<long>"), "jaccard-tokens")
    repeated = read.groupBy("set_id").agg(F.count("*").alias("times")).filter("times > 1")
    return read if repeated.isEmpty() else stored(read.dropDuplicates(["set_id"]), "jaccard-tokens")


def _links(shared: int, a: int, b: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def _dealt(places: DataFrame) -> DataFrame:
    """(set_id, key, chunk, hub, weight): sets of one key in chunks of about ``DEALT``.

    The central sets of a key that has several chunks, those whose n-grams are found most often, stand in
    each of its chunks.
    """
    many = places.groupBy("key").agg(F.ceil(F.count("*") / DEALT).alias("chunks")).filter("chunks > 1")
    best = Window.partitionBy("key").orderBy(F.desc("weight"), "set_id")
    hubs = places.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= HUBS).join(many, "key")
    hubs = stored(hubs.select("set_id", "key", "weight", "chunks"), "jaccard-hubs")
    others = places.join(hubs.select("set_id", "key"), ["set_id", "key"], "left_anti").join(many, "key", "left").select(
        "set_id", "key", F.coalesce(F.pmod(F.xxhash64("set_id"), "chunks"), F.lit(0)).alias("chunk"), F.lit(0).alias("hub"), "weight"
    )
    spread = hubs.select("set_id", "key", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("hub"), "weight")
    return others.unionByName(spread)


def _stars(places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(set_id, leader, distance): a verified link of each member with the leader of its star.

    Sets of a chunk come central ones first. Each is compared with the latest leaders and joins the first
    that it links with, or becomes one itself. What this misses is found later; it only has to gather
    most of a group cheaply. A set that lies between many, as the text that they are copies of does,
    comes before them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        key, last, leaders = None, None, []
        for batch in slices(batches, 64):
            rows: list[tuple[int, int, float]] = []
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for first, chunk, number, count, raw in zip(*columns):
                if (first, chunk) != key:
                    key, last, leaders = (first, chunk), None, []
                if number == last:  # the same set again
                    continue
                tokens, last = np.frombuffer(raw, np.uint64), number
                for place, (leader, other) in enumerate(leaders):
                    if 100 * min(len(other), count) < percent * max(len(other), count):
                        continue
                    both = _shared(tokens, other)
                    if _links(both, count, len(other), percent):
                        rows.append((number, leader, 1 - both / (count + len(other) - both)))
                        leaders.insert(0, leaders.pop(place))
                        break
                else:
                    leaders.insert(0, (number, tokens))
                    del leaders[LEADERS:]
                    rows.append((number, number, 0.0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.float64()))],
                ["set_id", "leader", "distance"],
            )

    parts = shuffle_partitions(sets.sparkSession)
    # Who is alone under a key has nobody to meet: only the others' n-grams are shuffled.
    several = places.groupBy("key").agg(F.count("*").alias("several")).filter("several > 1").select("key")
    meeting = stored(places.join(several, "key", "left_semi"), "jaccard-places")
    alone = places.join(several, "key", "left_anti").select("set_id", F.col("set_id").alias("leader"), F.lit(0.0).alias("distance"))
    dealt = sets.join(_beside(stored(_dealt(meeting), "jaccard-dealt")), "set_id").repartition(parts, "key", "chunk")
    dealt = dealt.sortWithinPartitions("key", "chunk", F.desc("hub"), F.desc("weight"), "set_id")
    found = dealt.select("key", "chunk", "set_id", "n", "tokens").mapInArrow(run, "set_id long, leader long, distance double")
    # Hubs meet each other in every chunk, with the same end.
    return found.distinct().unionByName(alone)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with their distance and whether they link, from the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        for batch in slices(batches, 256):
            distances, linked = [], []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = _shared(x, y)
                distances.append(1 - both / (len(x) + len(y) - both))
                linked.append(_links(both, len(x), len(y), percent))
            columns = [batch.column(0), batch.column(1), pa.array(distances, pa.float64()), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "distance", "linked"])

    return _side_by_side(pairs, sets).mapInArrow(run, "a long, b long, distance double, linked boolean")


def _side_by_side(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, tokens_a, tokens_b) for stored ``pairs`` (a, b); other sets are not shuffled."""
    left = _only(sets, pairs.select(F.col("a").alias("set_id"))).select(F.col("set_id").alias("a"), F.col("tokens").alias("tokens_a"))
    right = _only(sets, pairs.select(F.col("b").alias("set_id"))).select(F.col("set_id").alias("b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b")


def _apart(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, n, linked, apart): for each pair the size of b, whether it links with a, and the n-grams that only one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        for batch in slices(batches, 256):
            sizes, linked, apart = [], [], []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                apart.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
                sizes.append(len(y))
                linked.append(_links((len(x) + len(y) - len(apart[-1])) // 2, len(x), len(y), percent))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()), pa.array(apart, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "linked", "apart"])

    return _side_by_side(pairs, sets).mapInArrow(run, "a long, b long, n long, linked boolean, apart array<long>")


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links; known components are stars already, so few rounds are left."""
    return components(label.toDF("a", "b").unionByName(links))


def _near_sizes(a: str, b: str, percent: int) -> Column:
    """Whether the sizes from n_low to n_high that stand behind two entries can belong to a link."""
    return (100 * F.col(f"high_{a}") >= percent * F.col(f"low_{b}")) & (100 * F.col(f"high_{b}") >= percent * F.col(f"low_{a}"))


def _side(entries: DataFrame, side: str, *shared: str) -> DataFrame:
    return entries.select(*[F.col(c) if c in shared else F.col(c).alias(f"{c}_{side}") for c in entries.columns])


def _meeting(a: DataFrame, b: DataFrame, on: list[str], more: Column, percent: int, last: Column) -> DataFrame:
    """(key_a, key_b) of entries that meet often enough at places that leave enough to link.

    Entries have key, low, high (sizes of the sets behind them) and left (the most that follows their place).
    ``last`` is asked where everything else holds.
    """
    smaller = F.least("low_a", "low_b")
    waits = _counted(smaller, percent)
    left = _enough_left(F.least("left_a", "left_b"), F.col("low_a"), F.col("low_b"), waits, percent)
    met = a.join(b, on).filter(more & _near_sizes("a", "b", percent) & left & last)
    met = met.groupBy("key_a", "key_b").agg(F.count("*").alias("met"), F.min(smaller).alias("smallest"))
    return met.filter(F.col("met") >= _counted(F.col("smallest"), percent)).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def _may_be_near(percent: int) -> Column:
    """Whether the signatures of two leaders, if they are known, leave it open that members of their stars link.

    Such leaders are no further apart than a link and both reaches; at a distance d, sets have d / (2 - d) of their
    sizes' sum apart.
    """
    furthest = F.least(F.lit(1 - percent / 100 + 1e-9) + F.col("reach_a") + F.col("reach_b"), F.lit(1.0))
    words = [F.bit_count(F.col("signature_a")[n].bitwiseXOR(F.col("signature_b")[n])) for n in range(SIGNATURE // 64)]
    apart = sum(words[1:], words[0])
    return F.col("signature_a").isNull() | (apart <= furthest / (2 - furthest) * (F.col("size_a") + F.col("size_b")) + 1e-6)


def _leader_pairs(entries: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """(a, b) stars of different components whose members may link; ``entries`` are their lists by n-gram.

    ``signs`` (key, reach, signature) keep leaders of a crowded n-gram from meeting that are too far apart.
    """
    # Blocks by size: members' sizes differ from the leader's by percent at most.
    widest = (percent / 100) ** 3
    mixed = entries.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("listed"))
    live = entries.join(mixed.filter("x < y").select("token", "listed"), "token").withColumn(
        "block", F.floor(F.log("size") / F.lit(-np.log(widest)) + 1e-9)
    )
    crowded = F.col("listed") > CROWDED
    # Signatures come to the entries where these are joined, unless there are too many to broadcast.
    signs = _beside(signs)

    def signed(rows: DataFrame) -> DataFrame:
        met = rows.repartition("token", "block").join(signs, "key")
        return met.withColumn("signature", F.when(crowded, F.col("signature"))).drop("listed")

    a = _side(signed(live), "a", "token", "block")
    b = _side(signed(live.withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"))))), "b", "token", "block")
    near = (F.col("size_a") <= F.col("size_b")) & (F.col("size_a") >= widest * F.col("size_b") - 1e-6)
    once = (F.col("size_a") < F.col("size_b")) | (F.col("key_a") < F.col("key_b"))
    more = (F.col("component_a") != F.col("component_b")) & near & once
    return _meeting(a, b, ["token", "block"], more, percent, _may_be_near(percent))


def _member_links(open_: DataFrame, stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links between sets of stars ``open_`` (a, b, distance) whose leaders do not link.

    The leader of the larger star is the centre. What sets x and y have apart from each other is what they
    have apart from the centre less, twice, what both have so: x links with y when that is little enough. A set
    y of the smaller star either links with the centre, or must share some of what a member x has apart. So
    each member is described once, and those that share such n-grams are compared.
    """
    threshold = 1 - percent / 100 + 1e-9
    known = stars.groupBy("leader").agg(F.max("distance").alias("reach"), F.count("*").alias("members"))
    both = open_.join(known.toDF("a", "reach_a", "members_a"), "a").join(known.toDF("b", "reach_b", "members_b"), "b")
    larger = (F.col("members_a") > F.col("members_b")) | ((F.col("members_a") == F.col("members_b")) & (F.col("a") < F.col("b")))
    asked = both.select(
        F.when(larger, F.col("a")).otherwise(F.col("b")).alias("centre"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("leader"),
        F.when(larger, F.col("reach_a")).otherwise(F.col("reach_b")).alias("reach"), F.col("distance").alias("between"),
    )
    outer = asked.join(stars, "leader").filter(F.col("between") - F.col("distance") - F.col("reach") <= threshold)
    outer = stored(outer.select(F.col("centre").alias("a"), F.col("set_id").alias("b")).distinct(), "jaccard-outer")
    outer = stored(_apart(outer, sets, percent), "jaccard-outer")
    direct, others = outer.filter("linked").select("a", "b"), outer.filter("NOT linked")
    inner = stars.filter("set_id <> leader").join(others.select(F.col("a").alias("leader")), "leader", "left_semi")
    inner = stored(inner.select(F.col("leader").alias("a"), F.col("set_id").alias("b")).distinct(), "jaccard-inner")
    inner = stored(_apart(inner, sets, percent), "jaccard-inner")

    found = _verified(stored(_sharing(inner, others, percent), "jaccard-pairs"), sets, percent)
    return direct.unionByName(found.filter("linked").select("a", "b"))


def _sharing(inner: DataFrame, outer: DataFrame, percent: int) -> DataFrame:
    """(a, b) of ``inner`` and ``outer`` sets of one centre that may have enough apart from it in common to link.

    How much that is at least follows, for each set, from the sizes and from the least that the other side asks for.
    So many n-grams are shared only if one of the rarest is, the rest left out; what nearly all have apart
    from the centre, since only the centre lacks it, is not among these.
    """
    def side(rows: DataFrame, name: str) -> DataFrame:
        asks = (100 + percent) * F.size("apart") - (100 - percent) * F.col("n")
        return rows.select(F.col("a").alias("centre"), F.col("b").alias("set_id"), "apart", asks.cast("long").alias("asks"), F.lit(name).alias("side"))

    both = side(inner, "inner").unionByName(side(outer, "outer"))
    least = both.groupBy("centre").agg(*[F.min(F.when(F.col("side") == name, F.col("asks"))).alias(other) for name, other in (("inner", "outer"), ("outer", "inner"))])
    other = F.when(F.col("side") == "inner", F.col("inner")).otherwise(F.col("outer"))
    shared = F.ceil((F.col("asks") + other) / (2 * (100 + percent)) - 1e-9)
    tokens = both.join(least, "centre").select(
        "centre", "side", "set_id", (F.size("apart") - shared + 1).alias("most"), F.explode("apart").alias("token")
    )
    often = tokens.groupBy("centre", "token").agg(F.count("*").alias("often"), F.count_if(F.col("side") == "inner").alias("inner"))
    # What one side alone has keeps its place in the order, but leads to nobody.
    rarest = Window.partitionBy("centre", "side", "set_id").orderBy("often", "token")
    tokens = tokens.join(often, ["centre", "token"]).withColumn("place", F.row_number().over(rarest)).filter("place <= most AND inner BETWEEN 1 AND often - 1")
    tokens = stored(tokens.select("centre", "side", "set_id", "token"), "jaccard-apart")
    a = tokens.filter("side = 'inner'").select("centre", "token", F.col("set_id").alias("a"))
    b = tokens.filter("side = 'outer'").select("centre", "token", F.col("set_id").alias("b"))
    return a.join(b, ["centre", "token"]).select("a", "b").distinct()


def _with_print(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, text, print): ``print`` is a hash of the text."""
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *more)
    return texts.withColumn("print", F.xxhash64("text"))


def jaccard_components(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", keep_print: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row, and set_id, component and the text's hash with ``keep_print``.

    Two rows link when 100 * shared n-grams >= percent * n-grams of either. ``component_id`` is the
    smallest id that can be reached by links, the own one included. Null, empty and blank texts have
    no n-gram and link with nothing. Null ids come after all others; repeated rows have equal sets and
    so one component. Rows with equal sets are compared once. N-grams are compared as 64-bit hashes.
    ``component`` is the smallest set_id of the component: unlike the id it is never shared with another one.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = _with_print(docs, id_col, text_col)
    often = _common_shingles(texts, size).filter(F.col("count") >= COMMON).orderBy(F.desc("count"), "token").limit(MOVED)
    found = often.select("token").toArrow().column("token").to_numpy().astype(np.int64).view(np.uint64)
    by_token = np.argsort(found)
    # Ranks count from the least frequent on. Broadcast: ``MOVED`` numbers at most.
    rank = (len(found) - by_token).astype(np.int32)
    common = spark.sparkContext.broadcast((found[by_token].tobytes(), rank.tobytes()))
    rows = stored(_described(texts, common, size, percent, kind), "jaccard-rows")

    sets = rows.filter("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("least")
    ).select("set_id", F.col("least.id").alias("rep"), "least.print")
    sets = stored(sets, "jaccard-sets")
    shared = stored(_listed(rows), "jaccard-shared")
    met = shared.groupBy("set_id").agg(
        F.count("*").alias("met"), F.min(F.struct("pos", "token")).alias("least"), F.first("n").alias("n"),
        F.max(F.struct("sets", "token"))["token"].alias("hot"), F.sum("sets").alias("others"),
    ).select("set_id", "met", "n", "least.pos", F.col("least.token").alias("first"), "hot", "others")
    enough = met.filter(
        (F.col("met") >= _meetings(F.col("n"), percent, 1)) & (100 * (F.col("n") - F.col("pos")) >= percent * F.col("n"))
    )
    wanted = enough.join(sets, "set_id").select("set_id", "rep", "print", "first", "hot", (F.col("others") / F.col("n")).alias("weight"), "n")
    wanted = stored(wanted, "jaccard-wanted")
    # What any link asks for, also with a set of the least size that can link.
    left, n = F.col("n") - F.col("pos"), F.col("n")
    useful = _enough_left(left, n, percent * n / 100 - 1e-6, _counted(n, percent), percent)
    index = shared.filter(useful).join(_beside(wanted.select("set_id")), "set_id", "left_semi")
    index = stored(index.select("token", "set_id", "n", left.alias("left")), "jaccard-index")
    tokens = _whole_sets(texts, wanted, size)

    stars = stored(_stars(wanted.select("set_id", F.col("first").alias("key"), "weight"), tokens, percent), "jaccard-stars")
    # Leaders once more by their most common n-gram: copies that also share rarer ones stand apart so far.
    heads = stored(wanted.join(stars.filter("set_id = leader").select("set_id"), "set_id", "left_semi"), "jaccard-heads")
    again = _stars(heads.select("set_id", F.col("hot").alias("key"), "weight"), tokens, percent)
    links = stars.select(F.col("set_id").alias("a"), F.col("leader").alias("b")).unionByName(
        again.select(F.col("set_id").alias("a"), F.col("leader").alias("b"))
    )
    label = stored(components(links.filter("a <> b")), "jaccard-labels")

    leaders = heads.select(F.col("set_id").alias("leader"), F.col("n").alias("size")).join(
        label.toDF("leader", "component"), "leader", "left"
    ).withColumn("component", F.coalesce("component", "leader"))
    leaders = stored(leaders, "jaccard-leaders")
    entries = index.join(_beside(stars.select("set_id", "leader")), "set_id").groupBy("token", "leader").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("left").alias("left")
    )
    entries = stored(entries.join(_beside(leaders), "leader").withColumnRenamed("leader", "key"), "jaccard-entries")
    reach = stars.groupBy("leader").agg(F.max("distance").alias("reach"))
    signs = reach.join(tokens.select(F.col("set_id").alias("leader"), "signature"), "leader").withColumnRenamed("leader", "key")
    pairs = stored(_leader_pairs(entries, stored(signs, "jaccard-signs"), percent), "jaccard-pairs")
    compared = stored(_verified(pairs, tokens, percent), "jaccard-compared")
    label = stored(_joined(label, compared.filter("linked").select("a", "b")), "jaccard-labels")

    # Stars that are apart so far, but not so far that none of their members can link.
    open_ = compared.filter("NOT linked").join(reach.toDF("a", "reach_a"), "a").join(reach.toDF("b", "reach_b"), "b")
    both = F.col("reach_a") + F.col("reach_b")
    open_ = open_.filter((both > 0) & (F.col("distance") <= 1 - percent / 100 + 1e-9 + both))
    open_ = open_.join(label.toDF("a", "at_a"), "a", "left").join(label.toDF("b", "at_b"), "b", "left")
    open_ = stored(open_.filter("coalesce(at_a, a) <> coalesce(at_b, b)").select("a", "b", "distance"), "jaccard-open")
    if not open_.isEmpty():
        label = stored(_joined(label, _member_links(open_, stars, tokens, percent)), "jaccard-labels")

    reps = sets.select("set_id", "rep").join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    reps = reps.withColumn("component", F.coalesce("component", "set_id"))
    smallest = reps.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = reps.join(smallest, "component").select("set_id", "component_id", "component")
    out = rows.join(by_set, "set_id", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        *(["set_id", "component", "print"] if keep_print else []),
    )
    return out


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest id, with all its columns.

    Where nothing in a component has an id, one row without an id stays; of repeated rows with the
    smallest id one stays, that of the smallest set. Rows without words stay.
    """
    found = jaccard_components(docs, size, percent, id_col, text_col, keep_print=True)
    kept = found.filter((F.col("n_shingles") > 0) & F.col(id_col).eqNullSafe(F.col("component_id")))
    # All kept rows of a component have the same id, or none; one text stands for them.
    kept = kept.groupBy("component").agg(F.min_by(F.struct(F.col(id_col).alias("id"), "print"), "set_id").alias("meant")).select("meant")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("whole_row")
    rows = _with_print(docs, id_col, text_col, whole).withColumn("spot", F.struct("id", "print"))
    # The rows are read again and shuffled once, by id and hash of the text, which a text of another component never shares.
    # Grouped as the join has dealt them: by ``meant``, since the other side may be cast for the join.
    worded = rows.filter(F.rlike("text", F.lit(WORD))).select("spot", "whole_row")
    one = worded.join(kept, F.col("spot") == F.col("meant")).groupBy("meant").agg(F.first("whole_row").alias("whole_row"))
    blank = rows.filter(~F.rlike("text", F.lit(WORD)))
    return one.select("whole_row.*").unionByName(blank.select("whole_row.*"))
