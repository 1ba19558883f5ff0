"""Hard negatives by inner product, over cover trees of shards.

1. *Shards.* Vectors are dealt by hash to shards of about ``SHARD`` rows. Each shard becomes one cover
   tree, written to shared storage. Vectors get one more component that makes all of a shard's norms
   equal, so inner products follow distances. A node has a centre and the largest distance of what it
   covers; its children are centred on points more than half that distance apart and cover the rest
   within half of it. Points that cover nothing else, and small nodes, lie open in their parent.
2. *Descent.* Shards are dealt to groups, a task each. A task holds the trees of its group while requests pass
   by in blocks; only blocks are repeated, once per group. A request asks for the best rows between two scores.
   Centre and covering radius bound all inner products of a node; the node with the best bound is opened
   first, and a node is skipped when it lies outside what is still wanted. Open points are scored exactly,
   in integers. The first pass finds each anchor's positives, the second the negatives of each.
3. *Merge.* A group returns as many rows per request as are wanted; the best of all groups are kept.
"""

from __future__ import annotations

import heapq
import io
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.common import shuffle_partitions
from verdigris.sources.storage import stored

# Rows of a shard, and anchors of a block, about.
SHARD = 4_096
BLOCK = 128
# Trees that a task holds at most.
HELD = 16
# Points up to which a node is not divided.
OPEN = 32
# Integers up to here are exact as doubles; scores must leave room for percentages in 64 bits.
_EXACT, _MOST = 1 << 53, 1 << 56
_NONE = np.iinfo(np.int64).min


class Tree:
    """A cover tree as arrays. Points lie in the order of the nodes that hold them open."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, ids: np.ndarray, null: np.ndarray, labels: np.ndarray):
        norm, lifted = lift(points)
        # Per node: first and last open point, first and last child, the label of all its points or none.
        centres, radii, spans, order = [], [], [], []
        placed, waiting = 0, deque([(0, np.arange(len(points)))] if len(points) else [])
        while waiting:
            centre, members = waiting.popleft()
            distance = np.sqrt(((lifted[members] - lifted[centre]) ** 2).sum(axis=1))
            open_, groups = divide(lifted, centre, members, distance)
            child = len(radii) + 1 + len(waiting)
            alone = np.unique(labels[members])
            spans.append((placed, placed + len(open_), child, child + len(groups), alone[0] if len(alone) == 1 else _NONE))
            centres.append(centre)
            radii.append(distance.max())
            order.append(open_)
            placed += len(open_)
            waiting += groups
        self.norm, self.radii, self.spans = np.array(norm), np.array(radii), np.array(spans, np.int64)
        place = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.centres, self.points = narrow(points[np.array(centres, np.int64)]), narrow(points[place])
        self.rows, self.ids, self.null, self.labels = rows[place], ids[place], null[place], labels[place]

    @classmethod
    def restored(cls, arrays: dict[str, np.ndarray]) -> Tree:
        tree = cls.__new__(cls)
        vars(tree).update(arrays)
        return tree

    def find(self, queries: np.ndarray, asks: list[np.ndarray], wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ask, point, score) of the best ``wanted`` points per ask; equal scores go by id, nulls last.

        ``asks`` holds arrays: query, least score, largest score, label, whether it must be that label,
        row that is left out.
        """
        query, least, most, label, same, _ = asks
        least = least.copy()
        found = [np.zeros(0, np.int64) for _ in range(3)]
        queries, points = exact(queries, self.points)
        vectors = queries.astype(np.float64)
        lengths = np.sqrt((vectors**2).sum(axis=1))
        # Rounding of sums of squares and products stays far below this.
        slack = 1e-9 * (lengths + 1) * (self.norm + 1) + 1e-6
        centre = vectors[:, : self.centres.shape[1]] @ self.centres.T.astype(np.float64)
        waiting = [(0.0, 0, np.arange(len(query)))] if len(self.radii) else []
        while waiting:
            _, node, asking = heapq.heappop(waiting)
            first, last, child, end, pure = self.spans[node]
            reach = lengths[query[asking]] * self.radii[node] + slack[query[asking]]
            middle = centre[query[asking], node]
            # What an ask found meanwhile may leave nothing to want here.
            asking = asking[(middle + reach >= least[asking]) & (middle - reach <= most[asking])]
            if pure != _NONE:
                asking = asking[(label[asking] == pure) == same[asking]]
            if not len(asking):
                continue
            if last > first:
                self._open(first, last, queries, points, asks, asking, least, wanted, found)
            for number in range(child, end):
                bound = (centre[query[asking], number] + lengths[query[asking]] * self.radii[number] - least[asking]).max()
                heapq.heappush(waiting, (-float(bound), number, asking))
        return tuple(found)

    def _open(self, first, last, queries, points, asks, asking, least, wanted, found) -> None:
        """Score the open points of a node for the asks that still want some; ``found`` and ``least`` move on."""
        query, _, most, label, same, skipped = asks
        distinct, place = np.unique(query[asking], return_inverse=True)
        scores = (queries[distinct] @ points[first:last].T).astype(np.int64)[place]
        fits = (scores >= least[asking][:, None]) & (scores <= most[asking][:, None])
        fits &= (self.labels[first:last] == label[asking][:, None]) == same[asking][:, None]
        fits &= self.rows[first:last] != skipped[asking][:, None]
        if last - first > wanted:
            # Only what reaches the best few of these points can be among the best of all.
            cut = np.partition(np.where(fits, scores, _NONE), last - first - wanted, axis=1)[:, last - first - wanted]
            fits &= scores >= cut[:, None]
        row, column = np.nonzero(fits)
        if not len(row):
            return
        asked = np.concatenate([found[0], asking[row]])
        point = np.concatenate([found[1], first + column])
        score = np.concatenate([found[2], scores[row, column]])
        found[:] = best(asked, point, score, (self.ids[point], self.null[point]), wanted)
        ask_more(least, found[0], found[2], wanted)


def find_in_all(trees: list[Tree], queries: np.ndarray, asks: list[np.ndarray], wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ask, score, id, whether it is null) of the best ``wanted`` points of all trees; what one holds raises what is asked of the next."""
    query, least, *rest = asks
    least = least.copy()
    asked, score, ids, null = (np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, bool))
    for tree in trees:
        ask, point, more = tree.find(queries, [query, least, *rest], wanted)
        ids, null = np.concatenate([ids, tree.ids[point]]), np.concatenate([null, tree.null[point]])
        asked, place, score = best(np.concatenate([asked, ask]), np.arange(len(ids)), np.concatenate([score, more]), (ids, null), wanted)
        ids, null = ids[place], null[place]
        ask_more(least, asked, score, wanted)
    return asked, score, ids, null


def ask_more(least: np.ndarray, asked: np.ndarray, score: np.ndarray, wanted: int) -> None:
    """The last of a full set is what others must reach."""
    full = np.flatnonzero(np.bincount(asked, minlength=len(least)) == wanted)
    if len(full):
        ends = np.searchsorted(asked, full, "right") - 1
        least[full] = np.maximum(least[full], score[ends])


def lift(points: np.ndarray) -> tuple[float, np.ndarray]:
    """The largest norm, and the points with the component that gives all of them that norm."""
    points = points.astype(np.float64)
    squares = (points**2).sum(axis=1)
    most = squares.max(initial=0.0)
    return float(np.sqrt(most)), np.concatenate([points, np.sqrt(most - squares)[:, None]], axis=1)


def divide(lifted: np.ndarray, centre: int, members: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, list]:
    """Points that stay open in a node, and its children as (centre, members)."""
    radius = distance.max()
    if len(members) <= OPEN or radius == 0:
        return members, []
    open_, groups = [], []
    left, near = members, distance <= radius / 2
    while len(left):
        group = left[near]
        if len(group) > 1:
            groups.append((centre, group))
        else:
            open_.append(group)
        left = left[~near]
        if len(left):
            centre = left[0]
            near = ((lifted[left] - lifted[centre]) ** 2).sum(axis=1) <= (radius / 2) ** 2
            near[0] = True
    return np.concatenate(open_) if open_ else members[:0], groups


def best(asked, point, score, ids, wanted):
    """The first ``wanted`` of each ask, by score, then id; in the order of asks."""
    order = np.lexsort((*ids, -score, asked))
    asked, point, score = asked[order], point[order], score[order]
    heads = np.searchsorted(asked, asked)
    kept = np.arange(len(asked)) - heads < wanted
    return asked[kept], point[kept], score[kept]


def quantised(column: str, factor: int) -> Column:
    """floor(factor * x) of each component. Beyond 64 bits it stays at the largest or smallest value, which ``exact`` refuses."""
    return F.transform(F.col(column).cast("array<double>"), lambda x: F.floor(x * factor))


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows of integers; shorter ones end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy()
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return matrix


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes that hold them all."""
    return matrix.astype(np.min_scalar_type(min(int(matrix.min(initial=0)), -1 - int(matrix.max(initial=0)))))


def exact(queries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns, in a type that holds their inner products exactly: doubles, else 64-bit integers."""
    width = max(queries.shape[1], points.shape[1])
    bound = width
    for each in (queries, points):
        bound *= max(int(each.max(initial=0)), -int(each.min(initial=0)))
    if bound >= _MOST:
        raise ValueError("inner products of these vectors do not fit into 64 bits")
    kind = np.float64 if bound < _EXACT else np.int64
    return tuple(np.pad(each, ((0, 0), (0, width - each.shape[1]))).astype(kind) for each in (queries, points))


def _packed(**arrays: np.ndarray) -> bytes:
    held = io.BytesIO()
    np.savez(held, **arrays)
    return held.getvalue()


def _unpacked(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as held:
        return {name: held[name] for name in held.files}


def _sorted(table: pa.Table, *keys: str) -> pa.Table:
    """Rows may arrive in another order when a lost task is run again; what is made of them does not depend on it."""
    return table.sort_by([(key, "ascending") for key in keys]).combine_chunks()


def build_trees(vectors: DataFrame, shards: int) -> DataFrame:
    """(shard, tree) from (row, id, label, vector); dealing by hash keeps every shard near the same size."""

    def run(key, table):
        table = _sorted(table, "row")
        ids = table.column("id")
        tree = Tree(
            as_matrix(table.column("vector").chunk(0)), table.column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(),
            table.column("label").to_numpy(),
        )
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "tree": pa.array([_packed(**vars(tree))], pa.binary())})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(run, "shard int, tree binary")


def search(trees: DataFrame, shards: int, requests: DataFrame, blocks: int, wanted: int) -> DataFrame:
    """(row, place, id, score, rank): the best ``wanted`` rows per request, ranked by score, then id, null ids last.

    ``requests``: row, place, vector, least, most, label, same. Row and place name a request; its vector
    belongs to the row, which is not among its own results. Scores lie between ``least`` and ``most``, and
    ``same`` says whether labels must be equal or must differ.
    """

    def pack(key, table):
        table = _sorted(table, "row", "place")
        rows, first, query = np.unique(table.column("row").to_numpy(), return_index=True, return_inverse=True)
        raw = _packed(
            queries=narrow(as_matrix(table.column("vector").chunk(0).take(pa.array(first)))), query=query,
            **{name: table.column(name).to_numpy(zero_copy_only=False) for name in ("row", "place", "least", "most", "label", "same")},
        )
        return pa.table({"raw": pa.array([raw], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, standing = None, []
        for batch in batches:
            for group, block, raw in zip(*(batch.column(name) for name in ("group", "block", "raw"))):
                if group.as_py() != held:
                    held, standing = group.as_py(), []
                arrays = _unpacked(raw.as_py())
                if not block.as_py():
                    standing.append(Tree.restored(arrays))
                    continue
                ask, score, ids, null = find_in_all(
                    standing, arrays["queries"], [arrays[name] for name in ("query", "least", "most", "label", "same", "row")], wanted
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays["row"][ask]), pa.array(arrays["place"][ask]), pa.array(ids, mask=null), pa.array(score)],
                    ["row", "place", "id", "score"],
                )

    dealt = requests.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    packed = dealt.groupBy("part").applyInArrow(pack, "raw binary")
    groups = min(shards, max(shuffle_partitions(requests.sparkSession), -(-shards // HELD)))
    # A block goes to every group: a stated set of requests against all rows. As a join this may be planned as a
    # broadcast, by the size before blocks are repeated; dealt out like this it never passes through the driver.
    sent = packed.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(True).alias("block"), "raw")
    standing = trees.select((F.col("shard") % groups).alias("group"), F.lit(False).alias("block"), F.col("tree").alias("raw"))
    met = standing.union(sent).repartitionById(groups, "group").sortWithinPartitions("group", "block")
    found = met.mapInArrow(run, "row long, place int, id long, score long")
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, wanted: int = 5, least_percent: int = 80, factor: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Each row that ``is_anchor`` holds for has as positives its ``wanted`` best other rows of its ``label``. For
    each positive the best ``wanted`` rows of other labels are returned whose score is at least
    ``least_percent`` of the positive's and at most the positive's. Scores are inner products of
    floor(factor * x); equal ones go by id, null ids last.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Rows with one id
    are different rows. Vectors of different lengths are compared as if the shorter one ended in zeros.
    Scores of 2^56 and more are refused with an error. An empty table gives no rows.
    """
    x = F.col(vector_col).cast("array<double>")
    broken = F.exists(x, lambda each: each.isNull() | F.isnan(each) | (F.abs(each) == float("inf")))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.when(~broken, quantised(vector_col, factor)).alias("vector"),
    )
    rows = stored(rows.filter("label is not null and vector is not null"), "vectors")
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    shards, blocks = -(-sizes["rows"] // SHARD) or 1, -(-sizes["anchors"] // BLOCK) or 1
    trees = stored(build_trees(rows.select("row", "id", "label", "vector"), shards), "trees")
    anchors = rows.filter("anchor").select("row", "id", "label", "vector")
    limit = F.lit(1 << 62)
    first = anchors.select("row", F.lit(0).alias("place"), "vector", (-limit).alias("least"), limit.alias("most"), "label", F.lit(True).alias("same"))
    positives = stored(search(trees, shards, first, blocks, wanted), "positives").select(
        "row", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # The least score that is not below the share: the quotient rounded up.
    part = f"{least_percent} * positive_score"
    share = F.expr(f"{part} div 100 + if({part} % 100 > 0, 1, 0)")
    asked = positives.join(anchors.select("row", "label", "vector"), "row").select(
        "row", "place", "vector", share.alias("least"), F.col("positive_score").alias("most"), "label", F.lit(False).alias("same")
    )
    found = search(trees, shards, asked, blocks, wanted).select("row", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positives.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return named.join(found, ["row", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
