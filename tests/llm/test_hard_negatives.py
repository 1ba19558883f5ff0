import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigris.llm import hard_negatives, queries
from verdigris.verification.compare import difference, register_tables

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score int, id string, vector int"


def brute(rows, wanted=5, percent=80, factor=256):
    kept = [
        (vec_id, [math.floor(factor * x) for x in vector], label)
        for vec_id, vector, label in rows
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    last = float("inf")
    found = []
    for n, (anchor, query, label) in enumerate(kept):
        if anchor is None or anchor % 10:
            continue
        scored = [
            (-sum(a * b for a, b in zip(query, vector)), last if vec_id is None else vec_id, other)
            for m, (vec_id, vector, other) in enumerate(kept) if m != n
        ]
        scored.sort(key=lambda each: each[:2])
        for positive, positive_id, _ in [each for each in scored if each[2] == label][:wanted]:
            fits = [each for each in scored if each[2] != label and -percent * positive <= -100 * each[0] <= -100 * positive]
            for rank, (score, negative_id, _) in enumerate(fits[:wanted], 1):
                found.append(tuple(None if x == last else x for x in (anchor, positive_id, rank, negative_id, -positive, -score)))
    return sorted(found, key=str)


@pytest.fixture
def mine(spark):
    def run(rows, **options):
        docs = spark.createDataFrame([(*row, "r", 1, "i", 2) for row in rows], SCHEMA)
        return sorted(map(tuple, hard_negatives.hard_negatives(docs, F.col("vec_id") % 10 == 0, F.col("label"), **options).collect()), key=str)

    return run


@pytest.fixture
def shapes():
    """Random directions, tight groups, copies, different norms."""
    pick = np.random.default_rng(1)
    flat = pick.normal(size=(150, 6))
    tight = pick.normal(size=(4, 6))[pick.integers(0, 4, 250)] + pick.normal(size=(250, 6)) * pick.choice([0, 1e-3, 0.1], 250)[:, None]
    return np.concatenate([flat, tight, flat[:40] * 7, tight[:30]])


@pytest.mark.parametrize("shard, block, open_", [(4_096, 128, 32), (60, 3, 4), (25, 128, 1)])
def test_all_rows_against_brute_force(mine, shapes, shard, block, open_, monkeypatch):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("OPEN", open_)):
        monkeypatch.setattr(hard_negatives, name, value)
    labels = np.random.default_rng(2).integers(0, 4, len(shapes)).tolist()
    rows = [(n, vector, label) for n, (vector, label) in enumerate(zip(shapes.tolist(), labels))]
    # Nulls, rows that take no part, equal ids, repeated rows, other lengths.
    rows += [(None, rows[10][1], 1), (None, rows[20][1], 2), (10, rows[3][1], 0), rows[30], rows[30], (7, [], 1), (40, [], 0)]
    rows += [(50, None, 1), (60, [1.0, None], 1), (70, [float("nan")] * 6, 1), (80, [float("inf")] + [0.0] * 5, 1), (90, [1.0] * 6, None)]
    rows += [(100, [0.5, 0.25], 3), (110, [0.5] * 9, 2), (120, [0.0] * 6, 2)]
    assert mine(rows) == brute(rows)
    assert mine(rows, wanted=2, least_percent=95, factor=10) == brute(rows, 2, 95, 10)


def test_nothing(mine):
    assert mine([]) == [] and mine([(1, [1.0], 1)]) == [] and mine([(10, [1.0], 1)]) == [] and mine([(10, None, None)]) == []


def test_scores_beyond_doubles_stay_exact_and_beyond_64_bits_are_refused(mine):
    rows = [(n, [2.0**18 + n / 256, 1 / 256 * n], n % 2) for n in range(40)]
    assert mine(rows) == brute(rows)
    with pytest.raises(Exception, match="do not fit into 64 bits"):
        mine([(n, [2.0**40], 1) for n in range(20)])


def test_bounds_skip_nodes(shapes, monkeypatch):
    """In tight groups most points are never scored."""
    points = np.floor(256 * shapes[150:400]).astype(np.int64)
    tree = hard_negatives.Tree(points, np.arange(250), np.arange(250), np.zeros(250, bool), np.zeros(250, np.int64))
    assert sorted(tree.rows) == list(range(250)) and len(tree.radii) > 4
    scored = []
    opened = hard_negatives.Tree._open
    monkeypatch.setattr(hard_negatives.Tree, "_open", lambda self, first, last, *rest: (scored.append(last - first), opened(self, first, last, *rest)))
    ask = [np.array([0]), np.array([-(1 << 62)]), np.array([1 << 62]), np.array([0]), np.array([True]), np.array([0])]
    _, point, score = tree.find(points[:1], ask, 5)
    want = sorted((points[1:] @ points[0]).tolist(), reverse=True)[:5]
    assert score.tolist() == want and sum(scored) < 200


def test_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    database = duckdb.connect()
    register_tables(database, sf_dir)
    found = queries.op11_hard_negatives(spark, sf_dir).toPandas()
    assert len(found) > 0 and difference(found, database.sql(queries.oracle_sql()["op11_hard_negatives"]).df()) is None


def test_blocks_times_shards_are_never_broadcast(spark, shapes, monkeypatch):
    """The pairs of blocks and shards outgrow what a join is planned by, the requests."""
    monkeypatch.setattr(hard_negatives, "HELD", 2)
    docs = spark.createDataFrame([(n, vector, n % 3) for n, vector in enumerate(shapes.tolist())], "id long, vector array<double>, label long")
    rows = docs.select(F.col("id").alias("row"), "id", "label", hard_negatives.quantised("vector", 256).alias("vector")).localCheckpoint()
    requests = rows.select(
        "row", F.lit(0).alias("place"), "vector", F.lit(-(1 << 62)).alias("least"), F.lit(1 << 62).alias("most"), "label", F.lit(False).alias("same")
    )
    trees = hard_negatives.build_trees(rows, 20).localCheckpoint()
    found = hard_negatives.search(trees, 20, requests, 40, 3)
    assert found.groupBy("row").agg(F.count("*").alias("n")).filter("n <> 3").count() == 0
    assert len(found.collect()) == 3 * len(shapes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "MapInArrow" in plan and "Broadcast" not in plan and "Join" not in plan


def test_few_tasks_hold_several_trees(mine, shapes, spark, monkeypatch):
    for name, value in (("SHARD", 20), ("BLOCK", 10), ("HELD", 30)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives, "shuffle_partitions", lambda _: 1)
    labels = np.random.default_rng(5).integers(0, 3, len(shapes)).tolist()
    rows = [(n // 2 or None, vector, label) for n, (vector, label) in enumerate(zip(shapes.tolist(), labels))]
    assert mine(rows) == brute(rows)


@pytest.mark.parametrize("least, most, size", [(0, 0, 1), (-128, 127, 1), (-1, 128, 2), (-256, 256, 2), (-(1 << 31), 5, 4), (0, 1 << 31, 8), (-(1 << 63), (1 << 63) - 1, 8)])
def test_narrow_matrices_hold_the_same_integers(least, most, size):
    matrix = np.array([[least, most]], np.int64)
    kept = hard_negatives.narrow(matrix)
    assert kept.dtype.kind == "i" and kept.dtype.itemsize == size and (kept.astype(np.int64) == matrix).all()
