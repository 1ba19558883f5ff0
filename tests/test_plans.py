"""What the physical plans must not hold, writing queries included."""

import re

import pytest

import __spark_entry__ as entry
from verdigris.verification import catalog

# The predictor is the one step in Python, and it asks for its own partitions.
PREDICTS = {"score_batch"}
# Windows over one partition: the best k models, and the buckets of a hash histogram.
BOUNDED_WINDOWS = {"rank_models"}


class Plans:
    """Plans of every query that runs while another one is built, and of that one."""

    def __init__(self, spark, monkeypatch):
        self.texts = []
        frame = type(spark.range(0))
        write = frame.write

        def seen(df):
            self.texts.append(df._jdf.queryExecution().executedPlan().toString())
            return write.fget(df)

        monkeypatch.setattr(frame, "write", property(seen))


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_plans(spark, sf_dir, name, monkeypatch):
    plans = Plans(spark, monkeypatch)
    result = entry.queries()[name](spark, sf_dir)
    texts = [*plans.texts, result._jdf.queryExecution().executedPlan().toString()]
    for text in texts:
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text
        if name not in PREDICTS:
            for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "REPARTITION_BY_NUM"):
                assert node not in text
        # A window without partitions runs in one task: only over hash buckets or the best k.
        for order in re.findall(r"windowspecdefinition\(([^)]*)", text):
            first = order.split(",")[0]
            assert "ASC" not in first and "DESC" not in first or first.startswith("bucket") or name in BOUNDED_WINDOWS, order
