"""Count stop markers in raw model texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions.cleaning import NON_ASCII, STOP_PHRASES, stop_markers

MARKERS = [*STOP_PHRASES, NON_ASCII]


def stop_marker_counts(df: DataFrame, raw: str = "raw_text", by: str = "model_id") -> DataFrame:
    """(by, n_rows, n_flagged, marker, n_marked): one row per group and marker, zeros included.

    Every marker is a counter of one aggregation, so no row is multiplied before it is counted.
    """
    counters = [
        F.count_if(F.array_contains("_found", marker)).alias(f"_m{i}")
        for i, marker in enumerate(MARKERS)
    ]
    totals = (
        df.select(by, stop_markers(F.col(raw)).alias("_found"))
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.size("_found") > 0).alias("n_flagged"),
            *counters,
        )
    )
    lines = F.array(
        *[
            F.struct(F.lit(marker).alias("marker"), F.col(f"_m{i}").alias("n_marked"))
            for i, marker in enumerate(MARKERS)
        ]
    )
    return totals.select(by, "n_rows", "n_flagged", F.inline(lines))
