"""Where written tables go: the shared folder that the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"


def shared_folder(master: str, named: str | None, warehouse: str) -> str:
    """The folder that the cluster names, else the warehouse.

    A warehouse on a machine's own disk is shared only where driver and executors are one process; elsewhere
    each executor would write to a disk that the others do not see, so that is an error.
    """
    if named:
        return named
    on_disk = warehouse.startswith(("file:", "/")) or "://" not in warehouse
    if on_disk and not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {SHARED} to a folder that all executors share: the warehouse {warehouse} is local")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, under ``spark.checkpoint.dir``; see ``shared_folder`` where it is unset.

    Nothing under it is read by a later run, so the folder may be emptied between runs.
    """
    # A session without a context of its own runs elsewhere and cannot be asked; it is taken at its word.
    context = getattr(spark, "sparkContext", None)
    named, warehouse = spark.conf.get(SHARED, None), spark.conf.get("spark.sql.warehouse.dir")
    folder = shared_folder(context.master if context else "local", named, warehouse)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to shared storage and read back, under the schema it was written with.

    For results that are used more than once or are costly to make again: lost executors take
    nothing with them, and the lineage ends at the files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
