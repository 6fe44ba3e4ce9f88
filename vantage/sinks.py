"""Writers (K1, K2, K5, K8)."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_level(df: DataFrame, root: str, level: str, partition_cols=("capture_date",), mode: str = "overwrite") -> str:
    """K1: partitioned Parquet; with dynamic partition overwrite only the dates present in
    ``df`` are replaced (re-running a day is idempotent)."""
    path = f"{root.rstrip('/')}/{level}"
    _write_partitions(df, path, partition_cols, mode)
    return path


def _write_partitions(df: DataFrame, path: str, partition_cols, mode: str) -> None:
    """Rows are rebalanced by the partition columns: small dates meet in one task, and a date of
    more than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is split over several tasks and
    files, so one large date (a backfill, a single day's build) is never one task."""
    (df.hint("rebalance", *partition_cols).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path))


def refresh_table(df: DataFrame, name: str, root: str | None = None, keep: int = 2) -> str:
    """K2: full refresh that no reader meets half done.

    The rows go to a new folder under ``root`` (by default beside the warehouse's tables); only when
    it is complete does one catalog step point the view ``name`` to it.  Readers see the old rows or
    the new ones, a write that fails leaves the old ones, and a query that runs goes on reading its
    own folder: the newest ``keep`` versions stay, older ones are deleted.  Returns the folder."""
    spark = df.sparkSession
    root = (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}.versions").rstrip("/")
    folder = f"{root}/{time.time_ns():020d}-{os.urandom(3).hex()}"
    df.write.parquet(folder)
    if any(t.name == name.split(".")[-1] and t.tableType in ("MANAGED", "EXTERNAL") for t in spark.catalog.listTables()):
        spark.sql(f"DROP TABLE {name}")         # a plain table of an earlier layout
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    parent = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = sorted((s.getPath() for s in fs.listStatus(parent) if s.isDirectory()), key=lambda p: p.getName())
    complete = [p for p in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    for old in folders:
        if len(complete) > keep and old.getName() < complete[-keep].getName():
            fs.delete(old, True)
    return folder


def publish(df: DataFrame, uri: str, partition_cols=("capture_date",)) -> str:
    """K5: copy a result to a second location (``file:``, ``hdfs:``, ``s3a:`` ...)."""
    _write_partitions(df, uri, partition_cols, "overwrite")
    return uri


def write_geojson(features: DataFrame, path: str, col: str = "feature") -> str:
    """K8: GeoJSON text sequence, one Feature per line (no whole collection in memory)."""
    features.select(F.col(col).alias("value")).write.mode("overwrite").text(path)
    return path
