"""Snapshot JSON documents -> one row per aircraft (observation model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.columns import clean_callsign, epoch_to_local, nav_modes_csv
from vantage.schemas import snapshot_schema


def read_snapshots(spark: SparkSession, path: str, fields=None) -> DataFrame:
    """Snapshot files (one multi-line JSON object each) with a fixed schema; the file name
    (ring-buffer slot) comes from the hidden ``_metadata`` column.  ``fields`` narrows the
    aircraft fields that are parsed."""
    df = spark.read.schema(snapshot_schema(fields)).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    return df.select("*", F.col("_metadata.file_name").alias("source_file"))


def parse_snapshot_text(docs: DataFrame, text_col: str = "doc", file_col: str = "source_file",
                        fields=None) -> DataFrame:
    """Same as ``read_snapshots`` for documents already held in a string column."""
    p = F.from_json(F.col(text_col), snapshot_schema(fields))
    return docs.select(p.alias("_s"), F.col(file_col).alias("source_file")).select("_s.*", "source_file")


def flatten(snapshots: DataFrame, tz: str = "UTC") -> DataFrame:
    """One row per aircraft; every optional field missing -> NULL; callsign cleaned (P2);
    nav modes joined to CSV (P3); ``observation_time`` = receiver-local wall time of ``now``."""
    rows = snapshots.select("now", "source_file", F.inline(F.col("aircraft")))
    out = [epoch_to_local("now", tz).alias("observation_time"), F.col("now").alias("observation_epoch")]
    for f in snapshots.schema["aircraft"].dataType.elementType.fields:
        if f.name == "flight":
            out.append(clean_callsign("flight").alias("flight"))
        elif f.name == "nav_modes":
            out.append(nav_modes_csv("nav_modes").alias("nav_modes"))
        else:
            out.append(F.col(f.name))
    out.append(F.col("source_file"))
    return rows.select(*out)


def rejected_snapshots(snapshots: DataFrame) -> DataFrame:
    """(read, rejected): documents, and those that gave no ``now`` or no aircraft list (unreadable
    or of another shape), which ``flatten`` passes over."""
    bad = F.col("now").isNull() | F.col("aircraft").isNull()
    return snapshots.agg(F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("rejected"))


def to_snapshot_docs(obs: DataFrame, aircraft, *keep: str) -> DataFrame:
    """Rows -> snapshot JSON text with its slot name: one document per row, holding the aircraft
    structs ``aircraft`` (columns).  Used to feed the JSON path from the driver tables; no grouping,
    so no group can grow."""
    doc = F.to_json(F.struct(F.col("observation_epoch").alias("now"), F.col("event_id").alias("messages"),
                             F.array(*aircraft).alias("aircraft")))
    return obs.select(doc.alias("doc"), "source_file", *keep)
