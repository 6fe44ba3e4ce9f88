"""Session helpers: the configuration every operator assumes, and shared-folder lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, Observation, SparkSession

# Settings the operators rely on.  The session zone only matters for streaming
# (event time must be TIMESTAMP there); batch operators work on TIMESTAMP_NTZ and
# epoch seconds, so they give the same answer under any zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "vantage",
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the defaults above.  Used by tests and bench."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sizing_conf(input_bytes: int, executors: int, cores_per_executor: int,
                partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition sizing for a cluster run: shuffle partitions so that the largest shuffle
    (about the input size for the dedup / path jobs) lands near ``partition_bytes`` per
    partition and never below 2 waves of tasks; AQE coalesces small ones and splits skewed
    ones at runtime."""
    slots = max(1, executors * cores_per_executor)
    parts = max(2 * slots, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster that setting names shared storage (HDFS / object store) and is used as is; without
    it a cluster run is refused, as a folder of one machine is invisible to the others.  On a local
    master a scratch folder is made and registered, so later ``DataFrame.checkpoint()`` calls land
    in the same place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext handle (e.g. a remote session)
            base = None
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines see")
        base = tempfile.mkdtemp(prefix="vantage-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:
            pass
    return base.rstrip("/") + "/" + name


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once however often it is used, its
    size known to the planner, and safe from lost executors."""
    path = shared_dir(df.sparkSession, unique_name(name))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(metrics: Observation) -> dict:
    """The observed metrics; none where the plan was found empty before it ran, as Spark then has
    nothing to report."""
    return metrics.get if metrics._jo.getRow().schema() is not None else {}


def unique_name(prefix: str) -> str:
    return f"{prefix}-{os.getpid()}-{os.urandom(4).hex()}"
