"""Parquet levels (S4-S7, S11), file listings (S9), whole-text objects (S10), object-store
options (S8) and the registry NDJSON (S3/P7)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vantage.schemas import AIRFRAME_RAW, OBSERVATION
from vantage.session import shared_dir, unique_name


def read_level(spark: SparkSession, root: str, level: str, dates=None, pattern: str | None = None) -> DataFrame:
    """A level stored as ``<root>/<level>/capture_date=YYYY-MM-DD/...``.

    ``dates`` become a partition filter (only those directories are listed and read);
    ``pattern`` is a Hadoop glob under the level (e.g. ``capture_date=2025-12-*``)."""
    base = f"{root.rstrip('/')}/{level}"
    if pattern:
        df = spark.read.option("basePath", base).parquet(f"{base}/{pattern}")
    else:
        df = spark.read.parquet(base)
    if dates is not None:
        df = df.where(F.col("capture_date").isin([F.lit(d).cast("date") for d in dates]))
    return df


def level_metadata(spark: SparkSession, path: str, by: str = "capture_date", epoch: str = "observation_epoch") -> DataFrame:
    """A7, M5, M6 without reading rows: per partition of a stored level the number of rows and the
    first and last ``epoch``, answered from the Parquet footers alone (aggregates pushed into the
    scan).  Turns ``spark.sql.parquet.aggregatePushdown`` on for the session."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    v1 = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(v1)
    try:        # only the newer reader takes aggregates; which one is chosen when the path is loaded
        spark.conf.set(v1, ",".join(f for f in before.split(",") if f != "parquet"))
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(v1, before)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.min(epoch).alias("first_epoch"), F.max(epoch).alias("last_epoch"))


def latest_captures(df: DataFrame, n: int, col: str = "capture_date", dates_of: DataFrame | None = None) -> DataFrame:
    """Rows of the latest ``n`` values of ``col``.  ``dates_of`` may name a cheaper frame with
    the same dates (the level that ``df`` is built from).  The n values are a bounded relation
    (n rows), so broadcasting them is safe; on a partitioned level this becomes a dynamic
    partition-pruning filter."""
    latest = (df if dates_of is None else dates_of).select(col).distinct().orderBy(F.desc(col)).limit(n)
    return df.join(F.broadcast(latest), col, "left_semi")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast a drifted frame to the canonical schema: numeric-typed text columns become text
    (DOUBLE 100.0 -> '100.0'), a value that does not fit becomes NULL (``cast_rejects`` counts
    those); missing columns are added as NULL; extra columns are kept."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            continue
        cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name) if have[f.name] != f.dataType else F.col(f.name))
    extra = [F.col(n) for n in df.columns if n not in schema.fieldNames()]
    return df.select(*cols, *extra)


def cast_rejects(df: DataFrame, schema: StructType = OBSERVATION) -> DataFrame:
    """(column, rejected): values of each drifted column that ``conform`` turns into NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    drifted = [f for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    counts = df.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
                      for f in drifted] or [F.lit(0).alias("_none")])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("rejected")) for f in drifted]) if drifted \
        else F.array().cast("array<struct<column: string, rejected: bigint>>")
    return counts.select(F.inline(rows))


def union_by_name(dfs, schema: StructType = OBSERVATION) -> DataFrame:
    """Schema-evolving union.  Each input is conformed to the canonical schema, then
    ``unionByName(allowMissingColumns=True)`` fills absent columns with NULL."""
    out = None
    for d in dfs:
        c = conform(d, schema)
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    return out


def read_drifted(spark: SparkSession, paths, schema: StructType = OBSERVATION) -> DataFrame:
    """S7 over files and folders whose column types differ.  Every footer is read by Spark's own
    Parquet reader in tasks, so any file system that Spark is set up for will do; files of one set of
    types become one scan, each scan is conformed and the scans are united."""
    return union_by_name([_reader(spark, base).schema(s).parquet(*files)
                          for s, files, base in schema_groups(spark, paths)], schema)


def _reader(spark: SparkSession, base: str | None):
    return spark.read.option("basePath", base) if base else spark.read


def schema_groups(spark: SparkSession, paths) -> list[tuple[StructType, list[str], str | None]]:
    """(schema, paths, base) of the groups of ``paths`` whose types agree; a folder is one path as
    long as its own files agree, and else the ``base`` of their partition columns.  Columns that a
    file lacks are no disagreement.

    A list whose footers merge is one group after one job.  One that does not is cut in half, in the
    order of the names: where types change k times along it, some k log n jobs find the changes."""
    found: list[tuple[StructType, list[str], str | None]] = []

    def split(part: list[str], base: str | None) -> None:
        try:
            found.append((_reader(spark, base).option("mergeSchema", "true").parquet(*part).schema, part, base))
            return
        except Exception as e:
            if not _types_differ(e):
                raise
        if len(part) == 1:
            base, part = part[0], sorted(r["path"] for r in list_files(spark, part[0], "*.parquet").select("path").collect())
        middle = len(part) // 2
        split(part[:middle], base)
        split(part[middle:], base)

    split(sorted(paths), None)
    groups: list[tuple[StructType, list[str], str | None]] = []
    for s, part, base in found:
        for k, (known, files, root) in enumerate(groups):
            merged = _united(known, s) if root == base else None
            if merged is not None:
                groups[k] = (merged, files + part, base)
                break
        else:
            groups.append((s, part, base))
    return groups


def _types_differ(e: Exception) -> bool:
    return "CANNOT_MERGE" in str(e)


def _united(a: StructType, b: StructType) -> StructType | None:
    """All columns of two schemas, None where a shared one has two types."""
    have = {f.name: f.dataType for f in a.fields}
    if any(f.name in have and have[f.name] != f.dataType for f in b.fields):
        return None
    return StructType(a.fields + [f for f in b.fields if f.name not in have])


def list_files(spark: SparkSession, path: str | list, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Name, size and modification time of every file under ``path`` (content not read:
    the binaryFile source prunes the ``content`` column).  Spark's scans pass over files of no bytes;
    ``list_tree`` names those too."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.select(F.col("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def list_tree(spark: SparkSession, root: str, glob: str | None = None, prefixes: int = 1000) -> DataFrame:
    """S9 for large stores: the files under ``root``, listed ``prefixes`` folders at a time.

    The driver learns the names of the folders right under ``root`` only.  Each share of them is
    listed by Spark tasks and written to the shared folder before the next one is, so that no process
    ever holds more than one share; what is returned reads the written rows.  Files right under
    ``root`` are one share of their own."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    statuses = list(fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(fs_path))
    folders = sorted(s.getPath().toString() for s in statuses if s.isDirectory())
    shares = [folders[k:k + prefixes] for k in range(0, len(folders), prefixes)]
    shares.append([s.getPath().toString() for s in statuses if s.isFile()])
    out = shared_dir(spark, unique_name("listing"))
    in_tasks = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(in_tasks)
    try:
        spark.conf.set(in_tasks, "1")
        for k, share in enumerate(shares):
            if share:
                part = list_files(spark, share, glob)
                part.unionByName(_without_bytes(spark, part)).write.mode("overwrite").parquet(f"{out}/share={k}")
    finally:
        spark.conf.set(in_tasks, before)
    listed = "path string, name string, size bigint, mtime timestamp"
    return (spark.read.schema(listed + ", share int").parquet(out).drop("share") if any(shares)
            else spark.createDataFrame([], listed))


def _without_bytes(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """The files of a listing that its scan passes over; few, so they are asked for one by one."""
    names = spark.createDataFrame([(p,) for p in listed.inputFiles()], "path string")
    rows = []
    for r in names.join(listed, "path", "left_anti").collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        if status.getLen() == 0:
            rows.append((r["path"], path.getName(), 0, status.getModificationTime()))
    found = spark.createDataFrame(rows, "path string, name string, size bigint, millis bigint")
    return found.select("path", "name", "size", F.timestamp_millis("millis").alias("mtime"))


def read_text_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per object with its whole text; bytes that are not UTF-8 are replaced."""
    df = (spark.read.option("pathGlobFilter", glob) if glob else spark.read).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("name"), F.make_valid_utf8("value").alias("content"))


def read_lines(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """S10 for line-wise files: (name, line), each file split over tasks by size; bytes that are not
    UTF-8 are replaced."""
    df = spark.read.option("pathGlobFilter", glob).text(path)
    return df.select(F.col("_metadata.file_path").alias("name"), F.make_valid_utf8("value").alias("line"))


def read_airframes(spark: SparkSession, path: str) -> DataFrame:
    """S3 + P7: registry NDJSON with a fixed schema, renamed to the table's column names."""
    raw = spark.read.schema(AIRFRAME_RAW).json(path)
    return airframes_view(raw)


def airframes_view(raw: DataFrame) -> DataFrame:
    return raw.select("icao", F.col("reg").alias("registration"), F.col("icaotype").alias("icao_type"),
                      F.col("year").alias("manufacture_year"), "manufacturer", "model",
                      F.col("ownop").alias("owner_operator"), "faa_pia", "faa_ladd", "short_type",
                      F.col("mil").alias("military"))


def s3_options(env=None) -> dict:
    """Hadoop S3A settings for an S3-compatible store, taken from the environment
    (``S3_ENDPOINT``, ``S3_ACCESS_KEY``, ``S3_SECRET_KEY``, ``S3_USE_SSL``).  Credentials are
    never written in code; absent variables are simply left out."""
    env = os.environ if env is None else env
    out = {"spark.hadoop.fs.s3a.path.style.access": "true",
           "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if env.get("S3_ENDPOINT"):
        out["spark.hadoop.fs.s3a.endpoint"] = env["S3_ENDPOINT"]
    if env.get("S3_ACCESS_KEY"):
        out["spark.hadoop.fs.s3a.access.key"] = env["S3_ACCESS_KEY"]
    if env.get("S3_SECRET_KEY"):
        out["spark.hadoop.fs.s3a.secret.key"] = env["S3_SECRET_KEY"]
    ssl = str(env.get("S3_USE_SSL", "false")).lower() in ("1", "true", "yes")
    out["spark.hadoop.fs.s3a.connection.ssl.enabled"] = "true" if ssl else "false"
    return out
