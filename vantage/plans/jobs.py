"""Level jobs over stored data (M1-M3 + K1): what the scheduled hourly / daily / weekly
scripts did, as Spark jobs over a partitioned Parquet layout

    <root>/hourly/capture_date=D/capture_hour=H/part-*.parquet
    <root>/daily/capture_date=D/part-*.parquet
    <root>/weekly/week_ending=S/part-*.parquet

Each job reads only the partitions it needs (partition filters), handles any number of
dates in one run, and replaces exactly the partitions it produces (dynamic overwrite), so a
rerun after a failure is idempotent.

    python -m vantage.plans.jobs hourly <snapshots-glob> <root> <capture-ts>
    python -m vantage.plans.jobs daily  <root> <date> [<date> ...]
    python -m vantage.plans.jobs weekly <root> <sunday> [<sunday> ...]
    python -m vantage.plans.jobs regenerate <root> <first-date> <last-date> [force]
    python -m vantage.plans.jobs backfill <root> <first-date> <last-date>
    python -m vantage.plans.jobs publish <root> <target-uri> <level> <days-back> <today>
    python -m vantage.plans.jobs weather <objects> <root>
"""

from __future__ import annotations

import datetime as dt
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vantage import sinks
from vantage.operators import weather as W
from vantage.plans import levels as L
from vantage.plans import publish as P
from vantage.sources import levels as S
from vantage.sources import snapshots as SN
from vantage.session import observed, path_exists


def build_hourly(spark: SparkSession, snapshots: str, root: str, capture_ts: str, tz: str = "UTC") -> DataFrame:
    """M1: snapshot files -> flattened, complete observations of one capture hour.  The files are
    parsed once: the report reads the partition that was written."""
    flat = SN.flatten(SN.read_snapshots(spark, snapshots), tz)
    cap = flat.withColumn("capture_ts", F.date_trunc("hour", F.lit(capture_ts).cast("timestamp_ntz")).cast("timestamp_ntz"))
    written = Observation()
    h = L.hourly_level(cap).observe(written, F.count(F.lit(1)).alias("n"))
    sinks.write_level(h, root, "hourly", ("capture_date", "capture_hour"))
    if not observed(written).get("n", 0):        # nothing was written, and an earlier capture of the hour stays
        return L.capture_hourly(spark.createDataFrame([], cap.schema))
    at = dt.datetime.fromisoformat(capture_ts).replace(minute=0, second=0, microsecond=0)
    hour = S.read_level(spark, root, "hourly", dates=[str(at.date())]).where(F.col("capture_hour") == at.hour)
    return L.capture_hourly(hour.drop("capture_date", "capture_hour"))


def build_daily(spark: SparkSession, root: str, dates) -> DataFrame:
    """M2: dedup the hourly partitions of ``dates`` into daily partitions (one job)."""
    hourly = S.read_level(spark, root, "hourly", dates=dates)
    daily = L.daily_level(hourly).drop("capture_hour")
    sinks.write_level(daily, root, "daily", ("capture_date",))
    return L.dedup_counts(hourly, S.read_level(spark, root, "daily", dates=dates))


def build_weekly(spark: SparkSession, root: str, sundays, dedup: bool = False) -> DataFrame:
    """Union the daily partitions of each week (Monday..Sunday) under its Sunday."""
    days = sorted({str(d) for s in sundays for d in _week_days(s)})
    daily = S.read_level(spark, root, "daily", dates=days)
    w = L.weekly_level(daily, dedup).where(F.col("week_ending").isin([F.lit(s).cast("date") for s in sundays]))
    sinks.write_level(w, root, "weekly", ("week_ending",))
    return L.weekly_rollup(daily, dedup).where(F.col("week_ending").isin([F.lit(s).cast("date") for s in sundays]))


def regenerate(spark: SparkSession, root: str, start: str, end: str, force: bool = False) -> DataFrame:
    """Rebuild the daily partitions of a date range that have hourly input and are missing (or
    all of them with ``force``), in one job.  Returns the plan."""
    days = [str(d) for d in _dates(start, end)]
    present = _partitions(spark, f"{root}/daily", "capture_date")
    hours = S.read_level(spark, root, "hourly", dates=days).select("capture_ts").distinct()
    plan = _settled(L.regeneration_plan(hours, present, start, end, force))
    todo = [str(r["date"]) for r in plan.collect() if r["action"] == "regenerate"]
    if todo:
        build_daily(spark, root, todo)
    return plan


def backfill(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """Build every week that touches the date range, in one job."""
    return build_weekly(spark, root, sorted({str(_week_days(d)[-1]) for d in _dates(start, end)}))


def publish(spark: SparkSession, root: str, uri: str, level: str, days_back: int, today: str) -> DataFrame:
    """K5/K6: copy the partitions of ``level`` that lie in the window and are not at ``uri`` yet.
    Returns the plan; a failed copy is repeated by the next run, as partitions are committed whole."""
    col = "week_ending" if level == "weekly" else "capture_date"
    prefix = {"hourly": "flights_hourly_", "daily": "flights_daily_", "weekly": "flights_weekly_ending_"}[level]
    name = F.concat(F.lit(prefix), F.col(col).cast("string"), F.lit(".parquet"))
    here = _partitions(spark, f"{root}/{level}", col).select(name.alias("name"))
    there = _partitions(spark, f"{uri.rstrip('/')}/{level}", col)
    plan = _settled(P.publish_plan(here, there.select(F.concat(F.lit(f"{level}/"), name).alias("object_name")), level, days_back, today))
    days = [str(r["file_date"]) for r in plan.collect() if r["action"] == "upload"]
    if days:
        cols = ("capture_date", "capture_hour") if level == "hourly" else (col,)
        part = spark.read.parquet(f"{root}/{level}").where(F.col(col).isin([F.lit(d).cast("date") for d in days]))
        sinks.publish(part, f"{uri.rstrip('/')}/{level}", cols)
    return plan


def build_weather(spark: SparkSession, objects: str, root: str) -> DataFrame:
    """Weather files -> the weekly temperature table.  Returns the counts per route.  JSON files
    are read whole, METAR files line by line; of other files only the names are looked at."""
    json = S.read_text_objects(spark, objects, "*.json")
    temps = W.all_temps(json).unionByName(W.metar_temps_by_line(S.read_lines(spark, objects)))
    W.weather_weekly(temps).write.mode("overwrite").parquet(f"{root.rstrip('/')}/weather_weekly")
    rest = S.list_files(spark, objects).where(~F.col("path").endswith(".json"))
    return W.route_counts(W.weather_route(json.unionByName(rest.select(F.col("path").alias("name"), F.lit("").alias("content")))))


def _settled(plan: DataFrame) -> DataFrame:
    """A plan's rows (one per date) as they are before the job changes what they were read from."""
    return plan.sparkSession.createDataFrame(plan.collect(), plan.schema)


def _partitions(spark: SparkSession, path: str, col: str) -> DataFrame:
    """The dates that a stored level has, from its folders' names."""
    empty = spark.createDataFrame([], f"{col} date")
    if not path_exists(spark, path):
        return empty
    return spark.read.parquet(path).select(F.col(col).cast("date").alias(col)).distinct()


def _dates(start: str, end: str):
    a, b = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    return [a + dt.timedelta(days=k) for k in range((b - a).days + 1)]


def _week_days(sunday: str):
    """The seven dates of the Monday-Sunday week containing ``sunday`` (a parameter, so plain
    calendar arithmetic; the dates become a partition filter)."""
    d = dt.date.fromisoformat(str(sunday))
    end = d + dt.timedelta(days=(6 - d.weekday()) % 7)
    return [end - dt.timedelta(days=i) for i in range(6, -1, -1)]


def main(argv):
    from vantage.session import build_session
    spark = build_session(app="vantage-jobs")
    run = {"hourly": lambda a: build_hourly(spark, *a), "daily": lambda a: build_daily(spark, a[0], a[1:]),
           "weekly": lambda a: build_weekly(spark, a[0], a[1:]),
           "regenerate": lambda a: regenerate(spark, *a[:3], force=a[3:] == ["force"]),
           "backfill": lambda a: backfill(spark, *a), "weather": lambda a: build_weather(spark, *a),
           "publish": lambda a: publish(spark, *a[:3], int(a[3]), a[4])}
    if len(argv) < 2 or argv[1] not in run:
        raise SystemExit(__doc__)
    run[argv[1]](argv[2:]).show(truncate=False)


if __name__ == "__main__":
    main(sys.argv)
