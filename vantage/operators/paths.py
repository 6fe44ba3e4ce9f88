"""Flight paths, segments and GeoJSON features.

A path is the positioned observations of one ``(hex, flight)`` in time order: by observation
time, and among equal times by epoch, source file and the position itself, one total order that
sequence numbers, segments and end points all share.  A path of fewer than two points is not drawn.

Paths are kept in long form (one row per point with its sequence number), never collected.  The
points are shuffled once, by ``(hex, flight, time bucket)``, so an aircraft or callsign that owns a
third of all rows is spread over its buckets; rank and next point come from a window inside the
bucket, and a table with one row per bucket, made by a partial aggregate, adds how many points
came before and which point opens the next bucket.  End points, altitudes and totals need no order
at all: they are one aggregate per path, folded before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.functions.columns import epoch_micros, path_label

KEY = ("hex", "flight")
BUCKET_SECONDS = 60      # of a path's points that are ordered together
LEAST_POINTS = 2         # a line needs two
# What a point carries, in the order that settles equal times.
POINT = ("observation_time", "observation_epoch", "source_file", "lat", "lon", "alt_baro", "gs", "track", "rssi")


def positioned(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def flight_candidates(obs: DataFrame, min_obs: int = 5) -> DataFrame:
    """W4 (F13 HAVING count >= N): positioned (hex, flight) groups with enough points,
    NULL callsign included as its own group."""
    return (positioned(obs).groupBy(*KEY).agg(F.count(F.lit(1)).alias("points"))
            .where(F.col("points") >= min_obs))


def _named(obs: DataFrame) -> DataFrame:
    """Points that can be on a path: NULL identifiers never match a path lookup."""
    return positioned(obs).where(F.col("hex").isNotNull() & F.col("flight").isNotNull())


def _least(min_obs: int) -> int:
    return max(min_obs, LEAST_POINTS)


def _point() -> Column:
    """A point as a struct whose ordering is the path's: times first, NULL time last."""
    return F.struct(F.col("observation_time").isNull().alias("untimed"), *POINT)


def path_rows(obs: DataFrame, min_obs: int = 5, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every point of every path: hex, flight, seq (from 1), pt and next (the point after it, NULL
    at the end)."""
    micros = F.floor(epoch_micros("observation_time") / (bucket_seconds * 1_000_000))
    last = F.lit(2 ** 62)      # points without a time come after all others
    points = _named(obs).select(*KEY, F.coalesce(micros, last).cast("long").alias("bucket"), _point().alias("pt"))
    buckets = points.groupBy(*KEY, "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("pt").alias("first"))
    path = Window.partitionBy(*KEY)
    earlier = path.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = (buckets.select(*KEY, "bucket", F.sum("n").over(path).alias("points"),
                             F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                             F.lead("first").over(path.orderBy("bucket")).alias("opens"))
              .where(F.col("points") >= _least(min_obs)))
    inside = Window.partitionBy(*KEY, "bucket").orderBy("pt")
    return (points.join(placed, [*KEY, "bucket"])
            .select(*KEY, (F.col("before") + F.row_number().over(inside)).alias("seq"), "pt",
                    F.coalesce(F.lead("pt").over(inside), F.col("opens")).alias("next")))


def flight_paths(obs: DataFrame, min_obs: int = 5, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """W5 + W11: one row per point: hex, flight, label, seq, time, epoch, position, altitude, speed,
    track, signal."""
    names = [n for n in POINT if n != "source_file"]
    return path_rows(obs, min_obs, bucket_seconds).select(
        *KEY, path_label().alias("label"), "seq", *[F.col(f"pt.{n}").alias(n) for n in names])


def path_segments(obs: DataFrame, min_obs: int = 5, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Consecutive point pairs of every path (a path of n points gives n-1 segments), with the
    speed and track at each end."""
    short = {"observation_time": "time", "lat": "lat", "lon": "lon", "alt_baro": "alt", "gs": "speed", "track": "track"}
    ends = [F.col(f"{side}.{n}").alias(f"{to}_{s}") for side, to in (("pt", "from"), ("next", "to")) for n, s in short.items()]
    return (path_rows(obs, min_obs, bucket_seconds).where(F.col("next").isNotNull())
            .select(*KEY, path_label().alias("label"), "seq", *ends))


def _per_path(obs: DataFrame, min_obs: int, *aggregates: Column) -> DataFrame:
    return (_named(obs).groupBy(*KEY).agg(F.count(F.lit(1)).alias("points"), *aggregates)
            .where(F.col("points") >= _least(min_obs)))


def path_endpoints(obs: DataFrame, min_obs: int = 5) -> DataFrame:
    """First and last point of every path."""
    g = _per_path(obs, min_obs, F.min(_point()).alias("s"), F.max(_point()).alias("e"))
    return g.select(*KEY, path_label().alias("label"), "points",
                    F.col("s.observation_time").alias("start_time"), F.col("s.lat").alias("start_lat"),
                    F.col("s.lon").alias("start_lon"), F.col("e.observation_time").alias("end_time"),
                    F.col("e.lat").alias("end_lat"), F.col("e.lon").alias("end_lon"))


INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def path_altitude(obs: DataFrame, min_obs: int = 5) -> DataFrame:
    """W7: 'min-max ft' over numeric altitudes; 'ground' when none is left after dropping
    NULL and 'ground'; 'varies' when a value is not integer text."""
    a = F.col("alt_baro")
    usable = a.isNotNull() & (a != "ground")
    as_int = F.when(usable & a.rlike(INT_TEXT), F.trim(a).cast("int"))
    g = _per_path(obs, min_obs, F.count_if(usable).alias("_u"), F.count_if(usable & ~a.rlike(INT_TEXT)).alias("_bad"),
                  F.min(as_int).alias("min_alt"), F.max(as_int).alias("max_alt"))
    info = (F.when(F.col("_u") == 0, F.lit("ground")).when(F.col("_bad") > 0, F.lit("varies"))
            .otherwise(F.concat(F.col("min_alt").cast("string"), F.lit("-"), F.col("max_alt").cast("string"), F.lit(" ft"))))
    return g.select(*KEY, info.alias("alt_info"),
                    F.when(F.col("_bad") == 0, F.col("min_alt")).alias("min_alt"),
                    F.when(F.col("_bad") == 0, F.col("max_alt")).alias("max_alt"))


def path_totals(obs: DataFrame, min_obs: int = 5) -> DataFrame:
    """Number of paths and points drawn."""
    return _per_path(obs, min_obs).agg(F.count(F.lit(1)).alias("paths"), F.sum("points").alias("points"))


def iso_time(ts: Column) -> Column:
    """ISO 8601 text of a time; microseconds are written only when there are any."""
    whole, parts = "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return F.when(ts == F.date_trunc("second", ts).cast("timestamp_ntz"), F.date_format(ts, whole)).otherwise(F.date_format(ts, parts))


def path_features(obs: DataFrame, min_obs: int = 5, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The features of every path in columns: kind (point, segment), hex, flight, label, seq,
    times, coordinates, altitude, speed and track (of the segment's first point).  Points and
    segments are two projections of one pass."""
    point, nxt = F.col("pt"), F.col("next")
    pair = lambda p: F.array(p["lon"], p["lat"])
    one = F.struct(F.lit("point").alias("kind"), F.array(iso_time(point["observation_time"])).alias("times"),
                   F.array(pair(point)).alias("coordinates"))
    two = F.struct(F.lit("segment").alias("kind"),
                   F.array(iso_time(point["observation_time"]), iso_time(nxt["observation_time"])).alias("times"),
                   F.array(pair(point), pair(nxt)).alias("coordinates"))
    made = F.when(nxt.isNull(), F.array(one)).otherwise(F.array(one, two))
    return (path_rows(obs, min_obs, bucket_seconds)
            .select(*KEY, path_label().alias("label"), "seq", "pt", F.explode(made).alias("f"))
            .select("f.kind", *KEY, "label", "seq", "f.times", "f.coordinates", F.col("pt.alt_baro").alias("altitude"),
                    F.col("pt.gs").alias("speed"), F.col("pt.track").alias("track")))


def geojson_features(obs: DataFrame, min_obs: int = 5, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """K8: GeoJSON Feature text per point (time-stamped) and per segment (LineString)."""
    point = F.col("kind") == "point"
    properties = F.struct(F.col("times")[0].alias("time"), F.when(~point, F.col("times")).alias("times"),
                          F.col("label").alias("flight"), "hex", "altitude", "speed", "track", "seq")
    place = F.struct(F.lit("Point").alias("type"), F.col("coordinates")[0].alias("coordinates"))
    line = F.struct(F.lit("LineString").alias("type"), "coordinates")
    text = F.when(point, F.to_json(F.struct(F.lit("Feature").alias("type"), place.alias("geometry"), properties.alias("properties")))) \
            .otherwise(F.to_json(F.struct(F.lit("Feature").alias("type"), line.alias("geometry"), properties.alias("properties"))))
    return path_features(obs, min_obs, bucket_seconds).select("kind", "hex", "flight", text.alias("feature"))
