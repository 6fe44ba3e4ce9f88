"""Single-table observation reports.

Input is the observation model (``hex``, ``observation_time``, ``observation_epoch``,
``flight``, ``lat``, ``lon``, ``alt_baro``, ``gs``, ``track``, ``category``, ``rssi``,
``messages``, ``source_file`` ...).  Each report is one aggregate (partial + final
HashAggregate) or a top-k (TakeOrderedAndProject); nothing is collected.  Top-k reports
carry total-order tie-breakers so the k rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.functions.columns import alt_ft, has_callsign, pct

def _n():
    return F.count(F.lit(1))


def complete_only(obs: DataFrame, cols=("lat", "lon", "gs", "track")) -> DataFrame:
    """keep rows whose position/velocity columns are all present."""
    return obs.dropna(subset=list(cols))


def complete_counts(obs: DataFrame, cols=("lat", "lon", "gs", "track")) -> DataFrame:
    """F1 counters in one pass: collected / rejected / kept rows and kept aircraft."""
    ok = F.lit(True)
    for x in cols:
        ok = ok & F.col(x).isNotNull()
    return obs.agg(_n().alias("collected"), F.count_if(~ok).alias("rejected"), F.count_if(ok).alias("kept"),
                   F.count_distinct(F.when(ok, F.col("hex"))).alias("kept_aircraft"))


def capture_summary(obs: DataFrame) -> DataFrame:
    """A1"""
    return obs.agg(_n().alias("total_records"), F.count_distinct("hex").alias("unique_aircraft"),
                   F.min("observation_time").alias("earliest"), F.max("observation_time").alias("latest"))


def _met(obs: DataFrame, *columns: str, sums=()) -> DataFrame:
    """One row per combination of ``columns`` that occurs: n rows, the time range and ``sums`` of
    them.  Reports with several distinct counts run over this, as Spark expands their input once
    per count; a combination is folded before any shuffle."""
    return obs.groupBy(*columns).agg(_n().alias("n"), F.min("observation_time").alias("earliest"),
                                     F.max("observation_time").alias("latest"), *sums)


def summary_by(obs: DataFrame, *keys: str) -> DataFrame:
    """Rows, distinct hex, time range and distinct ring-slot files per group."""
    return _met(obs, *keys, "hex", "source_file").groupBy(*keys).agg(
        F.sum("n").alias("total_records"), F.count_distinct("hex").alias("unique_aircraft"),
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"),
        F.count_distinct("source_file").alias("source_files"))


def file_info(obs: DataFrame) -> DataFrame:
    """A7 / A27"""
    return _met(obs, "hex", "flight").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), F.count_distinct("hex").alias("unique_aircraft"),
        F.count_distinct("flight").alias("unique_flights"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))


def basic_info(obs: DataFrame) -> DataFrame:
    """A7 + distinct epochs + time span (seconds)."""
    # a row becomes its three values, each with its column's number; equal values are folded before
    # the only shuffle that grows with the rows, so counting distinct ones is counting rows after it
    epoch = F.col("observation_epoch")
    text = F.array(F.struct(F.lit(0).alias("c"), F.col("hex").alias("v")), F.struct(F.lit(1).alias("c"), F.col("flight").alias("v")),
                   F.struct(F.lit(2).alias("c"), epoch.cast("string").alias("v")))
    cells = (obs.select(F.explode(text).alias("cell"), "observation_time", epoch.alias("e"))
             .groupBy("cell.c", "cell.v").agg(_n().alias("n"), F.min("observation_time").alias("earliest"),
                                              F.max("observation_time").alias("latest"), F.min("e").alias("lo"), F.max("e").alias("hi")))
    many = lambda k: F.count_if((F.col("c") == k) & F.col("v").isNotNull())
    return cells.agg(F.coalesce(F.sum(F.when(F.col("c") == 0, F.col("n"))), F.lit(0)).alias("total_records"),
                     many(0).alias("unique_aircraft"), many(1).alias("unique_flights"), many(2).alias("unique_timestamps"),
                     F.min("earliest").alias("earliest"), F.max("latest").alias("latest"),
                     (F.max("hi") - F.min("lo")).alias("span_seconds"))


def unique_aircraft(obs: DataFrame) -> DataFrame:
    """A9"""
    return obs.agg(F.count_distinct("hex").alias("unique_aircraft"))


def category_counts(obs: DataFrame) -> DataFrame:
    """A10 (F11)"""
    return obs.where(F.col("category").isNotNull()).groupBy("category").agg(_n().alias("observations"))


def category_aircraft(obs: DataFrame) -> DataFrame:
    """A11"""
    return (obs.where(F.col("category").isNotNull()).groupBy("category")
            .agg(F.count_distinct("hex").alias("unique_aircraft"), _n().alias("observations")))


def category_share(obs: DataFrame, k: int = 10) -> DataFrame:
    """A12 + W2: categories incl. '(unknown)', percent of all rows, top k.

    The percent-of-total window runs over the grouped result (one row per category), so the
    single-partition window never sees raw rows."""
    g = obs.groupBy("category").agg(_n().alias("count"), F.count_distinct("hex").alias("unique_aircraft"))
    total = F.sum("count").over(Window.partitionBy())
    return (g.select(F.coalesce("category", F.lit("(unknown)")).alias("category"), "count", "unique_aircraft",
                     pct(F.col("count"), total).alias("percentage"), F.col("category").alias("_raw"))
            .orderBy(F.desc("count"), F.asc_nulls_last("_raw")).limit(k).drop("_raw"))


def signal_stats(obs: DataFrame) -> DataFrame:
    """A13"""
    return (obs.where(F.col("rssi").isNotNull())
            .agg(F.avg("rssi").alias("avg_rssi"), F.min("rssi").alias("min_rssi"),
                 F.max("rssi").alias("max_rssi"), F.avg("messages").alias("avg_messages")))


def signal_stats_full(obs: DataFrame) -> DataFrame:
    """A14"""
    return (obs.where(F.col("rssi").isNotNull())
            .agg(_n().alias("records_with_rssi"), F.avg("rssi").alias("avg_rssi"),
                 F.min("rssi").alias("min_rssi"), F.max("rssi").alias("max_rssi"),
                 F.avg("messages").alias("avg_messages"), F.max("messages").alias("max_messages")))


def top_flights(obs: DataFrame, k: int = 10) -> DataFrame:
    """(flight, hex) with most rows; callsign NOT NULL (keeps '')."""
    return (obs.where(F.col("flight").isNotNull()).groupBy("flight", "hex")
            .agg(_n().alias("observations"), F.min("observation_time").alias("first_seen"),
                 F.max("observation_time").alias("last_seen"))
            .orderBy(F.desc("observations"), "flight", "hex").limit(k))


def top_aircraft(obs: DataFrame, k: int = 10) -> DataFrame:
    """(hex, flight) incl. NULL callsign."""
    return (obs.groupBy("hex", "flight")
            .agg(_n().alias("observations"), F.min("observation_time").alias("first_seen"),
                 F.max("observation_time").alias("last_seen"))
            .orderBy(F.desc("observations"), F.asc_nulls_last("hex"), F.asc_nulls_last("flight")).limit(k))


def top_aircraft_dates(obs: DataFrame, k: int = 10) -> DataFrame:
    """As A16 with first/last date."""
    d = F.to_date("observation_time")
    return (obs.groupBy("hex", "flight")
            .agg(_n().alias("observations"), F.min(d).alias("first_seen"), F.max(d).alias("last_seen"))
            .orderBy(F.desc("observations"), F.asc_nulls_last("hex"), F.asc_nulls_last("flight")).limit(k))


def most_observed(obs: DataFrame, k: int = 15) -> DataFrame:
    """+ distinct days observed."""
    return (obs.where(F.col("flight").isNotNull()).groupBy("hex", "flight")
            .agg(_n().alias("total_observations"),
                 F.count_distinct(F.to_date("observation_time")).alias("days_observed"),
                 F.min("observation_time").alias("first_seen"), F.max("observation_time").alias("last_seen"))
            .orderBy(F.desc("total_observations"), "hex", "flight").limit(k))


# Band edges (fixed values): upper bounds in feet and their labels.
BANDS_AIRBORNE = [(5000, "< 5,000 ft"), (10000, "5,000-10,000 ft"), (20000, "10,000-20,000 ft"),
                  (30000, "20,000-30,000 ft"), (40000, "30,000-40,000 ft")]
TOP_AIRBORNE = "> 40,000 ft"
BANDS_GROUND = [(5000, "0-5k ft"), (10000, "5k-10k ft"), (20000, "10k-20k ft"),
                (30000, "20k-30k ft"), (40000, "30k-40k ft")]
TOP_GROUND = "40k+ ft"


def _band(a, bands, top):
    e = None
    for hi, label in bands:
        e = F.when(a < hi, F.lit(label)) if e is None else e.when(a < hi, F.lit(label))
    return e.otherwise(F.lit(top))


def altitude_bands(obs: DataFrame) -> DataFrame:
    """A19 (F4): airborne numeric altitudes only, ordered by the band's lowest altitude."""
    a = alt_ft()
    return (obs.where(F.col("alt_baro").isNotNull() & (F.col("alt_baro") != "ground") & a.isNotNull())
            .withColumn("_a", a)
            .groupBy(_band(F.col("_a"), BANDS_AIRBORNE, TOP_AIRBORNE).alias("altitude_range"))
            .agg(_n().alias("count"), F.min("_a").alias("_lo"))
            .orderBy("_lo").drop("_lo"))


def altitude_bands_ground(obs: DataFrame) -> DataFrame:
    """Bands incl. 'Ground', percent of rows with altitude, and the display rank."""
    a = alt_ft()
    label = F.when(F.col("alt_baro") == "ground", F.lit("Ground")).otherwise(_band(a, BANDS_GROUND, TOP_GROUND))
    rank = F.when(F.col("altitude_range") == "Ground", 0)
    for i, (_, lab) in enumerate(BANDS_GROUND, start=1):
        rank = rank.when(F.col("altitude_range") == lab, i)
    g = obs.where(F.col("alt_baro").isNotNull()).groupBy(label.alias("altitude_range")).agg(_n().alias("observations"))
    return (g.select("altitude_range", "observations",
                     pct(F.col("observations"), F.sum("observations").over(Window.partitionBy()), 1).alias("percentage"),
                     rank.otherwise(6).alias("sort_rank"))
            .orderBy("sort_rank"))


def daily_activity(obs: DataFrame) -> DataFrame:
    """A21"""
    placed = F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("placed")
    folded = _met(obs.withColumn("date", F.to_date("observation_time")), "date", "hex", "flight",
                  sums=(F.sum("gs").alias("gs"), F.count("gs").alias("n_gs"), placed))
    return (folded.groupBy("date")
            .agg(F.sum("n").alias("observations"), F.count_distinct("hex").alias("aircraft"),
                 F.count_distinct("flight").alias("flights"), F.try_divide(F.sum("gs"), F.sum("n_gs")).alias("avg_ground_speed"),
                 F.sum("placed").alias("with_position"))
            .orderBy("date"))


def hourly_activity(obs: DataFrame) -> DataFrame:
    """A22"""
    return (obs.groupBy(F.hour("observation_time").alias("hour"))
            .agg(_n().alias("observations"), F.count_distinct("hex").alias("unique_aircraft")).orderBy("hour"))


def null_profile(obs: DataFrame) -> DataFrame:
    """Missing-value counts and their percentages in one pass."""
    miss = {"missing_hex": F.col("hex").isNull(),
            "missing_position": F.col("lat").isNull() | F.col("lon").isNull(),
            "missing_ground_speed": F.col("gs").isNull(), "missing_track": F.col("track").isNull(),
            "missing_altitude": F.col("alt_baro").isNull()}
    g = obs.agg(_n().alias("total_records"), *[F.count_if(v).alias(k) for k, v in miss.items()])
    return g.select("*", *[pct(F.col(k), F.col("total_records")).alias(f"{k}_pct") for k in miss])


def range_summary(obs: DataFrame) -> DataFrame:
    """Rows, distinct hex, first/last observation date."""
    d = F.to_date("observation_time")
    return obs.agg(_n().alias("total_observations"), F.count_distinct("hex").alias("unique_aircraft"),
                   F.min(d).alias("first_date"), F.max(d).alias("last_date"))


def per_source_file(obs: DataFrame) -> DataFrame:
    """Per ring-buffer slot."""
    return (obs.groupBy("source_file")
            .agg(_n().alias("records"), F.count_distinct("hex").alias("aircraft"),
                 F.min("observation_time").alias("earliest"), F.max("observation_time").alias("latest"))
            .orderBy(F.desc("earliest")))


def centroid(obs: DataFrame) -> DataFrame:
    """A35"""
    return (obs.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .agg(F.avg("lat").alias("center_lat"), F.avg("lon").alias("center_lon")))


def time_extent(obs: DataFrame) -> DataFrame:
    """A36"""
    return (obs.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .agg(F.min("observation_epoch").alias("min_epoch"), F.max("observation_epoch").alias("max_epoch")))


def recent_positions(obs: DataFrame, k: int = 10) -> DataFrame:
    """O1 (F2): newest positioned rows."""
    return (obs.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .select("hex", "flight", "lat", "lon", "alt_baro", "gs", "track", "observation_time")
            .orderBy(F.desc_nulls_last("observation_time"), F.asc_nulls_last("hex")).limit(k))


def track_aircraft(obs: DataFrame, hex_code: str, flight: str | None = None) -> DataFrame:
    """F8/O2: one aircraft's (or one flight's) rows in time order; the value is a bound literal."""
    cond = F.col("hex") == F.lit(hex_code)
    if flight is not None:
        cond = cond & (F.col("flight") == F.lit(flight))
    return (obs.where(cond)
            .select("observation_time", "hex", "flight", "lat", "lon", "alt_baro", "gs", "track")
            .orderBy("observation_time"))


def distinct_callsigns(obs: DataFrame, k: int = 20) -> DataFrame:
    """A47 (F3 'not_null', U2)"""
    return (obs.where(has_callsign("flight", "not_null")).select("flight", "hex").distinct()
            .orderBy("flight", "hex").limit(k))


def duplicate_keys(obs: DataFrame, keys=("hex", "observation_epoch")) -> DataFrame:
    """A28 (F13 count > 1): number of keys that occur more than once."""
    return (obs.groupBy(*keys).agg(_n().alias("cnt"))
            .agg(F.count_if(F.col("cnt") > 1).alias("duplicate_count")))


def duplicate_examples(obs: DataFrame, k: int = 5, keys=("hex", "observation_epoch")) -> DataFrame:
    """A29"""
    return (obs.groupBy(*keys).agg(_n().alias("count")).where(F.col("count") > 1)
            .orderBy(F.desc("count"), *keys).limit(k))


def position_coverage(obs: DataFrame) -> DataFrame:
    """A31"""
    has = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    g = obs.agg(_n().alias("total"), F.count_if(has).alias("with_position"), F.count_if(~has).alias("without_position"))
    return g.withColumn("coverage_pct", pct(F.col("with_position"), F.col("total")))


def altitude_coverage(obs: DataFrame) -> DataFrame:
    """A32"""
    g = obs.agg(_n().alias("total"), F.count_if(F.col("alt_baro").isNotNull()).alias("with_alt_baro"),
                F.count_if(F.col("alt_baro") == "ground").alias("on_ground"))
    return g.select("*", pct(F.col("with_alt_baro"), F.col("total")).alias("altitude_coverage_pct"),
                    pct(F.col("on_ground"), F.col("total")).alias("ground_pct"))


def timestamp_sanity(obs: DataFrame, now: str, max_age_days: int = 365) -> DataFrame:
    """rows after ``now`` and rows older than ``max_age_days`` (the clock is a parameter)."""
    now_c = F.lit(now).cast("timestamp_ntz")
    old = F.timestamp_add("DAY", F.lit(-max_age_days), now_c)
    t = F.col("observation_time")
    return obs.agg(F.count_if(t > now_c).alias("future_rows"), F.count_if(t < old).alias("old_rows"))
