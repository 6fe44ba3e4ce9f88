"""Registry enrichment (J1-J3) and the enriched reports.

Plan shape used throughout: observations are first reduced per aircraft (or per
aircraft+callsign) with a partial/final aggregate, and only that reduced relation is joined
to the registry.  The join input therefore scales with the number of aircraft, not with
the number of observations, and a hot aircraft (a third of all rows) is folded map-side
before any shuffle.  The registry is broadcast only when its estimated size is under a
limit (``maybe_broadcast``); above it the planner keeps a shuffle join and AQE re-plans
from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.functions.columns import (alt_ft, avg_half_up, decade, engines_label, has_callsign, pct,
                                       platform_label, power_label, size_class, year_int)
from vantage.operators import paths as P
from vantage.session import staged

# Of the optimizer's estimate, which is of compressed files: several times that in memory.
DEFAULT_BROADCAST_LIMIT = 8 * 1024 * 1024

# Owner/operator patterns of medical operators (fixed values, matched case-insensitively).
MEDICAL_PATTERNS = ["%life%link%", "%medical%", "%critical care%", "%air ambulance%"]
# Type codes listed by the category report (fixed values).
CATEGORY_CODES = ["L1P", "L2J", "L4J", "L2T", "L1T", "H2T", "H1T"]
# Named year ranges [start, end) of the age examples (fixed values).
AGE_RANGES = [(1940, 1950, "1940s"), (1970, 1980, "1970s"), (2000, 2010, "2000s"), (2020, 2026, "2020s")]


def _n():
    return F.count(F.lit(1))


def estimated_size(df: DataFrame) -> int | None:
    """Optimizer's size estimate of a plan (bytes), or None when unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def maybe_broadcast(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the choice to the planner/AQE."""
    size = estimated_size(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def registry(af: DataFrame, *cols: str) -> DataFrame:
    return af.select("icao", *cols)


def enrich(left: DataFrame, af: DataFrame, how: str = "left", cols=None, limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """``left.hex = af.icao``; ``how='left'`` keeps unmatched rows.  A registry with a
    repeated icao fans out, as an SQL join does."""
    r = af if cols is None else registry(af, *cols)
    out = left.join(maybe_broadcast(r, limit), left["hex"] == r["icao"], how)
    return out


def per_aircraft(obs: DataFrame, *extra_keys: str, where: Column | None = None) -> DataFrame:
    """Observation count per hex (and extra keys): the reduced side of every enriched report."""
    src = obs if where is None else obs.where(where)
    return src.groupBy("hex", *extra_keys).agg(_n().alias("observations"))


def _valid_year(af: DataFrame, ref_year: int, lo: int = 1900) -> DataFrame:
    y = year_int()
    return (af.where(F.col("manufacture_year").isNotNull() & y.isNotNull() & (y >= lo) & (y <= ref_year))
            .withColumn("year_int", y))


def match_rate(obs: DataFrame, af: DataFrame) -> DataFrame:
    """Distinct observed aircraft, how many are in the registry, and the rate."""
    seen = obs.select("hex").distinct()
    j = enrich(seen, registry(af).distinct(), "left")
    return (j.agg(F.count_distinct("hex").alias("total_observed"),
                  F.count_distinct(F.when(F.col("icao").isNotNull(), F.col("hex"))).alias("matched"))
            .withColumn("match_pct", pct(F.col("matched"), F.col("total_observed"))))


def age_by_decade(obs: DataFrame, af: DataFrame, ref_year: int = 2025) -> DataFrame:
    """A37 (P10, F5, J2, W2): two-level aggregate -- per aircraft, then per decade."""
    per = per_aircraft(obs)
    r = _valid_year(af, ref_year).select("icao", "manufacture_year", "year_int")
    hy = (enrich(per, r, "inner").groupBy("hex", "manufacture_year", "year_int")
          .agg(F.sum("observations").alias("observations")))
    g = (hy.withColumn("decade", decade(F.col("year_int")))
         .groupBy("decade")
         .agg(F.count_distinct("hex").alias("unique_aircraft"), F.sum("observations").alias("total_observations"),
              F.min("year_int").alias("earliest_year"), F.max("year_int").alias("latest_year"),
              avg_half_up(F.lit(ref_year) - F.col("year_int"), 1).alias("avg_age")))
    return (g.select(F.concat(F.col("decade").cast("string"), F.lit("s")).alias("decade_label"),
                     "unique_aircraft", "total_observations",
                     pct(F.col("total_observations"), F.sum("total_observations").over(Window.partitionBy())).alias("percentage"),
                     "earliest_year", "latest_year", "avg_age", "decade")
            .orderBy("decade").drop("decade"))


def age_by_decade_total(obs: DataFrame, af: DataFrame, ref_year: int = 2025) -> DataFrame:
    """Per-decade lines plus the grand total, as ROLLUP(decade)."""
    per = per_aircraft(obs)
    r = _valid_year(af, ref_year).select("icao", "year_int")
    hy = enrich(per, r, "inner").withColumn("decade", decade(F.col("year_int")))
    g = hy.rollup("decade").agg(F.count_distinct("hex").alias("unique_aircraft"),
                                F.sum("observations").alias("total_observations"),
                                F.grouping("decade").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit("Total"))
                    .otherwise(F.concat(F.col("decade").cast("string"), F.lit("s"))).alias("decade_label"),
                    "unique_aircraft", "total_observations")


def age_examples(obs: DataFrame, af: DataFrame, ranges=None, k: int = 10, ref_year: int = 2025) -> DataFrame:
    """A39 (F6, W3): top-k flights of each named year range, in one job.

    The ranges are a literal relation of a handful of rows (a proven size bound), joined
    with a range condition after the per-flight aggregate."""
    ranges = ranges or AGE_RANGES
    spark = obs.sparkSession
    rg = spark.createDataFrame([(a, b, n) for a, b, n in ranges], "range_start INT, range_end INT, decade STRING")
    per = per_aircraft(obs, "flight", where=has_callsign("flight", "length"))
    r = (af.where(F.col("manufacture_year").isNotNull() & year_int().isNotNull())
         .select("icao", "registration", "manufacturer", "model", "manufacture_year", year_int().alias("year")))
    g = (enrich(per, r, "inner")
         .groupBy("hex", "flight", "registration", "manufacturer", "model", "manufacture_year", "year")
         .agg(F.sum("observations").alias("observations")))
    j = g.join(F.broadcast(rg), (g["year"] >= rg["range_start"]) & (g["year"] < rg["range_end"]))
    w = Window.partitionBy("decade").orderBy(F.desc("observations"), "flight", "hex", F.asc_nulls_last("registration"))
    return (j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .select("decade", "hex", "flight", "registration", "year", (F.lit(ref_year) - F.col("year")).alias("age"),
                    "manufacturer", "model", "observations"))


def age_by_type(obs: DataFrame, af: DataFrame, min_rows: int = 100, k: int = 15, ref_year: int = 2025) -> DataFrame:
    """A40 (F13 HAVING sum > min_rows)."""
    per = per_aircraft(obs)
    r = _valid_year(af, ref_year).where(F.col("icao_type").isNotNull()).select(
        "icao", "icao_type", "manufacturer", "model", "year_int")
    hy = (enrich(per, r, "inner").groupBy("hex", "icao_type", "manufacturer", "model", "year_int")
          .agg(F.sum("observations").alias("observations"))
          .withColumn("age", F.lit(ref_year) - F.col("year_int")))
    return (hy.groupBy("icao_type", "manufacturer", "model")
            .agg(F.count_distinct("hex").alias("aircraft_count"), F.sum("observations").alias("total_observations"),
                 avg_half_up("age", 1).alias("avg_age"), F.min("age").alias("youngest"), F.max("age").alias("oldest"))
            .where(F.col("total_observations") > min_rows)
            .orderBy(F.desc("total_observations"), F.asc_nulls_last("icao_type"), F.asc_nulls_last("manufacturer"),
                     F.asc_nulls_last("model"))
            .limit(k))


def category_summary(obs: DataFrame, af: DataFrame) -> DataFrame:
    """A41 (P8): platform x engines x power."""
    per = per_aircraft(obs)
    r = af.where(F.col("short_type").isNotNull()).select("icao", "short_type")
    hs = enrich(per, r, "inner").groupBy("hex", "short_type").agg(F.sum("observations").alias("observations"))
    return (hs.groupBy(platform_label().alias("platform"), engines_label().alias("engines"), power_label().alias("power"),
                       F.substring("short_type", 1, 1).alias("_p"), F.substring("short_type", 2, 1).alias("_e"),
                       F.substring("short_type", 3, 1).alias("_t"))
            .agg(F.count_distinct("hex").alias("aircraft"), F.sum("observations").alias("observations"))
            .orderBy(F.desc("observations")).drop("_p", "_e", "_t"))


def category_top_flights(obs: DataFrame, af: DataFrame, codes=None, k: int = 10) -> DataFrame:
    """A42 (F10, W3): top-k flights for each listed type code, one window instead of a loop."""
    codes = codes or CATEGORY_CODES
    per = per_aircraft(obs, "flight", where=has_callsign("flight", "length"))
    r = af.where(F.col("short_type").isin(codes)).select(
        "icao", "registration", "manufacturer", "model", "icao_type", "short_type", "owner_operator")
    g = (enrich(per, r, "inner")
         .groupBy("hex", "flight", "registration", "manufacturer", "model", "icao_type", "short_type", "owner_operator")
         .agg(F.sum("observations").alias("observations")))
    w = Window.partitionBy("short_type").orderBy(F.desc("observations"), "flight", "hex", F.asc_nulls_last("registration"))
    return (g.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .select("short_type", "hex", "flight", "registration", "manufacturer", "model", "icao_type",
                    "owner_operator", "observations"))


def business_top(obs: DataFrame, af: DataFrame, code: str = "L2J", k: int = 10) -> DataFrame:
    """A42 narrowed to one type code, with the owner."""
    return category_top_flights(obs, af, [code], k).drop("short_type")


def size_distribution(obs: DataFrame, af: DataFrame) -> DataFrame:
    """A43 (P9, W2): land planes by engine count; groups by label and digit."""
    per = per_aircraft(obs)
    r = af.where(F.col("short_type").isNotNull() & (F.substring("short_type", 1, 1) == "L")).select("icao", "short_type")
    hs = enrich(per, r, "inner").groupBy("hex", "short_type").agg(F.sum("observations").alias("observations"))
    g = (hs.groupBy(size_class().alias("size_category"), F.substring("short_type", 2, 1).alias("_e"))
         .agg(F.count_distinct("hex").alias("aircraft"), F.sum("observations").alias("observations")))
    return (g.select("size_category", "aircraft", "observations",
                     pct(F.col("observations"), F.sum("observations").over(Window.partitionBy())).alias("pct"))
            .orderBy(F.desc("observations")))


def medical(af: DataFrame, patterns=None, rotary: bool | None = True) -> DataFrame:
    """registry rows of medical operators (optionally rotary wing only)."""
    patterns = patterns or MEDICAL_PATTERNS
    low = F.lower(F.col("owner_operator"))
    cond = None
    for p in patterns:
        cond = low.like(p) if cond is None else (cond | low.like(p))
    if rotary:
        cond = cond & F.col("short_type").like("H%")
    return af.where(cond)


def medical_fleet(obs: DataFrame, af: DataFrame) -> DataFrame:
    """Distinct medical-helicopter (hex, flight) with registry attributes."""
    flights = obs.where(has_callsign("flight", "length")).select("hex", "flight").distinct()
    r = medical(af).select("icao", "registration", "manufacturer", "model", "owner_operator")
    return (enrich(flights, r, "inner")
            .select("hex", "flight", "registration", "manufacturer", "model", "owner_operator").distinct())


def _layer(owner: Column) -> Column:
    """The 'Life Link' layer of the medical map, or the rest."""
    return F.when(F.upper(owner).contains("LIFE LINK"), F.lit("Life Link")).otherwise(F.lit("Other"))


def medical_paths(obs: DataFrame, af: DataFrame, min_obs: int = 2) -> DataFrame:
    """W12 + W5: the paths of the medical fleet, point by point, each with its layer and operator.
    The fleet's flights are few: they are worked out once and written, and the points are found by a
    semi join with them before paths are ordered."""
    owner = F.coalesce(F.col("owner_operator"), F.lit("Unknown"))
    fleet = staged(medical_fleet(obs, af).groupBy("hex", "flight")
                   .agg(F.min(owner).alias("operator")).withColumn("layer", _layer(F.col("operator"))), "medical-fleet")
    points = P.flight_paths(obs.join(fleet.select("hex", "flight"), ["hex", "flight"], "left_semi"), min_obs)
    return points.join(fleet, ["hex", "flight"])


def medical_layers(obs: DataFrame, af: DataFrame) -> DataFrame:
    """Split the medical fleet into the 'Life Link' layer and the rest (NULL owner -> Unknown)."""
    m = medical_fleet(obs, af)
    owner = F.coalesce(F.col("owner_operator"), F.lit("Unknown"))
    return (m.groupBy(_layer(owner).alias("layer"))
            .agg(F.count(F.lit(1)).alias("flights"), F.count_distinct("hex").alias("aircraft"),
                 F.count_distinct(owner).alias("operators")))


def medical_activity(obs: DataFrame, af: DataFrame) -> DataFrame:
    """Medical aircraft, rotary and fixed wing: rows, first/last, active days, avg alt/speed.
    Observations are reduced to one row per aircraft and day before the registry is joined."""
    alt = alt_ft()
    per = (obs.groupBy("hex", F.to_date("observation_time").alias("day"))
           .agg(_n().alias("n"), F.min("observation_time").alias("first"), F.max("observation_time").alias("last"),
                F.sum(alt).alias("alt"), F.count(alt).alias("n_alt"), F.sum("gs").alias("gs"), F.count("gs").alias("n_gs")))
    r = medical(af, rotary=None).select("icao", "registration", "owner_operator", "short_type")
    j = enrich(per, r, "inner")
    return (j.groupBy("hex", "registration", "owner_operator", "short_type")
            .agg(F.sum("n").alias("observations"), F.min("first").alias("first_seen"), F.max("last").alias("last_seen"),
                 F.count_distinct("day").alias("active_days"),
                 F.try_divide(F.sum("alt").cast("double"), F.sum("n_alt")).alias("avg_altitude"),
                 F.try_divide(F.sum("gs"), F.sum("n_gs")).alias("avg_speed")))


def medical_share(obs: DataFrame, af: DataFrame) -> DataFrame:
    """Rotary vs fixed-wing share of each medical operator's rows."""
    per = per_aircraft(obs)
    r = medical(af, rotary=None).select("icao", "owner_operator", "short_type")
    j = enrich(per, r, "inner")
    g = (j.groupBy("owner_operator", F.when(F.col("short_type").like("H%"), F.lit("rotary"))
                   .otherwise(F.lit("fixed")).alias("wing"))
         .agg(F.sum("observations").alias("observations"), F.count_distinct("hex").alias("aircraft")))
    return g.withColumn("pct", pct(F.col("observations"),
                                   F.sum("observations").over(Window.partitionBy("owner_operator"))))


def enriched_top_flights(obs: DataFrame, af: DataFrame, k: int = 10) -> DataFrame:
    """A45 (J1): sample enrichment, left join, top k."""
    per = per_aircraft(obs, "flight", where=F.col("flight").isNotNull() & (F.col("flight") != ""))
    r = af.select("icao", "registration", "manufacturer", "model", "icao_type", "owner_operator")
    return (enrich(per, r, "left")
            .groupBy("hex", "flight", "registration", "manufacturer", "model", "icao_type", "owner_operator")
            .agg(F.sum("observations").alias("observations"))
            .orderBy(F.desc("observations"), "hex", "flight", F.asc_nulls_last("registration"))
            .limit(k))


def top_by_days(obs: DataFrame, k: int = 10) -> DataFrame:
    """D1"""
    return (obs.where(has_callsign("flight", "length")).groupBy("hex", "flight")
            .agg(F.count_distinct(F.to_date("observation_time")).alias("days"), _n().alias("observations"))
            .orderBy(F.desc("days"), F.desc("observations"), "hex", "flight").limit(k))


def top_flights_profile(obs: DataFrame, af: DataFrame, k: int = 10) -> DataFrame:
    """Top-k flights first (small), then the registry attributes by a left join."""
    top = (obs.where(has_callsign("flight", "length")).groupBy("hex", "flight")
           .agg(_n().alias("observations"), F.count_distinct(F.to_date("observation_time")).alias("days"),
                F.avg(alt_ft()).alias("avg_altitude"), F.avg("gs").alias("avg_speed"))
           .orderBy(F.desc("observations"), "hex", "flight").limit(k))
    r = af.select("icao", "manufacturer", "model", "manufacture_year")
    return enrich(top, r, "left").drop("icao")


def no_callsign(obs: DataFrame, k: int = 20) -> DataFrame:
    """D3: aircraft seen without a callsign (NULL or blank)."""
    blank = F.col("flight").isNull() | (F.trim(F.col("flight")) == "")
    return (obs.where(blank).groupBy("hex")
            .agg(_n().alias("observations"), F.count_distinct(F.to_date("observation_time")).alias("days"),
                 F.min("observation_time").alias("first_seen"), F.max("observation_time").alias("last_seen"))
            .orderBy(F.desc("observations"), "hex").limit(k))


def operator_prefix(obs: DataFrame) -> DataFrame:
    """Activity per three-letter operator prefix of the callsign."""
    p = F.regexp_extract(F.col("flight"), r"^([A-Z]{3})[0-9]", 1)
    return (obs.where(F.col("flight").isNotNull()).withColumn("prefix", p).where(F.col("prefix") != "")
            .groupBy("prefix").agg(_n().alias("observations"), F.count_distinct("hex").alias("aircraft"),
                                   F.count_distinct("flight").alias("flights")))


def age_completeness(obs: DataFrame, af: DataFrame, ref_year: int = 2025) -> DataFrame:
    """Rows with / without a usable manufacture year (left join, unmatched = without)."""
    per = per_aircraft(obs)
    y = year_int()
    r = af.select("icao", ((y >= 1900) & (y <= ref_year)).alias("_ok"))
    j = enrich(per, r, "left")
    ok = F.coalesce(F.col("_ok"), F.lit(False))
    return j.agg(F.sum("observations").alias("total_rows"),
                 F.coalesce(F.sum(F.when(ok, F.col("observations"))), F.lit(0)).alias("with_year"),
                 F.coalesce(F.sum(F.when(~ok, F.col("observations"))), F.lit(0)).alias("without_year"))


def modern_share(obs: DataFrame, af: DataFrame, from_year: int = 2000, ref_year: int = 2025) -> DataFrame:
    """Share of rows (with a valid year) from aircraft built in or after ``from_year``."""
    per = per_aircraft(obs)
    r = _valid_year(af, ref_year).select("icao", "year_int")
    j = enrich(per, r, "inner")
    g = j.agg(F.sum("observations").alias("rows_with_year"),
              F.coalesce(F.sum(F.when(F.col("year_int") >= from_year, F.col("observations"))), F.lit(0)).alias("modern_rows"))
    return g.withColumn("modern_pct", pct(F.col("modern_rows"), F.col("rows_with_year")))


def airframe_coverage(af: DataFrame) -> DataFrame:
    """A5"""
    return af.agg(_n().alias("total_records"), F.count_distinct("icao").alias("unique_icao"),
                  F.count("registration").alias("with_registration"), F.count("manufacturer").alias("with_manufacturer"),
                  F.count_if(F.col("military")).alias("military_count"))
