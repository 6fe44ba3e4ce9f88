"""Edge cases named in FIXTURES.md on tiny hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from vantage import sinks
from vantage.functions.columns import alt_ft, clean_callsign, path_label, week_ending
from vantage.operators import dedup as D
from vantage.operators import enrich as E
from vantage.operators import reports as R
from vantage.operators import weather as W
from vantage.plans import levels as L

OBS = ("observation_time timestamp_ntz, observation_epoch double, hex string, flight string, lat double, "
       "lon double, alt_baro string, gs double, track double, category string, rssi double, messages bigint, "
       "source_file string")


def _t(s):
    return dt.datetime.fromisoformat(s)


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBS)


def test_week_ending_and_last_sunday(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 21),), (dt.date(2025, 12, 22),), (dt.date(2025, 12, 28),)], "d date")
    got = [r.w for r in df.select(week_ending("d").alias("w")).collect()]
    assert got == [dt.date(2025, 12, 21), dt.date(2025, 12, 28), dt.date(2025, 12, 28)]
    ls = spark.range(1).select(L.last_sunday("2025-12-28").alias("a"), L.last_sunday("2025-12-29").alias("b"),
                               L.last_sunday("2025-12-27").alias("c")).first()
    assert (ls.a, ls.b, ls.c) == (dt.date(2025, 12, 21), dt.date(2025, 12, 28), dt.date(2025, 12, 21))


def test_altitude_and_callsign_edges(spark):
    df = spark.createDataFrame([("27975",), ("27975.0",), ("ground",), ("-125",), (None,), ("12.5",)], "alt_baro string")
    assert [r.a for r in df.select(alt_ft().alias("a")).collect()] == [27975, 27975, None, -125, None, 13]
    cs = spark.createDataFrame([(None, "a1"), ("", "a2"), ("   ", "a3"), (" N12\t", "a4")], "flight string, hex string")
    got = cs.select(clean_callsign().alias("c"), path_label().alias("l")).collect()
    assert [(r.c, r.l) for r in got] == [(None, "a1"), (None, "a2"), ("", "a3"), ("N12", "N12")]


def test_altitude_bands_place_edges(spark):
    rows = [(_t("2025-12-01 00:00:00"), float(i), "a1", "F", 1.0, 1.0, a, 1.0, 1.0, "A1", -1.0, 1, "h.json")
            for i, a in enumerate(["-50", "40000", "39999.0", "ground", "abc", None])]
    b = {r.altitude_range: r["count"] for r in R.altitude_bands(_obs(spark, rows)).collect()}
    assert b == {"< 5,000 ft": 1, "> 40,000 ft": 1, "30,000-40,000 ft": 1}
    g = {r.altitude_range: r.observations for r in R.altitude_bands_ground(_obs(spark, rows)).collect()}
    assert g == {"0-5k ft": 1, "40k+ ft": 2, "30k-40k ft": 1, "Ground": 1}   # junk text falls in the top band


def test_registry_edges_non_icao_and_critical_care(spark):
    o = _obs(spark, [(_t("2025-12-01 00:00:00"), 1.0, "~2a0001", "MED1", 1.0, 1.0, "500", 1.0, 1.0, None, -1.0, 1, "h"),
                     (_t("2025-12-01 00:00:01"), 2.0, "a00001", "MED1", 1.0, 1.0, "500", 1.0, 1.0, None, -1.0, 1, "h"),
                     (_t("2025-12-01 00:00:02"), 3.0, "a00002", "", 1.0, 1.0, "500", 1.0, 1.0, None, -1.0, 1, "h")])
    af = spark.createDataFrame([("a00001", "N1", "EC35", "1850", "Airbus", "EC135", "North Critical Care Inc", "H2T", False),
                                ("a00002", "N2", "C172", "19xx", "Cessna", "172", None, "L1P", False)],
                               "icao string, registration string, icao_type string, manufacture_year string, "
                               "manufacturer string, model string, owner_operator string, short_type string, military boolean")
    m = E.match_rate(o, af).first()
    assert (m.total_observed, m.matched, m.match_pct) == (3, 2, 66.67)
    assert [r.hex for r in E.medical_fleet(o, af).collect()] == ["a00001"]
    assert E.age_by_decade(o, af).count() == 0            # 1850 and 19xx are not plausible years
    c = E.age_completeness(o, af).first()
    assert (c.total_rows, c.with_year, c.without_year) == (3, 0, 3)


def test_append_new_with_pruned_target_and_daily_dates(spark):
    t = spark.createDataFrame([("a", 1.0, dt.date(2025, 1, 1)), ("b", 2.0, dt.date(2025, 1, 9))],
                              "hex string, observation_epoch double, capture_date date")
    b = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "x"), ("c", 3.0, "x")],
                              "hex string, observation_epoch double, source_file string")
    # with the target pruned to dates >= 2025-01-05 the old key 'a' is not consulted
    new = D.append_new(t, b, target_window=("capture_date", F.lit("2025-01-05").cast("date")))
    assert sorted(r.hex for r in new.collect()) == ["a", "c"]
    h = spark.createDataFrame([(_t("2025-01-01 10:00:00"), 1.0, "a", "x", _t("2025-01-01 11:00:00"), dt.date(2025, 1, 1)),
                               (_t("2025-01-01 10:00:00"), 1.0, "a", "x", _t("2025-01-01 12:00:00"), dt.date(2025, 1, 1)),
                               (_t("2025-01-02 10:00:00"), 2.0, "a", "x", _t("2025-01-02 11:00:00"), dt.date(2025, 1, 2))],
                              "observation_time timestamp_ntz, observation_epoch double, hex string, source_file string, "
                              "capture_ts timestamp_ntz, capture_date date")
    d = L.daily_level(h, dates=[dt.date(2025, 1, 1)]).collect()
    assert len(d) == 1 and d[0].capture_ts == _t("2025-01-01 11:00:00")


def test_weather_edges(spark):
    objs = spark.createDataFrame([
        ("wx/2024-01-01_metar.txt", "METAR A T01231045\nMETAR B T10051002\nno group\n"),
        ("wx/2024-01-02_metar.txt", "API endpoint has moved\nMETAR T00101000"),
        ("wx/2023-11-30_geo.json", '{"features":[{"properties":{"temp":3}},{"properties":{}}]}'),
        ("wx/2023-12-01_geo.json", '{"features":[{"properties":{"temp":4}}]}'),         # after GeoJSON era
        ("wx/2026-03-13T12:15.json", '{"temp_c": 1.5}'),
        ("wx/2026-03-14T12:15.json", "garbage"),
        ("wx/2025-10-01_metar.txt", "METAR T01000000"),                                  # gap
        ("wx/readme.txt", "T01000000"),                                                  # no date
    ], "name string, content string")
    temps = sorted((r.name, r.temp_c) for r in W.all_temps(objs).collect())
    assert temps == [("wx/2023-11-30_geo.json", 3.0), ("wx/2024-01-01_metar.txt", -0.5),
                     ("wx/2024-01-01_metar.txt", 12.3), ("wx/2026-03-13T12:15.json", 1.5)]
    routes = {r.route: r.objects for r in W.route_counts(W.weather_route(objs)).collect()}
    assert routes["gap"] == 1 and routes["no-date"] == 1 and routes["other"] == 1
    wk = {r.week_ending: (r.avg_temp_c, r.avg_temp_f) for r in W.weather_weekly(W.all_temps(objs)).collect()}
    assert wk[dt.date(2024, 1, 7)] == (5.9, 42.6)                 # mean 5.9 -> 42.62 F -> 42.6
    ties = spark.createDataFrame([(dt.date(2024, 1, 1), 0.125), (dt.date(2024, 1, 1), 0.125),
                                  (dt.date(2024, 1, 8), 0.135)], "obs_date date, temp_c double")
    t = {r.week_ending: r.avg_temp_c for r in W.weather_weekly(ties).collect()}
    assert t == {dt.date(2024, 1, 7): 0.12, dt.date(2024, 1, 14): 0.14}   # half to even, exact


def test_refresh_table(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    name = "vantage_refresh_test"
    try:
        sinks.refresh_table(df, name)
        sinks.refresh_table(df.union(df), name)
        assert spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_log_health_tail_and_age(spark):
    from vantage.operators import quality as Q
    logs = spark.createDataFrame([
        ("a.log", "ok\nok\nTraceback (most recent call last)\nok\nok\nok\n", _t("2025-01-01 10:00:00")),
        ("b.log", "ERROR early\nok\nok\nok\nok\nok\n", _t("2025-01-01 11:30:00")),
        ("c.log", "Error\r\nok", _t("2025-01-01 12:00:00")),
        ("d.log", "", _t("2025-01-01 12:00:00"))], "name string, content string, mtime timestamp_ntz")
    r = {x.name: x for x in Q.log_health(logs, "content", 5, "mtime", "2025-01-01 12:00:00").collect()}
    assert (r["a.log"].has_error, r["b.log"].has_error, r["c.log"].has_error, r["d.log"].has_error) == (True, False, True, False)
    assert (r["a.log"].n_lines, r["c.log"].n_lines, r["d.log"].n_lines) == (6, 2, 0)
    assert r["a.log"].age_hours == 2.0 and r["b.log"].age_hours == 0.5


def test_publish_plan_levels_and_retention(spark):
    from vantage.plans import publish as P
    files = spark.createDataFrame([
        ("flights_daily_2025-12-20.parquet", _t("2025-12-21 01:00:00")),
        ("flights_daily_2025-12-27.parquet", _t("2025-12-28 01:00:00")),
        ("flights_daily_2025-12-10.parquet", _t("2025-12-11 01:00:00")),
        ("flights_daily_bad.parquet", _t("2025-12-11 01:00:00"))], "name string, mtime timestamp_ntz")
    existing = spark.createDataFrame([("daily/flights_daily_2025-12-20.parquet",)], "object_name string")
    plan = {r.name: r.action for r in P.publish_plan(files, existing, "daily", 14, "2025-12-29").collect()}
    assert plan == {"flights_daily_2025-12-20.parquet": "skip-exists", "flights_daily_2025-12-27.parquet": "upload",
                    "flights_daily_2025-12-10.parquet": "outside-window", "flights_daily_bad.parquet": "unparsable"}
    weekly = spark.createDataFrame([("flights_weekly_ending_2025-12-21.parquet", _t("2025-12-22 02:00:00")),
                                    ("flights_weekly_ending_2025-12-28.parquet", _t("2025-12-29 02:00:00"))],
                                   "name string, mtime timestamp_ntz")
    none = spark.createDataFrame([], "object_name string")
    # today is Sunday 2025-12-28: the last completed week ends 2025-12-21
    wp = {r.name: r.action for r in P.publish_plan(weekly, none, "weekly", 1, "2025-12-28").collect()}
    assert wp == {"flights_weekly_ending_2025-12-21.parquet": "upload",
                  "flights_weekly_ending_2025-12-28.parquet": "outside-window"}
    old = [r.name for r in P.retention_candidates(files, "2025-12-29 00:00:00", 7).collect()]
    assert sorted(old) == ["flights_daily_2025-12-10.parquet", "flights_daily_2025-12-20.parquet", "flights_daily_bad.parquet"]
