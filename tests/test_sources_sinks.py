"""File-level tests for sources and sinks."""

import json
import os

from pyspark.sql import functions as F

from vantage import sinks
from vantage.sources import levels as S
from vantage.sources import snapshots as SN
from vantage.sources import stats as ST


def _write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def _snapshot(now, aircraft):
    return json.dumps({"now": now, "messages": 1000, "aircraft": aircraft}, indent=1)


def test_read_and_flatten_snapshots(spark, tmpdir_path):
    d = f"{tmpdir_path}/raw"
    _write(f"{d}/aircraft.json", _snapshot(1766000000.5, [
        {"hex": "a1b2c3", "flight": "UPS123  ", "lat": 44.9, "lon": -93.2, "alt_baro": 27975, "gs": 420.5,
         "track": 90.1, "nav_modes": ["autopilot", "tcas"], "rssi": -20.1, "messages": 55, "mlat": [], "tisb": []},
        {"hex": "~2a0001", "flight": "   ", "alt_baro": "ground", "rssi": -30.0, "messages": 3},
        {"hex": "a00003", "flight": "", "lat": 44.0, "rssi": -25.0, "messages": 7},
    ]))
    _write(f"{d}/history_17.json", _snapshot(1765999970.0, [{"hex": "a1b2c3", "rssi": -21.0, "messages": 50}]))
    rows = SN.flatten(SN.read_snapshots(spark, f"{d}/*.json")).orderBy("observation_epoch", "hex").collect()
    assert len(rows) == 4
    first = rows[0]
    assert first.source_file == "history_17.json" and first.flight is None
    by_hex = {r.hex: r for r in rows[1:]}
    assert by_hex["a1b2c3"].flight == "UPS123"               # stripped
    assert by_hex["a1b2c3"].alt_baro == "27975"               # number read as text
    assert by_hex["a1b2c3"].nav_modes == "autopilot,tcas"     # list -> CSV
    assert by_hex["~2a0001"].flight == ""                     # all blank -> ''
    assert by_hex["~2a0001"].alt_baro == "ground"
    assert by_hex["a00003"].flight is None                    # '' -> NULL
    assert by_hex["a00003"].lon is None                       # missing -> NULL
    assert str(first.observation_time) == "2025-12-17 19:32:50"


def test_malformed_snapshot_gives_no_rows(spark, tmpdir_path):
    d = f"{tmpdir_path}/raw"
    _write(f"{d}/history_1.json", "{not json")
    _write(f"{d}/history_2.json", _snapshot(1766000000.0, [{"hex": "abc123", "rssi": -1.0}]))
    rows = SN.flatten(SN.read_snapshots(spark, f"{d}/*.json")).collect()
    assert [r.hex for r in rows] == ["abc123"]


def test_receiver_stats_skip_missing_periods(spark, tmpdir_path):
    doc = {"latest": {"start": 10.0, "end": 70.0, "local": {"modes": 5, "accepted": [3, 4], "signal": -9.5},
                      "messages": 12, "tracks": {"all": 2}},
           "total": {"start": 0.0, "end": 70.0, "local": {}, "messages": 99, "tracks": {"all": 7}}}
    _write(f"{tmpdir_path}/stats.json", json.dumps(doc, indent=2))
    rows = {r.period: r for r in ST.read_receiver_stats(spark, f"{tmpdir_path}/stats.json").collect()}
    assert set(rows) == {"latest", "total"}
    assert (rows["latest"].accepted_0, rows["latest"].accepted_1, rows["latest"].modes) == (3, 4, 5)
    assert rows["total"].accepted_0 is None and rows["total"].messages == 99
    assert rows["latest"].source_file == "stats.json"


def test_read_airframes_ndjson(spark, tmpdir_path):
    lines = [{"icao": "a00001", "reg": "N1", "icaotype": "C172", "year": "1976", "manufacturer": "Cessna",
              "model": "172N", "ownop": "Someone", "faa_pia": False, "faa_ladd": False, "short_type": "L1P", "mil": False},
             {"icao": "a00002", "reg": None, "year": "19xx", "mil": True}]
    _write(f"{tmpdir_path}/af.json", "\n".join(json.dumps(x) for x in lines) + "\n")
    af = S.read_airframes(spark, f"{tmpdir_path}/af.json")
    assert af.columns[:4] == ["icao", "registration", "icao_type", "manufacture_year"]
    r = {x.icao: x for x in af.collect()}
    assert r["a00001"].owner_operator == "Someone" and r["a00002"].military is True


def test_drifted_parquet_union(spark, tmpdir_path):
    a = spark.createDataFrame([("a1", 1.0, 100.0)], "hex string, observation_epoch double, alt_baro double")
    b = spark.createDataFrame([("a2", 2.0, "ground", "A3")],
                              "hex string, observation_epoch double, alt_baro string, category string")
    a.write.parquet(f"{tmpdir_path}/h1.parquet")
    b.write.parquet(f"{tmpdir_path}/h2.parquet")
    u = S.read_drifted(spark, [f"{tmpdir_path}/h1.parquet", f"{tmpdir_path}/h2.parquet"])
    rows = {r.hex: r for r in u.collect()}
    assert rows["a1"].alt_baro == "100.0" and rows["a1"].category is None
    assert rows["a2"].alt_baro == "ground" and rows["a2"].category == "A3"


def test_write_level_dynamic_overwrite_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("a1", 1.0, "2024-01-01"), ("a2", 2.0, "2024-01-02")],
                               "hex string, observation_epoch double, d string").withColumn("capture_date", F.to_date("d")).drop("d")
    sinks.write_level(df, tmpdir_path, "daily")
    again = spark.createDataFrame([("a3", 3.0, "2024-01-02")], "hex string, observation_epoch double, d string") \
        .withColumn("capture_date", F.to_date("d")).drop("d")
    sinks.write_level(again, tmpdir_path, "daily")          # replaces only 2024-01-02
    back = S.read_level(spark, tmpdir_path, "daily")
    assert sorted(r.hex for r in back.collect()) == ["a1", "a3"]
    only = S.read_level(spark, tmpdir_path, "daily", dates=["2024-01-01"])
    assert [r.hex for r in only.collect()] == ["a1"]
    plan = only._jdf.queryExecution().executedPlan().toString()
    import re
    pf = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert pf and "capture_date" in pf.group(1), plan          # pruned at listing time, not filtered after the scan
    globbed = S.read_level(spark, tmpdir_path, "daily", pattern="capture_date=2024-01-0[12]")
    assert globbed.count() == 2
    sinks.publish(back, f"file://{tmpdir_path}/backup")
    assert spark.read.parquet(f"{tmpdir_path}/backup").count() == 2


def test_text_objects_replace_bad_bytes_and_listing(spark, tmpdir_path):
    _write(f"{tmpdir_path}/wx/2024-01-01_metar.txt", b"METAR KMSP T01231045 \xff\xfe\n".decode("latin-1"), "w")
    with open(f"{tmpdir_path}/wx/2024-01-02_metar.txt", "wb") as f:
        f.write(b"METAR T10051002\n\xff bad")
    objs = S.read_text_objects(spark, f"{tmpdir_path}/wx")
    assert objs.count() == 2
    assert all(isinstance(r.content, str) for r in objs.collect())
    listing = S.list_files(spark, f"{tmpdir_path}/wx", "*.txt").collect()
    assert sorted(r.name for r in listing) == ["2024-01-01_metar.txt", "2024-01-02_metar.txt"]
    assert all(r.size > 0 for r in listing)


def test_geojson_sink(spark, tmpdir_path):
    from vantage.operators import paths as PA
    from tests.conftest import SF_SMALL
    from vantage.sources import fixtures as fx
    feats = PA.geojson_features(fx.obs(spark, SF_SMALL))
    out = sinks.write_geojson(feats, f"{tmpdir_path}/paths.geojsonl")
    lines = spark.read.text(out).collect()
    assert len(lines) == feats.count()
    first = json.loads(lines[0].value)
    assert first["type"] == "Feature" and first["geometry"]["type"] in ("Point", "LineString")


def test_s3_options_from_environment():
    opts = S.s3_options({"S3_ENDPOINT": "http://store:9000", "S3_ACCESS_KEY": "k", "S3_SECRET_KEY": "s"})
    assert opts["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert opts["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert opts["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert "spark.hadoop.fs.s3a.access.key" not in S.s3_options({})


def test_level_jobs_end_to_end(spark, tmpdir_path):
    from vantage.plans import jobs
    from vantage.session import sizing_conf
    raw = f"{tmpdir_path}/raw"
    # two snapshots 30 s apart in one capture, a repeated aircraft (same key twice) in the next
    _write(f"{raw}/c1/aircraft.json", _snapshot(1766016000.0, [
        {"hex": "a1", "flight": "F1", "lat": 1.0, "lon": 2.0, "gs": 3.0, "track": 4.0, "rssi": -1.0},
        {"hex": "a2", "flight": "F2", "lat": 1.0, "rssi": -1.0}]))                  # incomplete
    _write(f"{raw}/c1/history_0.json", _snapshot(1766015970.0, [
        {"hex": "a1", "flight": "F1", "lat": 1.0, "lon": 2.0, "gs": 3.0, "track": 4.0, "rssi": -1.0}]))
    _write(f"{raw}/c2/history_0.json", _snapshot(1766016000.0, [
        {"hex": "a1", "flight": "F1", "lat": 1.0, "lon": 2.0, "gs": 3.0, "track": 4.0, "rssi": -1.0}]))
    root = f"{tmpdir_path}/levels"
    s1 = jobs.build_hourly(spark, f"{raw}/c1/*.json", root, "2025-12-18 00:59:00").collect()
    assert s1[0].total_records == 2
    jobs.build_hourly(spark, f"{raw}/c2/*.json", root, "2025-12-18 01:00:00")
    counts = jobs.build_daily(spark, root, ["2025-12-18"]).first()
    assert (counts.rows_before, counts.rows_after, counts.removed) == (3, 2, 1)
    jobs.build_daily(spark, root, ["2025-12-18"])                                      # rerun: idempotent
    assert S.read_level(spark, root, "daily").count() == 2
    wk = jobs.build_weekly(spark, root, ["2025-12-21"]).first()
    assert (wk.total_records, wk.files_used) == (2, 1)
    assert spark.read.parquet(f"{root}/weekly").count() == 2
    conf = sizing_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 400000


def test_one_date_is_written_by_several_tasks(spark, tmpdir_path):
    from vantage import sinks
    from vantage.sources import fixtures as fx
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    o = fx.obs(spark, "/root/testdata/sf0.01").withColumn("capture_date", F.lit("2024-01-01").cast("date"))
    o = o.union(o).union(o).union(o)                    # a day from several input tasks
    try:
        spark.conf.set(key, "64k")
        for write in (lambda: sinks.write_level(o, tmpdir_path, "hourly"), lambda: sinks.publish(o, tmpdir_path + "/out")):
            path = write()
            once = spark.read.parquet(path)
            n = once.select(F.input_file_name().alias("f")).distinct().count()
            assert n > 1 and once.count() == o.count()
            write()                                     # a rerun replaces the date
            assert spark.read.parquet(path).count() == o.count()
    finally:
        spark.conf.set(key, before)


def test_jobs_regenerate_backfill_publish_weather(spark, tmpdir_path):
    from vantage import sinks
    from vantage.plans import jobs
    from vantage.plans import levels as L
    from vantage.sources import fixtures as fx
    root = f"{tmpdir_path}/levels"
    hourly = L.hourly_level(fx.captures(spark, "/root/testdata/sf0.001")).where("capture_date between '2024-01-08' and '2024-01-14'")
    sinks.write_level(hourly, root, "hourly", ("capture_date", "capture_hour"))
    n_days = hourly.select("capture_date").distinct().count()
    jobs.build_daily(spark, root, ["2024-01-09"])
    plan = {str(r.date): r.action for r in jobs.regenerate(spark, root, "2024-01-07", "2024-01-14").collect()}
    assert plan["2024-01-07"] == "skip-no-input" and plan["2024-01-09"] == "skip-exists" and plan["2024-01-10"] == "regenerate"
    daily = spark.read.parquet(f"{root}/daily")
    assert daily.select("capture_date").distinct().count() == n_days
    assert daily.count() == L.daily_level(hourly).count()
    assert {r.action for r in jobs.regenerate(spark, root, "2024-01-08", "2024-01-14", force=True).collect()} == {"regenerate"}
    daily = spark.read.parquet(f"{root}/daily")
    week = jobs.backfill(spark, root, "2024-01-10", "2024-01-12").collect()
    assert [str(r.week_ending) for r in week] == ["2024-01-14"] and week[0].total_records == daily.count()
    out = f"{tmpdir_path}/remote"
    plan = jobs.publish(spark, root, out, "daily", 3, "2024-01-13").collect()
    assert sorted(str(r.file_date) for r in plan if r.action == "upload") == ["2024-01-10", "2024-01-11", "2024-01-12"]
    sent = spark.read.parquet(f"{out}/daily")
    assert sent.count() == daily.where("capture_date between '2024-01-10' and '2024-01-12'").count()
    jobs.publish(spark, root, out, "weekly", 2, "2024-01-16")
    assert spark.read.parquet(f"{out}/weekly").count() == daily.count()
    _write(f"{tmpdir_path}/wx/2023-01-02_geo.json", '{"features":[{"properties":{"temp":"12.5"}},{"properties":{"temp":7.5}},{"properties":{"temp":"x"}}]}', "w")
    _write(f"{tmpdir_path}/wx/2023-13-45_metar.txt", "METAR T01231045", "w")
    routes = {r.route: (r.objects, r.processed, r.errors) for r in jobs.build_weather(spark, f"{tmpdir_path}/wx", root).collect()}
    assert routes == {"geojson": (1, 1, 0), "bad-date": (1, 0, 1)}
    assert [(r.avg_temp_c, r.obs_count) for r in spark.read.parquet(f"{root}/weather_weekly").collect()] == [(10.0, 2)]


def test_drift_is_cast_leniently_and_counted(spark, tmpdir_path):
    bad = spark.createDataFrame([("a1", "12.5"), ("a2", "fast"), ("a3", None)], "hex string, gs string")
    good = spark.createDataFrame([("a4", 3.0)], "hex string, gs double")
    bad.write.parquet(f"{tmpdir_path}/x.parquet")
    good.write.parquet(f"{tmpdir_path}/y.parquet")
    u = S.read_drifted(spark, [f"{tmpdir_path}/x.parquet", f"{tmpdir_path}/y.parquet"])
    assert sorted((r.hex, r.gs) for r in u.collect() if r.gs is not None) == [("a1", 12.5), ("a4", 3.0)] and u.count() == 4
    assert [tuple(r) for r in S.cast_rejects(bad).collect()] == [("gs", 1)]
    assert S.cast_rejects(good).count() == 0


def test_unreadable_snapshots_are_counted(spark, tmpdir_path):
    from vantage.sources import snapshots as SN
    _write(f"{tmpdir_path}/s/a.json", '{"now": 1.0, "aircraft": [{"hex": "a1"}]}', "w")
    _write(f"{tmpdir_path}/s/b.json", '{"now": 1.0, "aircr', "w")
    read = SN.read_snapshots(spark, f"{tmpdir_path}/s/*.json")
    assert tuple(SN.rejected_snapshots(read).first()) == (2, 1)
    assert SN.flatten(read).count() == 1
