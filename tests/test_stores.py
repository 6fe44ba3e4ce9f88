"""Keyed tables, drifted inputs over any file system, listings, refreshes, metadata and sketches."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vantage import sinks
from vantage.operators import sketches as SK
from vantage.operators import weather as W
from vantage.operators.keyed import KeyedStore
from vantage.sources import fixtures as fx
from vantage.sources import levels as S

OBS = "hex string, observation_epoch double, source_file string"


def _rows(store):
    return sorted(tuple(r) for r in store.rows().collect())


# -- keyed tables ------------------------------------------------------------------------------

def test_keyed_table_inserts_or_ignores(spark, tmpdir_path):
    df = lambda rows: spark.createDataFrame(rows, OBS)
    store = KeyedStore(spark, f"{tmpdir_path}/t", df([]).schema, buckets=3)
    first = df([("a", 1.0, "g"), ("a", 1.0, "f"), ("a", 90000.0, "f"), (None, 1.0, "x"), ("b", None, "x"), (None, None, "x")])
    assert store.append(first, batch_id="1") == {"read": 6, "rejected": 3, "repeated": 1, "appended": 2}
    assert _rows(store) == [("a", 1.0, "f"), ("a", 90000.0, "f")]
    assert store.append(first, batch_id="1") == {"read": 6, "rejected": 3, "repeated": 3, "appended": 0}
    assert sorted((r.missing_part, r.batch_id) for r in store.rejects().collect()) == [
        ("hex", "1"), ("hex", "1"), ("observation_epoch", "1")]
    assert store.append(df([]), batch_id="2") == {"read": 0, "rejected": 0, "repeated": 0, "appended": 0}
    more = df([("a", 1.0, "z"), ("1:a", 1.0, "z"), ("a", 1.5, "z")])
    assert sorted(tuple(r) for r in store.new_rows(more).collect()) == [("1:a", 1.0, "z"), ("a", 1.5, "z")]


def test_keyed_table_is_reopened_with_its_own_settings(spark, tmpdir_path):
    o = fx.obs(spark, SF_SMALL)
    store = KeyedStore(spark, f"{tmpdir_path}/t", o.schema, buckets=5)
    store.append(o)
    n = store.rows().count()
    store.close()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")
        again = KeyedStore(spark, f"{tmpdir_path}/t", buckets=11)
        assert again.buckets == 5 and again.append(o)["appended"] == 0 and again.rows().count() == n
    finally:
        spark.conf.set(key, before)
    with pytest.raises(ValueError):
        KeyedStore(spark, f"{tmpdir_path}/nothing")


def test_keyed_append_reads_the_batch_s_periods_only(spark, tmpdir_path, monkeypatch):
    from vantage.operators import keyed
    rows = [(f"h{k}", 86400.0 * k + 5, "f") for k in range(30)]
    store = KeyedStore(spark, f"{tmpdir_path}/t", spark.createDataFrame(rows, OBS).schema, buckets=2)
    store.append(spark.createDataFrame(rows, OBS))
    batch = spark.createDataFrame([("h7", 86400.0 * 7 + 5, "g"), ("new", 86400.0 * 8, "g")], OBS)
    for listed in (1000, 1):        # the periods one by one, or their range
        monkeypatch.setattr(keyed, "LISTED_PERIODS", listed)
        new = store.new_rows(batch)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryFileIndex(2 paths)" in plan, plan
        assert [r.hex for r in new.collect()] == ["new"]


# -- drift and listings ------------------------------------------------------------------------

@pytest.fixture()
def lake(spark, tmpdir_path):
    """A folder under a scheme that only Hadoop's file systems know."""
    name = os.path.basename(tmpdir_path).replace("_", "").lower()
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{tmpdir_path}")
    return f"viewfs://{name}/data", tmpdir_path


def test_drift_inside_a_folder_over_a_hadoop_scheme(spark, lake):
    uri, path = lake
    for k in range(7):
        kind = "double" if k in (3, 4) else "string"
        more = [F.lit("A1").alias("category")] if k > 5 else []
        (spark.range(2).select(F.concat(F.lit(f"a{k}"), F.col("id").cast("string")).alias("hex"), F.lit(k * 1.0).alias("observation_epoch"),
                               F.lit(100.0).cast(kind).alias("alt_baro"), *more)
         .coalesce(1).write.parquet(f"{path}/mix/capture_date=2024-01-0{k + 1}"))
    groups = S.schema_groups(spark, [f"{uri}/mix"])
    assert sorted(len(files) for _, files, _ in groups) == [2, 5]
    u = S.read_drifted(spark, [f"{uri}/mix"])
    rows = {r.hex: r for r in u.collect()}
    assert len(rows) == 14 and all(r.alt_baro == "100.0" for r in rows.values())
    assert rows["a60"].category == "A1" and rows["a30"].category is None
    assert str(rows["a40"].capture_date) == "2024-01-05"
    assert len(S.schema_groups(spark, [f"{uri}/mix/capture_date=2024-01-01", f"{uri}/mix/capture_date=2024-01-07"])) == 1


def test_listing_in_shares_equals_one_listing(spark, lake):
    uri, path = lake
    for k in range(5):
        os.makedirs(f"{path}/day={k}/deep")
        for name, size in ((f"day={k}/a.txt", k), (f"day={k}/deep/b.txt", 10 + k), (f"day={k}/c.log", 3)):
            with open(f"{path}/{name}", "w") as f:
                f.write("x" * size)
    with open(f"{path}/top.txt", "w") as f:
        f.write("xy")
    want = {os.path.relpath(os.path.join(r, n), path): (n, os.path.getsize(os.path.join(r, n)), int(os.path.getmtime(os.path.join(r, n))))
            for r, _, names in os.walk(path) for n in names if n.endswith(".txt")}
    for prefixes in (2, 1000):
        listed = S.list_tree(spark, uri, "*.txt", prefixes).withColumn("t", F.unix_seconds("mtime"))
        assert {r.path.split("/data/")[1]: (r.name, r.size, r.t) for r in listed.collect()} == want
    os.makedirs(f"{path}/empty")
    assert S.list_tree(spark, f"{uri}/empty").count() == 0


def test_one_large_metar_file_is_read_by_several_tasks(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/wx")
    lines = [f"METAR KMSP {k:06d} T{k % 2}{k % 400:03d}1045" if k % 3 else f"METAR KMSP {k:06d}" for k in range(40_000)]
    with open(f"{tmpdir_path}/wx/2024-01-01_metar.txt", "wb") as f:
        f.write("\n".join(lines[:20_000]).encode() + b"\r\n\xff\xfe T10011002 \r" + "\r\n".join(lines[20_000:]).encode())
    with open(f"{tmpdir_path}/wx/2024-01-02_metar.txt", "w") as f:
        f.write("\n".join([*lines[:30_000], "The API endpoint has moved to", *lines[:10]]))
    with open(f"{tmpdir_path}/wx/none.txt", "w") as f:
        f.write(lines[1])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "128k")
        read = S.read_lines(spark, f"{tmpdir_path}/wx")
        assert read.where(F.col("name").contains("2024-01-01")).select(F.spark_partition_id()).distinct().count() > 3
        by_line = W.metar_temps_by_line(read).select("obs_date", "temp_c").collect()
        whole = W.metar_temps(W.weather_route(S.read_text_objects(spark, f"{tmpdir_path}/wx"))).select("obs_date", "temp_c").collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(by_line) == sorted(whole) and len(whole) > 20_000


# -- refresh -----------------------------------------------------------------------------------

def test_readers_meet_the_old_or_the_new_table(spark, tmpdir_path):
    name, root = "refreshed_registry", f"{tmpdir_path}/versions"
    df = lambda v, n: spark.range(n).select("id", F.lit(v).alias("v"))
    sinks.refresh_table(df(1, 500), name, root)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            rows = spark.table(name).groupBy("v").count().collect()
            seen.add(tuple(sorted((r["v"], r["count"]) for r in rows)))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(2, 5):
            sinks.refresh_table(df(v, 500 * v), name, root, keep=3)
    finally:
        stop.set()
        reader.join()
    assert seen <= {((v, 500 * v),) for v in range(1, 5)} and seen
    running = spark.table(name)
    broken = df(9, 10).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.refresh_table(broken, name, root)
    assert spark.table(name).groupBy("v").count().collect()[0]["count"] == 2000
    sinks.refresh_table(spark.range(3).select(F.lit("other").alias("shape")), name, root)
    assert spark.table(name).columns == ["shape"] and running.count() == 2000      # its folder is kept
    spark.sql(f"DROP VIEW {name}")


def test_refresh_takes_the_place_of_a_plain_table(spark, tmpdir_path):
    spark.range(3).write.mode("overwrite").saveAsTable("plain_registry")
    sinks.refresh_table(spark.range(5), "plain_registry", f"{tmpdir_path}/v")
    assert spark.table("plain_registry").count() == 5
    spark.sql("DROP VIEW plain_registry")


# -- metadata and sketches ---------------------------------------------------------------------

def test_metadata_equals_the_rows(spark, tmpdir_path):
    o = fx.obs(spark, SF_SMALL).withColumn("capture_date", F.to_date("observation_time"))
    path = sinks.write_level(o, tmpdir_path, "daily")
    got = sorted(tuple(r) for r in S.level_metadata(spark, path).collect())
    want = o.groupBy("capture_date").agg(F.count(F.lit(1)), F.min("observation_epoch"), F.max("observation_epoch"))
    assert got == sorted(tuple(r) for r in want.collect())


def test_sketches_merge_to_what_one_sketch_says(spark, tmpdir_path):
    dates = [F.date_add(F.lit("2024-01-01").cast("date"), k) for k in range(14)]
    level = (spark.range(60_000).withColumn("capture_date", F.explode(F.array(*dates)))
             .where(F.pmod(F.xxhash64("id", "capture_date"), F.lit(4)) == 0)
             .select(F.col("id").cast("string").alias("hex"), "capture_date", F.col("capture_date").cast("timestamp_ntz").alias("observation_time")))
    SK.store_sketches(level.where("capture_date < '2024-01-10'"), tmpdir_path)
    SK.store_sketches(level.where("capture_date >= '2024-01-10'"), tmpdir_path)      # each build adds its dates
    SK.store_sketches(level.where("capture_date = '2024-01-03'"), tmpdir_path)       # a rebuilt date replaces its own
    sketches = SK.read_sketches(spark, tmpdir_path)
    assert sketches.count() == 14
    weeks = {str(r.week_ending): r for r in SK.weekly_summary(sketches).collect()}
    exact = {str(r.w): r for r in level.groupBy(F.next_day(F.date_sub("capture_date", 1), "Sun").alias("w"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hex").alias("d")).collect()}
    assert set(weeks) == set(exact) == {"2024-01-07", "2024-01-14"}
    for w, r in weeks.items():
        assert r.total_records == exact[w].n and r.dates == 7
        assert abs(r.approx_aircraft - exact[w].d) <= 4 * SK.standard_error() * exact[w].d
    part = SK.range_summary(sketches, "2024-01-02", "2024-01-05").first()
    true = level.where("capture_date between '2024-01-02' and '2024-01-05'").select("hex").distinct().count()
    assert part.dates == 4 and abs(part.approx_aircraft - true) <= 4 * SK.standard_error() * true
    assert SK.range_summary(sketches, "2030-01-01").first().dates == 0
