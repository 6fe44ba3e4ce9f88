"""Streaming upsert (R4) and the driver entry point."""

import os
import sys

from pyspark.sql import functions as F

from tests.conftest import ROOT, SF_SMALL
from vantage.operators import reports as R
from vantage.operators.keyed import KeyedStore
from vantage.sources import fixtures as fx
from vantage.streaming import stream as ST


def test_foreach_batch_upsert_is_idempotent(spark, tmpdir_path):
    src = f"{tmpdir_path}/landing"
    o = fx.obs(spark, SF_SMALL).drop("event_id")
    o.where(F.col("observation_epoch") % 2 < 1).write.parquet(f"{src}/part1")
    o.write.parquet(f"{src}/part2")            # re-delivers the first part
    table = f"{tmpdir_path}/table"
    stream = spark.readStream.schema(o.schema).option("recursiveFileLookup", "true").parquet(src)
    ST.upsert_batches(stream, table, f"{tmpdir_path}/c1")
    out = KeyedStore(spark, table).rows()
    assert out.columns == o.columns and out.count() == o.count()
    assert out.groupBy("hex", "observation_epoch").count().where("count > 1").count() == 0
    # a second run over the same files (new checkpoint = replay) appends nothing
    ST.upsert_batches(spark.readStream.schema(o.schema).option("recursiveFileLookup", "true").parquet(src), table, f"{tmpdir_path}/c2")
    assert spark.read.parquet(table).count() == o.count()
    counts = ST.batch_counts(spark, table).collect()
    assert [(r.rejected, r.appended) for r in counts] == [(0, 0)] and counts[0].read == counts[0].repeated


def test_null_keys_are_rejected_in_the_first_batch_too(spark, tmpdir_path):
    rows = [("a", 1.0, "f"), (None, 1.0, "f"), ("b", None, "f"), ("a", 1.0, "g")]
    src = f"{tmpdir_path}/in"
    spark.createDataFrame(rows, "hex string, observation_epoch double, source_file string").write.parquet(src)
    ST.upsert_batches(ST.read_stream(spark, src), f"{tmpdir_path}/t", f"{tmpdir_path}/c")
    store = KeyedStore(spark, f"{tmpdir_path}/t")
    assert [tuple(r) for r in store.rows().collect()] == [("a", 1.0, "f")]
    assert sorted(r.missing_part for r in store.rejects().collect()) == ["hex", "observation_epoch"]
    assert [tuple(r) for r in ST.batch_counts(spark, f"{tmpdir_path}/t").collect()] == [(0, 4, 2, 1, 1)]


def test_redelivery_after_the_state_is_gone_and_late_rows(spark, tmpdir_path):
    """One file per batch: what the stream's state has forgotten is found in the stored table, also by
    a run that starts with a new checkpoint; rows behind the watermark are counted."""
    src, table = f"{tmpdir_path}/in", f"{tmpdir_path}/table"

    def land(n, rows):
        (spark.createDataFrame([(h, 1e6 + t, f"f{n}") for h, t in rows], "hex string, observation_epoch double, source_file string")
         .coalesce(1).write.mode("append").parquet(src))

    def run(point):
        ST.run_deduplicated(ST.read_stream(spark, src, max_files=1), table, f"{tmpdir_path}/{point}")
        return sorted((r.hex, r.observation_epoch - 1e6, r.source_file) for r in KeyedStore(spark, table).rows().collect())

    land(0, [("a", 0), ("b", 10), ("a", 0)])
    assert run("p") == [("a", 0.0, "f0"), ("b", 10.0, "f0")]
    land(1, [("c", 2e6), ("a", 0)])
    assert run("p") == [("a", 0.0, "f0"), ("b", 10.0, "f0"), ("c", 2e6, "f1")]
    land(2, [("a", 0), ("d", 2e6)])                 # 20 days late, state gone
    want = [("a", 0.0, "f0"), ("b", 10.0, "f0"), ("c", 2e6, "f1"), ("d", 2e6, "f2")]
    assert run("p") == want
    assert sum(r.late for r in ST.late_rows(spark, table).collect()) == 1
    assert run("other") == want                     # everything delivered again


def test_capture_counts_per_batch(spark, tmpdir_path):
    import json
    from vantage.sources import snapshots as SN
    land, sink = f"{tmpdir_path}/landing", f"{tmpdir_path}/out"
    os.makedirs(land)
    whole = {"hex": "a1", "lat": 1.0, "lon": 2.0, "gs": 3.0, "track": 4.0, "rssi": -1.0}
    docs = [json.dumps({"now": 1.0, "aircraft": [whole, {"hex": "a2", "rssi": -2.0}]}), "{broken",
            json.dumps({"now": 2.0, "aircraft": [whole]})]
    for k, text in enumerate(docs):
        with open(f"{land}/{k}.txt", "w") as f:
            f.write(text)
    stream = (spark.readStream.option("wholetext", "true").option("maxFilesPerTrigger", 1).text(land)
              .select(F.col("value").alias("doc"), F.col("_metadata.file_name").alias("source_file")))
    ST.run_capture(SN.parse_snapshot_text(stream), sink, f"{tmpdir_path}/point")
    counts = sorted(tuple(r)[1:] for r in ST.capture_counts(spark, sink).collect())
    assert counts == [(1, 0, 1, 0, 1), (1, 0, 2, 1, 1), (1, 1, 0, 0, 0)]
    assert sorted(r.observation_epoch for r in spark.read.parquet(sink).collect()) == [1.0, 2.0]


def test_all_grains_come_from_one_stream_of_hours(spark):
    from vantage.plans.catalog import load_all
    plan = load_all()[0]["stream_tumbling"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_keys_take_a_table_stored_as_a_folder(spark, tmpdir_path):
    from tests.oracle_compare import compare, duck
    from vantage.plans.catalog import load_all
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(f"{tmpdir_path}/events.parquet")
    queries, oracle = load_all()
    for key in ("stream_capture", "stream_dedup", "stream_tumbling"):
        got = queries[key](spark, tmpdir_path)
        con = duck(SF_SMALL)
        assert compare(spark, key, lambda *_, got=got: got, oracle[key], SF_SMALL, con)["status"] == "ok", key


def test_watermark_acts_over_batches_and_a_restart_resumes(spark, tmpdir_path):
    """One file per batch.  A repeat within two hours is dropped; once the watermark has
    passed a key, its state is gone.  A second start with the same folders reads new files only."""
    src, sink, point = (f"{tmpdir_path}/{x}" for x in ("in", "out", "point"))

    def land(n, rows):
        (spark.createDataFrame([(h, 1e6 + t, n) for h, t in rows], "hex string, observation_epoch double, n int")
         .coalesce(1).write.mode("append").parquet(src))

    def run():
        stream = ST.read_stream(spark, src, max_files=1)
        ST.run_append(ST.stream_dedup(stream).drop("event_ts"), sink, point)
        return sorted((r.hex, r.observation_epoch - 1e6, r.n) for r in spark.read.parquet(sink).collect())

    land(0, [("a", 0), ("b", 10)])
    assert run() == [("a", 0.0, 0), ("b", 10.0, 0)]
    land(1, [("a", 0), ("c", 20_000)])             # a repeat; the watermark then passes 12,800
    assert run() == [("a", 0.0, 0), ("b", 10.0, 0), ("c", 20000.0, 1)]
    land(2, [("d", 100), ("c", 20_000), ("e", 19_000)])     # too late; a repeat; late but inside
    assert run() == [("a", 0.0, 0), ("b", 10.0, 0), ("c", 20000.0, 1), ("e", 19000.0, 2)]
    assert run() == [("a", 0.0, 0), ("b", 10.0, 0), ("c", 20000.0, 1), ("e", 19000.0, 2)]


def test_windows_are_updated_over_batches(spark, tmpdir_path):
    src, sink, point = (f"{tmpdir_path}/{x}" for x in ("in", "out", "point"))
    for n, epochs in enumerate([[0, 10, 3600], [20, 3700, 7200]]):
        spark.createDataFrame([(float(e),) for e in epochs], "observation_epoch double").coalesce(1).write.mode("append").parquet(src)
        ST.run_update(ST.stream_tumbling(ST.read_stream(spark, src, max_files=1), "hour"), sink, point)
    now = ST.latest(spark.read.parquet(sink), ["window_start", "window_end"], ["observations"])
    assert sorted(r.observations for r in now.collect()) == [1, 2, 3]


def test_cluster_without_shared_folder_is_refused():
    import pytest
    from vantage.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError):
        shared_dir(Session(), "x")


def test_stream_equals_batch(spark, tmpdir_path):
    o = ST.read_stream(spark, f"{SF_SMALL}/events.parque[t]")
    out = ST.run_append(ST.stream_capture(fx.obs_from_events(o)), f"{tmpdir_path}/out", f"{tmpdir_path}/point")
    assert spark.read.parquet(out).count() == R.complete_only(fx.obs(spark, SF_SMALL)).count()


def test_entry_smoke(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) >= 0
    assert df.columns == ["decade_label", "unique_aircraft", "total_observations", "percentage",
                          "earliest_year", "latest_year", "avg_age"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_snapshot_file_stream_equals_batch(spark, tmpdir_path):
    import json
    from vantage.sources import snapshots as SN
    land = f"{tmpdir_path}/landing"
    for cap, now in (("capture=1", 1766016000.0), ("capture=2", 1766016030.0)):
        os.makedirs(f"{land}/{cap}")
        with open(f"{land}/{cap}/history_{cap[-1]}.json", "w") as f:
            json.dump({"now": now, "messages": 1, "aircraft": [
                {"hex": "a1", "flight": "F1 ", "lat": 1.0, "lon": 2.0, "gs": 3.0, "track": 4.0, "rssi": -1.0},
                {"hex": "a2", "lat": 1.0, "rssi": -2.0}]}, f, indent=1)
    out = ST.run_append(ST.stream_capture(ST.snapshot_stream(spark, land, max_files=1)), f"{tmpdir_path}/out", f"{tmpdir_path}/point")
    got = sorted((r.hex, r.observation_epoch, r.flight, r.source_file) for r in spark.read.parquet(out).collect())
    batch = R.complete_only(SN.flatten(SN.read_snapshots(spark, f"{land}/*/*.json")))
    want = sorted((r.hex, r.observation_epoch, r.flight, r.source_file) for r in batch.collect())
    assert got == want == [("a1", 1766016000.0, "F1", "history_1.json"), ("a1", 1766016030.0, "F1", "history_2.json")]
