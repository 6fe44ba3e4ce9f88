"""Properties of the pipeline operators (the reference's golden-number cross-checks, as tests)."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vantage.operators import dedup as D
from vantage.operators import paths as PA
from vantage.operators import reports as R
from vantage.plans import levels as L
from vantage.sources import fixtures as fx


def test_dedup_idempotent_and_removes_overlap(spark):
    h = L.hourly_level(fx.captures(spark, SF_SMALL))
    d1 = L.daily_level(h)
    d2 = L.daily_level(d1)
    assert d1.count() == d2.count()
    assert d1.groupBy("capture_date", "hex", "observation_epoch").count().where("count > 1").count() == 0
    # dedup(overlap(x)) == x for rows captured twice on the same date
    o = R.complete_only(fx.obs(spark, SF_SMALL))
    both = D.dedup(o.unionByName(o), D.OBS_KEY, ("observation_time",))
    assert both.count() == o.count()


def test_weekly_union_all_equals_sum_of_days(spark):
    d = L.daily_level(L.hourly_level(fx.captures(spark, SF_SMALL)))
    w = L.weekly_rollup(d)
    assert w.agg(F.sum("total_records")).first()[0] == d.count()
    dedup_w = L.weekly_level(d, dedup=True)
    assert dedup_w.count() <= d.count()


def test_band_counts_sum_to_numeric_altitudes(spark):
    o = fx.obs(spark, SF_SMALL)
    bands = R.altitude_bands(o).agg(F.sum("count")).first()[0]
    numeric = o.where((F.col("alt_baro") != "ground") & F.round(F.col("alt_baro").try_cast("double")).isNotNull()).count()
    assert bands == numeric
    g = R.altitude_bands_ground(o)
    assert abs(g.agg(F.sum("percentage")).first()[0] - 100.0) < 0.5


def test_segments_are_points_minus_paths(spark):
    o = fx.obs(spark, SF_SMALL)
    t = PA.path_totals(o).first()
    assert PA.path_segments(o).count() == t.points - t.paths
    # sequence numbers are 1..n per path, whatever the bucket size
    for b in (60, 3600, 10 ** 9):
        p = PA.flight_paths(o, bucket_seconds=b)
        chk = p.groupBy("hex", "flight").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count(F.lit(1)).alias("n"))
        assert chk.where("lo != 1 OR hi != n").count() == 0
        assert PA.path_segments(o, bucket_seconds=b).count() == t.points - t.paths


def test_equal_times_have_one_order(spark):
    """Ties, NULL epochs and NULL times: every point is entered once and left once, whatever the bucket size."""
    rows = [("a", "F1", None if t is None else f"2024-01-01 00:00:0{t}", e, f"s{k}", float(k), 1.0)
            for k, (t, e) in enumerate([(0, 0.0), (1, None), (2, 2.0), (2, 2.0), (2, None), (5, 5.0), (None, 6.0), (None, None)])]
    o = spark.createDataFrame(rows, "hex string, flight string, t string, observation_epoch double, source_file string, lat double, lon double") \
        .withColumn("observation_time", F.col("t").cast("timestamp_ntz")) \
        .withColumns({c: F.lit(None).cast("double") for c in ("gs", "track", "rssi")}).withColumn("alt_baro", F.lit("100"))
    for b in (1, 60, 10 ** 6):
        p = [r.lat for r in PA.flight_paths(o, 5, b).orderBy("seq").collect()]
        assert p == [0.0, 1.0, 4.0, 2.0, 3.0, 5.0, 7.0, 6.0]
        s = PA.path_segments(o, 5, b).orderBy("seq").collect()
        assert [(r.from_lat, r.to_lat) for r in s] == list(zip(p, p[1:]))
    e = PA.path_endpoints(o).first()
    assert (e.start_lat, e.end_lat) == (0.0, 6.0)


def test_single_points_are_no_path(spark):
    o = fx.obs(spark, SF_SMALL)
    assert PA.flight_paths(o, 1).groupBy("hex", "flight").count().where("count < 2").count() == 0


def test_ages_round_half_up_and_averages_keep_nan(spark):
    from vantage.functions.columns import avg_half_up
    from vantage.operators import reports as R
    ages = spark.createDataFrame([(27,), (27,), (27,), (28,), (None,)], "a int")
    assert ages.agg(avg_half_up("a").alias("x")).first().x == 27.3      # 27.25
    assert ages.where("a is null").agg(avg_half_up("a").alias("x")).first().x is None
    assert spark.createDataFrame([(-27,), (-27,), (-27,), (-28,)], "a int").agg(avg_half_up("a").alias("x")).first().x == -27.3
    nan = spark.createDataFrame([(float("nan"), 1), (1.0, 3)], "rssi double, messages long")
    r = R.signal_stats(nan).first()
    assert r.avg_rssi != r.avg_rssi and r.avg_messages == 2.0


def test_coverage_just_under_half_fails(spark):
    from vantage.operators import quality as Q
    rows = [(f"a{k}", float(k), "2024-01-01 00:00:00", 1.0 if k < 49_999 else None, 1.0, "1") for k in range(100_000)]
    o = spark.createDataFrame(rows, "hex string, observation_epoch double, t string, lat double, lon double, alt_baro string") \
        .withColumn("observation_time", F.col("t").cast("timestamp_ntz"))
    r = {x["check"]: x.status for x in Q.validation_report(o, "2024-01-02 00:00:00").collect()}
    assert r["position_coverage_pct"] == "FAIL"


def test_segments_follow_time_order(spark):
    o = fx.obs(spark, SF_SMALL)
    s = PA.path_segments(o, bucket_seconds=60)
    assert s.where(F.col("to_time") < F.col("from_time")).count() == 0


def test_keyed_append_rejects_null_keys_and_is_idempotent(spark):
    batch = spark.createDataFrame([("a", 1.0, "f1"), ("a", 1.0, "f0"), (None, 2.0, "f1"), ("b", 3.0, "f2")],
                                  "hex string, observation_epoch double, source_file string")
    target = spark.createDataFrame([("b", 3.0, "old")], "hex string, observation_epoch double, source_file string")
    new = D.append_new(target, batch).collect()
    assert [(r.hex, r.source_file) for r in new] == [("a", "f0")]
    merged = target.unionByName(D.append_new(target, batch))
    assert D.append_new(merged, batch).count() == 0


def test_percentages_sum_to_100(spark):
    from vantage.operators import enrich as E
    o, af = fx.obs(spark, SF_SMALL), fx.airframes(spark, SF_SMALL)
    for df, c in ((E.age_by_decade(o, af), "percentage"), (E.size_distribution(o, af), "pct"),
                  (R.category_share(o, 100), "percentage")):
        assert abs(df.agg(F.sum(c)).first()[0] - 100.0) < 0.1


def test_broadcast_only_behind_size_check(spark):
    from vantage.operators import enrich as E
    af = fx.airframes(spark, SF_SMALL)
    assert E.estimated_size(af) is not None
    small = E.maybe_broadcast(af, limit=10 ** 12)
    big = E.maybe_broadcast(af, limit=1)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()
