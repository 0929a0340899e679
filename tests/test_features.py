import math

import pytest
from pyspark.sql import functions as F

from beatline.operators.features import engineer_features
from beatline.operators.grouping import flow_summary, flow_totals, group_flows
from helpers import flow, frame


def feats(spark, rows, **kw):
    return {(r.src_ip, r.dst_ip, r.dst_port): r.asDict()
            for r in engineer_features(frame(spark, rows), **kw).collect()}


def one(spark, rows, **kw):
    out = feats(spark, rows, **kw)
    assert len(out) == 1
    return next(iter(out.values()))


def test_perfect_beacon(spark):
    f = one(spark, flow([60 * i for i in range(12)]))
    assert f["mean_interval"] == 60.0 and f["std_interval"] == 0.0
    assert f["interval_cov"] == 0.0 and f["interval_mad"] == 0.0
    assert f["autocorrelation_score"] == 0.0          # constant series (T7)
    assert f["payload_entropy"] == 0.0
    assert f["pct_connections_off_hours"] == 1.0
    assert f["session_duration"] == 660.0
    assert f["num_connections"] == 12 and f["num_unique_ports"] == 1


def test_simultaneous_records_cov_zero(spark):
    f = one(spark, flow([0.0] * 12))
    assert f["mean_interval"] == 0.0 and f["interval_cov"] == 0.0   # inf → 0 (T3)


def test_min_connections_boundary(spark):
    assert feats(spark, flow([60 * i for i in range(9)])) == {}
    assert len(feats(spark, flow([60 * i for i in range(10)]))) == 1


def test_short_series_autocorrelation(spark):
    f = one(spark, flow([0, 10, 30, 35, 80, 81, 200]), min_connections=2)
    assert f["autocorrelation_score"] == 0.0           # 6 deltas < 7


def test_two_sizes_entropy_is_one(spark):
    f = one(spark, flow([60 * i for i in range(10)], sizes=[100] * 5 + [200] * 5))
    assert f["payload_entropy"] == pytest.approx(1.0)


def test_null_received_counts_as_zero(spark):
    recv = [None if i % 2 else 100 for i in range(12)]
    f = one(spark, flow([60 * i for i in range(12)], recv=recv))
    assert f["mean_bytes"] == pytest.approx(250 + 50)


def test_null_times(spark):
    times = [60 * i for i in range(10)] + [None, None]
    f = one(spark, flow(times))
    assert f["num_connections"] == 12
    assert f["pct_connections_off_hours"] == pytest.approx(10 / 12)   # T6
    assert f["mean_interval"] == 60.0 and f["session_duration"] == 540.0


def test_null_key_dropped(spark):
    rows = flow([60 * i for i in range(12)], port=None)
    assert feats(spark, rows) == {}


def test_burst(spark):
    sizes = [50] * 10 + [8880]           # totals: 170 ×10 and 9000 with recv 120
    f = one(spark, flow([60 * i for i in range(11)], sizes=sizes))
    assert f["has_anomalous_burst"] == 1


def test_autocorrelation_matches_numpy(spark):
    import numpy as np
    t = np.cumsum([60, 61, 59, 90, 60, 61, 59, 90, 60, 61, 59, 90, 60])
    f = one(spark, flow([0.0] + [float(x) for x in t]))
    d = np.diff(np.concatenate([[0.0], t]))
    c = d - d.mean()
    full = np.correlate(c, c, "full") / (c ** 2).sum()
    mid = len(full) // 2
    assert f["autocorrelation_score"] == pytest.approx(max(abs(full[mid + k]) for k in range(1, 6)))


def test_hosts_per_destination(spark):
    rows = []
    for i in range(7):
        rows += flow([60 * j for j in range(10)], src=f"10.0.0.{i}", dst="8.8.8.8", start_id=100 * i)
    out = feats(spark, rows)
    assert {v["num_internal_hosts_contacting"] for v in out.values()} == {7}


def test_partitioning_does_not_change_features(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    rows = []
    for i in range(20):
        ts = np.cumsum(rng.exponential(30, size=25)).tolist()
        rows += flow(ts, sizes=rng.integers(50, 500, size=25).tolist(), src=f"10.1.0.{i}",
                     start_id=1000 * i)
    df = frame(spark, rows)
    a = sorted(engineer_features(df.repartition(1)).collect())
    b = sorted(engineer_features(df.repartition(7)).collect())
    assert a == b


def test_day_shift_invariance(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    ts = np.cumsum(rng.exponential(40, size=30)).tolist()
    a = one(spark, flow(ts))
    b = one(spark, flow([t + 86400 * 3 for t in ts]))
    for k in ("mean_interval", "std_interval", "interval_cov", "interval_mad", "autocorrelation_score",
              "pct_connections_off_hours", "session_duration"):
        assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-9)


def test_grouping_helpers(spark):
    rows = flow([60 * i for i in range(12)]) + flow([1, 2, 3], src="10.9.9.9", start_id=500)
    df = frame(spark, rows)
    assert group_flows(df).count() == 12
    s = flow_summary(df).collect()
    assert len(s) == 1 and s[0]["num_connections"] == 12
    t = flow_totals(df).collect()[0]
    assert (t["total_groups"], t["retained_groups"], t["filtered_groups"]) == (2, 1, 1)


def test_feature_plan_has_one_record_exchange(spark):
    from beatline.operators.features import flow_rows, per_flow_features
    df = frame(spark, flow([60 * i for i in range(12)]))
    plan = per_flow_features(flow_rows(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(src_ip") == 1, plan


def test_time_from_strings_and_ntz(spark):
    from beatline.operators.grouping import normalize_connections
    df = spark.createDataFrame([("a", "b", 1, "2024-01-01T03:00:00+00:00"),
                                ("a", "b", 1, "2024-01-01 03:00:00")],
                               "src_ip string, dst_ip string, dst_port int, timestamp string")
    got = [r.ts_us for r in normalize_connections(df).collect()]
    assert got == [1704078000000000, 1704078000000000]
    ntz = df.withColumn("timestamp", F.to_timestamp_ntz(F.lit("2024-07-01 03:00:00")))
    assert normalize_connections(ntz).first().ts_us == 1719802800000000


@pytest.mark.parametrize("hot_rows", [4, 11])
def test_hot_flow_route_matches_window_route(spark, hot_rows):
    import numpy as np
    rng = np.random.default_rng(11)
    rows = []
    for i in range(6):
        n = 30 + 7 * i
        ts = np.cumsum(rng.exponential(20, size=n)).tolist()
        ts[3] = None if i % 2 else ts[3]
        rows += flow(ts, sizes=rng.integers(50, 500, size=n).tolist(), src=f"10.2.0.{i}", start_id=1000 * i)
    rows += flow([60 * j for j in range(12)], src="10.3.0.1", start_id=9000)   # stays below the bound
    df = frame(spark, rows)
    a = {r[:3]: r for r in engineer_features(df, hot_flow_rows=None).collect()}
    b = {r[:3]: r for r in engineer_features(df, hot_flow_rows=hot_rows).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            if isinstance(x, float):
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9)
            else:
                assert x == y


def test_inter_arrivals_hot_route(spark):
    from beatline.operators.features import inter_arrivals
    import numpy as np
    rng = np.random.default_rng(2)
    rows = []
    for i in range(3):
        ts = np.cumsum(rng.exponential(15, size=40)).tolist()
        rows += flow(ts, src=f"10.4.0.{i}", start_id=1000 * i)
    df = frame(spark, rows)
    key = lambda r: (r.src_ip, r._tb0)
    a = sorted((key(r), r.inter_arrival_s) for r in inter_arrivals(df, hot_flow_rows=None).collect())
    b = sorted((key(r), r.inter_arrival_s) for r in inter_arrivals(df, hot_flow_rows=7).collect())
    assert len(a) == len(b) == 120
    for (ka, va), (kb, vb) in zip(a, b):
        assert ka == kb and (va == vb or abs(va - vb) < 1e-9)


def test_packet_rollup_hot_route(spark):
    from beatline.sources.captures import packets_to_flows
    pk = spark.createDataFrame(
        [("f", i, "10.0.0.1", "1.2.3.4", 443, 1_000_000 * ((i * 7) % 23), 100 + i, "TCP", 0) for i in range(23)]
        + [("f", 100 + i, "10.0.0.2", "1.2.3.4", 443, 1_000_000 * i, 50, "TCP", 0) for i in range(3)],
        "file string, packet_idx long, src_ip string, dst_ip string, dst_port int, ts_us long, "
        "packet_size int, protocol string, has_dns_lookup int")
    a = sorted(packets_to_flows(pk, hot_rows=None).drop("timestamp").collect())
    b = sorted(packets_to_flows(pk, hot_rows=4).drop("timestamp").collect())
    assert a == b


@pytest.mark.parametrize("case", ["burst", "one instant", "no time"])
def test_hot_flows_are_cut_whatever_their_times(spark, case):
    from beatline.operators import hotflows
    from beatline.operators.features import _with_tbkey, flow_rows
    times = {"burst": [i * 1000.0 for i in range(100)] + [50_000 + i * 33.0 for i in range(900)],
             "one instant": [60.0] * 1000, "no time": [60.0 * i for i in range(100)] + [0.0] * 900}[case]
    df = frame(spark, flow(times))
    if case == "no time":
        df = df.withColumn("ts_us", F.when((F.col("ts_us") != df.agg(F.min("ts_us")).first()[0]), F.col("ts_us")))
    rows = _with_tbkey(flow_rows(df))
    sizes = [r["count"] for r in hotflows.time_slices(rows, 100).groupBy("_slice").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200
    a = engineer_features(df, hot_flow_rows=None).first().asDict()
    b = engineer_features(df, hot_flow_rows=100).first().asDict()
    for k, v in a.items():
        assert b[k] == (pytest.approx(v, rel=1e-12, abs=1e-12) if isinstance(v, float) else v), k


def test_weighted_median(spark):
    import random
    from statistics import median
    from beatline.operators.hotflows import weighted_median
    rnd = random.Random(2)
    for n in (1, 2, 7, 60):
        rows = [(k, v, rnd.randint(1, 5)) for k in "ab" for v in rnd.sample(range(1000), n)]
        got = {r.k: r["median"] for r in weighted_median(spark.createDataFrame(rows, "k string, v long, w long"), ["k"], "v", "w", 4).collect()}
        assert got == {k: median([v for kk, v, w in rows if kk == k for _ in range(w)]) for k in "ab"}


def test_session_time_zone_does_not_change_features(spark):
    from pyspark.sql import functions as F
    base = frame(spark, flow([3600 * 24 * 190 + 600 * i for i in range(40)]))        # July, across hours
    ntz = base.withColumn("timestamp", F.timestamp_micros("ts_us").cast("string").cast("timestamp_ntz")).drop("ts_us")
    utc = sorted(engineer_features(ntz).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = sorted(engineer_features(ntz).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == ny
    assert utc[0].pct_connections_off_hours == pytest.approx(sum(1 for i in range(40) if (600 * i // 3600) % 24 <= 5) / 40)


def test_features_are_the_same_to_the_last_bit_on_every_route(spark):
    """Window route, slices of several sizes, any partitioning: one result."""
    import numpy as np
    rng = np.random.default_rng(4)
    rows = []
    for i in range(5):
        n = 40 + 31 * i
        gaps = rng.lognormal(3, 2, size=n)
        rows += flow(np.cumsum(gaps).round(6).tolist(), sizes=rng.integers(50, 90_000, size=n).tolist(), src=f"10.5.0.{i}",
                     recv=rng.integers(0, 7_000_000, size=n).tolist(), start_id=1000 * i)
    df = frame(spark, rows).withColumn("connection_duration", F.rand(7) * 300)
    df = df.withColumn("connection_duration", F.round("connection_duration", 7))
    found = []
    for parts, hot in ((1, None), (5, None), (3, 10), (7, 33), (2, 100)):
        out = engineer_features(df.repartition(parts, F.rand(parts)), hot_flow_rows=hot)
        found.append(sorted(tuple(r) for r in out.collect()))
    assert all(f == found[0] for f in found) and len(found[0]) == 5
    x = np.array([r.connection_duration for r in df.where("src_ip = '10.5.0.4'").collect()])
    got = next(r for r in engineer_features(df).collect() if r.src_ip == "10.5.0.4")
    assert got.std_connection_duration == pytest.approx(x.std(ddof=1), rel=1e-12)
    d = np.diff(np.sort([r.ts_us for r in df.where("src_ip = '10.5.0.4'").collect()])) / 1e6
    c = d - d.mean()
    assert got.std_interval == pytest.approx(d.std(ddof=1), rel=1e-12)
    assert got.autocorrelation_score == pytest.approx(max(abs((c[k:] * c[:-k]).sum()) for k in range(1, 6)) / (c * c).sum(), rel=1e-9)
