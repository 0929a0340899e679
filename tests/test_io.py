import os
import tempfile

import pytest

from beatline.operators.features import engineer_features
from beatline.sources.baseline import baseline_features, load_baseline, load_labelled_flows
from beatline.sources.connections import load_ground_truth, read_connection_dir, read_connections
from beatline.sources.sinks import export_alerts, save_flows, save_results
from beatline.streaming import connection_stream, land_connections

HEADER = ("flow_id,src_ip,dst_ip,dst_port,timestamp,packet_size,protocol,connection_duration,"
          "bytes_sent,bytes_received,is_failed,has_dns_lookup")


def _csv(path, start=0, n=12, src="10.0.0.1"):
    with open(path, "w") as f:
        f.write(HEADER + "\n")
        for i in range(n):
            f.write(f"f{start + i},{src},45.33.0.1,443,2024-01-01 0{i // 6}:{(i * 10) % 60:02d}:00,"
                    f"250,TCP,1.0,250,120,0,0\n")


def test_readers_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="beatline-io-")
    _csv(os.path.join(d, "a.csv"))
    _csv(os.path.join(d, "b.csv"), start=100, src="10.0.0.2")
    one = read_connections(spark, os.path.join(d, "a.csv"))
    assert one.count() == 12 and dict(one.dtypes)["timestamp"] == "timestamp"
    both = read_connection_dir(spark, d)
    feats = engineer_features(both)
    assert feats.count() == 2
    out = tempfile.mkdtemp(prefix="beatline-out-")
    assert save_flows(both, os.path.join(out, "flows")) is not None
    assert save_flows(both.limit(0), os.path.join(out, "empty")) is None
    save_results(feats.withColumn("final_verdict", feats.src_ip), os.path.join(out, "res"), partition_by_verdict=True)
    assert spark.read.parquet(os.path.join(out, "res")).count() == 2
    export_alerts(feats.select("src_ip", "dst_ip"), os.path.join(out, "alerts"))
    assert spark.read.option("header", True).csv(os.path.join(out, "alerts")).count() == 2


def test_ground_truth_reader(spark):
    d = tempfile.mkdtemp(prefix="beatline-gt-")
    p = os.path.join(d, "truth.csv")
    with open(p, "w") as f:
        f.write("src_ip,dst_ip,dst_port,is_malicious,beacon_type,mitre_technique_id\n")
        f.write("10.0.0.1,45.33.0.1,443,1,fixed,T1071.001\n10.0.0.1,45.33.0.1,443,0,none,\n")
    from beatline.operators.evaluate import dedup_truth
    rows = dedup_truth(load_ground_truth(spark, p)).collect()
    assert len(rows) == 1 and rows[0].is_malicious == 1          # first row kept


def test_baseline_csv_variants(spark):
    d = tempfile.mkdtemp(prefix="beatline-bl-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write(" Destination Port, Flow Duration, Total Fwd Packets, Total Backward Packets,"
                "Total Length of Fwd Packets, Total Length of Bwd Packets, Fwd IAT Mean, Fwd IAT Std, Label\n")
        f.write("443,100,3,1,300,100,10,5,BENIGN\n80,50,1,1,10,10,0,0, DoS\n")
    with open(os.path.join(d, "y.CSV"), "w") as f:
        f.write("Destination Port,Flow Duration\n53,5\n")           # no label: skipped
    benign = load_labelled_flows(spark, d)
    assert benign.count() == 1
    row = baseline_features(benign).first()
    assert row.interval_cov == 0.5 and row.mean_bytes == 100.0
    assert row.bytes_cov == round(200 / 2 ** 0.5 / (100.0 * 4), 6)
    assert row.protocol == 0.0                                       # absent → 0
    assert load_baseline(spark, "/nonexistent/dir") is None


def test_streaming_landing(spark):
    src = tempfile.mkdtemp(prefix="beatline-stream-in-")
    _csv(os.path.join(src, "a.csv"))
    out = tempfile.mkdtemp(prefix="beatline-stream-out-")
    q = land_connections(connection_stream(spark, src), out, name=os.path.basename(out))
    q.awaitTermination(120)
    landed = spark.read.parquet(out)
    assert landed.count() == 12 and "day" in landed.columns


def test_columns_in_any_order_and_without_the_optional_one(spark):
    d = tempfile.mkdtemp(prefix="beatline-order-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("dst_port,timestamp,dst_ip,src_ip,packet_size,extra\n443,2024-01-01T00:00:00Z,45.33.0.1,10.0.0.1,250.0,x\n"
                "bad,2024-01-01T00:00:00Z,45.33.0.1,10.0.0.1,,y\n")
    _csv(os.path.join(d, "b.csv"), n=2, src="10.0.0.2")
    rows = sorted(read_connection_dir(spark, d).select("src_ip", "dst_ip", "dst_port", "packet_size", "dst_domain", "timestamp").collect(), key=str)
    assert [(r.src_ip, r.dst_ip, r.dst_port, r.packet_size, r.dst_domain) for r in rows] == [
        ("10.0.0.1", "45.33.0.1", 443, 250, None), ("10.0.0.1", "45.33.0.1", None, None, None),
        ("10.0.0.2", "45.33.0.1", 443, 250, None), ("10.0.0.2", "45.33.0.1", 443, 250, None)]
    assert rows[0].timestamp is not None
    with open(os.path.join(d, "parsed_connections.csv"), "w") as f:
        f.write("dst_ip,src_ip,timestamp\n1.1.1.1,2.2.2.2,2024-01-01 00:00:00\n")
    with pytest.raises(ValueError, match="dst_port"):
        read_connection_dir(spark, d)
    with pytest.raises(FileNotFoundError):
        read_connection_dir(spark, d + "-none")
    with pytest.raises(FileNotFoundError):
        read_connections(spark, d + "/none.csv")


def test_truth_order_is_file_order(spark):
    d = tempfile.mkdtemp(prefix="beatline-order-")
    for name, n, flag in (("b.csv", 3, 0), ("a.csv", 40_000, 1)):
        with open(os.path.join(d, name), "w") as f:
            f.write("dst_ip,src_ip,dst_port,is_malicious,beacon_type,mitre_technique_id\n")
            f.write(f"45.33.0.1,10.0.0.1,443,{flag},{'fixed' if flag else 'none'},\n" * n)
    from beatline.operators.evaluate import dedup_truth
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = dedup_truth(load_ground_truth(spark, d)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.is_malicious for r in rows] == [1]


def test_stream_matches_names_and_rejects_another_layout(spark):
    src = tempfile.mkdtemp(prefix="beatline-stream-in-")
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("timestamp,dst_ip,src_ip,dst_port\n2024-01-01 00:00:00,45.33.0.1,10.0.0.1,443\n")
    out = tempfile.mkdtemp(prefix="beatline-stream-out-")
    land_connections(connection_stream(spark, src), out, name=os.path.basename(out)).awaitTermination(120)
    assert [(r.src_ip, r.dst_ip, r.dst_port) for r in spark.read.parquet(out).collect()] == [("10.0.0.1", "45.33.0.1", 443)]
    _csv(os.path.join(src, "b.csv"))
    with pytest.raises(Exception):
        land_connections(connection_stream(spark, src), out, name=os.path.basename(out)).awaitTermination(120)


def test_missing_columns_are_an_error(spark):
    from beatline.operators.grouping import group_flows
    with pytest.raises(ValueError, match="dst_port"):
        group_flows(spark.createDataFrame([("a", "b", "2024-01-01")], "src_ip string, dst_ip string, timestamp string"))


def test_cells_missing_in_floating_columns(spark):
    nan = float("nan")
    rows = [("10.0.0.1", "45.33.0.1", 443.0, f"2024-01-01 00:{i:02d}:00", nan if i % 2 else 100.0, nan if i % 3 else 9.0, nan)
            for i in range(12)] + [("10.0.0.1", "45.33.0.1", nan, "2024-01-01 00:00:00", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "src_ip string, dst_ip string, dst_port double, timestamp string, packet_size double, "
                                     "connection_duration double, bytes_received double")
    row = engineer_features(df).first()
    zero = engineer_features(df.na.fill(0.0, ["packet_size", "connection_duration", "bytes_received"]).where("dst_port = 443")).first()
    assert row.num_connections == 12 and row == zero and row.std_connection_duration > 0


def test_caption_of_a_lone_record(spark):
    from beatline.operators.explore import timeline_caption
    df = spark.createDataFrame([("a", "b", 1, "2024-01-01 00:00:00"), ("a", "c", 1, None)],
                               "src_ip string, dst_ip string, dst_port int, timestamp string")
    assert [(r.num_connections, r.mean_interval, r.cov) for r in timeline_caption(df).collect()] == [(1, None, None)] * 2


def test_shared_checkpoint_folder_is_required_off_local_mode():
    from beatline.session import checkpoint_dir

    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Fake)


def test_saved_by_flow_key_joins_without_a_shuffle_and_skips_row_groups(spark, tmp_path):
    from pyspark.sql import functions as F

    from beatline.operators.evaluate import merge_with_truth
    from beatline.operators.explore import flow_drilldown
    from beatline.sources.bucketed import load_bucketed, save_bucketed
    flows = spark.range(4000).select(
        F.concat(F.lit("10.0."), (F.col("id") % 40).cast("string"), F.lit("."), (F.col("id") % 97).cast("string")).alias("src_ip"),
        F.concat(F.lit("45.33.0."), (F.col("id") % 200).cast("string")).alias("dst_ip"), (F.col("id") % 7 + 440).cast("int").alias("dst_port"),
        F.col("id").alias("flow_id"), (F.col("id") * 1000).alias("ts_us"), F.rand(3).alias("deterministic_score"))
    one = flows.dropDuplicates(["src_ip", "dst_ip", "dst_port"]).checkpoint()
    truth = one.where("flow_id % 3 = 0").select("src_ip", "dst_ip", "dst_port", (F.col("flow_id") % 2).cast("int").alias("is_malicious"))
    truth = truth.unionByName(truth.where("is_malicious = 1"))                 # repeated truth rows
    paths = [save_bucketed(df, f"{tmp_path}/{k}", 8) for k, df in enumerate((one, truth, flows.where("src_ip is not null")))]
    results, known, records = (load_bucketed(spark, p) for p in paths)
    assert results.schema["deterministic_score"].dataType.simpleString() == "double" and results.count() == one.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_with_truth(results, known)
        got = sorted(map(tuple, merged.collect()))
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
        assert got == sorted(map(tuple, merge_with_truth(one, truth).select(*merged.columns).collect())) and got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    key = flows.where("flow_id = 5").first()
    found = flow_drilldown(records, key.src_ip, key.dst_ip, key.dst_port)
    assert found.count() == flow_drilldown(flows, key.src_ip, key.dst_ip, key.dst_port).count()
    missing = records.where("src_ip = '10.0.5.55x'")          # between the least and the largest address: the bloom filters tell
    assert missing.collect() == []
    leaves = missing._jdf.queryExecution().executedPlan().collectLeaves()
    read = [leaves.apply(k).metrics().get("numOutputRows") for k in range(leaves.size())]
    assert sum(m.get().value() for m in read if m.isDefined()) < 400
