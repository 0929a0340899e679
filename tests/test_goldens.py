
import pytest

from beatline.operators.anomaly import explanation
from beatline.operators.features import engineer_features
from beatline.operators.scoring import beacon_type
from beatline.operators.verdict import verdict
from beatline.plans.pipeline import run_pipeline
from beatline.schemas import ML_FEATURES, RESULT_COLUMNS
from helpers import flow, frame

# Published false-positive rows — (interval_cov, mean_interval,
# deterministic_score, ml_score, final_verdict, beacon_type_guess).
PUBLISHED_FP_ROWS = [
    (0.3395126663720825, 13409.2825960625, 45.05, 59.68, "MEDIUM", "evasive"),
    (0.3632949686302177, 14203.4073715, 44.97, 56.72, "MEDIUM", "evasive"),
    (0.7974114332610993, 49.12590860377358, 43.37, 48.48, "MEDIUM", "unlikely"),
    (0.7735939725213347, 47.75504014285714, 43.01, 48.95, "MEDIUM", "unlikely"),
    (0.8156413998191847, 47.643739796296295, 42.71, 49.12, "MEDIUM", "unlikely"),
    (0.9555191265093756, 36.61999452380952, 42.4, 46.38, "MEDIUM", "unlikely"),
    (0.722731939016453, 54.17339394339622, 41.66, 62.63, "MEDIUM", "unlikely"),
    (0.4961066697344968, 11366.8687289375, 41.35, 67.85, "MEDIUM", "evasive"),
    (0.4264692309777625, 2.5331417368421056, 29.76, 96.04, "MEDIUM", "unlikely"),
    (0.3876451301244117, 3.091253684210526, 27.85, 98.96, "MEDIUM", "jittered"),
    (0.5426772173663102, 2.5795483157894736, 23.57, 91.92, "MEDIUM", "unlikely"),
]


def test_published_rows_class_and_verdict(spark):
    df = spark.createDataFrame([(c, m, d, ml, False) for c, m, d, ml, *_ in PUBLISHED_FP_ROWS],
                               "interval_cov double, mean_interval double, deterministic_score double, "
                               "ml_score double, destination_in_allowlist boolean")
    got = df.select(beacon_type().alias("t"), verdict().alias("v")).collect()
    assert [(r.v, r.t) for r in got] == [(v, t) for *_, v, t in PUBLISHED_FP_ROWS]
    # the published std of row 9 is cov × mean
    assert PUBLISHED_FP_ROWS[8][0] * PUBLISHED_FP_ROWS[8][1] == pytest.approx(1.0803, abs=5e-5)


def test_explanation_format_golden(spark):
    stats = {c: (0.0, 0.0) for c in ML_FEATURES}
    stats["mean_interval"] = (39.6779, 14.4656)
    vals = {c: 0.0 for c in ML_FEATURES}
    vals["mean_interval"] = 2.5331417368421056
    df = spark.createDataFrame([tuple(vals[c] for c in ML_FEATURES)], ", ".join(f"{c} double" for c in ML_FEATURES))
    txt = df.select(explanation(stats).alias("e")).first().e
    assert txt == ("mean_interval is 2.5331 (benign mean: 39.6779, 2σ range: [10.7467, 68.6091]) — "
                   "unusually low average time between connections")


def test_interval_scaling_keeps_cov_and_autocorrelation(spark):
    import numpy as np
    rng = np.random.default_rng(9)
    ts = np.cumsum(rng.exponential(30, size=40)).round(3).tolist()
    a = engineer_features(frame(spark, flow(ts))).first()
    b = engineer_features(frame(spark, flow([t * 3 for t in ts]))).first()
    assert a.interval_cov == pytest.approx(b.interval_cov, rel=1e-6)
    assert a.autocorrelation_score == pytest.approx(b.autocorrelation_score, rel=1e-6)
    assert b.mean_interval == pytest.approx(3 * a.mean_interval, rel=1e-9)


def test_empty_input(spark):
    empty = frame(spark, [])
    assert engineer_features(empty).count() == 0
    res = run_pipeline(empty)
    assert res.columns == RESULT_COLUMNS and res.count() == 0


def test_single_record_with_min_one(spark):
    f = engineer_features(frame(spark, flow([5.0])), min_connections=1).first()
    assert (f.mean_interval, f.std_interval, f.interval_cov, f.payload_entropy, f.std_bytes) == (0, 0, 0, 0, 0)
    assert f.num_connections == 1


def test_constant_sizes_and_zero_bytes(spark):
    f = engineer_features(frame(spark, flow([60 * i for i in range(12)], sizes=[0] * 12, recv=0))).first()
    assert f.payload_entropy == 0.0 and f.mean_bytes == 0.0 and f.bytes_cov == 0.0
    assert f.has_anomalous_burst == 0 and f.bytes_sent_received_ratio == 0.0


def test_fewer_than_five_benign_rows_turns_model_off(spark):
    rows = []
    for i in range(3):      # three perfect beacons: high scores, nothing benign
        rows += flow([60 * j for j in range(30)], src=f"10.5.0.{i}", start_id=100 * i)
    res = run_pipeline(frame(spark, rows)).collect()
    assert len(res) == 3
    assert all(r.ml_score == 0.0 and r.ml_explanation == "" for r in res)


def test_single_class_truth_metrics(spark):
    from beatline.operators.evaluate import evaluate
    df = spark.createDataFrame([(0, 80.0, 0.0, "HIGH"), (0, 10.0, 0.0, "CLEAR")],
                               "is_malicious int, deterministic_score double, ml_score double, final_verdict string")
    m = {r.method: r for r in evaluate(df).collect()}
    assert m["deterministic"].fp == 1 and m["deterministic"].tn == 1
    assert m["deterministic"].precision == 0.0 and m["deterministic"].recall == 0.0
    assert m["deterministic"].fp_rate == 0.5
