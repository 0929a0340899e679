import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatline.operators import anomaly
from beatline.schemas import ML_FEATURES


def _features(spark, n=300, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        vals = rng.normal(1.0, 0.2, size=len(ML_FEATURES)).tolist()
        rows.append((f"10.0.{i // 256}.{i % 256}", "45.33.0.1", 443, *vals))
    rows.append(("10.9.9.9", "45.33.0.1", 443, *([25.0] * len(ML_FEATURES))))   # outlier
    cols = "src_ip string, dst_ip string, dst_port int, " + ", ".join(f"{c} double" for c in ML_FEATURES)
    return spark.createDataFrame(rows, cols)


def test_average_path_length():
    c = anomaly.average_path_length([0, 1, 2, 256])
    assert c[0] == 0 and c[1] == 0 and c[2] == 1
    assert c[3] == pytest.approx(2 * (np.log(255) + anomaly.EULER_GAMMA) - 2 * 255 / 256)


def test_forest_is_partition_independent_and_finds_outlier(spark):
    df = _features(spark)
    m1 = anomaly.fit(df.repartition(1), n_trees=40, seed=42)
    m2 = anomaly.fit(df.repartition(5), n_trees=40, seed=42)
    for k in m1.nodes:
        assert np.array_equal(m1.nodes[k], m2.nodes[k]), k
    assert m1.psi == 256 and m1.n_train == 301
    scores = {r.src_ip: r.ml_score for r in anomaly.score(m1, df).collect()}
    assert scores["10.9.9.9"] == 100.0
    assert scores["10.9.9.9"] > np.median(list(scores.values()))
    assert all(0.0 <= s <= 100.0 for s in scores.values())


def test_small_training_set_uses_all_rows(spark):
    df = _features(spark, n=30)
    m = anomaly.fit(df, n_trees=10, seed=1)
    assert m.psi == 31
    assert (m.nodes["size"][:, 1] == 31).all()       # every root holds the whole sample


def test_explanation_text(spark):
    stats = {c: (1.0, 0.0) for c in ML_FEATURES}
    stats["interval_cov"] = (0.5, 0.1)
    df = spark.createDataFrame([(0.05,) + (1.0,) * (len(ML_FEATURES) - 1)],
                               ", ".join(f"{c} double" for c in ML_FEATURES))
    txt = df.select(anomaly.explanation(stats).alias("e")).first().e
    assert txt == ("interval_cov is 0.0500 (benign mean: 0.5000, 2σ range: [0.3000, 0.7000]) — "
                   "unusually low timing regularity (lower = more regular)")


def test_short_tree_is_offered_rows_again(spark, monkeypatch):
    from pyspark.sql import functions as F
    df = _features(spark, n=300)
    real = anomaly.tree_samples

    def lossy(train, n_rows, trees, psi, seed, widen=1):        # tree 3 loses most of its candidates at first
        s = real(train, n_rows, trees, psi, seed, widen)
        return s if widen > 1 else s.where((F.col("_tree") != 3) | (F.col("_rank") <= 10))

    monkeypatch.setattr(anomaly, "tree_samples", lossy)
    m = anomaly.fit(df, n_trees=6, seed=42)
    assert (m.nodes["size"][:, 1] == 256).all()
    monkeypatch.setattr(anomaly, "tree_samples", real)
    ref = anomaly.fit(df, n_trees=6, seed=42)
    for k in m.nodes:
        assert np.array_equal(m.nodes[k], ref.nodes[k])


def test_equal_rows_keep_their_share(spark):
    cols = ", ".join(f"{c} double" for c in ML_FEATURES)
    rng = np.random.default_rng(3)
    rows = [tuple([1.0] * len(ML_FEATURES))] * 6000 + [tuple(rng.normal(size=len(ML_FEATURES)).tolist()) for _ in range(4000)]
    base = spark.createDataFrame(rows, cols)
    train = anomaly.training_matrix(_features(spark, 10), base)
    assert train.count() == 10_011 and train.select("_rid").distinct().count() == 10_011
    samples = anomaly.tree_samples(train, 10_011, list(range(60)), 256, 7).select("_tree", "interval_cov").toPandas()
    assert (samples.groupby("_tree").size() == 256).all()
    assert abs((samples["interval_cov"] == 1.0).mean() - 0.6) < 0.02
    one = anomaly.fit(_features(spark, 10), base.repartition(7), n_trees=8)
    two = anomaly.fit(_features(spark, 10), base.coalesce(1), n_trees=8)
    assert all(np.array_equal(one.nodes[k], two.nodes[k]) for k in one.nodes)


def test_copies_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "COPY_BLOCK", 7)
    base = spark.createDataFrame([(1.0,)] * 30 + [(2.0,)] * 7, "interval_cov double")
    ids = [r[0] for r in anomaly.training_matrix(base, None).select("_rid").collect()]
    assert len(ids) == len(set(ids)) == 37


def test_threshold_at_a_trillion_rows():
    psi, n = 256, 10 ** 12
    margin = psi + 6.0 * psi ** 0.5 + 20.0
    limit = int(margin / n * anomaly.HASH_SPACE)
    assert abs(limit / anomaly.HASH_SPACE * n - margin) < 1e-3 and limit > 10 ** 9


def test_tree_hashes_are_uniform(spark):
    rows = spark.range(40_000).selectExpr("cast(id as string) as _rid", "false as _base", *[f"0.0 as {c}" for c in ML_FEATURES])
    s = anomaly.tree_samples(rows, 40_000, [0, 1, 2], 40_000, 42).select("_tree", "_h").toPandas()
    for _, g in s.groupby("_tree"):
        cells = np.bincount((g["_h"].to_numpy() / anomaly.HASH_SPACE * 50).astype(int), minlength=50)
        assert ((cells - 800) ** 2 / 800).sum() < 100


def test_training_stats_do_not_depend_on_the_order_of_rows(spark):
    from beatline.operators.anomaly import training_matrix, training_stats
    rng = random.Random(3)
    rows = [(i, 10.0 ** rng.uniform(-6, 6), rng.random(), rng.choice([0.1, 0.3, 1 / 3])) for i in range(3000)]
    base = spark.createDataFrame(rows, "row_id long, mean_interval double, interval_cov double, payload_entropy double")
    found = [training_stats(training_matrix(base.repartition(n).orderBy(F.rand(n)))) for n in (1, 5, 37)]
    assert found[0] == found[1] == found[2]
    x = np.array([r[1] for r in rows])
    assert np.allclose(found[0]["stats"]["mean_interval"], (x.mean(), x.std(ddof=1)), rtol=1e-12)
    assert np.isclose(found[0]["scaler"]["mean_interval"][1], x.std(), rtol=1e-12) and found[0]["scaler"]["mean_bytes"] == (0.0, 1.0)


def test_scaled_features_have_mean_zero_and_unit_deviation(spark):
    from beatline.operators.anomaly import scale, training_matrix, training_stats
    rows = [(i, float(i % 17), 3.0) for i in range(500)]
    train = training_matrix(spark.createDataFrame(rows, "row_id long, mean_interval double, std_interval double"))
    got = scale(train, training_stats(train)["scaler"]).agg(
        F.avg("mean_interval"), F.stddev_pop("mean_interval"), F.max(F.abs("std_interval"))).first()
    assert np.allclose(got, (0.0, 1.0, 0.0), atol=1e-12)


def test_exact_median_of_any_values(spark, monkeypatch):
    from beatline.operators import ranks
    monkeypatch.setattr(ranks, "COLLECTED", 20)
    rng = random.Random(9)
    tables = [[10.0 ** rng.uniform(-200, 200) for _ in range(5001)], [float(rng.randrange(3)) for _ in range(4000)], [7.0] * 3000,
              [rng.gauss(0, 1) for _ in range(3000)] + [float("nan"), None], [1.0], [2.0, 5.0], [], [None],
              [0.0] * 2000 + [1.0] * 2000, [-1e300] * 999 + [float(k) for k in range(999)]]
    for values in tables:
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        real = [v for v in values if v is not None and v == v]
        want = float(np.median(real)) if real else None
        assert ranks.exact_median(df, "v") == want
