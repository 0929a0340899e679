"""Evaluation against ground truth: J2, U2, E1–E9, P13, T17.

All three prediction methods are scored in one pass: the merged table gets
three 0/1 columns, one aggregate counts the 12 confusion cells, and
``stack`` turns them into a method-per-row table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.schemas import FLOW_KEY
from beatline.session import checkpoint_dir

TRUTH_COLUMNS = ["is_malicious", "beacon_type", "mitre_technique_id"]
METHODS = ["deterministic", "ml", "combined"]


def dedup_truth(truth: DataFrame, order_col: str | None = "_row") -> DataFrame:
    """One truth row per flow key, the first by ``order_col``.

    An aggregate (``min_by`` over a struct) rather than a window, so a key
    repeated many times is pre-aggregated map-side instead of landing whole
    in one task.  Without an order column the smallest row by value wins.
    """
    cols = [c for c in TRUTH_COLUMNS if c in truth.columns]
    payload = F.struct(*[F.col(c) for c in cols])
    order = F.col(order_col) if order_col and order_col in truth.columns else payload
    return (truth.groupBy(*FLOW_KEY).agg(F.min_by(payload, order).alias("_t"))
            .select(*FLOW_KEY, *[F.col("_t").getField(c).alias(c) for c in cols]))


def merge_with_truth(results: DataFrame, truth: DataFrame) -> DataFrame:
    """Results ⋈ deduplicated truth, inner, on the flow key."""
    return results.join(dedup_truth(truth), FLOW_KEY, "inner")


def dropped_truth(results: DataFrame, truth: DataFrame) -> DataFrame:
    """Truth flows absent from the results (e.g. fewer than 10 records)."""
    return dedup_truth(truth).join(results.select(*FLOW_KEY), FLOW_KEY, "left_anti")


def predictions(det_threshold: float = 75.0, ml_threshold: float = 70.0) -> dict[str, Column]:
    """The three 0/1 predictions."""
    return {
        "deterministic": (F.col("deterministic_score") > F.lit(det_threshold)).cast("int"),
        "ml": (F.col("ml_score") > F.lit(ml_threshold)).cast("int"),
        "combined": F.col("final_verdict").isin("HIGH", "MEDIUM").cast("int"),
    }


def _rates(tp, fp, fn, tn) -> dict[str, Column]:
    """Precision, recall, F1, FP rate; 0 where the denominator is 0."""
    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
            "f1": ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn), "fp_rate": ratio(fp, fp + tn)}


def compute_metrics(merged: DataFrame, pred: Column, truth: str = "is_malicious") -> DataFrame:
    """One row of tn, fp, fn, tp and the rates for one prediction."""
    y = F.col(truth) == 1
    p = pred == 1
    agg = merged.agg(F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
                     F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))
    return agg.withColumns(_rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def evaluate(merged: DataFrame, det_threshold: float = 75.0, ml_threshold: float = 70.0) -> DataFrame:
    """One row per method with the confusion counts and the four rates."""
    preds = predictions(det_threshold, ml_threshold)
    y = F.col("is_malicious") == 1
    aggs = []
    for m, p in preds.items():
        p = p == 1
        aggs += [F.count_if(~y & ~p).alias(f"{m}_tn"), F.count_if(~y & p).alias(f"{m}_fp"),
                 F.count_if(y & ~p).alias(f"{m}_fn"), F.count_if(y & p).alias(f"{m}_tp")]
    wide = merged.agg(*aggs)
    stack = ", ".join(f"'{m}', {m}_tn, {m}_fp, {m}_fn, {m}_tp" for m in METHODS)
    long = wide.selectExpr(f"stack({len(METHODS)}, {stack}) as (method, tn, fp, fn, tp)")
    return long.withColumns(_rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def by_beacon_type(merged: DataFrame) -> DataFrame:
    """E5: recall and count per beacon class of the truth ('none' and NULL skipped)."""
    pred = predictions()["combined"]
    return (merged.where(F.col("beacon_type").isNotNull() & (F.col("beacon_type") != "none"))
            .groupBy("beacon_type")
            .agg(F.avg(pred.cast("double")).alias("recall"), F.count(F.lit(1)).alias("count")))


def false_positives(merged: DataFrame) -> DataFrame:
    """Benign flows with a HIGH or MEDIUM verdict."""
    return merged.where((F.col("is_malicious") == 0) & F.col("final_verdict").isin("HIGH", "MEDIUM"))


def confusion_cells(merged: DataFrame, det_threshold: float = 75.0,
                    ml_threshold: float = 70.0) -> DataFrame:
    """(method, y_true, y_pred, count) — the data under the three matrices."""
    preds = predictions(det_threshold, ml_threshold)
    arr = F.array(*[F.struct(F.lit(m).alias("method"), p.alias("y_pred")) for m, p in preds.items()])
    return (merged.select(F.col("is_malicious").alias("y_true"), F.explode(arr).alias("_p"))
            .groupBy(F.col("_p.method").alias("method"), "y_true", F.col("_p.y_pred").alias("y_pred"))
            .agg(F.count(F.lit(1)).alias("count")))


def known_benign_slice(merged: DataFrame, port: int = 123) -> DataFrame:
    """Benign flows on ``port``: count, false positives, mean score."""
    s = merged.where((F.col("dst_port") == port) & (F.col("is_malicious") == 0))
    # scores carry 2 decimals: average the exact hundredths (order-independent)
    cents = F.floor(F.col("deterministic_score") * F.lit(100.0) + F.lit(0.5)).cast("bigint")
    n = F.count(F.lit(1))
    return s.agg(n.alias("num_flows"),
                 F.count_if(F.col("final_verdict").isin("HIGH", "MEDIUM")).alias("num_false_positives"),
                 F.when(n > 0, F.sum(cents) / n / F.lit(100.0)).alias("avg_deterministic_score"))


def truth_slice(merged: DataFrame, which: str) -> DataFrame:
    """P13: 'benign', 'malicious' or a beacon class."""
    if which == "benign":
        return merged.where(F.col("is_malicious") == 0)
    if which == "malicious":
        return merged.where(F.col("is_malicious") == 1)
    return merged.where(F.col("beacon_type") == which)


def run_full_evaluation(results: DataFrame, truth: DataFrame) -> dict[str, DataFrame]:
    """E9 entry point: every evaluation table.

    Results are computed once, into the shared checkpoint folder; the tables are lazy.
    """
    checkpoint_dir(results.sparkSession)
    results = results.checkpoint(eager=True)
    merged = merge_with_truth(results, truth).checkpoint(eager=True)
    return {"metrics": evaluate(merged), "by_type": by_beacon_type(merged),
            "false_positives": false_positives(merged), "confusion": confusion_cells(merged),
            "ntp": known_benign_slice(merged), "dropped_truth": dropped_truth(results, truth)}
