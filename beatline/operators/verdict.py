"""Verdicts and the result projection: V1, P7, P11, P12, O3, A10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.schemas import (
    FLOW_KEY, HIGH_THRESHOLD, MEDIUM_THRESHOLD, ML_MEDIUM_THRESHOLD, RESULT_COLUMNS, VERDICTS,
)


def verdict(allow="destination_in_allowlist", det="deterministic_score", ml="ml_score") -> Column:
    """V1: SUPPRESSED > HIGH > MEDIUM > CLEAR; all thresholds strict."""
    allow = F.coalesce(F.col(allow).cast("boolean"), F.lit(False))
    det = F.coalesce(F.col(det).cast("double"), F.lit(0.0))
    ml = F.coalesce(F.col(ml).cast("double"), F.lit(0.0))
    return (F.when(allow, "SUPPRESSED")
            .when(det > HIGH_THRESHOLD, "HIGH")
            .when((det > MEDIUM_THRESHOLD) | (ml > ML_MEDIUM_THRESHOLD), "MEDIUM")
            .otherwise("CLEAR"))


def benign_for_training() -> Column:
    """Allowlisted, or a composite score under the MEDIUM threshold."""
    return (F.coalesce(F.col("destination_in_allowlist").cast("boolean"), F.lit(False))
            | (F.col("deterministic_score") < MEDIUM_THRESHOLD))


def assign_verdicts(scored: DataFrame) -> DataFrame:
    if "ml_score" not in scored.columns:
        scored = scored.withColumn("ml_score", F.lit(0.0))
    return scored.withColumn("final_verdict", verdict())


def result_table(df: DataFrame, sort: bool = True) -> DataFrame:
    """P11 + O3: the 14 result columns (absent ones as ''), best first."""
    cols = [F.col(c) if c in df.columns else F.lit("").alias(c) for c in RESULT_COLUMNS]
    out = df.select(*cols)
    if sort:
        out = out.orderBy(F.desc("deterministic_score"), *FLOW_KEY)
    return out


def verdict_slice(results: DataFrame, which: str) -> DataFrame:
    """Rows of one verdict, or ``'EXPLAINED'`` for non-empty explanations."""
    if which == "EXPLAINED":
        return results.where(F.length(F.coalesce(F.col("ml_explanation"), F.lit(""))) > 0)
    if which not in VERDICTS:
        raise ValueError(f"unknown verdict {which!r}")
    return results.where(F.col("final_verdict") == F.lit(which))


def verdict_counts(results: DataFrame) -> DataFrame:
    """A10: count and percentage per verdict, all four listed even when 0.

    The four-row verdict list is a literal table; the counts a
    ``groupBy`` — the join between them is on ≤ 4 rows.
    """
    spark = results.sparkSession
    order = spark.createDataFrame([(i, v) for i, v in enumerate(VERDICTS)],
                                  "verdict_order int, final_verdict string")
    counts = results.groupBy("final_verdict").agg(F.count(F.lit(1)).alias("count"))
    out = (order.join(counts, "final_verdict", "left")
           .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long")))
    # total over the four rows: a window on a 4-row table
    total = F.sum("count").over(Window.partitionBy())
    pct = F.lit(100.0) * F.col("count") / F.greatest(total, F.lit(1))
    return (out.withColumn("pct", pct).orderBy("verdict_order")
            .select("final_verdict", "count", "pct"))
