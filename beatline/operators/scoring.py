"""Deterministic scoring: B1–B14 as column expressions (no per-row Python)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.functions.columns import clamp, round_half_up

# ---------------------------------------------------------------------------
# Sub-score weights (sum 1.0), class texts and the exfil suffix.
# ---------------------------------------------------------------------------
SCORING_WEIGHTS = {
    "interval_cov": 0.30,
    "bytes_cov": 0.10,
    "autocorrelation": 0.15,
    "num_connections": 0.10,
    "session_duration": 0.10,
    "off_hours_pct": 0.10,
    "not_allowlisted": 0.05,
    "direct_ip_no_dns": 0.05,
    "low_internal_hosts": 0.05,
}
MITRE_MAP = {
    "fixed": "T1071.001 — Application Layer Protocol: Web Protocols (fixed-interval beacon)",
    "jittered": "T1071.001 — Application Layer Protocol: Web Protocols "
                "(jittered beacon with sleep randomisation)",
    "evasive": "T1573 — Encrypted Channel / T1090 — Proxy (low-and-slow evasive beacon)",
    "unlikely": "No strong MITRE mapping — likely benign",
}
EXFIL_TECHNIQUE = "T1041 — Exfiltration Over C2 Channel"

# sub-score column → weight key, in summation order
SUB_SCORES = {
    "interval_cov_score": "interval_cov",
    "bytes_cov_score": "bytes_cov",
    "autocorrelation_sub_score": "autocorrelation",
    "num_connections_score": "num_connections",
    "session_duration_score": "session_duration",
    "off_hours_score": "off_hours_pct",
    "not_allowlisted_score": "not_allowlisted",
    "direct_ip_score": "direct_ip_no_dns",
    "low_internal_hosts_score": "low_internal_hosts",
}

# Inputs and their defaults when the column is absent.
_DEFAULTS = {
    "interval_cov": 1.0, "bytes_cov": 2.0, "autocorrelation_score": 0.0,
    "num_connections": 0, "session_duration": 0.0, "pct_connections_off_hours": 0.0,
    "destination_in_allowlist": False, "is_direct_ip_no_dns": 0,
    "num_internal_hosts_contacting": 1, "mean_interval": 0.0, "has_anomalous_burst": 0,
}


def check_weights(weights: dict[str, float]) -> None:
    """Weights must sum to 1 (checked when a scorer is built)."""
    if abs(sum(weights.values()) - 1.0) >= 1e-9:
        raise ValueError("Scoring weights must sum to 1.0")


check_weights(SCORING_WEIGHTS)


def _in(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(name)
    return F.lit(_DEFAULTS[name])


def sub_score_columns(df: DataFrame) -> dict[str, Column]:
    """Each sub-score in [0, 100]."""
    cov = _in(df, "interval_cov").cast("double")
    bcov = _in(df, "bytes_cov").cast("double")
    ac = _in(df, "autocorrelation_score").cast("double")
    n = _in(df, "num_connections").cast("long")
    dur = _in(df, "session_duration").cast("double")
    off = _in(df, "pct_connections_off_hours").cast("double")
    allow = F.coalesce(_in(df, "destination_in_allowlist").cast("boolean"), F.lit(False))
    direct = F.coalesce(_in(df, "is_direct_ip_no_dns").cast("int"), F.lit(0))
    hosts = _in(df, "num_internal_hosts_contacting").cast("long")
    return {
        "interval_cov_score": clamp(F.lit(100.0) * (F.lit(1.0) - cov / F.lit(0.5))),
        "bytes_cov_score": clamp(F.lit(100.0) * (F.lit(1.0) - bcov / F.lit(1.0))),
        "autocorrelation_sub_score": clamp(ac * F.lit(100.0)),
        "num_connections_score": F.least(F.lit(100.0), n * F.lit(2.0)),
        "session_duration_score": F.least(F.lit(100.0), dur / F.lit(3600.0) * F.lit(100.0)),
        "off_hours_score": F.least(F.lit(100.0), off * F.lit(100.0)),
        "not_allowlisted_score": F.when(allow, F.lit(0.0)).otherwise(F.lit(100.0)),
        "direct_ip_score": F.when(direct != 0, F.lit(100.0)).otherwise(F.lit(0.0)),
        "low_internal_hosts_score": F.greatest(F.lit(0.0),
                                               F.lit(100.0) * (F.lit(1.0) - hosts / F.lit(10.0))),
    }


def composite_score(weights: dict[str, float] = SCORING_WEIGHTS) -> Column:
    """Weighted sum of the sub-score columns, clamped, rounded to 2."""
    check_weights(weights)
    total = F.lit(0.0)
    for col, wkey in SUB_SCORES.items():
        total = total + F.col(col) * F.lit(weights[wkey])
    return round_half_up(clamp(total), 2)


def beacon_type(cov="interval_cov", mean="mean_interval") -> Column:
    """Class from CoV and mean interval; CASE order matters."""
    cov = F.col(cov) if isinstance(cov, str) else cov
    mean = F.col(mean) if isinstance(mean, str) else mean
    return (F.when(mean > 300, "evasive")
            .when((cov < 0.1) & (mean < 120), "fixed")
            .when((cov >= 0.1) & (cov <= 0.4) & (mean < 120), "jittered")
            .otherwise("unlikely"))


def mitre_technique(btype="beacon_type_guess", burst="has_anomalous_burst") -> Column:
    """Technique text per class, exfiltration appended on a burst."""
    btype = F.col(btype) if isinstance(btype, str) else btype
    burst = F.col(burst) if isinstance(burst, str) else burst
    base = F.coalesce(F.create_map(*[F.lit(x) for kv in MITRE_MAP.items() for x in kv])[btype],
                      F.lit(MITRE_MAP["unlikely"]))
    return F.when(F.coalesce(burst, F.lit(0)) != 0,
                  F.concat(base, F.lit(" + " + EXFIL_TECHNIQUE))).otherwise(base)


def score_flows(features: DataFrame, weights: dict[str, float] = SCORING_WEIGHTS,
                sort: bool = False) -> DataFrame:
    """Sub-scores, ``deterministic_score``, class and technique appended.

    One projection over the feature table.  ``sort=True`` orders by score
    descending with the flow key as tiebreak (O3); leave it to the end of a
    plan otherwise, since a global sort is a range exchange.
    """
    subs = sub_score_columns(features)
    out = features.withColumns(subs)
    burst = _in(features, "has_anomalous_burst")
    out = out.withColumns({
        "deterministic_score": composite_score(weights),
        "beacon_type_guess": beacon_type(_in(features, "interval_cov"), _in(features, "mean_interval")),
    })
    out = out.withColumn("suggested_mitre_technique", mitre_technique("beacon_type_guess", burst))
    if sort:
        out = out.orderBy(F.desc("deterministic_score"), "src_ip", "dst_ip", "dst_port")
    return out


def score_stats(scored: DataFrame, threshold: float = 75.0) -> DataFrame:
    """Max, median and count above ``threshold`` of the composite score."""
    s = F.col("deterministic_score")
    return scored.agg(F.count(F.lit(1)).alias("num_flows"), F.max(s).alias("max_score"),
                      F.median(s).alias("median_score"),
                      F.count_if(s > F.lit(threshold)).alias("num_above"))
