"""Schemas, column lists and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Flow key: one flow per (source, destination, destination port).
FLOW_KEY = ["src_ip", "dst_ip", "dst_port"]

# Connection records as read from CSV/Parquet (dst_domain optional).
CONNECTION_SCHEMA = T.StructType([
    T.StructField("flow_id", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("packet_size", T.LongType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("connection_duration", T.DoubleType()),
    T.StructField("bytes_sent", T.LongType()),
    T.StructField("bytes_received", T.LongType()),
    T.StructField("is_failed", T.IntegerType()),
    T.StructField("has_dns_lookup", T.IntegerType()),
    T.StructField("dst_domain", T.StringType()),
])

# Columns with their null → 0 defaults before features are computed.
CONNECTION_VALUE_COLUMNS = {
    "packet_size": T.LongType(),
    "bytes_sent": T.LongType(),
    "bytes_received": T.LongType(),
    "connection_duration": T.DoubleType(),
    "is_failed": T.IntegerType(),
    "has_dns_lookup": T.IntegerType(),
}

PACKET_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("packet_idx", T.LongType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("packet_size", T.IntegerType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("has_dns_lookup", T.IntegerType()),
])

DNS_ANSWER_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("packet_idx", T.LongType()),
    T.StructField("answer_idx", T.IntegerType()),
    T.StructField("ip", T.StringType()),
    T.StructField("domain", T.StringType()),
])

TRUTH_SCHEMA = T.StructType([
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("is_malicious", T.IntegerType()),
    T.StructField("beacon_type", T.StringType()),
    T.StructField("mitre_technique_id", T.StringType()),
])

# Per-flow feature columns in output order (F1–F19, then F20).
TIMING_FEATURES = [
    "mean_interval", "std_interval", "interval_cov", "interval_mad",
    "autocorrelation_score", "session_duration", "pct_connections_off_hours",
]
VOLUME_FEATURES = [
    "mean_bytes", "std_bytes", "bytes_cov", "bytes_sent_received_ratio",
    "payload_entropy", "has_anomalous_burst",
]
CONNECTION_FEATURES = [
    "num_connections", "num_unique_ports", "mean_connection_duration",
    "std_connection_duration", "failed_connection_ratio", "is_direct_ip_no_dns",
]
FEATURE_COLUMNS = TIMING_FEATURES + VOLUME_FEATURES + CONNECTION_FEATURES + [
    "num_internal_hosts_contacting"]
INTEGER_FEATURES = {"has_anomalous_burst", "num_connections", "num_unique_ports",
                    "is_direct_ip_no_dns", "num_internal_hosts_contacting"}

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Features fed to the isolation forest, in this order.
ML_FEATURES = [
    "interval_cov", "mean_interval", "std_interval", "bytes_cov", "mean_bytes",
    "num_connections", "session_duration", "pct_connections_off_hours",
    "mean_connection_duration", "failed_connection_ratio", "payload_entropy",
]

# Text used in anomaly explanations, per feature.
FEATURE_DESCRIPTIONS = {
    "interval_cov": "timing regularity (lower = more regular)",
    "mean_interval": "average time between connections",
    "std_interval": "variability of connection timing",
    "bytes_cov": "payload size regularity",
    "mean_bytes": "average payload size",
    "num_connections": "total connection count",
    "session_duration": "total session duration (seconds)",
    "pct_connections_off_hours": "fraction of activity during off-hours",
    "mean_connection_duration": "average connection duration",
    "failed_connection_ratio": "fraction of failed connections",
    "payload_entropy": "entropy of payload size distribution",
}

# Result table columns, in order.
RESULT_COLUMNS = [
    "src_ip", "dst_ip", "dst_domain", "dst_port", "num_connections",
    "interval_cov", "mean_interval", "deterministic_score", "ml_score",
    "final_verdict", "beacon_type_guess", "suggested_mitre_technique",
    "ml_explanation", "allowlist_reason",
]

RESULT_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c == "dst_port" else T.LongType() if c == "num_connections" else
                                            T.DoubleType() if c in ("interval_cov", "mean_interval", "deterministic_score", "ml_score")
                                            else T.StringType()) for c in RESULT_COLUMNS])

# Verdict thresholds (strict comparisons).
HIGH_THRESHOLD = 75.0
MEDIUM_THRESHOLD = 40.0
ML_MEDIUM_THRESHOLD = 70.0
VERDICTS = ["HIGH", "MEDIUM", "CLEAR", "SUPPRESSED"]

# Feature defaults.
MIN_CONNECTIONS = 10
OFF_HOURS = (0, 5)          # hours 0..5 inclusive, UTC
ENTROPY_BINS = 20
AUTOCORR_MAX_LAG = 5
BURST_FACTOR = 5.0
