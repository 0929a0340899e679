"""Flow grouping: P1–P5, A3, A4, A16.

A *flow* is every connection record sharing (src_ip, dst_ip, dst_port).
Nothing is materialised per flow: the grouping is a hash partitioning on the
key that the feature windows and the final aggregate share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.columns import epoch_micros, present, require_columns
from beatline.schemas import CONNECTION_VALUE_COLUMNS, FLOW_KEY, MIN_CONNECTIONS

TIEBREAK_CANDIDATES = ("file", "packet_idx", "flow_id")


def default_tiebreak(df: DataFrame) -> list[str]:
    """Columns that order records sharing a timestamp (deterministic reruns)."""
    return [c for c in TIEBREAK_CANDIDATES if c in df.columns]


def normalize_connections(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Required columns, time as ``ts_us``, no null keys.

    * ``ts_us`` (bigint µs since the epoch, UTC) is added from ``time_col``
      unless the input already carries it;
    * optional value columns that are absent are added as NULL (they count
      as 0 downstream), ``dst_domain`` as '' when absent;
    * rows with a NULL (or NaN) key component are dropped (pandas' groupby drops them).
    """
    has_us = "ts_us" in df.columns
    require_columns(df, FLOW_KEY + ([] if has_us else [time_col]), "group_flows")
    out = df
    if not has_us:
        out = out.withColumn("ts_us", epoch_micros(time_col, df.schema[time_col].dataType))
    add = {c: F.lit(None).cast(t) for c, t in CONNECTION_VALUE_COLUMNS.items()
           if c not in out.columns}
    if "dst_domain" not in out.columns:
        add["dst_domain"] = F.lit("")
    if add:
        out = out.withColumns(add)
    out = out.withColumn("dst_port", present(out, "dst_port").cast("int"))
    # explicit IS NOT NULL predicates reach the Parquet reader (dropna's
    # AtLeastNNonNulls would not)
    return out.where(F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull()
                     & F.col("dst_port").isNotNull())


def group_flows(df: DataFrame, min_connections: int = MIN_CONNECTIONS) -> DataFrame:
    """A3: records of flows with at least ``min_connections`` rows.

    Returns the tagged connection table (``ts_us`` and the flow's
    ``num_connections`` added).  The count is a partial aggregate joined
    back on the key (HAVING before the join), so a flow with a large share of
    all records is counted map-side and its join partition can be split by
    AQE, instead of being handed whole to one window task.
    """
    rows = normalize_connections(df)
    counts = (rows.groupBy(*FLOW_KEY).agg(F.count(F.lit(1)).alias("num_connections"))
              .where(F.col("num_connections") >= F.lit(min_connections)))
    return rows.join(counts, FLOW_KEY, "inner")


def flow_summary(df: DataFrame, min_connections: int = MIN_CONNECTIONS) -> DataFrame:
    """A4: one row per retained flow with count, first and last time, by count desc.

    A plain ``groupBy`` (partial aggregation before the shuffle), HAVING for
    the minimum; ordering ties are broken by the key for a total order.
    """
    rows = normalize_connections(df)
    return (rows.groupBy(*FLOW_KEY)
            .agg(F.count(F.lit(1)).alias("num_connections"),
                 F.min("ts_us").alias("first_seen_us"),
                 F.max("ts_us").alias("last_seen_us"))
            .where(F.col("num_connections") >= F.lit(min_connections))
            .withColumns({"first_seen": F.timestamp_micros("first_seen_us"),
                          "last_seen": F.timestamp_micros("last_seen_us")})
            .orderBy(F.desc("num_connections"), *FLOW_KEY))


def flow_totals(df: DataFrame, min_connections: int = MIN_CONNECTIONS) -> DataFrame:
    """Total groups, retained groups (≥ min), filtered groups — one row."""
    rows = normalize_connections(df)
    per_key = rows.groupBy(*FLOW_KEY).agg(F.count(F.lit(1)).alias("n"))
    kept = F.col("n") >= F.lit(min_connections)
    return per_key.agg(F.count(F.lit(1)).alias("total_groups"),
                       F.count_if(kept).alias("retained_groups"),
                       F.count_if(~kept).alias("filtered_groups"),
                       F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("retained_records"))
