"""Investigation queries: P8–P10, P12 helpers, W8, A11–A15, O4–O6.

The data behind the reference's dashboard and notebook views; rendering is
left to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.columns import MICROS_PER_SECOND, safe_div
from beatline.operators.grouping import normalize_connections
from beatline.schemas import FLOW_KEY
from beatline.session import checkpoint_dir


def top_k(df: DataFrame, k: int, by: str = "deterministic_score") -> DataFrame:
    """The ``k`` best rows (score desc, flow key as tiebreak) — TakeOrderedAndProject."""
    return df.orderBy(F.desc(by), *[c for c in FLOW_KEY if c in df.columns]).limit(k)


def alert_filter(results: DataFrame, verdicts=None, beacon_types=None,
                 min_det: float = 0.0, min_ml: float = 0.0) -> DataFrame:
    """Verdict IN, class IN, score floors; an empty selection means all."""
    cond = (F.col("deterministic_score") >= F.lit(min_det)) & (F.col("ml_score") >= F.lit(min_ml))
    if verdicts:
        cond = cond & F.col("final_verdict").isin(list(verdicts))
    if beacon_types and "beacon_type_guess" in results.columns:
        cond = cond & F.col("beacon_type_guess").isin(list(beacon_types))
    return results.where(cond)


def flow_drilldown(connections: DataFrame, src_ip: str, dst_ip: str, dst_port: int) -> DataFrame:
    """One flow's records in time order (filters reach the scan)."""
    rows = normalize_connections(connections)
    return (rows.where((F.col("src_ip") == src_ip) & (F.col("dst_ip") == dst_ip)
                       & (F.col("dst_port") == dst_port))
            .orderBy(F.col("ts_us").asc_nulls_last(),
                     *[c for c in ("flow_id", "packet_idx") if c in rows.columns]))


def host_pivot(results: DataFrame, src_ip: str) -> DataFrame:
    """P10: every flow of one internal host, best first."""
    cols = [c for c in ["dst_ip", "dst_domain", "dst_port", "final_verdict", "deterministic_score",
                        "ml_score", "num_connections", "beacon_type_guess"] if c in results.columns]
    return results.where(F.col("src_ip") == src_ip).select(*cols).orderBy(
        F.desc("deterministic_score"), "dst_ip", "dst_port")


def host_destination_count(results: DataFrame, src_ip: str) -> DataFrame:
    """P10: number of destinations one host contacts."""
    return results.where(F.col("src_ip") == src_ip).agg(F.count(F.lit(1)).alias("num_destinations"))


def host_domain_counts(results: DataFrame, src_ip: str) -> DataFrame:
    """Domain counts for one host, '' excluded."""
    return (results.where((F.col("src_ip") == src_ip) & (F.col("dst_domain") != ""))
            .groupBy("dst_domain").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "dst_domain"))


def host_list(results: DataFrame) -> DataFrame:
    """Sorted distinct internal hosts."""
    return results.select("src_ip").distinct().orderBy("src_ip")


def timeline(connections: DataFrame) -> DataFrame:
    """Seconds since the flow's first record (the "comb" plot data)."""
    rows = normalize_connections(connections)
    # first time per flow: partial aggregate joined back (hot flows split by AQE)
    first = rows.groupBy(*FLOW_KEY).agg(F.min("ts_us").alias("_first"))
    return rows.join(first, FLOW_KEY, "inner").select(
        *FLOW_KEY, "ts_us", ((F.col("ts_us") - F.col("_first")) / F.lit(float(MICROS_PER_SECOND))).alias("offset_s"))


def timeline_caption(connections: DataFrame) -> DataFrame:
    """Per flow, mean interval and population-std CoV (0 when the mean is 0,
    both NULL for a flow without intervals).

    Built on W1 (hot flows sliced) and a partial aggregate; the deltas
    telescope, so the mean is (last − first) / count, exact in µs.
    """
    from beatline.operators.features import inter_arrivals
    d = inter_arrivals(connections, min_connections=1)
    g = d.groupBy(*FLOW_KEY).agg(
        F.count(F.lit(1)).alias("num_connections"),
        (safe_div(F.max("ts_us") - F.min("ts_us"), F.count("inter_arrival_s"), None)
         / F.lit(float(MICROS_PER_SECOND))).alias("mean_interval"),
        F.stddev_pop("inter_arrival_s").alias("_sd"))
    return g.select(*FLOW_KEY, "num_connections", "mean_interval",
                    F.when(F.col("mean_interval").isNotNull(), safe_div("_sd", "mean_interval")).alias("cov"))


def sample_per_class(truth: DataFrame, seed: int = 42, class_col: str = "beacon_type") -> DataFrame:
    """One pseudo-random flow per class, reproducible for a seed.

    ``min_by`` over a seeded hash — an aggregate, so a class holding most of
    the rows is reduced map-side rather than sorted in one task.
    """
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in FLOW_KEY], F.lit(str(seed))))
    key = F.struct(*[F.col(c) for c in FLOW_KEY])
    return (truth.groupBy(class_col).agg(F.min_by(key, h).alias("_k"))
            .select(class_col, *[F.col("_k").getField(c).alias(c) for c in FLOW_KEY]))


def histogram(df: DataFrame, value: str, by: str | None = None, bins: int = 30,
              density: bool = False, clip_upper: float | None = None,
              transform: str | None = None) -> DataFrame:
    """Fixed-width histogram of ``value`` per ``by`` group.

    Each group gets its own range (min..max of that group), as a per-series
    histogram call does; the last bin is closed.  Range per group is an
    aggregate joined back on the (few) groups; Spark broadcasts it by its size.
    ``transform='log1p'`` and ``clip_upper`` prepare the value first.
    """
    x = F.col(value).cast("double")
    if transform == "log1p":
        x = F.log1p(x)
    if clip_upper is not None:
        x = F.least(x, F.lit(float(clip_upper)))
    grp = [F.col(by)] if by else []
    # the upstream plan runs once: ranges and bins both read the two columns from the shared folder
    checkpoint_dir(df.sparkSession)
    base = df.select(*grp, x.alias("_x")).where(F.col("_x").isNotNull()).checkpoint(eager=True)
    ranges = base.groupBy(*grp).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                    F.count(F.lit(1)).alias("_n"))
    if by:
        joined = base.join(ranges, by)
    else:
        r = ranges.collect()[0]
        lo, hi, n = r["_lo"], r["_hi"], r["_n"]
        joined = base.withColumns({"_lo": F.lit(lo), "_hi": F.lit(hi), "_n": F.lit(n)})
    # a zero-width range puts everything into one bin of width 1 around it
    lo = F.when(F.col("_hi") > F.col("_lo"), F.col("_lo")).otherwise(F.col("_lo") - 0.5)
    hi = F.when(F.col("_hi") > F.col("_lo"), F.col("_hi")).otherwise(F.col("_hi") + 0.5)
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.lit(bins - 1).cast("bigint"), F.floor((F.col("_x") - lo) / (hi - lo) * F.lit(float(bins))))
    out = (joined.select(*grp, b.alias("bin"), (lo + b * width).alias("bin_start"),
                         (lo + (b + 1) * width).alias("bin_end"), "_n", width.alias("_w"))
           .groupBy(*grp, "bin", "bin_start", "bin_end", "_n", "_w")
           .agg(F.count(F.lit(1)).alias("count")))
    if density:
        out = out.withColumn("density", F.col("count") / (F.col("_n") * F.col("_w")))
    return out.drop("_n", "_w")


def scatter_points(results: DataFrame, by: str = "final_verdict") -> DataFrame:
    """(interval_cov, num_connections) per point with its group."""
    return results.select(by, "interval_cov", "num_connections")


def scatter_density(results: DataFrame, by: str = "final_verdict", per_decade: int = 10) -> DataFrame:
    """A15 at scale: counts on a log-log grid (``per_decade`` cells per decade);
    zero CoV gets its own column (NULL bucket)."""
    cov = F.col("interval_cov")
    cx = F.when(cov > 0, F.floor(F.log10(cov) * F.lit(float(per_decade)))).cast("bigint")
    cy = F.floor(F.log10(F.col("num_connections").cast("double")) * F.lit(float(per_decade))).cast("bigint")
    return (results.groupBy(by, cx.alias("cov_cell"), cy.alias("conn_cell"))
            .agg(F.count(F.lit(1)).alias("count")))


def protocol_counts(flows: DataFrame) -> DataFrame:
    """Records per protocol."""
    return flows.groupBy("protocol").agg(F.count(F.lit(1)).alias("count"))


def top_ports(flows: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent destination ports (port as tiebreak)."""
    return (flows.groupBy("dst_port").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "dst_port").limit(k))


def parse_summary(flows: DataFrame) -> DataFrame:
    """Distinct sources and destinations, size range (one row)."""
    return flows.agg(F.count(F.lit(1)).alias("num_records"),
                     F.count_distinct("src_ip").alias("unique_src"),
                     F.count_distinct("dst_ip").alias("unique_dst"),
                     F.min("packet_size").alias("min_size"), F.max("packet_size").alias("max_size"))


def explanation_parts(results: DataFrame) -> DataFrame:
    """One row per '; '-separated part of each non-empty explanation."""
    e = F.coalesce(F.col("ml_explanation"), F.lit(""))
    return (results.where(F.length(e) > 0)
            .select(*[c for c in FLOW_KEY if c in results.columns],
                    F.posexplode(F.split(e, "; ")).alias("part_idx", "part")))
