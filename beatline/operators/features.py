"""Per-flow features F0–F20 (W1–W7) as one windowed aggregate.

Plan shape (checked with ``explain`` in the tests): the records are hash
partitioned once on the flow key; one window stage sorted by
``(key, ts_us, tiebreak)`` adds six time lags, whose differences are the
inter-arrival delta and its lags, another the per-flow medians; the ``groupBy`` on the same key reuses that partitioning,
so the whole feature table costs **one** exchange of the records.  F20
(hosts per destination) adds one small exchange on the per-flow table.

Hot keys: a single flow may hold a large share of all records.  Ordered
windows put a flow into one task, so the records of flows above ``hot_flow_rows``
are dealt otherwise (``beatline.operators.hotflows``): by time slices whose borders
are stitched.  Both ways sum up the same exact integers and share
:func:`finish_features`, so a flow's features do not depend on the way, on the
number of partitions or on the order of rows, to the last bit.

Moments: every value is taken as an integer (microseconds, bytes, nanoseconds)
less an integer near its mean; sums of these, of their squares and of their lag
products are exact decimals.  The rest of the mean (below one unit) is taken
out of the sums at the end: ``sum((x - mean)^2) = sum(c^2) - n * rest^2``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.columns import (
    MICROS_PER_SECOND, present,
)
from beatline.operators.grouping import default_tiebreak, normalize_connections
from beatline.schemas import (
    AUTOCORR_MAX_LAG, BURST_FACTOR, ENTROPY_BINS, FEATURE_COLUMNS, FLOW_KEY,
    INTEGER_FEATURES, MIN_CONNECTIONS, OFF_HOURS,
)

US = float(MICROS_PER_SECOND)
US_SQL = "1e6"          # a double literal in SQL text (``1000000.0`` would be DECIMAL)
# Flows with more records than this leave the single-task window route.
DEFAULT_HOT_FLOW_ROWS = 2_000_000


def flow_rows(connections: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Normalised records reduced to what the features read (column pruning).

    Value columns get their NULL and NaN → 0 defaults (P5); ``_tb*`` are the order
    tiebreaks.
    """
    df = normalize_connections(connections)
    tb = tiebreak if tiebreak is not None else default_tiebreak(df)

    def value(name: str, kind: str) -> Column:
        return F.coalesce(present(df, name).cast(kind), F.lit(0).cast(kind))
    sent, recv = value("bytes_sent", "bigint"), value("bytes_received", "bigint")
    return df.select(
        *FLOW_KEY, "ts_us",
        *[F.col(c).alias(f"_tb{i}") for i, c in enumerate(tb)],
        value("packet_size", "double").alias("_ps"),
        sent.alias("_sent"), recv.alias("_recv"), (sent + recv).alias("_tot"),
        value("connection_duration", "double").alias("_dur"),
        value("is_failed", "int").alias("_failed"),
        value("has_dns_lookup", "int").alias("_dns"),
        F.coalesce(F.col("dst_domain").cast("string"), F.lit("")).alias("_domain"),
    )


def exact_sum(c: str):
    """Order-independent sum of a double column (decimal(38,9) accumulator).

    A float sum depends on the order rows arrive in, i.e. on partitioning;
    summing at nanounit precision in decimal makes the result identical for
    any shuffle order (and equal to the oracle's), then it is cast back.
    """
    return F.sum(F.col(c).cast("decimal(38,9)"))


def centres() -> dict[str, Column]:
    """Integers near the means of a flow's deltas, bytes and durations (in nanoseconds)."""
    return {"_md": F.expr("case when _m > 1 then (_tmax - _tmin) div (_m - 1) end"),
            "_mb": F.expr("_stot div _n"),
            "_mn": F.expr(f"cast(_sdur * {NANOS} / _n as decimal(28,0))")}


def _product(a: str, b: str) -> str:
    return f"sum(cast({a} as decimal(19,0)) * cast({b} as decimal(19,0)))"


#: The duration in nanoseconds, the grid of its sums, less the integer near the mean.
_NANO = "cast(cast(_dur as decimal(28,9)) * 1000000000 as decimal(28,0)) - _mn"
NANOS = 1_000_000_000


def volume_moments() -> list[str]:
    """Sums of squares of bytes and durations around their centres."""
    return [f"{_product('_tot - _mb', '_tot - _mb')} as _qtot", "max(_mb) as _mb",
            f"{_product(_NANO, _NANO)} as _qdur", "max(_mn) as _mn"]


def _order_cols(df: DataFrame) -> list[Column]:
    tbs = sorted(c for c in df.columns if c.startswith("_tb"))
    return [F.col("ts_us").asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tbs]


def _window_stage(rows: DataFrame, min_connections: int) -> DataFrame:
    """W1–W5 on one sorted partitioning; keeps flows with ≥ min records."""
    w = Window.partitionBy(*FLOW_KEY).orderBy(*_order_cols(rows))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s1 = rows.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("_n"),
        F.count("ts_us").over(whole).alias("_m"),
        F.min("ts_us").over(whole).alias("_tmin"),
        F.max("ts_us").over(whole).alias("_tmax"),
        *[F.lag("ts_us", k).over(w).alias(f"_lag{k}") for k in range(1, AUTOCORR_MAX_LAG + 2)],
        # the earliest record's domain (NULL times sort last), constant per flow
        F.first("_domain").over(w).alias("_fd"),
        F.min("_ps").over(whole).alias("_lo"),
        F.max("_ps").over(whole).alias("_hi"),
        F.sum("_tot").over(whole).alias("_stot"),
        exact_sum("_dur").over(whole).alias("_sdur"),
    ).where(F.col("_n") >= F.lit(min_connections))
    s1 = s1.withColumns({
        "_d_us": F.col("ts_us") - F.col("_lag1"),
        **{f"_dl{k}": F.col(f"_lag{k}") - F.col(f"_lag{k + 1}") for k in range(1, AUTOCORR_MAX_LAG + 1)},
        # the deltas telescope to (last − first), so their mean is known before they are
        **centres(),
    })
    # medians need an unordered window; placed after the ordered stages the
    # rows are already sorted by key, so no further sort is planned.  Keeping
    # them out of the aggregate lets it be a code-generated hash aggregate.
    flow = Window.partitionBy(*FLOW_KEY)
    s3 = s1.withColumn("_med", F.median("_d_us").over(flow))
    return s3.withColumn("_mad", F.median(F.abs(F.col("_d_us") - F.col("_med"))).over(flow))


def _entropy_bin() -> Column:
    """20 equal-width bins over the flow's own size range, last bin closed."""
    width = F.col("_hi") - F.col("_lo")
    b = F.floor((F.col("_ps") - F.col("_lo")) / width * F.lit(float(ENTROPY_BINS)))
    return F.when(F.col("_hi") > F.col("_lo"),
                  F.least(F.lit(ENTROPY_BINS - 1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))


def feature_aggregates() -> list[Column]:
    """Aggregate expressions over the windowed rows (F1–F19 raw inputs).

    Stated as SQL expression text: one JVM call per expression keeps plan
    construction cheap.  Shared by the ordinary and the hot-flow route.
    """
    lo, hi = OFF_HOURS
    hour = "floor(pmod(ts_us, 86400000000) / 3600000000)"
    exprs = [
        "count(1) as _n", "count(_d_us) as _L", "max(ts_us) as _tmax", "min(ts_us) as _tmin",
        "max(_md) as _md", f"{_product('_d_us - _md', '_d_us - _md')} as _qd",
        *[f"{_product('_d_us - _md', f'_dl{k} - _md')} as _p{k}" for k in range(1, AUTOCORR_MAX_LAG + 1)],
        *[f"sum(case when _d_us is not null and _dl{k} is not null then (_d_us - _md) + (_dl{k} - _md) end) as _s{k}"
          for k in range(1, AUTOCORR_MAX_LAG + 1)],
        "max(_mad) as _mad_us",
        f"sum(case when ts_us is not null and {hour} between {lo} and {hi} then 1 else 0 end) as _off",
        "sum(_tot) as _stot", "max(_tot) as _maxtot", *volume_moments(),
        "sum(_sent) as _ssent", "sum(_recv) as _srecv", "max(_hi) as _hi", "max(_lo) as _lo",
        *[f"count_if(_bin = {b}) as _b{b}" for b in range(ENTROPY_BINS)],
        "sum(cast(_dur as decimal(38,9))) as _sdur", "sum(_failed) as _sfailed", "sum(_dns) as _sdns",
    ]
    return [F.expr(e) for e in exprs]


def _first_domain_from_cols() -> Column:
    return F.min(F.struct(F.col("ts_us").isNull().alias("a"), F.col("ts_us").alias("b"),
                          F.col("_tbkey").alias("t"), F.col("_domain").alias("z"))).getField("z")


def finish_features(agg: DataFrame) -> DataFrame:
    """Turn the aggregate's sums into F1–F19 (scalar expressions only).

    The shared intermediates (what the centres lack of the means, then means and
    standard deviations) become columns first, so later expressions name them instead
    of repeating their trees; SQL expression text keeps plan building cheap.
    """
    lags = range(1, AUTOCORR_MAX_LAG + 1)
    rest = agg.selectExpr(
        "*", "case when _L > 0 then cast(_tmax - _tmin - _L * _md as double) / _L else 0.0 end as _rd",
        "cast(_stot - _n * _mb as double) / _n as _rb",
        f"cast(cast(_sdur * {NANOS} as decimal(38,0)) - _n * _mn as double) / _n as _rn")
    rest = rest.selectExpr(
        "*", "greatest(cast(_qd as double) - _L * _rd * _rd, 0.0) / 1e12 as _var",
        *[f"(cast(_p{k} as double) - _rd * cast(_s{k} as double) + greatest(_L - {k}, 0) * _rd * _rd) / 1e12 as _ac{k}" for k in lags],
        "greatest(cast(_qtot as double) - _n * _rb * _rb, 0.0) as _sstot",
        "greatest(cast(_qdur as double) - _n * _rn * _rn, 0.0) / 1e18 as _ssdur")
    ent = " + ".join(f"(case when _b{b} > 0 then _b{b} / _n * log2(_b{b} / _n) else 0.0 end)"
                     for b in range(ENTROPY_BINS))
    acmax = "greatest(" + ", ".join(f"abs(_ac{k})" for k in range(1, AUTOCORR_MAX_LAG + 1)) + ")"
    stage = rest.selectExpr(
        *FLOW_KEY, "dst_domain", "_n", "_srecv", "_ssent", "_maxtot", "_off", "_sdur", "_ssdur",
        "_sfailed", "_sdns", "_tmax", "_tmin", "_L", "_mad_us",
        f"case when _L > 0 then (_tmax - _tmin) / _L / {US_SQL} else 0.0 end as _mean_iv",
        "case when _L > 1 then sqrt(_var / (_L - 1)) else 0.0 end as _std_iv",
        f"case when _L >= {AUTOCORR_MAX_LAG + 2} and _var > 0 then {acmax} / _var else 0.0 end as _autocorr",
        "_stot / _n as _mean_b",
        "case when _n > 1 then sqrt(_sstot / (_n - 1)) else 0.0 end as _std_b",
        f"case when _n >= 2 and _hi > _lo then -({ent}) else 0.0 end as _entropy",
    )
    cols = {
        "mean_interval": "_mean_iv",
        "std_interval": "_std_iv",
        "interval_cov": "case when _mean_iv = 0 then 0.0 else _std_iv / _mean_iv end",
        "interval_mad": f"case when _L > 1 then _mad_us / {US_SQL} else 0.0 end",
        "autocorrelation_score": "_autocorr",
        "session_duration": f"coalesce((_tmax - _tmin) / {US_SQL}, 0.0)",
        "pct_connections_off_hours": "_off / _n",
        "mean_bytes": "_mean_b",
        "std_bytes": "_std_b",
        "bytes_cov": "case when _mean_b = 0 then 0.0 else _std_b / _mean_b end",
        "bytes_sent_received_ratio": "case when _srecv = 0 then 0.0 else (_ssent / _n) / (_srecv / _n) end",
        "payload_entropy": "_entropy",
        "has_anomalous_burst": f"case when _mean_b > 0 and _maxtot > double({BURST_FACTOR!r}) * _mean_b then 1 else 0 end",
        "num_connections": "_n",
        # dst_port is part of the flow key, so every flow has exactly one (T5)
        "num_unique_ports": "1",
        "mean_connection_duration": "cast(_sdur as double) / _n",
        "std_connection_duration": "case when _n > 1 then sqrt(_ssdur / (_n - 1)) else 0.0 end",
        "failed_connection_ratio": "_sfailed / _n",
        "is_direct_ip_no_dns": "case when _sdns / _n < 0.5 then 1 else 0 end",
    }
    out = stage.selectExpr(*FLOW_KEY, "dst_domain", *[f"{v} as {k}" for k, v in cols.items()])
    # P6 on plain column references (NaN / ±inf → 0)
    fin = [k if k in INTEGER_FEATURES else
           f"case when isnan({k}) or abs({k}) = double('inf') or {k} is null then 0.0 else {k} end as {k}"
           for k in cols]
    return out.selectExpr(*FLOW_KEY, "dst_domain", *fin)


def flow_census(rows: DataFrame) -> DataFrame:
    """Per flow key: records, timed records, first and last time.

    A partial aggregate over the key and time columns only; it feeds both
    the hot-flow check and F20 (so the feature table is never joined with
    an aggregate of itself, which would plan the features twice).
    """
    return rows.groupBy(*FLOW_KEY).agg(F.count(F.lit(1)).alias("_n"), F.count("ts_us").alias("_m"),
                                       F.min("ts_us").alias("_tmin"), F.max("ts_us").alias("_tmax"))


def add_cross_flow(features: DataFrame, census: DataFrame, min_connections: int = MIN_CONNECTIONS) -> DataFrame:
    """F20 (J4/W7): sources per destination over *retained* flows.

    Keys are unique, so this is a count of retained flow keys per
    (dst_ip, dst_port), taken from the census and joined on the
    destination.  A destination shared by a large share of all flows is
    counted map-side, and AQE can split its side of the join, where a window
    would hand the whole destination to one task.
    """
    hosts = (census.where(F.col("_n") >= F.lit(min_connections)).groupBy("dst_ip", "dst_port")
             .agg(F.count(F.lit(1)).alias("num_internal_hosts_contacting")))
    return features.join(hosts, ["dst_ip", "dst_port"], "inner")


def _with_tbkey(rows: DataFrame) -> DataFrame:
    tbs = sorted(c for c in rows.columns if c.startswith("_tb") and c != "_tbkey")
    key = F.struct(*[F.col(c) for c in tbs]) if tbs else F.lit(None).cast("int")
    return rows.withColumn("_tbkey", key)


def per_flow_features(rows: DataFrame, min_connections: int = MIN_CONNECTIONS) -> DataFrame:
    """F0–F19 for the window route (rows from :func:`flow_rows`)."""
    staged = _window_stage(rows, min_connections).withColumn("_bin", _entropy_bin())
    # the domain is constant per flow: as a grouping key it keeps the
    # aggregate buffer fixed-width (hash aggregate), and hash(flow key)
    # still satisfies the clustering, so no exchange is added
    agg = (staged.groupBy(*FLOW_KEY, F.col("_fd").alias("dst_domain"))
           .agg(*feature_aggregates()))
    return finish_features(agg)


def engineer_features(connections: DataFrame, min_connections: int = MIN_CONNECTIONS,
                      tiebreak: list[str] | None = None,
                      hot_flow_rows: int | None = DEFAULT_HOT_FLOW_ROWS) -> DataFrame:
    """Group → per-flow features → cross-flow feature.

    ``hot_flow_rows``: flows above this many records are computed by the
    sliced route; ``None`` sends every flow through the window route.  With
    the check on, the per-flow census is checkpointed (shared checkpoint
    folder): it is read by the check and by F20.
    """
    rows = flow_rows(connections, tiebreak)
    census = flow_census(rows)
    if hot_flow_rows is None:
        per_flow = per_flow_features(rows, min_connections)
    else:
        from beatline.operators import hotflows
        from beatline.session import checkpoint_dir
        checkpoint_dir(rows.sparkSession)
        census = census.checkpoint(eager=True)
        # P3 first: records of flows below the minimum leave before the sort and
        # the windows (the semi join is hash-partitioned on the flow key, which
        # the windows reuse, so no record exchange is added)
        if min_connections > 1:
            kept = census.where(F.col("_n") >= F.lit(min_connections)).select(*FLOW_KEY)
            rows = rows.join(kept, FLOW_KEY, "left_semi")
        per_flow = hotflows.split_and_compute(rows, min_connections, hot_flow_rows, census)
    return add_cross_flow(per_flow, census, min_connections).select(*FLOW_KEY, "dst_domain", *FEATURE_COLUMNS)


def inter_arrivals(connections: DataFrame, min_connections: int = MIN_CONNECTIONS,
                   tiebreak: list[str] | None = None,
                   hot_flow_rows: int | None = DEFAULT_HOT_FLOW_ROWS) -> DataFrame:
    """Each record of a retained flow with the seconds since the flow's
    previous record in time order (NULL for the first and for NULL times).

    Flows above ``hot_flow_rows`` records get their lags from time slices
    stitched exactly (``hotflows.stitched_lags``) instead of one window task.
    """
    rows = flow_rows(connections, tiebreak)

    def window_route(r: DataFrame) -> DataFrame:
        w = Window.partitionBy(*FLOW_KEY).orderBy(*_order_cols(r))
        n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return (r.select("*", n.alias("_n"), F.lag("ts_us", 1).over(w).alias("_lag1"))
                .where(F.col("_n") >= F.lit(min_connections)).drop("_n"))

    if hot_flow_rows is None:
        out = window_route(rows)
    else:
        from beatline.operators import hotflows
        hot = hotflows.hot_flow_table(flow_census(rows), hot_flow_rows, min_connections)
        n_hot = hot.count()
        if n_hot == 0:
            out = window_route(rows)
        else:
            hb = F.broadcast(hot) if n_hot <= hotflows.MAX_BROADCAST_HOT_FLOWS else hot
            cold = window_route(rows.join(hb.select(*FLOW_KEY), FLOW_KEY, "left_anti"))
            hot_rows = _with_tbkey(rows.join(hb, FLOW_KEY, "inner"))
            hot_part = hotflows.stitched_lags(hot_rows, hot_flow_rows, lags=1).select(*cold.columns)
            out = cold.unionByName(hot_part)
    return out.withColumn("inter_arrival_s", (F.col("ts_us") - F.col("_lag1")) / F.lit(US)).drop("_lag1")
