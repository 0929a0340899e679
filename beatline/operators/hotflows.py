"""Features for flows too large for one task (the hot-key route).

The ordinary route sorts each flow inside one window partition; a flow with
a large share of all records would then be processed by a single task.
Flows with more than ``hot_flow_rows`` records come here instead:

1. **find them** — ``groupBy(key).count()`` is a partial aggregate (map-side
   combine), so even a flow with a third of all rows costs one small row
   per map task.  There are at most ``N / hot_flow_rows`` hot flows; that
   bound is checked before their table is broadcast.
2. **order-free features** (volumes, durations, counts, entropy bins,
   first domain) are plain aggregates by key — partial aggregation again.
3. **inter-arrival features** need time order.  The records are cut into
   slices of about ``hot_flow_rows`` by a range partitioning on (flow, time,
   tiebreak); lags 1–6 are computed per (flow, slice) window.  A slice's first six rows lack their
   predecessors, which are the last rows of earlier slices: a small table
   of every slice's first and last six rows, windowed per flow, supplies
   them exactly.  Deltas and lagged deltas follow from the six lags.
4. the delta statistics (count, sums of squares and lag products) are reduced
   through a ``(flow, delta)`` value-count aggregate — partial
   aggregation again — and median and MAD are found by cumulating value
   counts over ranges of values, so no task holds all values of a flow.

The output has the columns of the ordinary route's aggregate, the same exact
integers, and the same finishing expressions turn it into F1–F19: where a flow is
computed cannot be seen in its features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.columns import hour_of_day_utc
from beatline.operators import features as ft
from beatline.schemas import AUTOCORR_MAX_LAG, ENTROPY_BINS, FLOW_KEY, OFF_HOURS

LAGS = AUTOCORR_MAX_LAG + 1          # ts lags needed for a delta and its 5 predecessors
MAX_BROADCAST_HOT_FLOWS = 1_000_000


def hot_flow_table(census: DataFrame, hot_flow_rows: int, min_connections: int = 1) -> DataFrame:
    """Hot flows of a census (``features.flow_census``): more than
    ``hot_flow_rows`` records (and at least ``min_connections``)."""
    return census.where((F.col("_n") > F.lit(hot_flow_rows)) & (F.col("_n") >= F.lit(min_connections)))


def split_and_compute(rows: DataFrame, min_connections: int, hot_flow_rows: int,
                      census: DataFrame | None = None) -> DataFrame:
    """Per-flow F0–F19 raw columns, hot flows routed through time slices."""
    if census is None:
        census = ft.flow_census(rows)
    hot = hot_flow_table(census, hot_flow_rows, min_connections)
    hot_rows_n = hot.count()          # small action: at most N / hot_flow_rows rows
    if hot_rows_n == 0:
        return ft.per_flow_features(rows, min_connections)
    hb = F.broadcast(hot) if hot_rows_n <= MAX_BROADCAST_HOT_FLOWS else hot
    cold_rows = rows.join(hb.select(*FLOW_KEY), FLOW_KEY, "left_anti")
    hot_rows = rows.join(hb, FLOW_KEY, "inner")
    cold = ft.per_flow_features(cold_rows, min_connections)
    return cold.unionByName(hot_features(hot_rows, hot, hot_flow_rows, hot_rows_n))


def time_slices(rows: DataFrame, hot_flow_rows: int, key: list[str] = FLOW_KEY) -> DataFrame:
    """``_slice``: runs of about ``hot_flow_rows`` records in (key, time, tiebreak) order.

    A range partitioning by all of them, so records of one instant, bursts and NULL
    times (last in their group) are cut like any others; records that agree in all
    of it are told apart by their place, which no lag depends on.  The sliced
    records are written to the shared checkpoint folder, so a slice keeps its rows.
    """
    from beatline.session import checkpoint_dir
    checkpoint_dir(rows.sparkSession)
    n = max(1, -(-rows.count() // hot_flow_rows))
    order = [*key, F.col("ts_us").asc_nulls_last(), F.col("_tbkey").asc_nulls_last(), "_place"]
    out = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n, *order)
    return out.withColumn("_slice", F.spark_partition_id()).drop("_place").checkpoint(eager=True)


def weighted_median(counts: DataFrame, key: list[str], value: str, weight: str, target_rows: int) -> DataFrame:
    """(key, median) of values with their numbers of occurrences, exact, for any number of values.

    Values are cut into ranges of about ``target_rows`` rows; the totals of the ranges
    (a small table) are cumulated per key, and only the ranges that hold the middle
    are cumulated value by value.
    """
    n = max(1, -(-counts.count() // target_rows))
    cut = (counts.select(*key, F.col(value).alias("_v"), F.col(weight).alias("_w")).repartitionByRange(n, *key, "_v")
           .withColumn("_range", F.spark_partition_id()).checkpoint(eager=True))
    totals = cut.groupBy(*key, "_range").agg(F.sum("_w").alias("_t"))
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    placed = totals.select(*key, "_range", "_t", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"),
                           F.sum("_t").over(whole).alias("_n"))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)      # 0-based places of the middle
    held = placed.where((F.col("_before") <= high) & (F.col("_before") + F.col("_t") > low))
    inside = Window.partitionBy(*key, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut.join(held, [*key, "_range"]).withColumn("_end", F.col("_before") + F.sum("_w").over(inside))
    start = F.col("_end") - F.col("_w")

    def at(place) -> Column:
        return F.max(F.when((start <= place) & (place < F.col("_end")), F.col("_v")))
    return rows.groupBy(*key).agg(at(low).alias("_lo"), at(high).alias("_hi")).select(
        *key, ((F.col("_lo") + F.col("_hi")) / 2.0).alias("median"))


def stitched_lags(rows: DataFrame, hot_flow_rows: int, key: list[str] = FLOW_KEY, lags: int = LAGS) -> DataFrame:
    """Every row with ``_lag1.._lag{lags}`` (earlier times of its group in
    (ts_us, _tbkey) order), computed per time slice and exact across slices.

    In-slice windows give all lags except for a slice's first ``lags`` rows;
    those are recomputed over a small table holding each slice's first and
    last ``lags`` rows (≤ 2·lags per slice), whose window per group is
    bounded by the number of slices.
    """
    sliced = time_slices(rows, hot_flow_rows, key)
    order = [F.col("ts_us").asc_nulls_last(), F.col("_tbkey").asc_nulls_last()]
    w = Window.partitionBy(*key, "_slice").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    main = sliced.select("*", F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(whole).alias("_c"),
                         *[F.lag("ts_us", j).over(w).alias(f"_lag{j}") for j in range(1, lags + 1)])
    edges = main.where((F.col("_rn") <= lags) | (F.col("_rn") > F.col("_c") - lags)).drop(
        *[f"_lag{j}" for j in range(1, lags + 1)])
    w2 = Window.partitionBy(*key).orderBy(F.col("_slice"), *order)
    heads = (edges.select("*", *[F.lag("ts_us", j).over(w2).alias(f"_lag{j}") for j in range(1, lags + 1)])
             .where(F.col("_rn") <= lags))
    body = main.where(F.col("_rn") > lags)
    return heads.unionByName(body).drop("_rn", "_c")


def global_rank(rows: DataFrame, hot_flow_rows: int, key: list[str]) -> DataFrame:
    """``_rank``: 1-based position of each row in its group's (ts_us, _tbkey)
    order, for groups too large for one window task.

    Rank inside a time slice plus the count of all earlier slices; the
    per-slice counts are a small table (one row per slice).
    """
    sliced = time_slices(rows, hot_flow_rows, key)
    w = Window.partitionBy(*key, "_slice").orderBy(F.col("ts_us").asc_nulls_last(),
                                                   F.col("_tbkey").asc_nulls_last())
    counts = sliced.groupBy(*key, "_slice").agg(F.count(F.lit(1)).alias("_sc"))
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    prefix = counts.select(*key, "_slice", F.coalesce(F.sum("_sc").over(before), F.lit(0)).alias("_before"))
    return (sliced.withColumn("_rin", F.row_number().over(w)).join(prefix, key + ["_slice"])
            .withColumn("_rank", F.col("_before") + F.col("_rin")).drop("_rin", "_before", "_slice"))


def hot_features(hot_rows: DataFrame, hot: DataFrame, hot_flow_rows: int, n_hot: int) -> DataFrame:
    """F0–F19 (pre-finish columns) for rows of hot flows joined with their stats."""
    bc = (lambda d: F.broadcast(d)) if n_hot <= MAX_BROADCAST_HOT_FLOWS else (lambda d: d)
    rows = ft._with_tbkey(hot_rows)

    # -- order-free part: per-flow means first (for two-pass variances) -------
    means = rows.groupBy(*FLOW_KEY).agg(F.sum("_tot").alias("_stot"), ft.exact_sum("_dur").alias("_sdur"),
                                        F.min("_ps").alias("_lo"), F.max("_ps").alias("_hi"))
    r = rows.join(bc(means), FLOW_KEY).withColumns(ft.centres()).withColumn("_bin", ft._entropy_bin())
    plain = r.groupBy(*FLOW_KEY).agg(
        ft._first_domain_from_cols().alias("dst_domain"),
        F.count(F.lit(1)).alias("_n"), F.max("ts_us").alias("_tmax"), F.min("ts_us").alias("_tmin"),
        F.sum(F.when(F.col("ts_us").isNotNull()
                     & hour_of_day_utc("ts_us").between(*OFF_HOURS), 1).otherwise(0)).alias("_off"),
        F.sum("_tot").alias("_stot"), F.max("_tot").alias("_maxtot"),
        *[F.expr(e) for e in ft.volume_moments()],
        F.sum("_sent").alias("_ssent"), F.sum("_recv").alias("_srecv"),
        F.max("_hi").alias("_hi"), F.max("_lo").alias("_lo"),
        *[F.count_if(F.col("_bin") == F.lit(b)).alias(f"_b{b}") for b in range(ENTROPY_BINS)],
        ft.exact_sum("_dur").alias("_sdur"),
        F.sum("_failed").alias("_sfailed"), F.sum("_dns").alias("_sdns"),
    )

    # -- ordered part: time slices, in-slice lags, stitched slice heads --------
    lagged = stitched_lags(rows, hot_flow_rows)
    deltas = lagged.select(
        *FLOW_KEY, (F.col("ts_us") - F.col("_lag1")).alias("_d_us"),
        *[(F.col(f"_lag{k}") - F.col(f"_lag{k + 1}")).alias(f"_dl{k}") for k in range(1, AUTOCORR_MAX_LAG + 1)])

    # -- delta statistics through a (flow, delta) value-count aggregate --------
    vc = deltas.where(F.col("_d_us").isNotNull()).groupBy(*FLOW_KEY, "_d_us").agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.sum(F.col(f"_dl{k}").cast("decimal(19,0)")).alias(f"_sdl{k}") for k in range(1, AUTOCORR_MAX_LAG + 1)],
        *[F.count(f"_dl{k}").alias(f"_cdl{k}") for k in range(1, AUTOCORR_MAX_LAG + 1)])
    vc = vc.checkpoint(eager=True)
    med = weighted_median(vc, FLOW_KEY, "_d_us", "_cnt", hot_flow_rows).withColumnRenamed("median", "_med").checkpoint(eager=True)
    spread = (vc.join(bc(med), FLOW_KEY).groupBy(*FLOW_KEY, F.abs(F.col("_d_us") - F.col("_med")).alias("_dev"))
              .agg(F.sum("_cnt").alias("_cnt")))
    mad = weighted_median(spread, FLOW_KEY, "_dev", "_cnt", hot_flow_rows).withColumnRenamed("median", "_mad_us")
    v = vc.join(bc(hot.withColumns({"_stot": F.lit(0), "_sdur": F.lit(0)}).withColumns(ft.centres()).select(*FLOW_KEY, "_md")), FLOW_KEY)
    lags = range(1, AUTOCORR_MAX_LAG + 1)
    c = "cast(_d_us - _md as decimal(19,0))"
    dstats = v.groupBy(*FLOW_KEY).agg(*[F.expr(e) for e in (
        "sum(_cnt) as _L", "max(_md) as _md", f"sum({c} * {c} * cast(_cnt as decimal(19,0))) as _qd",
        *[f"sum({c} * (_sdl{k} - cast(_md as decimal(19,0)) * cast(_cdl{k} as decimal(19,0)))) as _p{k}" for k in lags],
        *[f"sum({c} * cast(_cdl{k} as decimal(19,0)) + _sdl{k} - cast(_md as decimal(19,0)) * cast(_cdl{k} as decimal(19,0))) as _s{k}"
          for k in lags])])
    out = (plain.join(dstats, FLOW_KEY, "left").join(mad, FLOW_KEY, "left")
           .withColumn("_L", F.coalesce(F.col("_L"), F.lit(0).cast("bigint"))))
    return ft.finish_features(out)
