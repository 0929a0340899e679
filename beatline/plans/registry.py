"""Registered queries: one per operator of the inventory, each with its oracle.

Every query reads the driver's tables at ``sf_dir`` (through the adapters in
``beatline.sources.testdata``) and runs over them whole.  ``oracle`` is the
DuckDB statement of the same result.
Float outputs are rounded to 6 digits with the same arithmetic on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.functions.columns import round_half_up
from beatline.plans import oracle as O
from beatline.schemas import FEATURE_COLUMNS, FLOW_KEY, INTEGER_FEATURES
from beatline.sources import testdata as td


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = Query(name, fn, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column the way the oracle does."""
    return df.select(*[round_half_up(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _cx(spark: SparkSession, sf: str) -> DataFrame:
    return td.connections(spark, sf)


KEYS = "src_ip, dst_ip, dst_port"
FEAT = O.base_ctes() + O.features_ctes()
SCORED = FEAT + O.scored_ctes()
VERD = SCORED + O.verdict_ctes()
_TRAIN = SCORED + [("tr", "select * from sc where destination_in_allowlist or deterministic_score < 40.0")]


def _explained_ctes() -> list[tuple[str, str]]:
    stats = ", ".join(f"avg(cast({c} as double)) as {c}_m, coalesce(stddev_samp(cast({c} as double)), 0.0) as {c}_s"
                      for c in O.MODEL_FEATURES)
    parts = []
    for c in O.MODEL_FEATURES:
        v, m, s = f"cast({c} as double)", f"{c}_m", f"{c}_s"
        lo = f"(case when {s} > 0 then {m} - 2.0 * {s} else {m} end)"
        hi = f"(case when {s} > 0 then {m} + 2.0 * {s} else {m} end)"
        hit = f"(case when {s} > 0 then abs({v} - {m}) / {s} > 2.0 else {v} <> {m} end)"
        four = [f"floor(({x}) * 10000.0 + 0.5) / 10000.0" for x in (v, m, lo, hi)]
        text = (f"printf('{c} is %.4f (benign mean: %.4f, 2σ range: [%.4f, %.4f]) — %s "
                f"{O.DESCRIPTIONS[c]}', {', '.join(four)}, "
                f"case when {v} < {m} then 'unusually low' else 'unusually high' end)")
        parts.append(f"case when {hit} then {text} end")
    return [("st", f"select {stats} from tr"),
            ("ex", f"select {KEYS}, concat_ws('; ', {', '.join(parts)}) as ml_explanation from sc, st")]


_EXPLAINED = _TRAIN + _explained_ctes()
_FOREST = _EXPLAINED + O.forest_ctes()
#: Verdicts with the model on.
MODELLED = _FOREST + [("vd", f"""select sc.*, ml.ml_score, case when ml.ml_score > 70.0 then ex.ml_explanation else '' end as ml_explanation,
  case when destination_in_allowlist then 'SUPPRESSED' when deterministic_score > 75.0 then 'HIGH'
       when deterministic_score > 40.0 or ml.ml_score > 70.0 then 'MEDIUM' else 'CLEAR' end as final_verdict
from sc join ml using ({KEYS}) join ex using ({KEYS})""")]


# --- grouping ---------------------------------------------------------------

@register("p2_normalize_connections", O.with_(O.base_ctes(), f"""select flow_id, {KEYS}, ts_us,
  packet_size, {O.r6('connection_duration')} as connection_duration, bytes_sent,
  cast(bytes_received as double) as bytes_received, is_failed, has_dns_lookup, '' as dst_domain from cx
  where src_ip is not null and dst_ip is not null and dst_port is not null"""))
def q_p2(spark, sf):
    """A caller's DataFrame normalised (µs time, no null keys)."""
    from beatline.operators.grouping import normalize_connections
    df = normalize_connections(_cx(spark, sf))
    # nullable integer column as double on both sides (NULL ≠ 0 survives export)
    df = df.withColumn("bytes_received", F.col("bytes_received").cast("double"))
    return rounded(df.select("flow_id", *FLOW_KEY, "ts_us", "packet_size", "connection_duration",
                             "bytes_sent", "bytes_received", "is_failed", "has_dns_lookup", "dst_domain"))


@register("a3_group_flows", O.with_(O.base_ctes(), f"""select flow_id, {KEYS}, ts_us, num_connections from (
  select *, count(*) over (partition by {KEYS}) as num_connections from cx
  where src_ip is not null and dst_ip is not null and dst_port is not null) t
  where num_connections >= 10"""))
def q_a3(spark, sf):
    """Records of flows with at least 10 records, tagged with the count."""
    from beatline.operators.grouping import group_flows
    return group_flows(_cx(spark, sf)).select("flow_id", *FLOW_KEY, "ts_us", "num_connections")


_A4_SQL = f"""select {KEYS}, count(*) as num_connections, min(ts_us) as first_seen_us,
  max(ts_us) as last_seen_us from cx where src_ip is not null and dst_ip is not null and dst_port is not null
  group by {KEYS} having count(*) >= 10"""


@register("a4_flow_summary", O.with_(O.base_ctes(), _A4_SQL))
def q_a4(spark, sf):
    """A4: per-flow count, first and last time (µs), by count descending."""
    from beatline.operators.grouping import flow_summary
    return flow_summary(_cx(spark, sf)).select(*FLOW_KEY, "num_connections", "first_seen_us", "last_seen_us")


@register("o2_top20_flows", O.with_(O.base_ctes(), _A4_SQL
                                    + f" order by num_connections desc, {KEYS} limit 20"))
def q_o2(spark, sf):
    """O2: the 20 flows with most records (total order: count, then key)."""
    return q_a4(spark, sf).limit(20)


@register("a16_flow_totals", O.with_(O.base_ctes(), f"""select count(*) as total_groups,
  cast(count_if(n >= 10) as bigint) as retained_groups, cast(count_if(n < 10) as bigint) as filtered_groups,
  cast(coalesce(sum(case when n >= 10 then n end), 0) as bigint) as retained_records
  from (select count(*) as n from cx where src_ip is not null and dst_ip is not null
        and dst_port is not null group by {KEYS}) t"""))
def q_a16(spark, sf):
    """Total, retained and filtered flow groups."""
    from beatline.operators.grouping import flow_totals
    return flow_totals(_cx(spark, sf))


# --- features ---------------------------------------------------------------

@register("w1_inter_arrival", O.with_(O.base_ctes() + O.features_ctes()[:2], f"""select tb0 as flow_id, {KEYS}, ts_us,
  {O.r6(f'(ts_us - prev_) / {O.US}')} as inter_arrival_s from fs1 where n_ >= 10"""))
def q_w1(spark, sf):
    """Seconds since the previous record of the same flow, in time order."""
    from beatline.operators.features import inter_arrivals
    df = inter_arrivals(_cx(spark, sf))
    return rounded(df.select(F.col("_tb0").alias("flow_id"), *FLOW_KEY, "ts_us", "inter_arrival_s"))


def _features(spark, sf) -> DataFrame:
    from beatline.operators.features import engineer_features
    return engineer_features(_cx(spark, sf))


def _feature_query(cols):
    def run(spark, sf):
        return rounded(_features(spark, sf).select(*FLOW_KEY, *cols))
    return run


def _feature_sql(cols):
    return O.with_(FEAT, f"select {KEYS}, {O.feature_select(cols)} from feat")


for _name, _cols, _doc in [
    ("features", ["dst_domain"] + FEATURE_COLUMNS, "F0–F20: the full per-flow feature table."),
    ("f1_f3_interval_stats", ["mean_interval", "std_interval", "interval_cov"],
     "F1–F3: mean, sample std and CoV of inter-arrival times."),
    ("f4_interval_mad", ["interval_mad"], "F4: median absolute deviation of inter-arrivals."),
    ("f5_autocorrelation", ["autocorrelation_score"], "F5/W2: max |lag-k autocorrelation|, k=1..5."),
    ("f6_f7_session_offhours", ["session_duration", "pct_connections_off_hours"],
     "F6/F7: session span and share of records at hours 0–5."),
    ("f8_f11_volume", ["mean_bytes", "std_bytes", "bytes_cov", "bytes_sent_received_ratio"],
     "F8–F11: volume statistics."),
    ("f12_payload_entropy", ["payload_entropy"], "F12/W3/W4: entropy of 20 per-flow size bins."),
    ("f13_burst", ["has_anomalous_burst"], "F13: any record above 5× the mean volume."),
    ("f14_f19_connection", ["num_connections", "num_unique_ports", "mean_connection_duration",
                            "std_connection_duration", "failed_connection_ratio", "is_direct_ip_no_dns"],
     "F14–F19: connection features."),
    ("f20_hosts_per_destination", ["num_internal_hosts_contacting"],
     "F20/J4/W7: retained flows per destination."),
]:
    _fn = _feature_query(_cols)
    _fn.__doc__ = _doc
    sql = (O.with_(FEAT, f"select {KEYS}, dst_domain, {O.feature_select(FEATURE_COLUMNS)} from feat")
           if _name == "features" else _feature_sql(_cols))
    register(_name, sql)(_fn)


# Records with missing cells: null keys and times, NaN in floating columns, domains, lone records.
_MESSY = [("mx", O.duckdb_views()["mx"])]
_MESSY_FEAT = _MESSY + O.features_ctes(src="mx", domain="dst_domain")


@register("p4_p5_f0_messy_features", O.with_(_MESSY_FEAT, f"select {KEYS}, dst_domain, {O.feature_select(FEATURE_COLUMNS)} from feat"))
def q_messy(spark, sf):
    """Features of records with null and NaN cells and domains."""
    from beatline.operators.features import engineer_features
    return rounded(engineer_features(td.messy_connections(spark, sf)).select(*FLOW_KEY, "dst_domain", *FEATURE_COLUMNS))


@register("w8_messy_caption", O.with_(_MESSY, f"""select {KEYS}, num_connections, {O.r6('mean_')} as mean_interval
  from (select src_ip, dst_ip, cast(dst_port as integer) as dst_port, count(*) as num_connections,
          case when count(ts_us) > 1 then (max(ts_us) - min(ts_us)) / (count(ts_us) - 1) / {O.US} end as mean_
        from mx where src_ip is not null and dst_ip is not null and dst_port is not null group by all) z"""))
def q_messy_caption(spark, sf):
    """Captions where many flows have one record or no time."""
    from beatline.operators.explore import timeline_caption
    return rounded(timeline_caption(td.messy_connections(spark, sf)).select(*FLOW_KEY, "num_connections", "mean_interval"))


@register("u2_truth_duplicates", O.with_(_MESSY + [("dup", O.duckdb_views()["dup"])], f"""select {KEYS}, is_malicious, beacon_type from (
  select *, row_number() over (partition by {KEYS} order by pos) as r from dup) z where r = 1"""))
def q_u2(spark, sf):
    """One truth row per flow where rows contradict each other, the first by position."""
    from beatline.operators.evaluate import dedup_truth
    return dedup_truth(td.repeated_truth(spark, sf), "pos").select(*FLOW_KEY, "is_malicious", "beacon_type")


# --- allowlist, scoring, verdict ---------------------------------------------

def _scored(spark, sf) -> DataFrame:
    from beatline.plans.pipeline import scored_flows
    return scored_flows(_cx(spark, sf))


@register("l6_allowlist", O.with_(SCORED, f"select {KEYS}, destination_in_allowlist, allowlist_reason from al2"))
def q_l6(spark, sf):
    """First-match allowlist rules (one CASE)."""
    from beatline.operators.allowlist import apply_allowlist
    return apply_allowlist(_features(spark, sf)).select(*FLOW_KEY, "destination_in_allowlist",
                                                        "allowlist_reason")


@register("j5_allowlist_rule_table",
          O.with_(SCORED, f"select {KEYS}, destination_in_allowlist, allowlist_reason from al2"))
def q_j5(spark, sf):
    """The same rules as a rule table, matched by an exact prefix equi-join."""
    from beatline.operators.allowlist import apply_rule_table, default_rule_table
    out = apply_rule_table(_features(spark, sf), default_rule_table(spark))
    return out.select(*FLOW_KEY, "destination_in_allowlist", "allowlist_reason")


@register("a9_allowlist_stats", O.with_(SCORED, f"""select cast(count_if(destination_in_allowlist) as bigint) as num_suppressed,
  count(*) as num_flows, {O.r6('coalesce(avg(case when destination_in_allowlist then 1.0 else 0.0 end), 0.0)')}
  as suppressed_share from al2"""))
def q_a9(spark, sf):
    """Allowlisted count and share."""
    from beatline.operators.allowlist import allowlist_stats, apply_allowlist
    return rounded(allowlist_stats(apply_allowlist(_features(spark, sf))))


_SUBS = ["interval_cov_score", "bytes_cov_score", "autocorrelation_sub_score", "num_connections_score",
         "session_duration_score", "off_hours_score", "not_allowlisted_score", "direct_ip_score",
         "low_internal_hosts_score"]


@register("b14_scores", O.with_(SCORED, f"select {KEYS}, "
                                + ", ".join(f"{O.r6(c)} as {c}" for c in _SUBS)
                                + f", {O.r6('deterministic_score')} as deterministic_score, beacon_type_guess,"
                                " suggested_mitre_technique from sc"))
def q_b14(spark, sf):
    """Sub-scores, composite score, class and technique."""
    return rounded(_scored(spark, sf).select(*FLOW_KEY, *_SUBS, "deterministic_score",
                                             "beacon_type_guess", "suggested_mitre_technique"))


@register("a8_score_stats", O.with_(SCORED, """select count(*) as num_flows, floor(max(deterministic_score) * 1e6 + 0.5) / 1e6 as max_score,
  floor(median(deterministic_score) * 1e6 + 0.5) / 1e6 as median_score,
  cast(count_if(deterministic_score > 75.0) as bigint) as num_above from sc"""))
def q_a8(spark, sf):
    """Max, median and count above 75 of the composite score."""
    from beatline.operators.scoring import score_stats
    return rounded(score_stats(_scored(spark, sf)))


@register("p7_training_rows", O.with_(SCORED, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score from sc
  where destination_in_allowlist or deterministic_score < 40.0"""))
def q_p7(spark, sf):
    """Flows used to train the model (allowlisted or score < 40)."""
    from beatline.operators.verdict import benign_for_training
    return rounded(_scored(spark, sf).where(benign_for_training()).select(*FLOW_KEY, "deterministic_score"))


def _results_off(spark, sf) -> DataFrame:
    from beatline.plans.pipeline import run_pipeline
    return run_pipeline(_cx(spark, sf), use_model=False, sort=False)


@register("v1_verdicts", O.with_(VERD, f"select {KEYS}, final_verdict from vd"))
def q_v1(spark, sf):
    """V1: verdict per flow (model off: ml_score 0)."""
    return _results_off(spark, sf).select(*FLOW_KEY, "final_verdict")


_RESULT_SQL = f"""select src_ip, dst_ip, dst_domain, dst_port, num_connections, {O.r6('interval_cov')} as interval_cov,
  {O.r6('mean_interval')} as mean_interval, {O.r6('deterministic_score')} as deterministic_score,
  {O.r6('ml_score')} as ml_score, final_verdict, beacon_type_guess,
  suggested_mitre_technique, ml_explanation, allowlist_reason from vd"""


@register("v2_results_model_off", O.with_(VERD, _RESULT_SQL))
def q_v2_off(spark, sf):
    """The 14-column result table with the model switched off."""
    return rounded(_results_off(spark, sf))


@register("a10_verdict_counts", O.with_(VERD, """select v.final_verdict, coalesce(c.cnt, 0) as count,
  floor(100.0 * coalesce(c.cnt, 0) / greatest(sum(coalesce(c.cnt, 0)) over (), 1) * 1e6 + 0.5) / 1e6 as pct
  from (values ('HIGH'), ('MEDIUM'), ('CLEAR'), ('SUPPRESSED')) v(final_verdict)
  left join (select final_verdict, count(*) as cnt from vd group by final_verdict) c using (final_verdict)"""))
def q_a10(spark, sf):
    """A10: count and share per verdict, all four listed."""
    from beatline.operators.verdict import verdict_counts
    return rounded(verdict_counts(_results_off(spark, sf)))


# --- evaluation ---------------------------------------------------------------

def _merged_off(spark, sf) -> DataFrame:
    from beatline.operators.evaluate import merge_with_truth
    return merge_with_truth(_results_off(spark, sf), td.ground_truth(spark, sf))


_GT = O.duckdb_views()["gt"]
_MERGE = [("gt", _GT), ("m", f"""select vd.*, gt.is_malicious, gt.beacon_type, gt.mitre_technique_id
  from vd join gt using ({KEYS})"""),
          ("mp", """select *, case when deterministic_score > 75.0 then 1 else 0 end as p_deterministic,
  case when ml_score > 70.0 then 1 else 0 end as p_ml,
  case when final_verdict in ('HIGH', 'MEDIUM') then 1 else 0 end as p_combined from m""")]
MERGED = VERD + _MERGE
_CELLS = ("cells", """select method,
  cast(count_if(is_malicious <> 1 and p = 0) as bigint) as tn, cast(count_if(is_malicious <> 1 and p = 1) as bigint) as fp,
  cast(count_if(is_malicious = 1 and p = 0) as bigint) as fn, cast(count_if(is_malicious = 1 and p = 1) as bigint) as tp
  from (select 'deterministic' as method, is_malicious, p_deterministic as p from mp
        union all select 'ml', is_malicious, p_ml from mp
        union all select 'combined', is_malicious, p_combined from mp) t group by method""")


def _rate_sql(a: str, b: str) -> str:
    return O.r6(f"case when ({b}) > 0 then ({a}) / ({b}) else 0.0 end")


@register("j2_merge_truth", O.with_(MERGED, f"""select {KEYS}, final_verdict, is_malicious, beacon_type,
  mitre_technique_id from m"""))
def q_j2(spark, sf):
    """Results joined to deduplicated truth on the flow key."""
    return _merged_off(spark, sf).select(*FLOW_KEY, "final_verdict", "is_malicious", "beacon_type",
                                         "mitre_technique_id")


@register("j2_merge_saved", O.with_(MERGED, f"""select {KEYS}, final_verdict, is_malicious, beacon_type from m"""))
def q_j2_saved(spark, sf):
    """Results and truth saved by flow key, reloaded, joined where their buckets lie."""
    from beatline.operators.evaluate import merge_with_truth
    from beatline.sources.bucketed import load_bucketed, save_bucketed
    saved = [save_bucketed(df, _scratch(spark, "j2-saved"), 16) for df in (_results_off(spark, sf), td.ground_truth(spark, sf))]
    results, truth = (load_bucketed(spark, path) for path in saved)
    return merge_with_truth(results, truth).select(*FLOW_KEY, "final_verdict", "is_malicious", "beacon_type")


@register("p9_saved_drilldown", O.with_(O.base_ctes(), """select flow_id, ts_us, packet_size from cx
  where src_ip = '10.0.0.1' and dst_ip = '45.33.0.1' and dst_port = 443"""))
def q_p9_saved(spark, sf):
    """One flow's records from connections saved by flow key."""
    from beatline.operators.explore import flow_drilldown
    from beatline.sources.bucketed import load_bucketed, save_bucketed
    path = save_bucketed(_cx(spark, sf), _scratch(spark, "p9-saved"), 16)
    return flow_drilldown(load_bucketed(spark, path), "10.0.0.1", "45.33.0.1", 443).select("flow_id", "ts_us", "packet_size")


_RATES = f"""select method, tn, fp, fn, tp, {_rate_sql('tp', 'tp + fp')} as precision,
  {_rate_sql('tp', 'tp + fn')} as recall, {_rate_sql('2 * tp', '2 * tp + fp + fn')} as f1,
  {_rate_sql('fp', 'fp + tn')} as fp_rate from cells"""


@register("e9_evaluation_model_off", O.with_(MERGED + [_CELLS], _RATES))
def q_e9(spark, sf):
    """Precision, recall, F1, FP rate of the three methods (model off)."""
    from beatline.operators.evaluate import evaluate
    return rounded(evaluate(_merged_off(spark, sf)))


@register("e5_recall_by_type", O.with_(MERGED, f"""select beacon_type,
  {O.r6('avg(case when p_combined = 1 then 1.0 else 0.0 end)')} as recall, count(*) as count
  from mp where beacon_type is not null and beacon_type <> 'none' group by beacon_type"""))
def q_e5(spark, sf):
    """E5: recall and count per truth beacon class (combined prediction)."""
    from beatline.operators.evaluate import by_beacon_type
    return rounded(by_beacon_type(_merged_off(spark, sf)))


@register("e6_false_positives", O.with_(MERGED, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score,
  {O.r6('ml_score')} as ml_score, final_verdict, ml_explanation from m
  where is_malicious = 0 and final_verdict in ('HIGH', 'MEDIUM')"""))
def q_e6(spark, sf):
    """Benign flows flagged HIGH/MEDIUM."""
    from beatline.operators.evaluate import false_positives
    return rounded(false_positives(_merged_off(spark, sf)).select(
        *FLOW_KEY, "deterministic_score", "ml_score", "final_verdict", "ml_explanation"))


@register("e7_confusion_cells", O.with_(MERGED, """select method, y_true, y_pred, count(*) as count from (
  select 'deterministic' as method, is_malicious as y_true, p_deterministic as y_pred from mp
  union all select 'ml', is_malicious, p_ml from mp
  union all select 'combined', is_malicious, p_combined from mp) t group by method, y_true, y_pred"""))
def q_e7(spark, sf):
    """Confusion-matrix cells of the three methods."""
    from beatline.operators.evaluate import confusion_cells
    return confusion_cells(_merged_off(spark, sf))


@register("e8_ntp_slice", O.with_(MERGED, """select count(*) as num_flows,
  cast(count_if(final_verdict in ('HIGH', 'MEDIUM')) as bigint) as num_false_positives,
  floor((case when count(*) > 0 then sum(cast(floor(deterministic_score * 100.0 + 0.5) as bigint)) / count(*) / 100.0 end)
        * 1e6 + 0.5) / 1e6 as avg_deterministic_score
  from m where dst_port = 123 and is_malicious = 0"""))
def q_e8(spark, sf):
    """Benign NTP flows: count, false positives, mean score."""
    from beatline.operators.evaluate import known_benign_slice
    return rounded(known_benign_slice(_merged_off(spark, sf)))


@register("p13_truth_malicious", O.with_(MERGED, f"select {KEYS}, beacon_type from m where is_malicious = 1"))
def q_p13(spark, sf):
    """The malicious slice of the merged table."""
    from beatline.operators.evaluate import truth_slice
    return truth_slice(_merged_off(spark, sf), "malicious").select(*FLOW_KEY, "beacon_type")


@register("t17_dropped_truth", O.with_(VERD + [("gt", _GT)], f"""select {KEYS}, is_malicious from gt
  where not exists (select 1 from vd where vd.src_ip = gt.src_ip and vd.dst_ip = gt.dst_ip
                    and vd.dst_port = gt.dst_port)"""))
def q_t17(spark, sf):
    """Truth flows with no result row (left anti join)."""
    from beatline.operators.evaluate import dropped_truth
    return dropped_truth(_results_off(spark, sf), td.ground_truth(spark, sf)).select(*FLOW_KEY, "is_malicious")


@register("e9_evaluation_with_model", O.with_(MODELLED + _MERGE + [_CELLS], _RATES))
def q_e9_model(spark, sf):
    """E9 with the isolation forest on."""
    from beatline.operators.evaluate import evaluate, merge_with_truth
    from beatline.plans.pipeline import run_pipeline
    res = run_pipeline(_cx(spark, sf), sort=False)
    return rounded(evaluate(merge_with_truth(res, td.ground_truth(spark, sf))))


# --- exploration -------------------------------------------------------------

@register("p8_alert_filter", O.with_(VERD, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score,
  final_verdict from vd where final_verdict in ('HIGH', 'MEDIUM') and deterministic_score >= 50.0
  and ml_score >= 0.0"""))
def q_p8(spark, sf):
    """Alerts with verdict HIGH/MEDIUM and score ≥ 50."""
    from beatline.operators.explore import alert_filter
    return rounded(alert_filter(_results_off(spark, sf), verdicts=["HIGH", "MEDIUM"], min_det=50.0)
                   .select(*FLOW_KEY, "deterministic_score", "final_verdict"))


@register("p9_flow_drilldown", O.with_(O.base_ctes(), """select flow_id, ts_us, packet_size from cx
  where src_ip = '10.0.0.1' and dst_ip = '45.33.0.1' and dst_port = 443"""))
def q_p9(spark, sf):
    """One flow's records in time order."""
    from beatline.operators.explore import flow_drilldown
    return flow_drilldown(_cx(spark, sf), "10.0.0.1", "45.33.0.1", 443).select("flow_id", "ts_us", "packet_size")


@register("p10_host_pivot", O.with_(VERD, f"""select dst_ip, dst_domain, dst_port, final_verdict,
  {O.r6('deterministic_score')} as deterministic_score, {O.r6('ml_score')} as ml_score, num_connections,
  beacon_type_guess from vd where src_ip = '10.0.0.1'"""))
def q_p10(spark, sf):
    """P10: all flows of one internal host."""
    from beatline.operators.explore import host_pivot
    return rounded(host_pivot(_results_off(spark, sf), "10.0.0.1"))


@register("p12_high_slice", O.with_(VERD, f"select {KEYS}, {O.r6('deterministic_score')} as deterministic_score"
                                     " from vd where final_verdict = 'HIGH'"))
def q_p12(spark, sf):
    """The HIGH verdict slice."""
    from beatline.operators.verdict import verdict_slice
    return rounded(verdict_slice(_results_off(spark, sf), "HIGH").select(*FLOW_KEY, "deterministic_score"))


@register("o4_top10_high", O.with_(VERD, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score
  from vd where final_verdict = 'HIGH' order by deterministic_score desc, {KEYS} limit 10"""))
def q_o4(spark, sf):
    """Top 10 HIGH flows by score."""
    from beatline.operators.explore import top_k
    from beatline.operators.verdict import verdict_slice
    return rounded(top_k(verdict_slice(_results_off(spark, sf), "HIGH"), 10).select(*FLOW_KEY, "deterministic_score"))


@register("o5_host_list", O.with_(VERD, "select distinct src_ip from vd"))
def q_o5(spark, sf):
    """Sorted distinct internal hosts."""
    from beatline.operators.explore import host_list
    return host_list(_results_off(spark, sf))


@register("o6_sample_per_class", O.with_([("gt", _GT)], f"""select beacon_type,
  min_by(src_ip, k) as src_ip, min_by(dst_ip, k) as dst_ip, min_by(dst_port, k) as dst_port from (
  select *, md5(concat_ws('|', src_ip, dst_ip, cast(dst_port as varchar), '42')) as k from gt) t
  group by beacon_type"""))
def q_o6(spark, sf):
    """One seeded pseudo-random flow per truth class."""
    from beatline.operators.explore import sample_per_class
    return sample_per_class(td.ground_truth(spark, sf))


@register("w8_timeline", O.with_(O.base_ctes(), f"""select {KEYS}, ts_us,
  {O.r6(f'(ts_us - min(ts_us) over (partition by {KEYS})) / {O.US}')} as offset_s from cx
  where src_ip is not null and dst_ip is not null and dst_port is not null"""))
def q_w8(spark, sf):
    """Seconds since each flow's first record."""
    from beatline.operators.explore import timeline
    return rounded(timeline(_cx(spark, sf)))


@register("w8_timeline_caption", O.with_(O.base_ctes(), f"""select {KEYS}, num_connections, {O.r6('mean_')} as mean_interval,
  {O.r6('case when mean_ > 0 then sd / mean_ when mean_ = 0 then 0.0 end')} as cov
  from (select {KEYS}, count(*) as num_connections, case when count(d) > 0 then (max(ts_us) - min(ts_us)) / count(d) / {O.US} end as mean_,
          stddev_pop(d) as sd
        from (select *, (ts_us - lag(ts_us) over (partition by {KEYS} order by ts_us asc nulls last, flow_id asc nulls last)) / {O.US} as d
              from cx where src_ip is not null and dst_ip is not null and dst_port is not null) t group by {KEYS}) z"""))
def q_w8c(spark, sf):
    """Per-flow mean interval and population-std CoV (plot caption)."""
    from beatline.operators.explore import timeline_caption
    return rounded(timeline_caption(_cx(spark, sf)))


def _hist_sql(src: str, value: str, by: str, bins: int = 30, density: bool = False) -> str:
    lo = "(case when hi_ > lo_ then lo_ else lo_ - 0.5 end)"
    hi = "(case when hi_ > lo_ then hi_ else hi_ + 0.5 end)"
    w = f"(({hi} - {lo}) / {float(bins)!r})"
    b = f"least({bins - 1}, floor((x - {lo}) / ({hi} - {lo}) * {float(bins)!r}))"
    dens = f", {O.r6(f'count(*) / (n_ * {w})')} as density" if density else ""
    return f"""select {by}, cast(bin as bigint) as bin, {O.r6('bin_start')} as bin_start, {O.r6('bin_end')} as bin_end, count(*) as count{dens.replace(w, 'w_')}
from (select {by}, {b} as bin, {lo} + {b} * {w} as bin_start, {lo} + ({b} + 1) * {w} as bin_end, n_, {w} as w_
      from (select {by}, x, min(x) over (partition by {by}) as lo_, max(x) over (partition by {by}) as hi_,
                   count(*) over (partition by {by}) as n_
            from (select {by}, cast({value} as double) as x from {src}) s where x is not null) r) t
group by {by}, bin, bin_start, bin_end, n_, w_"""


@register("a14_hist_score_by_verdict", O.with_(VERD, _hist_sql("vd", "deterministic_score", "final_verdict")))
def q_a14(spark, sf):
    """30-bin histogram of the composite score per verdict."""
    from beatline.operators.explore import histogram
    return rounded(histogram(_results_off(spark, sf), "deterministic_score", by="final_verdict"))


@register("a14_hist_cov_by_truth", O.with_(MERGED, _hist_sql("m", "least(interval_cov, 2.0)", "is_malicious",
                                                              density=True)))
def q_a14b(spark, sf):
    """Density histogram of CoV (clipped at 2) per truth class."""
    from beatline.operators.explore import histogram
    return rounded(histogram(_merged_off(spark, sf), "interval_cov", by="is_malicious", density=True,
                             clip_upper=2.0))


@register("a15_scatter_density", O.with_(VERD, """select final_verdict,
  cast(case when interval_cov > 0 then floor(log10(interval_cov) * 10.0) end as double) as cov_cell,
  cast(floor(log10(cast(num_connections as double)) * 10.0) as bigint) as conn_cell, count(*) as count
  from vd group by all"""))
def q_a15(spark, sf):
    """CoV × connections on a log-log grid per verdict."""
    from beatline.operators.explore import scatter_density
    # nullable cell index as double on both sides (NULL = zero CoV)
    out = scatter_density(_results_off(spark, sf))
    return out.withColumn("cov_cell", F.col("cov_cell").cast("double"))


@register("a11_protocol_counts", O.with_(O.base_ctes(), "select protocol, count(*) as count from cx group by protocol"))
def q_a11a(spark, sf):
    """Records per protocol."""
    from beatline.operators.explore import protocol_counts
    return protocol_counts(_cx(spark, sf))


@register("a11_top_ports", O.with_(O.base_ctes(), """select dst_port, count(*) as count from cx group by dst_port
  order by count desc, dst_port limit 10"""))
def q_a11b(spark, sf):
    """Ten most frequent destination ports."""
    from beatline.operators.explore import top_ports
    return top_ports(_cx(spark, sf))


@register("a11_parse_summary", O.with_(O.base_ctes(), """select count(*) as num_records,
  count(distinct src_ip) as unique_src, count(distinct dst_ip) as unique_dst,
  min(packet_size) as min_size, max(packet_size) as max_size from cx"""))
def q_a11c(spark, sf):
    """Distinct sources/destinations and the size range."""
    from beatline.operators.explore import parse_summary
    return parse_summary(_cx(spark, sf))


# --- baseline -----------------------------------------------------------------

def _baseline(spark, sf) -> DataFrame:
    from beatline.sources.baseline import baseline_features, benign_rows
    return baseline_features(benign_rows(td.baseline_raw(spark, sf)))


_BL = [("bl", O.duckdb_views()["bl"]),
       ("bb", """select cast(flow_duration as double) as flow_duration, cast(fwd_packets as double) as fwd_packets,
  cast(bwd_packets as double) as bwd_packets, cast(total_fwd_bytes as double) as total_fwd_bytes,
  cast(total_bwd_bytes as double) as total_bwd_bytes, cast(fwd_iat_mean as double) as fwd_iat_mean,
  cast(fwd_iat_std as double) as fwd_iat_std, cast(bwd_iat_mean as double) as bwd_iat_mean,
  cast(bwd_iat_std as double) as bwd_iat_std, cast(dst_port as double) as dst_port,
  cast(protocol as double) as protocol from bl where upper(trim(label)) = 'BENIGN'"""),
       ("bd1", """select *, fwd_iat_mean as mean_interval, fwd_iat_std as std_interval,
  floor((case when fwd_iat_mean > 0 then fwd_iat_std / fwd_iat_mean else 0.0 end) * 1e6 + 0.5) / 1e6 as interval_cov,
  floor((case when fwd_packets + bwd_packets > 0 then (total_fwd_bytes + total_bwd_bytes) / (fwd_packets + bwd_packets)
        else 0.0 end) * 100.0 + 0.5) / 100.0 as mean_bytes from bb"""),
       ("bd", f"""select *, floor(least(greatest(case when mean_bytes > 0 then abs(total_fwd_bytes - total_bwd_bytes)
  / {2.0 ** 0.5!r} / (mean_bytes * (fwd_packets + bwd_packets)) else 0.0 end, 0.0), 10.0) * 1e6 + 0.5) / 1e6 as bytes_cov
  from bd1""")]


@register("s7_baseline_features", O.with_(_BL, "select " + ", ".join(
    O.r6(c) + f" as {c}" for c in ["flow_duration", "fwd_packets", "bwd_packets", "total_fwd_bytes",
                                   "total_bwd_bytes", "fwd_iat_mean", "fwd_iat_std", "bwd_iat_mean",
                                   "bwd_iat_std", "dst_port", "protocol", "mean_interval", "std_interval",
                                   "interval_cov", "mean_bytes", "bytes_cov"]) + " from bd"))
def q_s7(spark, sf):
    """Benign labelled flow statistics with derived features."""
    return rounded(_baseline(spark, sf))


@register("s8_baseline_matrix", O.with_(_BL, "select " + ", ".join(
    O.r6(c) + f" as {c}" for c in ["mean_interval", "std_interval", "interval_cov", "mean_bytes",
                                   "bytes_cov"]) + " from bd"))
def q_s8(spark, sf):
    """The baseline's five-column feature matrix (distributed)."""
    from beatline.sources.baseline import feature_matrix
    return rounded(feature_matrix(_baseline(spark, sf)))


@register("a13_baseline_ports", O.with_(_BL, """select dst_port, count(*) as count from bd group by dst_port
  order by count desc, dst_port limit 10"""))
def q_a13(spark, sf):
    """Ten most frequent destination ports of the baseline."""
    from beatline.sources.baseline import top_ports
    return top_ports(_baseline(spark, sf))


_PROFILED = ["flow_duration", "fwd_packets", "bwd_packets", "total_fwd_bytes", "total_bwd_bytes", "fwd_iat_mean",
             "fwd_iat_std", "bwd_iat_mean", "bwd_iat_std", "dst_port", "protocol", "mean_interval", "std_interval",
             "interval_cov", "mean_bytes", "bytes_cov"]


@register("a13_baseline_profile", O.with_(_BL, " union all ".join(
    f"select '{c}' as column, {O.r6(f'avg({c})')} as mean, {O.r6(f'stddev_samp({c})')} as std, "
    f"{O.r6(f'min({c})')} as min, {O.r6(f'max({c})')} as max from bd" for c in _PROFILED)))
def q_a13p(spark, sf):
    """Mean, std, min, max of every baseline column, base and derived."""
    from beatline.sources.baseline import profile
    return rounded(profile(_baseline(spark, sf)))


# --- captures -------------------------------------------------------------------

_PK = [("pk", O.duckdb_views()["pk"])]
_ROLL = _PK + [
    ("pp", """select *, row_number() over (partition by file, src_ip, dst_ip, dst_port, protocol
          order by ts_us asc nulls last, packet_idx) as rn_,
       count(*) over (partition by file, src_ip, dst_ip, dst_port, protocol) as n_ from pk"""),
    ("pg", """select file, src_ip, dst_ip, dst_port, protocol, min(ts_us) as ts_us, max(ts_us) as last_,
  min(packet_idx) as first_idx_, cast(sum(coalesce(cast(packet_size as bigint), 0)) as bigint) as packet_size,
  cast(sum(case when rn_ <= greatest(1, floor(n_ / 2)) then coalesce(cast(packet_size as bigint), 0) else 0 end) as bigint) as bytes_sent,
  cast(sum(case when rn_ > greatest(1, floor(n_ / 2)) then coalesce(cast(packet_size as bigint), 0) else 0 end) as bigint) as recv_,
  max(has_dns_lookup) as has_dns_lookup from pp group by file, src_ip, dst_ip, dst_port, protocol"""),
    ("pf", """select file, src_ip, dst_ip, dst_port, protocol, ts_us, packet_size,
  floor(greatest(0.001, (last_ - ts_us) / 1e6) * 10000.0 + 0.5) / 10000.0 as connection_duration,
  bytes_sent, case when recv_ = 0 then bytes_sent else recv_ end as bytes_received, 0 as is_failed,
  coalesce(has_dns_lookup, 0) as has_dns_lookup, '' as dst_domain, first_idx_ from pg"""),
]
_ROLL_COLS = ["file", "src_ip", "dst_ip", "dst_port", "protocol", "ts_us", "packet_size", "connection_duration",
              "bytes_sent", "bytes_received", "is_failed", "has_dns_lookup", "dst_domain"]


def _rollup(spark, sf) -> DataFrame:
    from beatline.sources.captures import packets_to_flows
    return packets_to_flows(td.packets(spark, sf))


# Captures are written from the tables (S1 lists them), then read back; ranges are small, so files are cut.
_CUT_BYTES = 256 << 10
_CAPTURED = _PK + [("wr", td.CAPTURED_SQL)]


def _read_back(spark, sf) -> dict[str, DataFrame]:
    from beatline.sources.captures import read_captures
    return read_captures(spark, td.write_events_as_captures(spark, sf), piece_bytes=_CUT_BYTES)


def _named(df: DataFrame) -> DataFrame:
    from beatline.sources.capture_source import base_name
    return df.withColumn("file", base_name(F.col("file")))


_DNS_FILES = [("dn", O.duckdb_views()["dns"]), ("df", f"""
select concat('dns_', cast(no_ as varchar(9)), case when no_ % 2 = 0 then '.pcap' else '.pcapng' end) as file,
  row_number() over (partition by no_ order by packet_idx) - 1 as place, ip, domain
from (select dn.*, cast(floor(packet_idx / {td.PAGES_PER_CAPTURE}.0) as bigint) as no_ from dn) t""")]


@register("s1_capture_files", O.with_(_CAPTURED + _DNS_FILES, """
select file, cast(sum(frames_) as bigint) as n_total, cast(count(*) as bigint) as n_parsed from wr group by file
union all select file, count(*), count(*) from df group by file"""))
def q_s1(spark, sf):
    """Every capture of a directory, pcap and pcapng, with its frames and IP packets."""
    return _named(_read_back(spark, sf)["stats"]).select("file", "n_total", "n_parsed")


@register("s2_capture_packets", O.with_(_CAPTURED + _DNS_FILES, """
select file, cast(place as bigint) as packet_idx, src_ip, dst_ip, dst_port, ts_us, cast(packet_size as integer) as packet_size,
  protocol, has_dns_lookup from wr"""))
def q_s2(spark, sf):
    """Packets decoded from captures that were cut at any byte."""
    packets = _named(_read_back(spark, sf)["packets"]).where(F.col("file").startswith("ev_"))
    return packets.select("file", "packet_idx", "src_ip", "dst_ip", "dst_port", "ts_us", "packet_size", "protocol", "has_dns_lookup")


@register("s2_capture_scan", O.with_(_CAPTURED, """
select file, cast(place as bigint) as packet_idx, src_ip, ts_us from wr
where dst_port = 8443 and protocol = 'TCP' and ts_us >= 1704067800000000"""))
def q_s2_scan(spark, sf):
    """The registered source reads planned ranges; port, protocol and time are pushed into the scan."""
    from beatline.session import scratch_path
    from beatline.sources.capture_source import register as register_source
    from beatline.sources.capture_source import save_plan
    register_source(spark)
    plan = save_plan(spark, td.write_events_as_captures(spark, sf), scratch_path(spark, f"plan-{uuid.uuid4().hex}"), _CUT_BYTES)
    rows = spark.read.format("captures").option("plan", plan).load()
    found = rows.where((F.col("kind") == "packet") & (F.col("dst_port") == 8443) & (F.col("protocol") == "TCP")
                       & (F.col("ts_us") >= 1704067800000000))
    return _named(found).select("file", "packet_idx", "src_ip", "ts_us")


@register("s3_dns_answers", O.with_(_DNS_FILES, """
select file, place as packet_idx, 0 as answer_idx, ip, domain from df"""))
def q_s3(spark, sf):
    """S3: DNS A answers decoded from captures."""
    return _named(_read_back(spark, sf)["dns_answers"]).select("file", "packet_idx", "answer_idx", "ip", "domain")


@register("p14_non_ip_frames", O.with_(_CAPTURED, """
select file, cast(sum(skipped_) as bigint) as n_skipped, cast(sum(errors_) as bigint) as n_errors from wr group by file"""))
def q_p14(spark, sf):
    """Frames that are not IP are left out and counted, cut ones too."""
    return _named(_read_back(spark, sf)["stats"]).where(F.col("file").startswith("ev_")).select("file", "n_skipped", "n_errors")


@register("a1_packet_rollup", O.with_(_ROLL, "select " + ", ".join(
    O.r6(c) + f" as {c}" if c == "connection_duration" else c for c in _ROLL_COLS) + " from pf"))
def q_a1(spark, sf):
    """A1: packets rolled up per (file, src, dst, port, protocol)."""
    return rounded(_rollup(spark, sf).select(*_ROLL_COLS))


@register("a2_flow_ids", O.with_(_ROLL + [("pc", """select file, count(*) as cnt_ from pf group by file"""),
                                          ("po", "select file, sum(cnt_) over (order by file) - cnt_ as off_ from pc")],
    """select pf.file, src_ip, dst_ip, dst_port, protocol,
  printf('pcap_flow_%06d', off_ + row_number() over (partition by pf.file order by first_idx_, src_ip, dst_ip,
         dst_port, protocol) - 1) as flow_id
  from pf join po using (file)"""))
def q_a2(spark, sf):
    """A2: flow ids by first appearance, numbered across files in name order."""
    from beatline.sources.captures import number_flows
    return number_flows(_rollup(spark, sf)).select("file", "src_ip", "dst_ip", "dst_port", "protocol", "flow_id")


@register("j1_dns_enrichment", O.with_(_ROLL + [("dn", O.duckdb_views()["dns"]),
                                                ("dl", """select file, ip, domain from (select *, row_number() over
  (partition by file, ip order by packet_idx desc, answer_idx desc) as r_ from dn) t where r_ = 1""")],
    """select pf.file, src_ip, pf.dst_ip, dst_port, protocol, coalesce(dl.domain, '') as dst_domain
  from pf left join dl on pf.file = dl.file and pf.dst_ip = dl.ip"""))
def q_j1(spark, sf):
    """Destination domain from the same capture file's last DNS answer."""
    from beatline.sources.captures import enrich_domains
    out = enrich_domains(_rollup(spark, sf), td.dns_answers(spark, sf))
    return out.select("file", "src_ip", "dst_ip", "dst_port", "protocol", "dst_domain")


@register("a12_host_domains", O.with_(_ROLL + [("dn", O.duckdb_views()["dns"]),
                                               ("dl", """select file, ip, domain from (select *, row_number() over
  (partition by file, ip order by packet_idx desc, answer_idx desc) as r_ from dn) t where r_ = 1"""),
                                               ("en", """select pf.*, coalesce(dl.domain, '') as dst_domain2
  from pf left join dl on pf.file = dl.file and pf.dst_ip = dl.ip""")],
    """select dst_domain2 as dst_domain, count(*) as count from en where src_ip = '10.0.0.1' and dst_domain2 <> ''
  group by dst_domain2"""))
def q_a12(spark, sf):
    """Domain counts of one host's enriched flows ('' excluded)."""
    from beatline.operators.explore import host_domain_counts
    from beatline.sources.captures import enrich_domains
    return host_domain_counts(enrich_domains(_rollup(spark, sf), td.dns_answers(spark, sf)), "10.0.0.1")


@register("t1_packets_as_records", O.with_(_PK + [("pr", """select src_ip, dst_ip, dst_port, ts_us, packet_idx as flow_id,
  packet_size, cast(0.0 as double) as connection_duration, packet_size as bytes_sent,
  cast(null as bigint) as bytes_received, 0 as is_failed, has_dns_lookup from pk""")]
    + O.features_ctes(src="pr"), f"select {KEYS}, {O.feature_select()} from feat"))
def q_t1(spark, sf):
    """Packets taken directly as connection records, then F1–F20."""
    from beatline.operators.features import engineer_features
    from beatline.sources.captures import packets_as_connections
    recs = packets_as_connections(td.packets(spark, sf)).drop("file").withColumnRenamed("packet_idx", "flow_id")
    return rounded(engineer_features(recs).select(*FLOW_KEY, *FEATURE_COLUMNS))


# --- anomaly layer ----------------------------------------------------------------

def _training_rows(spark, sf) -> DataFrame:
    from beatline.operators.anomaly import training_matrix
    from beatline.operators.verdict import benign_for_training
    return training_matrix(_scored(spark, sf).where(benign_for_training()))


_SCALED = ["interval_cov", "mean_interval", "bytes_cov", "mean_bytes", "session_duration", "payload_entropy"]


@register("a5_a6_training_stats", O.with_(_TRAIN, " union all ".join(
    f"select '{c}' as feature, {O.r6(f'avg(cast({c} as double))')} as mean, "
    f"{O.r6(f'stddev_samp(cast({c} as double))')} as std, {O.r6(f'stddev_pop(cast({c} as double))')} as pstd from tr"
    for c in ["interval_cov", "mean_interval", "std_interval", "bytes_cov", "mean_bytes", "num_connections",
              "session_duration", "pct_connections_off_hours", "mean_connection_duration",
              "failed_connection_ratio", "payload_entropy"])))
def q_a5(spark, sf):
    """Mean, sample and population std of the 11 model features
    over the benign training rows."""
    from beatline.operators.anomaly import training_stats_table
    return rounded(training_stats_table(_training_rows(spark, sf)))


@register("a7_batch_bounds", O.with_(SCORED, """select floor(min(deterministic_score) * 1e6 + 0.5) / 1e6 as min,
  floor(max(deterministic_score) * 1e6 + 0.5) / 1e6 as max,
  floor(median(deterministic_score) * 1e6 + 0.5) / 1e6 as median, count(*) as n,
  cast(count_if(deterministic_score > 70.0) as bigint) as n_above from sc"""))
def q_a7(spark, sf):
    """Min, max, median and count above 70 of a score over the batch."""
    from beatline.operators.anomaly import batch_bounds
    return rounded(batch_bounds(_scored(spark, sf), "deterministic_score", threshold=70.0))


@register("a6_scaled_features", O.with_(_TRAIN, f"select {KEYS}, " + ", ".join(
    O.r6(f"(sc.{c} - (select avg(cast({c} as double)) from tr)) / (select case when stddev_pop(cast({c} as double)) > 0 "
         f"then stddev_pop(cast({c} as double)) else 1.0 end from tr)") + f" as {c}" for c in _SCALED) + " from sc"))
def q_a6(spark, sf):
    """Features of every flow, less the mean and over the population std of the benign training rows."""
    from beatline.operators.anomaly import scale, training_stats
    scored = _scored(spark, sf)
    scaler = training_stats(_training_rows(spark, sf), _SCALED)["scaler"]
    return rounded(scale(scored, scaler).select(*FLOW_KEY, *_SCALED))


@register("a7_raw_median", O.with_([("cx", O.duckdb_views()["cx"])], f"""select {O.r6('min(bytes_per_second)')} as min,
  {O.r6('max(bytes_per_second)')} as max, {O.r6('median(bytes_per_second)')} as median, count(*) as n
  from (select bytes_sent / (connection_duration + 0.001) as bytes_per_second from cx) t"""))
def q_a7_raw(spark, sf):
    """Exact median of an unrounded value of every record, almost all of them distinct."""
    from beatline.operators.anomaly import batch_bounds
    rate = F.col("bytes_sent") / (F.col("connection_duration") + F.lit(0.001).cast("double"))
    return rounded(batch_bounds(_cx(spark, sf).select(rate.alias("bytes_per_second")), "bytes_per_second"))


def _fitted(spark, sf):
    """The scored flows, computed once, and the forest fitted on the benign ones."""
    from beatline.operators import anomaly
    from beatline.operators.verdict import benign_for_training
    from beatline.session import checkpoint_dir
    checkpoint_dir(spark)
    scored = _scored(spark, sf).checkpoint(eager=True)
    return scored, anomaly.fit(scored.where(benign_for_training()))


@register("m2_m3_ml_scores", O.with_(_FOREST, f"select {KEYS}, ml_score from ml"))
def q_m23(spark, sf):
    """M2/M3: isolation forest fitted on the benign flows, every flow scored 0–100."""
    from beatline.operators import anomaly
    scored, model = _fitted(spark, sf)
    return anomaly.score(model, scored).select(*FLOW_KEY, "ml_score")


@register("m2_forest_nodes", O.with_(_FOREST, """select cast(t as integer) as tree, cast(node as integer) as node,
  cast(coalesce(f, -1) as integer) as feature, floor(threshold * 1e6 + 0.5) / 1e6 as threshold, cast(size as integer) as size from forest_"""))
def q_m2(spark, sf):
    """M2: the fitted forest itself, node by node."""
    from beatline.operators import anomaly
    return rounded(anomaly.node_table(_fitted(spark, sf)[1], spark))


@register("m4_m5_explanations", O.with_(MODELLED, f"select {KEYS}, ml_score, ml_explanation from vd"))
def q_m45(spark, sf):
    """M4/M5: text explanations of the flows the model scores above 70."""
    from beatline.operators import anomaly
    scored, model = _fitted(spark, sf)
    out = anomaly.explain_all(anomaly.score(model, scored), model.stats)
    return out.select(*FLOW_KEY, "ml_score", "ml_explanation")


@register("v2_results", O.with_(MODELLED, _RESULT_SQL))
def q_v2(spark, sf):
    """V2: the full pipeline with the model on (the flagship result table)."""
    from beatline.plans.pipeline import run_pipeline
    return rounded(run_pipeline(_cx(spark, sf)))


@register("v3_summary_top_high", O.with_(VERD, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score
  from vd where final_verdict = 'HIGH' order by deterministic_score desc, {KEYS} limit 10"""))
def q_v3_high(spark, sf):
    """V3: the summary's top-10 HIGH table (model off)."""
    from beatline.plans.pipeline import summary
    return rounded(summary(_results_off(spark, sf))["top_high"].select(*FLOW_KEY, "deterministic_score"))


@register("v3_summary", O.with_(MODELLED, f"""select 'counts' as section, v.verdict, '' as src_ip, '' as dst_ip, -1 as dst_port,
    cast(coalesce(n, 0) as double) as value from (values ('HIGH'), ('MEDIUM'), ('CLEAR'), ('SUPPRESSED')) v(verdict)
    left join (select final_verdict as verdict, count(*) as n from vd group by 1) c on c.verdict = v.verdict
  union all select * from (select 'top_high', final_verdict, {KEYS}, {O.r6('deterministic_score')} from vd
    where final_verdict = 'HIGH' order by deterministic_score desc, {KEYS} limit 10) a
  union all select * from (select 'top_medium', final_verdict, {KEYS}, {O.r6('deterministic_score')} from vd
    where final_verdict = 'MEDIUM' order by deterministic_score desc, {KEYS} limit 5) b
  union all select * from (select 'explained', final_verdict, {KEYS}, {O.r6('deterministic_score')} from vd
    where length(ml_explanation) > 0 order by deterministic_score desc, {KEYS} limit 5) c"""))
def q_v3(spark, sf):
    """V3: the summary's four tables (model on), one under the other."""
    from beatline.plans.pipeline import run_pipeline, summary
    from beatline.session import checkpoint_dir
    checkpoint_dir(spark)
    tables = summary(run_pipeline(_cx(spark, sf), sort=False).checkpoint(eager=True))
    none = [F.lit(v).alias(c) for c, v in zip(FLOW_KEY, ("", "", -1))]
    out = tables["verdict_counts"].select(F.lit("counts").alias("section"), F.col("final_verdict").alias("verdict"), *none,
                                          F.col("count").cast("double").alias("value"))
    for name in ("top_high", "top_medium", "explained"):
        out = out.unionByName(tables[name].select(F.lit(name).alias("section"), F.col("final_verdict").alias("verdict"),
                                                  *FLOW_KEY, F.col("deterministic_score").alias("value")))
    return rounded(out)


@register("m4_explain_all_flows", O.with_(_EXPLAINED, "select * from ex"))
def q_m4(spark, sf):
    """M4: the 2σ explanation text of every flow against the benign statistics."""
    from beatline.operators import anomaly
    scored, model = _fitted(spark, sf)
    return scored.select(*FLOW_KEY, anomaly.explanation(model.stats).alias("ml_explanation"))


@register("x8_explanation_parts", O.with_(_EXPLAINED, f"""select {KEYS}, cast(part_idx as integer) as part_idx, part
  from (select {KEYS}, unnest(range(len(string_split(ml_explanation, '; ')))) as part_idx,
               unnest(string_split(ml_explanation, '; ')) as part from ex where length(ml_explanation) > 0) t"""))
def q_x8(spark, sf):
    """Explanations split back into their parts (concat_ws / split)."""
    from beatline.operators.explore import explanation_parts
    return explanation_parts(q_m4(spark, sf))


# --- file round trips (sinks → readers) ------------------------------------------

def _scratch(spark, name: str) -> str:
    import uuid
    from beatline.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("k1_s5_csv_roundtrip", O.with_(O.base_ctes(), f"""select cast(flow_id as varchar) as flow_id, {KEYS}, ts_us,
  packet_size, {O.r6('connection_duration')} as connection_duration, bytes_sent,
  cast(bytes_received as double) as bytes_received, is_failed, has_dns_lookup from cx"""))
def q_k1_s5(spark, sf):
    """K1 → S5/S4: connections written as CSV, read back by name, normalised."""
    from beatline.operators.grouping import normalize_connections
    from beatline.sources.connections import read_connection_dir
    from beatline.sources.sinks import save_flows
    cx = _cx(spark, sf)
    out = cx.select(F.col("flow_id").cast("string").alias("flow_id"), *FLOW_KEY,
                    F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
                    "packet_size", "protocol", "connection_duration", "bytes_sent", "bytes_received",
                    "is_failed", "has_dns_lookup")
    path = _scratch(spark, "k1-connections")
    save_flows(out, path, fmt="csv")
    back = normalize_connections(read_connection_dir(spark, path))
    return rounded(back.select("flow_id", *FLOW_KEY, "ts_us", "packet_size", "connection_duration", "bytes_sent",
                               F.col("bytes_received").cast("double").alias("bytes_received"),
                               "is_failed", "has_dns_lookup"))


@register("s10_truth_roundtrip", O.with_([("gt", _GT)], f"select {KEYS}, is_malicious, beacon_type from gt"))
def q_s10(spark, sf):
    """K3-style CSV write of the truth, S10 read back, U2 keep-first dedup."""
    from beatline.operators.evaluate import dedup_truth
    from beatline.sources.connections import load_ground_truth
    from beatline.sources.sinks import save_false_positives
    path = _scratch(spark, "s10-truth")
    save_false_positives(td.ground_truth(spark, sf), path)
    back = dedup_truth(load_ground_truth(spark, path))
    return back.select(*FLOW_KEY, "is_malicious", "beacon_type")


@register("s4_single_file", O.with_(O.base_ctes(), f"""select cast(flow_id as varchar) as flow_id, {KEYS}, ts_us, packet_size,
  is_failed, '' as dst_domain from cx"""))
def q_s4(spark, sf):
    """Files read one by one through the single-file reader, columns in another order, no ``dst_domain``."""
    from beatline.operators.grouping import normalize_connections
    from beatline.sources.connections import read_connections
    from beatline.sources.files import list_files
    path = _scratch(spark, "s4-connections")
    (_cx(spark, sf).select("is_failed", F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
                           "packet_size", "dst_port", "dst_ip", "src_ip", "flow_id")
     .repartition(3).write.option("header", True).csv(path))
    parts = [read_connections(spark, f) for f in list_files(spark, path, (".csv",))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return normalize_connections(rows).select("flow_id", *FLOW_KEY, "ts_us", "packet_size", "is_failed",
                                              F.coalesce("dst_domain", F.lit("")).alias("dst_domain"))


@register("s6_header_variants", O.with_(_BL, "select " + ", ".join(
    O.r6(c) + f" as {c}" for c in ["flow_duration", "fwd_packets", "total_bwd_bytes", "dst_port"]) + " from bb"))
def q_s6(spark, sf):
    """Baseline files with two header spellings and column orders, read by name."""
    from beatline.sources.baseline import COLUMN_MAP, load_labelled_flows
    from beatline.sources.files import list_files
    raw = td.baseline_raw(spark, sf)
    path = _scratch(spark, "s6-baseline")
    plain = {v: k for k, v in COLUMN_MAP.items() if not k.startswith(" ")}
    even = F.col("fwd_packets") % 2 == 0
    raw.where(even).withColumnsRenamed({c: plain[c] for c in raw.columns}).write.option("header", True).csv(f"{path}/a")
    raw.where(~even).select(*reversed(raw.columns)).withColumnsRenamed({c: " " + plain[c] for c in raw.columns}).write.option(
        "header", True).csv(f"{path}/b")
    files = list_files(spark, f"{path}/a", (".csv",)) + list_files(spark, f"{path}/b", (".csv",))
    return rounded(load_labelled_flows(spark, files).select("flow_duration", "fwd_packets", "total_bwd_bytes", "dst_port"))


@register("k2_s11_saved_results", O.with_(VERD, f"select {KEYS}, {O.r6('deterministic_score')} as deterministic_score, final_verdict from vd"))
def q_k2(spark, sf):
    """Results saved by verdict and reloaded for investigation."""
    from beatline.sources.connections import load_saved
    from beatline.sources.sinks import save_results
    path = save_results(_results_off(spark, sf), _scratch(spark, "k2-results"), partition_by_verdict=True)
    return rounded(load_saved(spark, path)[0].select(*FLOW_KEY, "deterministic_score", "final_verdict"))


@register("k2_s11_saved_csv", O.with_(VERD, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score, num_connections,
  final_verdict from (select *, row_number() over (partition by final_verdict order by deterministic_score desc, {KEYS}) as r_ from vd) t
  where r_ <= 10"""))
def q_k2_csv(spark, sf):
    """Results saved as CSV come back typed, so the best ten of each verdict sort as numbers."""
    from beatline.sources.connections import load_saved
    from beatline.sources.sinks import save_results
    path = save_results(_results_off(spark, sf), _scratch(spark, "k2-csv"), fmt="csv")
    w = Window.partitionBy("final_verdict").orderBy(F.desc("deterministic_score"), *FLOW_KEY)
    back = load_saved(spark, path, fmt="csv")[0].withColumn("r", F.row_number().over(w)).where("r <= 10")
    return rounded(back.select(*FLOW_KEY, "deterministic_score", "num_connections", "final_verdict"))


@register("k4_exported_alerts", O.with_(VERD, f"""select {KEYS}, {O.r6('deterministic_score')} as deterministic_score, final_verdict
  from vd where final_verdict in ('HIGH', 'MEDIUM')"""))
def q_k4(spark, sf):
    """K4: exported alerts, read back."""
    from beatline.operators.explore import alert_filter
    from beatline.sources.sinks import export_alerts
    path = export_alerts(alert_filter(_results_off(spark, sf), ["HIGH", "MEDIUM"]), _scratch(spark, "k4-alerts"))
    back = spark.read.option("header", True).csv(path)
    return rounded(back.select("src_ip", "dst_ip", F.col("dst_port").cast("int").alias("dst_port"),
                               F.col("deterministic_score").cast("double").alias("deterministic_score"), "final_verdict"))
