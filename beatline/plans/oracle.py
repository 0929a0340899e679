"""DuckDB statements of the registered queries (the correctness oracle).

Each builder returns CTE text stating, in SQL, the same formulas the Spark
operators use; the driver runs them on the same parquet tables.  Float
outputs are rounded with ``floor(x·1e6 + 0.5)/1e6`` on both sides.
"""

from __future__ import annotations

from beatline.schemas import FEATURE_COLUMNS, INTEGER_FEATURES
from beatline.sources.testdata import duckdb_views

# ---------------------------------------------------------------------------
# Fixed values, stated here on their own so that a wrong one in the code under
# test does not pass on both sides.
# ---------------------------------------------------------------------------
WEIGHTED = [("interval_cov_score", 0.30), ("bytes_cov_score", 0.10), ("autocorrelation_sub_score", 0.15),
            ("num_connections_score", 0.10), ("session_duration_score", 0.10), ("off_hours_score", 0.10),
            ("not_allowlisted_score", 0.05), ("direct_ip_score", 0.05), ("low_internal_hosts_score", 0.05)]
TECHNIQUES = {
    "fixed": "T1071.001 — Application Layer Protocol: Web Protocols (fixed-interval beacon)",
    "jittered": "T1071.001 — Application Layer Protocol: Web Protocols (jittered beacon with sleep randomisation)",
    "evasive": "T1573 — Encrypted Channel / T1090 — Proxy (low-and-slow evasive beacon)",
    "unlikely": "No strong MITRE mapping — likely benign",
}
EXFILTRATION = "T1041 — Exfiltration Over C2 Channel"
MODEL_FEATURES = ["interval_cov", "mean_interval", "std_interval", "bytes_cov", "mean_bytes", "num_connections",
                  "session_duration", "pct_connections_off_hours", "mean_connection_duration",
                  "failed_connection_ratio", "payload_entropy"]

DESCRIPTIONS = {
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

KEY = "src_ip, dst_ip, dst_port"
US = "CAST(1000000 AS DOUBLE)"


def r6(expr: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.5) / 1e6"


def r2(expr: str) -> str:
    return f"floor(({expr}) * 100.0 + 0.5) / 100.0"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def base_ctes() -> list[tuple[str, str]]:
    v = duckdb_views()
    return [("cx", v["cx"])]


def features_ctes(min_conn: int = 10, src: str = "cx", tiebreak: str = "flow_id",
                  domain: str = "''") -> list[tuple[str, str]]:
    wk = f"(partition by {KEY})"
    wo = f"(partition by {KEY} order by ts_us asc nulls last, tb0 asc nulls last)"
    ctes = [
        ("fr", f"""select src_ip, dst_ip, cast(dst_port as integer) as dst_port, ts_us, {tiebreak} as tb0, {domain} as dom,
  coalesce(cast(packet_size as double), 0.0) as ps,
  coalesce(cast(bytes_sent as bigint), 0) as snt, coalesce(cast(bytes_received as bigint), 0) as rcv,
  coalesce(cast(bytes_sent as bigint), 0) + coalesce(cast(bytes_received as bigint), 0) as tot,
  coalesce(cast(connection_duration as double), 0.0) as dur,
  coalesce(cast(is_failed as integer), 0) as failed, coalesce(cast(has_dns_lookup as integer), 0) as dns
from {src} where src_ip is not null and dst_ip is not null and dst_port is not null"""),
        ("fs1", f"""select *, count(*) over {wk} as n_, count(ts_us) over {wk} as m_,
  min(ts_us) over {wk} as tmin_, max(ts_us) over {wk} as tmax_, lag(ts_us, 1) over {wo} as prev_,
  min(ps) over {wk} as lo_, max(ps) over {wk} as hi_, sum(tot) over {wk} as stot_, sum(cast(dur as decimal(38,9))) over {wk} as sdur_
from fr"""),
        ("fs2", f"""select *, ts_us - prev_ as d_us,
  case when m_ > 1 then (tmax_ - tmin_) / (m_ - 1) / {US} end as mu_,
  stot_ / n_ as mtot_, cast(sdur_ as double) / n_ as mdur_
from fs1 where n_ >= {int(min_conn)}"""),
        ("fs3", "select *, " + ", ".join(f"lag(d_us, {k}) over {wo} as dl{k}" for k in range(1, 6))
         + f""", median(d_us) over {wk} as med_,
  case when hi_ > lo_ then least(19, floor((ps - lo_) / (hi_ - lo_) * 20.0)) else 0 end as bin_
from fs2"""),
    ]
    c = f"(d_us / {US} - mu_)"
    hour = "floor((((ts_us % 86400000000) + 86400000000) % 86400000000) / 3600000000)"
    agg = [f"{KEY}", "first(dom order by ts_us asc nulls last, tb0 asc nulls last) as dom_", "count(*) as n_", "count(d_us) as L_", "max(ts_us) as tmax_", "min(ts_us) as tmin_",
           f"sum({c} * {c}) as var_"]
    agg += [f"sum({c} * (dl{k} / {US} - mu_)) as ac{k}_" for k in range(1, 6)]
    agg += ["median(abs(d_us - med_)) as mad_us_",
            f"sum(case when ts_us is not null and {hour} between 0 and 5 then 1 else 0 end) as off_",
            "sum(tot) as stot_", "max(tot) as maxtot_", "sum((tot - mtot_) * (tot - mtot_)) as sstot_",
            "sum(snt) as ssent_", "sum(rcv) as srecv_", "max(hi_) as hi_", "max(lo_) as lo_"]
    agg += [f"count_if(bin_ = {b}) as b{b}_" for b in range(20)]
    agg += ["sum(cast(dur as decimal(38,9))) as sdur_", "sum((dur - mdur_) * (dur - mdur_)) as ssdur_",
            "sum(failed) as sfailed_", "sum(dns) as sdns_"]
    ctes.append(("fa", "select " + ",\n  ".join(agg) + f"\nfrom fs3 group by {KEY}"))
    mean_iv = f"(case when L_ > 0 then (tmax_ - tmin_) / L_ / {US} else 0.0 end)"
    std_iv = "(case when L_ > 1 then sqrt(var_ / (L_ - 1)) else 0.0 end)"
    acmax = "greatest(" + ", ".join(f"abs(ac{k}_)" for k in range(1, 6)) + ")"
    mean_b = "(stot_ / n_)"
    std_b = "(case when n_ > 1 then sqrt(sstot_ / (n_ - 1)) else 0.0 end)"
    ent = " + ".join(f"(case when b{b}_ > 0 then b{b}_ / n_ * log2(b{b}_ / n_) else 0.0 end)"
                     for b in range(20))
    feats = {
        "mean_interval": mean_iv,
        "std_interval": std_iv,
        "interval_cov": f"(case when {mean_iv} = 0 then 0.0 else {std_iv} / {mean_iv} end)",
        "interval_mad": f"(case when L_ > 1 then mad_us_ / {US} else 0.0 end)",
        "autocorrelation_score": f"(case when L_ >= 7 and var_ > 0 then {acmax} / var_ else 0.0 end)",
        "session_duration": f"coalesce((tmax_ - tmin_) / {US}, 0.0)",
        "pct_connections_off_hours": "(off_ / n_)",
        "mean_bytes": mean_b,
        "std_bytes": std_b,
        "bytes_cov": f"(case when {mean_b} = 0 then 0.0 else {std_b} / {mean_b} end)",
        "bytes_sent_received_ratio": "(case when srecv_ = 0 then 0.0 else (ssent_ / n_) / (srecv_ / n_) end)",
        "payload_entropy": f"(case when n_ >= 2 and hi_ > lo_ then -({ent}) else 0.0 end)",
        "has_anomalous_burst": f"(case when {mean_b} > 0 and maxtot_ > 5.0 * {mean_b} then 1 else 0 end)",
        "num_connections": "n_",
        "num_unique_ports": "1",
        "mean_connection_duration": "(cast(sdur_ as double) / n_)",
        "std_connection_duration": "(case when n_ > 1 then sqrt(ssdur_ / (n_ - 1)) else 0.0 end)",
        "failed_connection_ratio": "(sfailed_ / n_)",
        "is_direct_ip_no_dns": "(case when sdns_ / n_ < 0.5 then 1 else 0 end)",
    }
    ctes.append(("f0", f"select {KEY}, coalesce(dom_, '') as dst_domain, "
                 + ",\n  ".join(f"{v} as {k}" for k, v in feats.items()) + "\nfrom fa"))
    ctes.append(("feat", "select *, count(*) over (partition by dst_ip, dst_port) "
                 "as num_internal_hosts_contacting from f0"))
    return ctes


def allowlist_expr(ip="dst_ip", port="dst_port", hosts="num_internal_hosts_contacting") -> str:
    def one_of(*prefixes: str) -> str:
        return " or ".join(f"starts_with({ip}, {q(p)})" for p in prefixes)
    return (f"(case when {port} = 123 then 'NTP traffic (dst_port 123)'"
            f" when {port} = 443 and ({one_of('13.107.', '20.190.', '52.96.')})"
            " then 'Windows Update / Microsoft HTTPS endpoint'"
            f" when {one_of('13.107.', '20.190.', '52.96.', '172.217.', '104.16.', '151.101.')}"
            " then 'Known CDN/cloud provider IP range'"
            f" when {hosts} > 5 then 'Widely contacted destination (> 5 internal hosts)' else '' end)")


def scored_ctes() -> list[tuple[str, str]]:
    sub = {
        "interval_cov_score": "least(greatest(100.0 * (1.0 - interval_cov / 0.5), 0.0), 100.0)",
        "bytes_cov_score": "least(greatest(100.0 * (1.0 - bytes_cov / 1.0), 0.0), 100.0)",
        "autocorrelation_sub_score": "least(greatest(autocorrelation_score * 100.0, 0.0), 100.0)",
        "num_connections_score": "least(100.0, num_connections * 2.0)",
        "session_duration_score": "least(100.0, session_duration / 3600.0 * 100.0)",
        "off_hours_score": "least(100.0, pct_connections_off_hours * 100.0)",
        "not_allowlisted_score": "(case when destination_in_allowlist then 0.0 else 100.0 end)",
        "direct_ip_score": "(case when is_direct_ip_no_dns <> 0 then 100.0 else 0.0 end)",
        "low_internal_hosts_score": "greatest(0.0, 100.0 * (1.0 - num_internal_hosts_contacting / 10.0))",
    }
    total = "0.0"
    for col, weight in WEIGHTED:
        total = f"({total} + {col} * {weight!r})"
    btype = ("(case when mean_interval > 300 then 'evasive'"
             " when interval_cov < 0.1 and mean_interval < 120 then 'fixed'"
             " when interval_cov >= 0.1 and interval_cov <= 0.4 and mean_interval < 120 then 'jittered'"
             " else 'unlikely' end)")
    mitre = "(case beacon_type_guess " + " ".join(
        f"when {q(k)} then {q(v)}" for k, v in TECHNIQUES.items()) + f" else {q(TECHNIQUES['unlikely'])} end)"
    return [
        ("al", f"select *, {allowlist_expr()} as allowlist_reason from feat"),
        ("al2", "select *, allowlist_reason <> '' as destination_in_allowlist from al"),
        ("sc1", "select *, " + ", ".join(f"{v} as {k}" for k, v in sub.items()) + " from al2"),
        ("sc2", f"select *, {r2('least(greatest(' + total + ', 0.0), 100.0)')} as deterministic_score,"
                f" {btype} as beacon_type_guess from sc1"),
        ("sc", f"select *, case when has_anomalous_burst <> 0 then {mitre} || {q(' + ' + EXFILTRATION)}"
               f" else {mitre} end as suggested_mitre_technique from sc2"),
    ]


def verdict_ctes(ml_expr: str = "0.0", expl_expr: str = "''") -> list[tuple[str, str]]:
    return [("vd", f"""select *, {ml_expr} as ml_score, {expl_expr} as ml_explanation,
  case when destination_in_allowlist then 'SUPPRESSED'
       when deterministic_score > 75.0 then 'HIGH'
       when deterministic_score > 40.0 or {ml_expr} > 70.0 then 'MEDIUM'
       else 'CLEAR' end as final_verdict
from sc""")]


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    return "with " + ",\n".join(f"{n} as {'materialized ' * n.endswith('_')}(\n{body}\n)" for n, body in ctes) + "\n" + final


def feature_select(cols=None, prefix: str = "") -> str:
    cols = cols or FEATURE_COLUMNS
    out = []
    for c in cols:
        out.append(f"{prefix}{c}" if c in INTEGER_FEATURES else f"{r6(prefix + c)} as {c}")
    return ", ".join(out)


# --- the isolation forest ------------------------------------------------------

def _digits(expr: str, start: int, size: int) -> str:
    return f"cast('0x' || substr({expr}, {start}, {size}) as bigint)"


def forest_ctes(trees: int = 200, seed: int = 42, psi: int = 256, depth: int = 8) -> list[tuple[str, str]]:
    """The forest grown level by level, and every flow's model score (``ml``).

    ``tr`` are the training flows, ``sc`` all flows.  Path lengths are summed in
    billionths.  For fewer than ``psi`` training rows the depth is that of their number.
    """
    xs = "[" + ", ".join(f"floor(cast({c} as double) * 1e6 + 0.5) / 1e6" for c in MODEL_FEATURES) + "]"
    prime = 2147483647
    n = len(MODEL_FEATURES)

    def c_units(x: str) -> str:
        return (f"(case when {x} > 2 then cast(floor((2.0 * (ln({x} - 1.0) + 0.5772156649015329) - 2.0 * ({x} - 1.0) / {x})"
                f" * 1e9 + 0.5) as bigint) when {x} = 2 then 1000000000 else 0 end)")

    nums = ", ".join(f"{_digits(f"md5('{seed}|' || t || '|{k}')", 1, 8)} % {prime - 1} + 1 as n{k}" for k in range(6))
    x4 = ", ".join(f"{_digits('m', 1 + 7 * k, 7)} as x{k}" for k in range(4))
    out = [
        ("size_", f"select least({psi}, count(*)) as psi, cast(ceil(log2(greatest(least({psi}, count(*)), 2))) as integer) as deep from tr"),
        ("num_", f"select t, {nums} from (select unnest(range({trees})) as t) z"),
        ("row_", f"select rid, xs, {x4} from (select concat_ws('|', src_ip, dst_ip, cast(dst_port as varchar), '0') as rid, "
                 f"md5(concat_ws('|', src_ip, dst_ip, cast(dst_port as varchar), '0', '{seed}')) as m, {xs} as xs from tr) z"),
        ("pick_", f"""select t, xs from (select t, xs, row_number() over (partition by t order by
  ((x0 * n0 + x1 * n1 + n2) % {prime}) * 2147483648 + (x2 * n3 + x3 * n4 + n5) % {prime}, rid) as r from row_, num_) z, size_ where r <= psi"""),
        ("l0_", "select t, cast(1 as bigint) as node, xs from pick_"),
    ]
    lows = "[" + ", ".join(f"min(xs[{i + 1}])" for i in range(n)) + "]"
    highs = "[" + ", ".join(f"max(xs[{i + 1}])" for i in range(n)) + "]"
    for d in range(depth + 1):
        out.append((f"g{d}_", f"select t, node, count(*) as size, {lows} as lo, {highs} as hi from l{d}_ group by t, node"))
        split = f"cnt > 0 and size > 1 and {d} < deep"
        out.append((f"s{d}_", f"""select t, node, size, {d} as depth, f, case when f is null then 0.0 when lo[f + 1] + u * (hi[f + 1] - lo[f + 1]) >= hi[f + 1]
  then lo[f + 1] else lo[f + 1] + u * (hi[f + 1] - lo[f + 1]) end as threshold
from (select *, case when {split} then cand[({_digits('m', 1, 8)} * cnt) // 4294967296 + 1] end as f, {_digits('m', 9, 13)} / 4503599627370496.0 as u
  from (select *, len(cand) as cnt from (select *, list_filter(range({n}), lambda i: lo[i + 1] < hi[i + 1]) as cand,
    md5('{seed}|' || t || '|node|' || node) as m from g{d}_) a) b, size_) c"""))
        if d < depth:
            out.append((f"l{d + 1}_", f"""select l.t, 2 * l.node + case when l.xs[s.f + 1] > s.threshold then 1 else 0 end as node, l.xs
from l{d}_ l join s{d}_ s on l.t = s.t and l.node = s.node where s.f is not null"""))
    out.append(("forest_", " union all ".join(f"select * from s{d}_" for d in range(depth + 1))))
    out.append(("w0_", f"select {KEY}, xs, t, cast(1 as bigint) as node from (select {KEY}, {xs} as xs from sc) z, (select unnest(range({trees})) as t) y"))
    for d in range(depth):
        out.append((f"w{d + 1}_", f"""select {KEY}, xs, w.t, case when s.f is null then w.node
  else 2 * w.node + case when w.xs[s.f + 1] > s.threshold then 1 else 0 end end as node
from w{d}_ w join forest_ s on w.t = s.t and w.node = s.node"""))
    out.append(("an_", f"""select {KEY}, pow(2.0, -(cast(h as double) / {float(trees)!r} / 1e9) / ({c_units('psi')} / 1e9)) as a
from (select {KEY}, sum(cast(s.depth as bigint) * 1000000000 + {c_units('s.size')}) as h from w{depth}_ w join forest_ s on w.t = s.t and w.node = s.node
  group by {KEY}) z, size_"""))
    out.append(("ml", f"""select {KEY}, case when hi - lo > 0 then {r2('100.0 * (a - lo) / (hi - lo)')} else 50.0 end as ml_score
from an_, (select min(a) as lo, max(a) as hi from an_) z"""))
    return out
