
import numpy as np
import pytest

from beatline.operators.features import engineer_features
from helpers import flow, frame


def restate(times, sizes, recv, durations, failed, dns):
    """Per-flow features from the definitions, in plain NumPy."""
    n = len(times)
    t = np.array([x for x in times if x is not None], dtype=float)
    t.sort()
    d = np.diff(t) if len(t) >= 2 else np.array([0.0])
    d = d if n >= 2 else np.array([0.0])
    mean = d.mean() if len(d) else 0.0
    std = d.std(ddof=1) if len(d) > 1 else 0.0
    ac = 0.0
    if len(d) >= 7:
        c = d - d.mean()
        var = (c ** 2).sum()
        if var:
            full = np.correlate(c, c, "full") / var
            mid = len(full) // 2
            ac = max(abs(full[mid + k]) for k in range(1, 6))
    tot = np.array(sizes, dtype=float) + np.array([0 if r is None else r for r in recv], dtype=float)
    ps = np.array(sizes, dtype=float)
    if n >= 2 and ps.max() > ps.min():
        b = np.minimum(19, np.floor((ps - ps.min()) / (ps.max() - ps.min()) * 20)).astype(int)
        p = np.bincount(b, minlength=20) / n
        p = p[p > 0]
        ent = float(-(p * np.log2(p)).sum())
    else:
        ent = 0.0
    hours = [(int(x) // 3600) % 24 for x in times if x is not None]
    mean_recv = np.mean([0 if r is None else r for r in recv])
    return {
        "mean_interval": mean, "std_interval": std, "interval_cov": std / mean if mean else 0.0,
        "interval_mad": float(np.median(np.abs(d - np.median(d)))) if len(d) > 1 else 0.0,
        "autocorrelation_score": ac, "session_duration": (t.max() - t.min()) if len(t) else 0.0,
        "pct_connections_off_hours": sum(1 for h in hours if h <= 5) / n,
        "mean_bytes": tot.mean(), "std_bytes": tot.std(ddof=1) if n > 1 else 0.0,
        "bytes_cov": (tot.std(ddof=1) / tot.mean()) if n > 1 and tot.mean() else 0.0,
        "bytes_sent_received_ratio": (np.mean(sizes) / mean_recv) if mean_recv else 0.0,
        "payload_entropy": ent,
        "has_anomalous_burst": int(tot.mean() > 0 and (tot > 5 * tot.mean()).any()),
        "num_connections": n, "num_unique_ports": 1,
        "mean_connection_duration": float(np.mean(durations)),
        "std_connection_duration": float(np.std(durations, ddof=1)) if n > 1 else 0.0,
        "failed_connection_ratio": float(np.mean(failed)),
        "is_direct_ip_no_dns": int(np.mean(dns) < 0.5),
    }


def cases():
    rng = np.random.default_rng(2024)
    out = []
    for i in range(8):
        n = int(rng.integers(10, 60))
        gaps = {0: rng.normal(60, 3, n), 1: rng.exponential(40, n), 2: np.full(n, 30.0),
                3: rng.choice([1.0, 300.0], n), 4: np.zeros(n), 5: rng.normal(600, 90, n),
                6: rng.uniform(0, 5, n), 7: rng.exponential(3600, n)}[i]
        times = list(np.round(np.cumsum(np.abs(gaps)), 6))
        if i == 3:
            times[2] = None
            times[7] = None
        sizes = [int(x) for x in rng.integers(40, 1500, n)] if i % 2 else [250] * n
        if i == 6:
            sizes[5] = 90_000
        recv = [None if (i == 1 and k % 3 == 0) else int(rng.integers(0, 400)) for k in range(n)]
        durations = list(np.round(rng.exponential(2.0, n), 3))
        failed = list(rng.integers(0, 2, n))
        dns = list(rng.integers(0, 2, n)) if i % 3 else [0] * n
        out.append((f"10.8.0.{i}", times, sizes, recv, durations, failed, dns))
    return out


def test_features_match_numpy_restatement(spark):
    rows = []
    for k, (src, times, sizes, recv, durations, failed, dns) in enumerate(cases()):
        base = flow(times, sizes=sizes, src=src, recv=recv, start_id=1000 * k)
        rows += [r[:6] + (float(durations[j]), r[7], r[8], int(failed[j]), int(dns[j]))
                 for j, r in enumerate(base)]
    got = {r.src_ip: r.asDict() for r in engineer_features(frame(spark, rows)).collect()}
    assert len(got) == 8
    for src, times, sizes, recv, durations, failed, dns in cases():
        want = restate(times, sizes, recv, durations, failed, dns)
        for k, v in want.items():
            assert got[src][k] == pytest.approx(v, rel=1e-9, abs=1e-9), (src, k)
