import pytest

from beatline.operators.allowlist import (
    apply_allowlist, apply_rule_table, check_allowlist, default_rule_table,
)
from beatline.operators.scoring import MITRE_MAP, EXFIL_TECHNIQUE, score_flows
from beatline.operators.verdict import verdict, verdict_counts

SCORE_COLS = ("interval_cov double, bytes_cov double, autocorrelation_score double, num_connections long, "
              "session_duration double, pct_connections_off_hours double, destination_in_allowlist boolean, "
              "is_direct_ip_no_dns int, num_internal_hosts_contacting long, mean_interval double, "
              "has_anomalous_burst int")


def test_scoring_goldens(spark):
    rows = [(.05, .1, .9, 80, 7200.0, .6, False, 1, 1, 60.0, 0),
            (1.2, 1.5, .1, 25, 3600.0, .1, True, 0, 8, 200.0, 0),
            (.25, .3, .6, 45, 5400.0, .4, False, 1, 2, 90.0, 1)]
    out = score_flows(spark.createDataFrame(rows, SCORE_COLS)).collect()
    assert [r.deterministic_score for r in out] == pytest.approx([90.0, 18.5, 68.0], abs=0.01)
    assert [r.beacon_type_guess for r in out] == ["fixed", "unlikely", "jittered"]
    assert out[0].suggested_mitre_technique == MITRE_MAP["fixed"]
    assert out[2].suggested_mitre_technique == MITRE_MAP["jittered"] + " + " + EXFIL_TECHNIQUE
    for r in out:
        for k in ("interval_cov_score", "bytes_cov_score", "autocorrelation_sub_score",
                  "num_connections_score", "session_duration_score", "off_hours_score"):
            assert 0.0 <= r[k] <= 100.0


@pytest.mark.parametrize("mean,cov,expected", [
    (300.0, .05, "unlikely"), (300.01, .05, "evasive"), (119.99, .0999, "fixed"), (119.99, .1, "jittered"),
    (119.99, .4, "jittered"), (119.99, .4001, "unlikely"), (120.0, .05, "unlikely")])
def test_type_edges(spark, mean, cov, expected):
    row = [(cov, 0.5, 0.0, 20, 100.0, 0.0, False, 0, 1, mean, 0)]
    assert score_flows(spark.createDataFrame(row, SCORE_COLS)).first().beacon_type_guess == expected


@pytest.mark.parametrize("allow,det,ml,expected", [
    (False, 75.0, 0.0, "MEDIUM"), (False, 75.01, 0.0, "HIGH"), (False, 40.0, 70.0, "CLEAR"),
    (False, 40.0, 70.01, "MEDIUM"), (True, 99.0, 0.0, "SUPPRESSED")])
def test_verdict_edges(spark, allow, det, ml, expected):
    df = spark.createDataFrame([(allow, det, ml)], "destination_in_allowlist boolean, "
                               "deterministic_score double, ml_score double")
    assert df.select(verdict().alias("v")).first().v == expected


ALLOW_CASES = [("192.168.1.50", 123, 1, True), ("13.107.42.14", 443, 1, True), ("13.107.42.14", 80, 1, True),
               ("172.217.14.99", 443, 1, True), ("104.16.51.111", 443, 1, True), ("151.101.1.69", 443, 1, True),
               ("10.20.30.40", 8443, 8, True), ("45.33.32.156", 443, 1, False), ("192.168.1.1", 80, 2, False),
               ("10.20.30.40", 8443, 5, False), ("10.20.30.40", 8443, 6, True)]


def test_allowlist_cases(spark):
    df = spark.createDataFrame([(i, p, h) for i, p, h, _ in ALLOW_CASES],
                               "dst_ip string, dst_port int, num_internal_hosts_contacting long")
    got = [r.a.allowlisted for r in
           df.select(check_allowlist("dst_ip", "dst_port", "num_internal_hosts_contacting").alias("a")).collect()]
    assert got == [e for *_, e in ALLOW_CASES]
    first = spark.createDataFrame([("13.107.42.14", 123)], "dst_ip string, dst_port int")
    assert apply_allowlist(first).first().allowlist_reason == "NTP traffic (dst_port 123)"


def test_rule_table_equals_case(spark):
    df = spark.createDataFrame([(f"10.0.0.{k}", i, p, h) for k, (i, p, h, _) in enumerate(ALLOW_CASES)],
                               "src_ip string, dst_ip string, dst_port int, num_internal_hosts_contacting long")
    a = sorted((r.src_ip, r.allowlist_reason) for r in apply_allowlist(df).collect())
    b = sorted((r.src_ip, r.allowlist_reason) for r in apply_rule_table(df, default_rule_table(spark)).collect())
    assert a == b


def test_verdict_counts_lists_all(spark):
    df = spark.createDataFrame([("HIGH",), ("HIGH",), ("CLEAR",)], "final_verdict string")
    got = {r.final_verdict: r["count"] for r in verdict_counts(df).collect()}
    assert got == {"HIGH": 2, "MEDIUM": 0, "CLEAR": 1, "SUPPRESSED": 0}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_rule_table_random_equivalence(spark, threshold):
    import random
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)      # -1: salted shuffle join
    rnd = random.Random(7)
    heads = ["13.107", "20.190", "52.96", "172.217", "104.16", "151.101", "13.10", "45.33", "10.0", "104.160"]
    rows = []
    for i in range(400):
        ip = f"{rnd.choice(heads)}.{rnd.randint(0, 255)}.{rnd.randint(0, 255)}"
        rows.append((f"10.9.{i // 256}.{i % 256}", ip, rnd.choice([123, 443, 80, 8443]), rnd.randint(1, 9)))
    df = spark.createDataFrame(rows, "src_ip string, dst_ip string, dst_port int, num_internal_hosts_contacting long")
    a = sorted((r.src_ip, r.allowlist_reason) for r in apply_allowlist(df).collect())
    b = sorted((r.src_ip, r.allowlist_reason) for r in apply_rule_table(df, default_rule_table(spark)).collect())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b
    assert len({r for _, r in a}) == 5          # every rule and "no match" occur


def test_rules_of_one_priority_do_not_depend_on_the_order_of_rows(spark):
    from beatline.operators.allowlist import apply_rule_table
    rules = [(1, "10.", None, None, "wide"), (1, "10.1.", None, None, "narrow"), (1, "10.1.", 443, None, "port"),
             (1, None, None, None, "any"), (1, "10.1.", 443, 5, "hosts"), (0, "99.", None, None, "first")]
    table = spark.createDataFrame(rules, "priority int, prefix string, port int, min_hosts long, reason string")
    flows = spark.createDataFrame([("s", f"10.1.0.{i}", 443, 9) for i in range(60)] + [("s", "10.1.0.1", 80, 9), ("s", "10.2.0.1", 80, 9),
                                   ("s", "8.8.8.8", 53, 9), ("s", "99.1.1.1", 1, 1)],
                                  "src_ip string, dst_ip string, dst_port int, num_internal_hosts_contacting long").dropDuplicates()
    for parts in (1, 5):
        got = {(r.dst_ip, r.dst_port, r.num_internal_hosts_contacting): r.allowlist_reason
               for r in apply_rule_table(flows.repartition(parts), table.repartition(parts)).collect()}
        assert got["10.1.0.7", 443, 9] == "hosts" and got["10.1.0.1", 80, 9] == "narrow" and got["10.2.0.1", 80, 9] == "wide"
        assert got["8.8.8.8", 53, 9] == "any" and got["99.1.1.1", 1, 1] == "first"
