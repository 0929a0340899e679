"""Destination allowlist: L1–L6 (one CASE) and J5 (rule table join).

Rules are stated once, as rows (priority, prefixes, port, least hosts, reason);
the first match wins.  The default rules become a single ``CASE WHEN`` — a
projection, no shuffle — and, for joins, a table of the same rows.  A NULL input
makes a test NULL, which CASE treats as "no match", the same outcome as a rule
that raises and is skipped.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.functions.columns import require_columns


class Rule(NamedTuple):
    """``prefixes`` empty: any address; ``port`` None: any port; ``min_hosts`` None: any count."""
    priority: int
    prefixes: tuple[str, ...]
    port: int | None
    min_hosts: int | None
    reason: str


# ---------------------------------------------------------------------------
# Prefixes, threshold and reasons of the default rules.
# ---------------------------------------------------------------------------
RULES = (
    Rule(1, (), 123, None, "NTP traffic (dst_port 123)"),
    Rule(2, ("13.107.", "20.190.", "52.96."), 443, None, "Windows Update / Microsoft HTTPS endpoint"),
    Rule(3, ("13.107.", "20.190.", "52.96.", "172.217.", "104.16.", "151.101."), None, None,
         "Known CDN/cloud provider IP range"),
    Rule(4, (), None, 6, "Widely contacted destination (> 5 internal hosts)"),
)


def starts_with_any(ip: Column, prefixes) -> Column:
    """OR-chain of ``startswith`` (prefix tests, not CIDR)."""
    return reduce(lambda a, b: a | b, [ip.startswith(p) for p in prefixes])


def matches(rule: Rule, ip: Column, port: Column, hosts: Column) -> Column:
    """L1–L4: all tests a rule states."""
    tests = []
    if rule.prefixes:
        tests.append(starts_with_any(ip, rule.prefixes))
    if rule.port is not None:
        tests.append(port == rule.port)
    if rule.min_hosts is not None:
        tests.append(hosts >= rule.min_hosts)
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def allowlist_reason(ip, port, hosts=None, rules=RULES) -> Column:
    """Reason of the first matching rule, '' when none matches."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    port = F.col(port) if isinstance(port, str) else port
    hosts = F.lit(1) if hosts is None else (F.col(hosts) if isinstance(hosts, str) else hosts)
    ordered = sorted(rules, key=lambda r: r.priority)
    return reduce(lambda case, r: case.when(matches(r, ip, port, hosts), F.lit(r.reason)), ordered[1:],
                  F.when(matches(ordered[0], ip, port, hosts), F.lit(ordered[0].reason))).otherwise(F.lit(""))


def check_allowlist(ip, port, hosts=None, rules=RULES) -> Column:
    """``struct(allowlisted boolean, reason string)``."""
    reason = allowlist_reason(ip, port, hosts, rules)
    return F.struct((reason != F.lit("")).alias("allowlisted"), reason.alias("reason"))


def apply_allowlist(features: DataFrame, hosts_column: str = "num_internal_hosts_contacting",
                    rules=RULES) -> DataFrame:
    """Add ``destination_in_allowlist`` and ``allowlist_reason``.

    Hosts count as 1 when ``hosts_column`` is absent.  Tagged rows stay in
    the table (they are scored and feed the benign training set, T18).
    """
    require_columns(features, ["dst_ip", "dst_port"], "apply_allowlist")
    hosts = hosts_column if hosts_column in features.columns else None
    reason = allowlist_reason("dst_ip", "dst_port", hosts, rules)
    return (features.withColumn("allowlist_reason", reason)
            .withColumn("destination_in_allowlist", F.col("allowlist_reason") != F.lit("")))


def allowlist_stats(tagged: DataFrame) -> DataFrame:
    """Suppressed count, total and share (one row)."""
    flag = F.col("destination_in_allowlist")
    return tagged.agg(F.count_if(flag).alias("num_suppressed"),
                      F.count(F.lit(1)).alias("num_flows"),
                      F.coalesce(F.avg(flag.cast("double")), F.lit(0.0)).alias("suppressed_share"))


def default_rule_table(spark) -> DataFrame:
    """The default rules as a table: one row per (priority, prefix, port) test.

    ``prefix`` NULL matches any address, ``port`` NULL any port,
    ``min_hosts`` NULL any host count.
    """
    rows = [(r.priority, p, r.port, r.min_hosts, r.reason) for r in RULES for p in r.prefixes or (None,)]
    return spark.createDataFrame(
        rows, "priority int, prefix string, port int, min_hosts long, reason string")


ANY_PREFIX = "*"
ANY_PORT = -1
SALTS = 16


def apply_rule_table(features: DataFrame, rules: DataFrame,
                     hosts_column: str = "num_internal_hosts_contacting") -> DataFrame:
    """First-match allowlist against a rule *table* (for long user lists).

    The prefix test becomes an exact equi-join: every flow emits the prefixes of
    its ``dst_ip`` of the lengths that rules have (plus ``'*'`` for rules without a
    prefix) crossed with ``{dst_port, -1}`` where rules without a port exist; rules
    are keyed the same way.  The host floor is a filter after the join and the lowest
    priority wins via ``min_by``; of equal priorities the longest prefix, then a rule for the
    port before one for any, then the higher host floor, then prefix and reason in order.

    Spark broadcasts the rules if their measured size allows, else the join shuffles.
    Prefixes are shared by very many flows (``'*'`` by all), so both sides carry a
    salt: a flow its own, a rule every one.
    """
    require_columns(features, ["dst_ip", "dst_port"], "apply_rule_table")
    key = ["src_ip", "dst_ip", "dst_port"]
    hosts = F.col(hosts_column) if hosts_column in features.columns else F.lit(1)
    r = rules.select(F.coalesce("prefix", F.lit(ANY_PREFIX)).alias("_pfx"),
                     F.coalesce("port", F.lit(ANY_PORT)).alias("_prt"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
                     "priority", "min_hosts", "reason")
    shape = rules.agg(F.collect_set(F.when(F.col("prefix").isNotNull(), F.length("prefix"))).alias("lengths"),
                      F.coalesce(F.bool_or(F.col("prefix").isNull()), F.lit(False)).alias("any_prefix"),
                      F.coalesce(F.bool_or(F.col("port").isNull()), F.lit(False)).alias("any_port")).first()
    ip, long_enough = F.col("dst_ip"), F.length("dst_ip")
    tests = [F.when(long_enough >= n, F.substring(ip, 1, n)) for n in sorted(shape.lengths)]
    tests += [F.lit(ANY_PREFIX)] if shape.any_prefix else []
    ports = [F.col("dst_port")] + ([F.lit(ANY_PORT)] if shape.any_port else [])
    cand = (features.select(*key, hosts.alias("_hosts"), F.pmod(F.xxhash64(*key), F.lit(SALTS)).cast("int").alias("_salt"),
                            F.explode(F.array(*tests or [F.lit(None).cast("string")])).alias("_pfx"))
            .where(F.col("_pfx").isNotNull()).withColumn("_prt", F.explode(F.array(*ports))))
    joined = cand.join(r, ["_pfx", "_prt", "_salt"], "inner")
    rank = F.struct("priority", F.when(F.col("_pfx") == ANY_PREFIX, 0).otherwise(-F.length("_pfx")).alias("a"),
                    (F.col("_prt") == ANY_PORT).alias("b"), (-F.coalesce("min_hosts", F.lit(0))).alias("c"), "_pfx", "reason")
    found = (joined.where(F.col("min_hosts").isNull() | (F.col("_hosts") >= F.col("min_hosts")))
               .groupBy(*key).agg(F.min_by("reason", rank).alias("_reason")))
    out = features.join(found, key, "left")
    return (out.withColumn("allowlist_reason", F.coalesce(F.col("_reason"), F.lit("")))
            .withColumn("destination_in_allowlist", F.col("allowlist_reason") != F.lit(""))
            .drop("_reason"))
