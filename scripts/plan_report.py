"""Summarise the physical plans of the headline queries into PLANS.md.

    python scripts/plan_report.py [sf_dir]

For each query: exchanges by kind, sorts, windows, aggregates, joins, and
what the Parquet scans read (columns, pushed filters).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from beatline.session import get_spark  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> dict:
    head = text.split("\n\n(1)")[0]
    ops = re.findall(r"([A-Z][A-Za-z]+)(?: [A-Za-z]+){0,2} \(\d+\)", head)
    count = lambda name: sum(1 for o in ops if o == name)
    hash_ex = len(re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text))
    keys = sorted(set(re.sub(r"#\d+L?", "", k).rsplit(",", 1)[0]
                      for k in re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)))
    range_ex = len(re.findall(r"Arguments: rangepartitioning", text))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    pushed = [p for p in re.findall(r"PushedFilters: (\[[^\]]*\])", text) if p != "[]"]
    return {"exchanges(hash)": hash_ex, "hash keys": keys, "exchanges(range)": range_ex,
            "sorts": count("Sort"), "windows": count("Window"),
            "hash aggregates": count("HashAggregate"), "object/sort aggregates":
            count("ObjectHashAggregate") + count("SortAggregate"),
            "broadcast joins": count("BroadcastHashJoin"), "shuffle joins": count("SortMergeJoin")
            + count("ShuffledHashJoin"), "python stages": count("MapInPandas") + count("FlatMapGroupsInPandas")
            + count("ArrowEvalPython"), "scan columns": scans, "pushed filters": pushed}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("beatline-plans", master="local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # small test files would hide the exchanges
    from beatline.operators.evaluate import evaluate, merge_with_truth
    from beatline.operators.features import engineer_features, flow_rows, per_flow_features
    from beatline.operators.grouping import flow_summary
    from beatline.plans.pipeline import run_pipeline
    from beatline.sources import testdata as td

    events = spark.read.parquet(f"{sf}/events.parquet")
    # connections straight from Parquet (the adapter's window is a fixture, not the library)
    cx = td.connections(spark, sf)
    import tempfile
    path = os.path.join(tempfile.mkdtemp(prefix="beatline-plans-"), "connections")   # local review only
    cx.write.parquet(path)
    conn = spark.read.parquet(path)
    queries = {
        "per-flow features F0–F19 (window route)": per_flow_features(flow_rows(conn)),
        "features F0–F20": engineer_features(conn, hot_flow_rows=None),
        "flow summary A4": flow_summary(conn),
        "results, model off (V2)": run_pipeline(conn, use_model=False),
        "evaluation E9": evaluate(merge_with_truth(run_pipeline(conn, use_model=False, sort=False),
                                                  td.ground_truth(spark, sf))),
        "drill-down P9 (filter pushdown)": conn.where("src_ip = '10.0.0.1' and dst_port = 443")
                                               .select("ts_us", "packet_size"),
    }
    del events
    lines = ["# Physical plans of the headline queries", "",
             "Generated by `scripts/plan_report.py` (initial AQE plans, connections read from Parquet).",
             "", "Automatic broadcasts are off here, so joins are shown as they plan on large inputs; AQE re-plans",
             "them from measured sizes.  The library itself broadcasts only tables with a bound (see README).", ""]
    for name, df in queries.items():
        s = summary(plan_text(df))
        lines.append(f"## {name}")
        lines.append("")
        for k, v in s.items():
            lines.append(f"- {k}: {v}")
        lines.append("")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
