"""Sinks: K1–K4.  Writes are Spark jobs into a directory; nothing passes
through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: list[str] | None):
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    return w.format(fmt)


def save_flows(flows: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str | None:
    """K1: parsed connection records; nothing is written for an empty table."""
    if flows.isEmpty():
        return None
    _writer(flows, fmt, mode, None).save(path)
    return path


def save_results(results: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by_verdict: bool = False) -> str:
    """K2: the result table, optionally one folder per verdict."""
    _writer(results, fmt, mode, ["final_verdict"] if partition_by_verdict else None).save(path)
    return path


def save_false_positives(false_positives: DataFrame, path: str, fmt: str = "csv",
                         mode: str = "overwrite") -> str:
    """K3: the false-positive table of an evaluation."""
    _writer(false_positives, fmt, mode, None).save(path)
    return path


def export_alerts(filtered: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K4: filtered alerts as CSV."""
    _writer(filtered, "csv", mode, None).save(path)
    return path
