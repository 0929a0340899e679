"""Files of any store, and CSV tables read by column name.

Folders are listed and header lines read through Hadoop's file system API (the
one Spark's own readers use), so a path works wherever Spark can read it.  Files
with the same header form one scan, whatever their number.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.functions.columns import epoch_micros

HEADER_THREADS = 32


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def list_files(spark: SparkSession, directory: str, suffixes: tuple[str, ...]) -> list[str]:
    """Files of one folder (not recursive) with one of the suffixes, sorted by name.

    A missing folder raises FileNotFoundError; any other failure is the store's own error.
    """
    fs, p = _file_system(spark, directory)
    if not fs.exists(p):
        raise FileNotFoundError(f"no such folder: {directory}")
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName().endswith(suffixes))


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in the first line of a CSV file, as they stand there; () for an empty file."""
    fs, p = _file_system(spark, path)
    jvm = spark._jvm
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = lines.readLine()
    finally:
        lines.close()
    return tuple(next(csv.reader([line.lstrip("﻿")]), ())) if line else ()


def read_csv_by_name(spark: SparkSession, files: list[str], pick: Callable[[DataFrame], DataFrame | None]) -> DataFrame | None:
    """Union by name of ``pick(scan)`` over one scan per header layout; None if none gives a table.

    A scan has the file's columns as strings.  Repeated names keep the first column.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for path, names in zip(files, pool.map(lambda f: header(spark, f), files)):
            if names:
                layouts.setdefault(names, []).append(path)
    out = None
    for names, paths in layouts.items():
        unique = [n if names.index(n) == i else f"_again{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in unique])
        part = pick(spark.read.schema(schema).option("header", True).csv(paths))
        if part is not None:
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def parsed(name: str, kind: T.DataType) -> Column:
    """A string column as ``kind``; text that does not parse is NULL."""
    s = F.trim(F.col(f"`{name}`"))
    if isinstance(kind, T.StringType):
        return F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.when(F.try_to_timestamp(s).isNotNull(), epoch_micros(s, T.StringType())))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(s.try_cast(kind), s.try_cast("double").try_cast(kind))
    return s.try_cast(kind)


def typed(scan: DataFrame, schema: T.StructType, required: tuple[str, ...] = (), what: str = "table") -> DataFrame:
    """Columns of ``schema`` by name (absent ones NULL), then the scan's other columns."""
    names = {c.strip(): c for c in reversed(scan.columns)}
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{what}: input is missing required columns: {missing}")
    known = [(parsed(names[f.name], f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
             for f in schema.fields]
    rest = [F.col(f"`{c}`") for c in scan.columns
            if c.strip() not in schema.fieldNames() and not c.startswith("_again")]
    return scan.select(*known, *rest)
