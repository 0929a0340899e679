"""Connection and truth readers: S4, S5, S10, S11, S12.

Files are found and read through Spark's file systems and matched by column
name, so columns may stand in any order and optional ones may be absent.  A
DataFrame the caller already holds (S12) goes straight into the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatline.schemas import CONNECTION_SCHEMA, FLOW_KEY, RESULT_SCHEMA, TRUTH_SCHEMA
from beatline.sources.files import exists, list_files, read_csv_by_name, typed

PREFERRED_FILE = "parsed_connections.csv"


def _connections(spark: SparkSession, files: list[str]) -> DataFrame:
    out = read_csv_by_name(spark, files, lambda scan: typed(
        scan, CONNECTION_SCHEMA, (*FLOW_KEY, "timestamp"), "connections"))
    return out if out is not None else spark.createDataFrame([], CONNECTION_SCHEMA)


def read_connections(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """One connections file (CSV with header, or Parquet)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if not exists(spark, path):
        raise FileNotFoundError(f"connections file not found: {path}")
    return _connections(spark, [path])


def read_connection_dir(spark: SparkSession, directory: str) -> DataFrame:
    """The well-known file if present, else every ``*.csv`` (sorted)."""
    one = f"{directory.rstrip('/')}/{PREFERRED_FILE}"
    if exists(spark, one):
        return _connections(spark, [one])
    files = list_files(spark, directory, (".csv",))
    if not files:
        raise FileNotFoundError(f"No CSV files found in directory: {directory}")
    return _connections(spark, files)


def load_ground_truth(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Truth rows with ``_row`` (file, then place in it) for keep-first deduplication.

    Inside one block of a CSV file rows are numbered as they are read; blocks and
    files are ordered by their own position, not by the task that read them.
    """
    if fmt == "parquet":
        return spark.read.parquet(path).withColumn("_row", F.struct("_metadata.file_path", "_metadata.row_index"))

    def pick(scan: DataFrame) -> DataFrame:
        place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                         F.monotonically_increasing_id().alias("n"))
        return typed(scan.withColumn("_row", place), TRUTH_SCHEMA, tuple(FLOW_KEY), "ground truth")
    files = list_files(spark, path, (".csv",)) if not path.endswith(".csv") else [path]
    if not files or not exists(spark, path):
        raise FileNotFoundError(f"ground truth not found: {path}")
    return read_csv_by_name(spark, files, pick)


def load_saved(spark: SparkSession, results_path: str, connections_path: str | None = None,
               fmt: str = "parquet") -> tuple[DataFrame, DataFrame | None]:
    """Reload saved results (and connections) for investigation.

    CSV columns get the types they were saved with, by name; empty cells of text columns come
    back as '' and columns without a known type as text.  ``results_path`` may hold one folder
    per verdict.
    """
    if fmt == "parquet":
        return spark.read.parquet(results_path), spark.read.parquet(connections_path) if connections_path else None

    def scan(path: str) -> DataFrame:
        # partition folders name a column too: text, like the rest
        return spark.read.option("header", True).option("enforceSchema", False).csv(path)

    def filled(df: DataFrame) -> DataFrame:
        return df.fillna("", [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    results = scan(results_path)
    known = StructType([f for f in RESULT_SCHEMA.fields if f.name in results.columns])
    con = typed(scan(connections_path), CONNECTION_SCHEMA, tuple(FLOW_KEY), "connections") if connections_path else None
    return filled(typed(results, known, tuple(FLOW_KEY), "results")), con
