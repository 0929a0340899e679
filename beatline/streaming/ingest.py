"""S5/K1 as Structured Streaming: connection CSVs arriving in a directory are
normalised (µs time, no NULL keys) and appended to a Parquet table
partitioned by UTC day.  Exactly-once through the file sink's log and the
query checkpoint, which lives in the session's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from beatline.functions.columns import MICROS_PER_DAY
from beatline.operators.grouping import normalize_connections
from beatline.schemas import CONNECTION_SCHEMA, FLOW_KEY
from beatline.session import checkpoint_dir
from beatline.sources.files import header, list_files, typed


def connection_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of connection records, columns matched by name.

    The header of the first file that is there gives the layout (the usual columns in
    an empty folder).  A file with another header fails the batch instead of landing
    its values in the wrong columns; start one stream per layout.
    """
    files = list_files(spark, directory, (".csv",))
    names = (header(spark, files[0]) if files else ()) or CONNECTION_SCHEMA.fieldNames()
    r = (spark.readStream.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
         .option("header", True).option("enforceSchema", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed(r.csv(directory), CONNECTION_SCHEMA, (*FLOW_KEY, "timestamp"), "connections")


def land_connections(stream: DataFrame, out_path: str, name: str = "land_connections",
                     available_now: bool = True) -> StreamingQuery:
    """Append normalised records to ``out_path`` (Parquet, one folder per day)."""
    spark = stream.sparkSession
    ckpt = f"{checkpoint_dir(spark)}/streams/{name}"
    rows = normalize_connections(stream).withColumn(
        "day", F.date_from_unix_date(F.floor(F.col("ts_us") / F.lit(MICROS_PER_DAY)).cast("int")))
    w = (rows.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", ckpt).partitionBy("day").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
