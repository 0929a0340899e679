"""Table access and lineage cuts shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.session import scratch_path

#: A side of a join is broadcast by hand only when its rows times width stay below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The folder is ``spark.checkpoint.dir``, so the rows outlive any executor.
    ``options`` go to the Parquet writer.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """``df``; from here on the session hands rows to Python in batches of ``limit`` bytes.

    Texts differ in length by orders of magnitude, so batches are bounded by bytes.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))
    return df


def own_prefix(df: DataFrame) -> str:
    """A beginning that no column of ``df`` has, for columns added on the way."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def code_points(text: Column) -> Column:
    """Length in code points, 0 for null."""
    return F.coalesce(F.char_length(text), F.lit(0)).cast("long")


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit the bound, else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
