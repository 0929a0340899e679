"""Saved tables laid out by flow key (K1, K2, S11): joins without a shuffle, drill-downs without a scan.

A saved table is cut into buckets by the hash of the flow key, the rows of a file are
sorted by it, and the Parquet files carry bloom filters on the addresses.  Reloaded in any
session, two such tables with as many buckets join on the flow key (J2) where they lie,
and a drill-down (P9) or host pivot (P10) reads the row groups that may hold the key.

The layout (schema and buckets) is a one-row table beside the data, so a reload needs the path only.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatline.operators.grouping import require_columns
from beatline.schemas import FLOW_KEY

BUCKETS = 64
#: Tasks that share a bucket's rows when it is written, so a flow with most records is not written by one.
WRITERS = 4
BLOOM = ("src_ip", "dst_ip")


def _layout(path: str) -> str:
    return f"{path.rstrip('/')}.layout"


def _table_name(path: str) -> str:
    return f"beatline_{hashlib.md5(path.encode()).hexdigest()}"


def save_bucketed(df: DataFrame, path: str, buckets: int = BUCKETS) -> str:
    """Write ``df`` (with the flow key) as a bucketed table at ``path``, replacing what is there."""
    require_columns(df, FLOW_KEY, "save_bucketed")
    spark, name = df.sparkSession, _table_name(path)
    spark.sql(f"drop table if exists {name}")
    bucket = F.pmod(F.hash(*FLOW_KEY), F.lit(buckets))            # as Spark's bucketing does
    dealt = df.repartition(buckets * WRITERS, bucket, F.pmod(F.xxhash64(*df.columns), F.lit(WRITERS)))
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *FLOW_KEY).sortBy(*FLOW_KEY)
    for column in BLOOM:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.saveAsTable(name)
    spark.sql(f"drop table {name}")                               # the files stay, the name does not
    spark.createDataFrame([(df.schema.json(), buckets)], "schema string, buckets int").coalesce(1).write.mode("overwrite").json(_layout(path))
    return path


def load_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`save_bucketed`, with its types and buckets."""
    layout = spark.read.schema("schema string, buckets int").json(_layout(path)).first()
    schema = StructType.fromJson(json.loads(layout["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys, name = ", ".join(FLOW_KEY), _table_name(path)
    spark.sql(f"drop table if exists {name}")
    spark.sql(f"create table {name} ({columns}) using parquet location '{path}' "
              f"clustered by ({keys}) sorted by ({keys}) into {layout['buckets']} buckets")
    return spark.table(name)
