"""Session helpers: one place that pins the settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "beatline", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC, AQE and Arrow switched on.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests
    and the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # checkpoints written for lineage cuts are removed once unreferenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # no Python call-site capture per Column call (plan building is py4j-bound)
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Read from the session, scheme included.  Only a ``local[*]`` session without
    that setting gets a scratch folder of its own (tests); any other master
    raises, since executors do not share a machine's folders.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="beatline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return f"{checkpoint_dir(spark)}/{name}"
