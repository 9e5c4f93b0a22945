"""Session defaults and the shared folder.

Library code never creates a session; it receives one. ``build_session`` is
for tests, the bench and command-line use. Queries that write tables of their
own put them under the shared folder named by the session's
``spark.checkpoint.dir``, never in a machine-local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "marquee",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on, the UI off and sensible shuffle sizing.

    ``master`` is set only when given: under ``spark-submit`` the cluster's
    master and resources apply (a plain ``python`` run defaults to local).
    Driver memory is only set for an explicit local master, where the driver
    is the whole cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "4g"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names, which
    every executor shares; it is deleted when the session's JVM ends. Unset, it
    is an error, but for a local session, where a private folder is shared by all."""
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a folder every executor shares")
        base = tempfile.mkdtemp(prefix="marquee-shared-")
    path = f"{base.rstrip('/')}/marquee/{name}-{uuid.uuid4().hex}"
    where, fs = file_system(spark, path)
    fs.deleteOnExit(where)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): where Spark itself reads and writes ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
