"""Session-level helpers: whole input tables, scratch tables, partition counts."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
WHITESPACE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole test table, read by Spark (the path may be in any store)."""
    _importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver does, unless the
    session already says where (``--py-files``, PYTHONPATH)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def id_and_text(docs: DataFrame) -> DataFrame:
    """Exactly (doc_id long, text string); every other column is left behind,
    so extra columns never clash with an operator's own. Null text is empty."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


def partitions(spark: SparkSession) -> int:
    """Blocks and shards follow the session's shuffle setting, which is sized to the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a private folder (tests);
    on a cluster a missing setting is an error. The path is deleted when the
    session's JVM ends, through Hadoop's file system API.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a folder every executor shares")
        base = tempfile.mkdtemp(prefix="marquee-llm-")
    path = f"{base.rstrip('/')}/marquee-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and what
    later stages read no longer depends on any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def begin() -> None:
    """Called where an operator's work on a block or a task begins: lets go of
    the encoders an earlier stage left in this Python worker, and of what
    earlier work freed."""
    held = sys.modules.get("marquee.llm.bpe")
    if held is not None and held._ENCODERS:
        held.release()
        gc.collect()
    trim()


def trim() -> None:
    """Hands freed memory back to the system. Python workers live as long as
    their executor; else each would keep the most it ever used."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if give_back is not None:
        give_back(0)


def quiet_threads() -> None:
    """One thread per task: Spark owns the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
