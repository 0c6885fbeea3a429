"""Session-level helpers: the shared checkpoint folder and scratch tables.

The library never configures the caller's session beyond the checkpoint
folder, and it only sets that when the session has none: a cluster names
its shared folder in ``spark.checkpoint.dir``; a single-machine session
(``local[...]`` master, as in tests) may fall back to a private folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, registering it if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        # A single JVM: a folder on this machine is visible to every task.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="revlens-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor "
            "can reach (HDFS, S3, ...) before running revlens jobs")
    return sc.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/revlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove what this application has written with :func:`write_table`.

    Results read those tables lazily, so only the caller knows when they are
    no longer needed. Other applications' folders stay. False when there was
    nothing to remove.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint.

    Keeps the partitioning and the order inside each partition, and cuts the
    lineage so a lost executor re-reads the checkpoint instead of re-running
    the plan (whose partition boundaries could come out differently).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cheaper to store than :func:`pin` (columnar, compressed) when the
    partitioning does not have to survive. ``compression``: other than the
    session's, for a table as long as the corpus.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return spark.read.parquet(path)
