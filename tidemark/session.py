"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark") -> SparkSession:
    """Session used by tests and the bench. On a cluster, pass no master and let spark-submit decide."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:  # else the cluster's own setting holds
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator of the cluster and points at shared storage; it is read,
    never overridden, and its absence is an error: a machine-local folder would be written by each executor on
    its own disk. Only under a ``local`` master (tests) is a fresh scratch folder created when it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, e.g. for a streaming query's checkpointLocation."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path to write to, in a folder under the shared checkpoint folder that goes when the driver ends."""
    folder = checkpoint_path(spark, os.path.join("tidemark", name))
    fs, p = _hadoop(spark, folder)
    fs.mkdirs(p)  # only what exists can be marked
    fs.deleteOnExit(p)
    return os.path.join(folder, "data")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    fs, p = _hadoop(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def materialize(df: DataFrame, tag: str = "stage", files: int | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back: cuts the lineage
    (a lost executor recomputes from the written files) and, unlike an eager ``checkpoint()`` of an
    uncached plan, computes the plan a single time.

    The folder goes when the driver ends, or earlier by :func:`release`, once all that reads it is written.
    ``files``: at most so many files, for results known to be small beside the shuffle's partitions.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tidemark", f"{tag}-{uuid.uuid4().hex}")
    (df.coalesce(files) if files else df).write.parquet(path)
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.parquet(path)
    out.scratch_path = path
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast, for tables that grow with the input.

    The planner takes a table's size from the compressed files that it was read from, which can be a hundredth of its
    rows in memory, and less before an ``explode``: left to it, such a table goes through the driver and into every task.
    """
    return df.hint("merge")


def release(*written: DataFrame) -> None:
    """Delete the folders behind results of :func:`materialize` that nothing reads any more."""
    for df in written:
        path = getattr(df, "scratch_path", None)
        if path:
            delete_path(df.sparkSession, path)
