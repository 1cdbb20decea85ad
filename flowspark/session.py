"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "flowspark", cpus: int | str | None = None,
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local session used by tests and the bench.  On a cluster, the job's
    own session (with its shared ``spark.checkpoint.dir``) is used instead."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    if shuffle_partitions is None:
        shuffle_partitions = int(cpus) if str(cpus).isdigit() else 8
    parts = shuffle_partitions
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
JIT_BYTES = 8000     # the JVM compiles no method whose bytecode is longer


def compiled_methods(spark: SparkSession) -> None:
    """Lets a stage whose generated method is too long for the JVM's compiler
    run as separate projections instead, which Spark splits into short
    methods; with Spark's default such a stage runs interpreted.  A limit
    that the session was given is left."""
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, JIT_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (set by the cluster to a
    shared file system).  Only when it is unset and the master is local -- as
    in tests -- a fresh scratch folder is created and registered; on a cluster
    that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not conf_dir:
        conf_dir = sc.getCheckpointDir()
    if not conf_dir:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", None) or "local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder: executors of a cluster do not see "
                             "a local one")
        conf_dir = tempfile.mkdtemp(prefix="flowspark-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"



def write_table(spark: SparkSession, df, name: str):
    """Cut lineage with a parquet table below the shared folder: survives
    executor loss, and later reads are columnar (pruned, vectorised), unlike
    a ``checkpoint()`` scan."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, by the file system of its path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by the file system of its path; none if it is not there."""
    if not table_exists(spark, path):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Length of all files below a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
