"""Shared scratch folder for tables that are read more than once."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_owners: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    Only a local session, whose tasks share one machine, gets a folder of its own where none is
    named; it is removed when Python ends.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="agorastat-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Own every scratch table written inside the block, and remove them at its end.

    Write the results before the block ends: frames built inside still read these tables.
    """
    _owners.append(f"run-{uuid.uuid4().hex}")
    folder = os.path.join(scratch_dir(spark), *_owners)
    try:
        yield folder
    finally:
        _owners.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, inside that of the current owner."""
    return os.path.join(scratch_dir(spark), *_owners, f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Write the frame to the scratch folder and read it back.

    Cuts the lineage at a table that outlives lost executors, and computes a
    frame with several readers only once. ``scratch`` removes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on the file system that its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
