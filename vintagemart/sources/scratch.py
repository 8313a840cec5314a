"""Intermediate tables in the folder all executors share.

The folder is the session's ``spark.checkpoint.dir``. Only a local session
that names none gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


# Paths handed out by this process and not yet released.
_in_use: list[str] = []


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="vintagemart-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = _local_folder()
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _in_use.append(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the rows once and go on from the files: short lineage, nothing is
    computed twice, and a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_use() -> list[str]:
    """Paths handed out and not yet released."""
    return list(_in_use)


def release(spark: SparkSession, paths: Iterable[str] | None = None) -> int:
    """Delete the given scratch tables, or every one of this process; for the end of a
    job or a stage, when all results are stored."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    released = 0
    for name in in_use() if paths is None else list(paths):
        if name not in _in_use:
            continue
        _in_use.remove(name)
        path = hadoop(name)
        released += path.getFileSystem(conf).delete(path, True)
    return released
