"""SparkSession defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    app_name: str = "vintagemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    shared_folder: str | None = None,
    **extra: str,
) -> SparkSession:
    """Build (or fetch) a session.

    ``master`` and ``shuffle_partitions`` stay unset on a cluster, where
    spark-submit and AQE decide; tests and ``bench.py`` pass local values.
    ``shared_folder`` is where intermediate tables go, unless spark-submit names one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if shared_folder:
        conf["spark.checkpoint.dir"] = shared_folder
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
