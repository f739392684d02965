"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings applied when this package builds a session (tests, bench).  On a
# cluster the same keys belong in the job's submit configuration;
# shuffle partitions and max partition bytes are sized there for the data.
JOB_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName("tillroll")
    conf = dict(JOB_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
