"""Reliable materialisation of reused stages.

A stage read by several later joins (the tracked-item set, the first-PO
table, the shipments in range) is written once as a Parquet table into the
shared folder the cluster names in ``spark.checkpoint.dir`` and read back.
That cuts its lineage, survives executor loss (the files are on shared
storage, not executor disks), computes the stage exactly once, and gives the
planner true file sizes for its broadcast decisions.  The folder is read from
the session; a local folder is set only when none is configured and the
master is local (tests, single-machine runs).
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CODEC = "zstd"


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, configuring it from the conf if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    raise RuntimeError(
        "spark.checkpoint.dir is not set: a cluster run needs a shared folder "
        "for reliable checkpoints"
    )


def checkpointed(df: DataFrame, name: str = "") -> tuple[DataFrame, int]:
    """Materialise ``df`` and return it with its row count.  The count is an
    observed metric of the write itself, so it costs no extra job.  (``name``
    is for stages that a later run may find again: see ``stage_catalog``.)"""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tillroll-stages/{uuid.uuid4().hex}"
    obs = Observation(f"stage_rows_{uuid.uuid4().hex}")  # unique: stages may run concurrently
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC).parquet(path)
    return spark.read.parquet(path), int(obs.get["rows"])


def discard(table: DataFrame) -> None:
    """Delete a stage that ``checkpointed`` wrote and that nothing reads any more."""
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Free the shuffle files of queries that have ended: Spark deletes them once the driver's JVM has collected
    their plans, which a large heap does late.  It holds the last job, so one without a shuffle takes its place."""
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
