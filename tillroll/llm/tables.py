"""Stage tables in the shared folder, and the columns an operator reads.

A stage that several later steps read is written once as Parquet below the
folder in ``spark.checkpoint.dir`` and read again: its lineage ends there, it
survives lost executors, and the planner knows its true size.  ``Stages``
deletes what a later stage no longer reads and, when the session's Python
ends, the rest.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only where it is unset and the master is local."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; the stages need a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-stages-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Stages:
    """The stage tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        self.release()
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Spark deletes shuffle files once the driver has collected the queries they belong to; it holds the
        last job, so a job without a shuffle takes that place first.  ``write`` frees those of the tables before;
        a caller that has let go of its own table's query frees them with this."""
        self.spark.range(1).collect()
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Delete the named tables (all without names)."""
        if self.spark.sparkContext._jsc is None:
            return
        jvm = self.spark.sparkContext._jvm
        try:
            for name in names or ("",):
                path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except (ConnectionError, OSError):
            return  # the session has ended


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, cast to the given types; other columns (whatever their names) go."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of df has (whatever the case)."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def buckets(spark: SparkSession) -> int:
    """Hash buckets for packed exchanges: as many as shuffle partitions, so that they grow with the cluster's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
