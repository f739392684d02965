"""Stages that outlive a failed driver: found again by what they were made from.

A run's stages lie in one folder below ``spark.checkpoint.dir``, named by a
fingerprint of the job, its parameters and its input files (path, length and
time).  A stage counts once its write has committed, so a run that starts after
a driver failure reads the finished stages and writes the others.  When the run
ends well its folder is removed.

One run owns the folder: the newest.  An older one that still lives notices at its next
stage that it has lost the folder, and stops.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans.stages import CODEC, checkpoint_dir


class StageOwnerLost(RuntimeError):
    """A newer run of the same job on the same inputs has taken the stages over."""


class StageCatalog:
    """Use as ``with StageCatalog(...) as stages: run_profit(..., stage=stages.stage)``, and store the
    result inside the block: the stages are removed at its end, kept if it fails."""

    def __init__(self, spark: SparkSession, job: str, inputs: Mapping[str, DataFrame], **parameters):
        self._spark, self._jvm = spark, spark.sparkContext._jvm
        self.owner = uuid.uuid4().hex
        self.written: list[str] = []
        self.found: list[str] = []
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        key = json.dumps([job, parameters, {name: self._files(df) for name, df in inputs.items()}], sort_keys=True, default=str)
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/tillroll-stages/{job}-{hashlib.sha256(key.encode()).hexdigest()[:32]}"
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def _files(self, df: DataFrame) -> str:
        """A digest of the table's files."""
        digest = hashlib.sha256()
        for name in sorted(df.inputFiles()):
            path = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(name))
            status = path.getFileSystem(self._conf).getFileStatus(path)
            digest.update(f"{name}|{status.getLen()}|{status.getModificationTime()}\n".encode())
        return digest.hexdigest()

    def __enter__(self) -> StageCatalog:
        out = self._fs.create(self._path("_owner"), True)
        try:
            out.write(bytearray(self.owner.encode()))
        finally:
            out.close()
        return self

    def _check_owner(self) -> None:
        try:
            stream = self._fs.open(self._path("_owner"))
        except Exception as e:
            raise StageOwnerLost(f"the stages in {self.root} are gone: another run has ended") from e
        try:
            owner = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if owner != self.owner:
            raise StageOwnerLost(f"another run owns the stages in {self.root}")

    def stage(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The stage ``name`` and its row count: as a former run left it, or written now from ``df``."""
        self._check_owner()
        path = f"{self.root}/{name}"
        if self._fs.exists(self._path(f"{name}/_SUCCESS")):
            self.found.append(name)
        else:
            df.write.mode("overwrite").option("compression", CODEC).parquet(path)
            self.written.append(name)
        table = self._spark.read.schema(df.schema).parquet(path)
        return table, table.count()  # from the footers

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self._check_owner()
            self._fs.delete(self._path(""), True)
