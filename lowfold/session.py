"""Session settings and the step tables that cut lineage in iterative jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def step_root(spark: SparkSession) -> str:
    """Shared folder for step tables: the session's ``spark.checkpoint.dir``.

    Only a session of one process may go without that setting; it then gets a
    fresh temporary folder. On a cluster, a local one included, executors do
    not share such a folder, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="lowfold-steps-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class StepStore:
    """Written intermediate tables of one job.

    A written table ends the lineage, survives the loss of executors, is read
    back with column pruning, and tells Catalyst its true size, so small steps
    are broadcast and large ones are shuffle-joined without any hint.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{step_root(spark)}/{label}-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{self._count:04d}-{name}"
        self._count += 1
        self._write(df, path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._lowfold_step = path
        return saved

    def _write(self, df: DataFrame, path: str) -> None:
        """Write and free the shuffle files of the write at once; else they stay until the driver collects its garbage."""
        conf = self.spark.conf
        before = conf.get(FREE_SHUFFLES, None)
        conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.unset(FREE_SHUFFLES) if before is None else conf.set(FREE_SHUFFLES, before)

    def drop(self, *saved: DataFrame) -> None:
        """Delete step tables that a newer step has replaced."""
        for df in saved:
            path = getattr(df, "_lowfold_step", None)
            if path and path.startswith(self.root):
                jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                jvm_path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)
