"""Session settings and the shared working folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(app_name: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library is tuned for; `extra` uses __ for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only where the setting is absent and everything runs in one process (a laptop or a test) is a temporary folder
    made; on a cluster executors would not see it, so there the setting must be given. The context's
    checkpoint directory is pointed at the same place, so `checkpoint()` survives lost executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path for one run under the shared folder."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage, and lost executors only re-read the shared folder."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)
