"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on; each is applied only where the caller left it unset.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tideline", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session carrying ``DEFAULTS``, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory under the folder the cluster shares between its nodes.

    The folder is ``spark.checkpoint.dir``. Only a local session, where driver and executors
    are one machine, may go without it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = os.path.join(tempfile.gettempdir(), "tideline-scratch")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder, unless the session already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "lineage"))
