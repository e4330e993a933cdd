"""Session helpers.

On a cluster the session is created by the platform; ``ensure_checkpoint_dir``
only fills ``spark.checkpoint.dir`` when nobody set it (tests, local runs), and
every table this library writes for lineage cutting or read-back lives under
that shared folder, never in a machine-local temporary folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (a
# broadcast only happens behind the autoBroadcastJoinThreshold size check),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "martforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a local one only when it is unset.

    A folder of this machine is of use only where all tasks run on it, so with
    any but a ``local`` master an unset folder is an error.
    """
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    # Unset: only in tests and local runs.
    if not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="martforge-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the checkpoint folder and read back: what
    comes of joins and aggregates gets its true size, by which the planner may
    broadcast it instead of moving the rows that it is joined to."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
