"""Session construction and the shared working folder.

Library code never invents its own scratch location on a cluster: it reads
``spark.checkpoint.dir`` from the running session and fails without it.  Only in
a local session (tests, one machine) does :func:`work_dir` create a temporary
folder and register it, so ``checkpoint()`` works there too.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "turnstile", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; a local session without it
    gets a fresh folder, registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="turnstile-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # noqa: BLE001 - some deployments reject core confs at runtime
        pass
    sc.setCheckpointDir(local)
    # setCheckpointDir adds a random sub-folder; reuse whatever Spark chose.
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path inside the shared working folder."""
    return "/".join([work_dir(spark), *parts, uuid.uuid4().hex])


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared working folder as Parquet, and read back: cuts lineage where rounds follow rounds."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    base = work_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base
