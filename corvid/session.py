"""Session construction and the cluster-facing settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job relies on; anything already set on the session wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "corvid") -> SparkSession:
    """Build (or reuse) a session. Tests and the bench call this; on a cluster
    the caller's session is passed straight to the operators instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CORVID_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    (or one already set on the context). Only a local-mode session without one
    gets a scratch folder of its own; a cluster session without one is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    local = tempfile.mkdtemp(prefix="corvid-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


_SCRATCH: dict[str, list[str]] = {}  # by application: folders handed out and not yet dropped


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory for written intermediate tables.
    It is remembered, so that ``iterate.release`` can drop it."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    scratch_folders(spark).append(path)
    return path


def scratch_folders(spark: SparkSession) -> list[str]:
    """Scratch folders of this application, in the order they were handed out."""
    return _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
