"""Small session-level helpers shared by the plans."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


@contextlib.contextmanager
def persisted(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache frames for the block and always release the cached handles (Q9)."""
    cached = [f.persist(level) for f in frames]
    try:
        yield cached if len(cached) != 1 else cached[0]
    finally:
        for f in cached:
            f.unpersist()


def new_run_id() -> str:
    """one run id per job run, a driver literal (not a per-row uuid)."""
    return str(uuid.uuid4())


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared lineage-cut folder named by ``spark.checkpoint.dir``.

    Set one only where the session has none (tests); on a cluster the setting
    must point at shared storage.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        if default is None:
            raise RuntimeError("spark.checkpoint.dir is not set")
        spark.conf.set("spark.checkpoint.dir", default)
        value = default
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(value)
    return value


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared folder; a ``local`` session without the setting gets a temporary one."""
    local = spark.sparkContext.master.split("[")[0] == "local" and not spark.conf.get("spark.checkpoint.dir", None)
    folder = checkpoint_dir(spark, tempfile.mkdtemp(prefix="drivelake-") if local else None)
    return f"{folder.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
