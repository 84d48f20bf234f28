"""Session construction for local runs, tests and the bench.

On a cluster the session comes from the platform; these settings only fill
gaps (AQE on, UTC, no UI) and never override what the cluster already set.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "8", shuffle_partitions: int = 8, app: str = "drivelake", checkpoint: str | None = None) -> SparkSession:
    """A local session; ``checkpoint`` is the shared folder to use where the environment names none (tests pass a temporary one)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("DRIVELAKE_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint:
        from drivelake.util import checkpoint_dir
        checkpoint_dir(spark, default=checkpoint)  # only when unset
    return spark
