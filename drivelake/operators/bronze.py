"""Bronze: raw rows as strings with lineage (E3, E4, E1/E2 via sinks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.sinks.tables import append_merging, create_table
from drivelake.sources.tables import Table, table_exists

METADATA_COLUMNS = ("source_file", "release_id", "ingested_at", "processing_run_id")

def to_strings(df: DataFrame, keep: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """Every source column as STRING (names back-quoted), lineage kept."""
    cols = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c not in keep]
    return df.select(*cols, *[F.col(k) for k in keep if k in df.columns])


def stamp(df: DataFrame, release_id, run_id: str, ingested_at=None) -> DataFrame:
    """``release_id`` (a literal, or a Column such as the file's folder),
    ``ingested_at`` (one instant per write) and the run id."""
    at = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    release = release_id if isinstance(release_id, Column) else F.lit(str(release_id))
    return df.withColumns({
        "release_id": release,
        "ingested_at": at,
        "processing_run_id": F.lit(run_id),
    })


def release_from_path(path: Column) -> Column:
    """The release is the folder holding the drop: ``.../<release_id>/<day>.csv``
    (a ``release_id=<x>`` folder name also works); empty where there is none.

    As ``(?:release_id=)?([^/=]+)/[^/]+$`` would find it, without a regex for each row."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    inside = path.contains("/") & (F.substring_index(path, "/", -1) != "")
    return F.when(inside, F.substring_index(folder, "=", -1)).when(path.isNotNull(), "")


def bronze_frame(raw: DataFrame, release_id, run_id: str, ingested_at=None) -> DataFrame:
    """E3 + E4 in one projection, metadata columns last."""
    data = [c for c in raw.columns if c not in METADATA_COLUMNS]
    out = stamp(to_strings(raw.select(*[f"`{c}`" for c in data], "source_file")), release_id, run_id, ingested_at)
    return out.select(*[f"`{c}`" for c in data], *METADATA_COLUMNS)


def write_bronze(spark: SparkSession, bronze: DataFrame, table: Table) -> None:
    """K1 on first write; otherwise evolve (E1), align by name (E2), append (K2).

    Appends are not idempotent (Q8); incremental runs skip a file that Bronze
    already holds.
    """
    if table_exists(spark, table):
        append_merging(spark, bronze, table)
    else:
        create_table(bronze, table)
