"""Incremental processing of landed files with Structured Streaming.

A text file stream over the landing folder (``*.csv``, ``maxFilesPerTrigger``
files per micro-batch, ``availableNow`` to drain what has landed) feeds a
``foreachBatch`` function that runs the same layer jobs as a backfill, scoped
to the files of a release in the micro-batch (one file by default):
Bronze -> Silver -> DQ, then Gold once per release.  If a scope of several
files fails, they go one at a time, stopping at the first failure, so that the
failure names its file.  The stream only names the files; the layout reader
reads them.

Replay safety (the sink is at-least-once):
* Bronze: a file whose rows are already committed is not appended again
  (files are immutable once landed; Spark's commit protocol makes each append
  all-or-nothing, so "present" means "complete").
* Quarantine: a file's rejects of one kind are appended once.
* Silver: key-based upsert (K4) - a replay converges.
* Gold: the release is recomputed and its partition replaced (K5); late files
  of an old release simply recompute that release (Z4, no watermark needed).
Every step appends to a run log; ``status_rollup`` / ``resume_plan`` (R6/R7)
read it, and ``resume_failed`` runs each failed file from the stage it failed
at, on what its earlier stages committed.
"""

from __future__ import annotations

import datetime as _dt
import re
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from drivelake.functions.paths import decode_path
from drivelake.operators.registry import resume_plan, status_rollup
from drivelake.plans.backfill import Lakehouse, run_bronze, run_dq, run_gold, run_silver
from drivelake.schema import Field
from drivelake.sinks.tables import append
from drivelake.sources.raw import check_single_file, literal_path
from drivelake.sources.tables import Table, read_table, scope, table_exists
from drivelake.util import checkpoint_dir, new_run_id

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("stage", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("at", T.TimestampType()),
])


def run_log_table(lake: Lakehouse) -> Table:
    return Table(f"{lake.root}/run_log", (), RUN_LOG_SCHEMA)


def release_of_path(path: str) -> str:
    """``.../<release_id>/<YYYY-MM-DD>.csv`` -> ``release_id``."""
    parts = path.rstrip("/").split("/")
    if len(parts) < 2 or not parts[-2]:
        raise ValueError(f"Unable to determine release_id: {path}")
    return parts[-2].removeprefix("release_id=")  # as bronze.release_from_path


#: Stages of a file, in order.
STAGES = ("BRONZE", "SILVER", "DQ", "GOLD")


def _log(spark: SparkSession, lake: Lakehouse, files: str | Sequence[str], status: str, run_id: str,
         stage: str | None = None, error: str | None = None) -> None:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    seq = int(now.timestamp() * 1_000_000)
    rows = [(f, seq, status, stage, error, run_id, now) for f in ([files] if isinstance(files, str) else files)]
    append(spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1), run_log_table(lake))


def _plain(path: str) -> str:
    """A local path without its scheme, which readers spell in several ways."""
    return re.sub(r"^file:/+", "/", path)


def ingested(spark: SparkSession, lake: Lakehouse, release_id: str, files: Sequence[str]) -> set[str]:
    """Those of the files that Bronze holds."""
    if not table_exists(spark, lake.bronze):
        return set()
    lineage = T.StructType([T.StructField("source_file", T.StringType()),
                            T.StructField("release_id", T.StringType())])
    held = scope(read_table(spark, lake.bronze, lineage), release_id, list(files))
    return {r[0] for r in held.select("source_file").distinct().collect()}  # as many as the files asked for


def process_files(spark: SparkSession, files: Sequence[str], lake: Lakehouse, release_id: str, landing: str | None = None,
                  fields: Sequence[Field] | None = None, run_id: str | None = None, gold: bool = True,
                  start_at: str = "BRONZE") -> str | None:
    """Bronze -> Silver -> DQ (-> Gold) for landed files of one release.

    With ``gold=False`` the caller publishes Gold and logs their SUCCESS
    afterwards.  ``start_at`` (R7) resumes: the stages before it are taken as
    committed and are not run; the log gets a RESUMED row.  ``landing`` is the
    folder that the files must be under (S2).  Returns the DQ verdict.
    """
    run_id, files = run_id or new_run_id(), list(files)
    scoped = files[0] if len(files) == 1 else files
    first = STAGES.index(start_at)
    _log(spark, lake, files, "RESUMED" if first else "PROCESSING", run_id, start_at if first else None)
    stage, verdict, measured = start_at, None, None
    try:
        for stage in STAGES[first:4 if gold else 3]:
            if stage == "BRONZE":
                for f in files:
                    check_single_file(_plain(f), f"{_plain(landing).rstrip('/')}/" if landing else "")
                held = ingested(spark, lake, release_id, files)
                missing = [literal_path(f) for f in files if f not in held]
                if missing:
                    drops = run_bronze(spark, missing, release_id, lake, run_id)
                    if drops.headless or drops.empty:
                        raise ValueError(f"CSV file(s) without a header or without any line: {[*drops.headless, *drops.empty]}")
            elif stage == "SILVER":
                measured = run_silver(spark, release_id, lake, run_id, fields, source_file=scoped)["measured"]
            elif stage == "DQ":
                verdict = run_dq(spark, release_id, lake, run_id, fields, source_file=scoped, measured=measured)
            else:
                run_gold(spark, release_id, lake, run_id)
    except Exception as exc:
        # of several files only the one that fails by itself is named as failed
        _log(spark, lake, files, "FAILED" if len(files) == 1 else "PENDING", run_id, stage, f"{type(exc).__name__}: {exc}")
        raise
    if gold:
        _log(spark, lake, files, "SUCCESS", run_id)
    return verdict


def process_batch(spark: SparkSession, batch: DataFrame, epoch_id: int, lake: Lakehouse,
                  fields: Sequence[Field] | None = None,
                  release_of: Callable[[str], str] = release_of_path, landing: str | None = None) -> list[str]:
    """``foreachBatch`` body: the batch's files in path order (date-named files
    -> arrival order of the drops, R5), those of a release together, through
    Bronze -> Silver -> DQ; then Gold once per release the batch touched.

    Gold after the last file of a release is what per-file publishing would
    leave behind, so deferring it to the end of the micro-batch gives the
    same tables with one release recompute instead of one per file.  If a
    file fails, the releases of the files before it still get their Gold
    before the failure stops the query.
    """
    done: list[tuple[str, str, str]] = []  # (file, release, run id)

    def through(files: Sequence[str], release: str) -> None:
        run_id = new_run_id()
        process_files(spark, files, lake, release, landing, fields, run_id=run_id, gold=False)
        done.extend((f, release, run_id) for f in files)

    try:
        files = sorted(r[0] for r in batch.select("source_file").distinct().collect())  # <= maxFilesPerTrigger
        members: dict[str, list[str]] = {}
        for f in files:
            members.setdefault(release_of(f), []).append(f)
        for release, own in members.items():
            try:
                through(own, release)
            except Exception:
                if len(own) == 1:
                    raise
                for f in own:
                    through([f], release)
    finally:
        for release in sorted({rel for _, rel, _ in done}):
            own = [(f, rid) for f, rel, rid in done if rel == release]
            try:
                run_gold(spark, release, lake, own[-1][1])
            except Exception as exc:
                for f, rid in own:
                    _log(spark, lake, f, "FAILED", rid, "GOLD", f"{type(exc).__name__}: {exc}")
                raise
            for rid in dict.fromkeys(rid for _, rid in own):
                _log(spark, lake, [f for f, r in own if r == rid], "SUCCESS", rid)
    return [f for f, _, _ in done]


def resume_failed(spark: SparkSession, lake: Lakehouse, landing: str | None = None, fields: Sequence[Field] | None = None,
                  release_of: Callable[[str], str] = release_of_path) -> list[str]:
    """Every file whose latest state is FAILED, from the stage it failed at, in path order; the files resumed.

    Earlier stages are read from their tables.  The first file that fails again stops the run.
    """
    log = run_log_table(lake)
    if not table_exists(spark, log):
        return []
    plan = resume_plan(status_rollup(read_table(spark, log))).select("source_file", "resume_from").orderBy("source_file").collect()  # a row per failed file
    for r in plan:
        process_files(spark, [r["source_file"]], lake, release_of(r["source_file"]), landing, fields, start_at=r["resume_from"])
    return [r["source_file"] for r in plan]


def file_lines(spark: SparkSession, landing: str, max_files: int = 1) -> DataFrame:
    """The landing folder as a stream of text lines tagged with their file."""
    return (spark.readStream.format("text")
            .option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", "*.[cC][sS][vV]")
            .option("recursiveFileLookup", "true")
            .load(landing)
            .select(F.col("value"), decode_path(F.col("_metadata.file_path")).alias("source_file"),
                    F.col("_metadata.file_block_start").alias("block_start")))


def run_incremental(spark: SparkSession, landing: str, lake: Lakehouse, checkpoint: str | None = None,
                    max_files: int = 1, fields: Sequence[Field] | None = None,
                    release_of: Callable[[str], str] = release_of_path,
                    available_now: bool = True) -> StreamingQuery:
    """Start the incremental query; ``availableNow`` drains the landed files
    (one micro-batch per ``max_files``) and stops.  The checkpoint records
    which files were consumed, so a restart continues where it stopped.
    Without ``checkpoint`` it lives under the session's shared
    ``spark.checkpoint.dir``, keyed by the lake root."""
    if checkpoint is None:
        import hashlib
        key = hashlib.sha1(f"{landing}|{lake.root}".encode()).hexdigest()[:16]
        checkpoint = f"{checkpoint_dir(spark)}/drivelake-stream-{key}"

    def body(batch: DataFrame, epoch_id: int) -> None:
        process_batch(spark, batch, epoch_id, lake, fields, release_of, landing)

    writer = (file_lines(spark, landing, max_files).writeStream
              .foreachBatch(body)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
