"""Layer-to-layer plans: Bronze -> Silver -> DQ -> Gold for one scope.

The same functions serve a release backfill (scope = ``release_id``) and a
single-file increment (scope = ``source_file``); streaming calls them from
``foreachBatch``.  Each function is a lazy DataFrame plan plus the writes of
its layer; the only driver round trips are 1-row verdicts and partition lists.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivelake.operators import bronze as B
from drivelake.operators import gold as G
from drivelake.operators import quality as Q
from drivelake.operators import silver as S
from drivelake.operators.dedup import dedup_latest
from drivelake.schema import BUSINESS_KEY, Field, drivestats_fields
from drivelake.sinks.tables import TASK_ROWS, create_or_append, overwrite_partitions, upsert, verify_written_by
from drivelake.sources.raw import Drops, find_layouts, headless_lines, read_layouts
from drivelake.sources.tables import Table, read_table, require_rows, scope, spread, table_exists
from drivelake.util import new_run_id, persisted


def silver_schema(fields: Sequence[Field]) -> T.StructType:
    """Canonical columns, Silver lineage, then the partition columns."""
    cols = [T.StructField(f.name, f.spark_type, True) for f in fields]
    cols += [T.StructField("source_file", T.StringType()), T.StructField("bronze_ingested_at", T.TimestampType()),
             T.StructField("processing_run_id", T.StringType()), T.StructField("silver_processed_at", T.TimestampType()),
             T.StructField("release_id", T.StringType()), T.StructField("snapshot_month", T.StringType())]
    return T.StructType(cols)


DQ_SCHEMA = T.StructType([T.StructField("check_name", T.StringType()), T.StructField("result", T.StringType()),
                          T.StructField("details", T.StringType()), T.StructField("run_id", T.StringType()),
                          T.StructField("timestamp", T.TimestampType()), T.StructField("release_id", T.StringType())])
GOLD_RELEASE_SCHEMA = T.StructType(
    [T.StructField("start_date", T.DateType()), T.StructField("end_date", T.DateType())]
    + [T.StructField(c, T.LongType()) for c in ("distinct_snapshot_dates", "distinct_drives", "distinct_models",
                                                 "total_drive_days", "drive_failures")]
    + [T.StructField("annualized_failure_rate_pct", T.DoubleType()), T.StructField("processing_run_id", T.StringType()),
       T.StructField("gold_processed_at", T.TimestampType()), T.StructField("release_id", T.StringType())])
GOLD_MODEL_SCHEMA = T.StructType(
    [T.StructField("drive_model", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("distinct_drives", "total_drive_days", "drive_failures")]
    + [T.StructField("annualized_failure_rate_pct", T.DoubleType()), T.StructField("first_snapshot_date", T.DateType()),
       T.StructField("last_snapshot_date", T.DateType()), T.StructField("processing_run_id", T.StringType()),
       T.StructField("gold_processed_at", T.TimestampType()), T.StructField("release_id", T.StringType())])


@dataclass(frozen=True)
class Lakehouse:
    """Table locations under one root folder (a shared store on a cluster)."""
    root: str
    fields: tuple[Field, ...] = tuple(drivestats_fields())

    @property
    def bronze(self) -> Table:
        return Table(f"{self.root}/bronze", ("release_id",))

    @property
    def quarantine(self) -> Table:
        return Table(f"{self.root}/quarantine", ())

    @property
    def silver(self) -> Table:
        return Table(f"{self.root}/silver", ("release_id", "snapshot_month"), silver_schema(self.fields))

    @property
    def dq(self) -> Table:
        return Table(f"{self.root}/dq_results", ("release_id",), DQ_SCHEMA)

    @property
    def gold_release(self) -> Table:
        return Table(f"{self.root}/gold_release", ("release_id",), GOLD_RELEASE_SCHEMA)

    @property
    def gold_model(self) -> Table:
        return Table(f"{self.root}/gold_model", ("release_id",), GOLD_MODEL_SCHEMA)


# ---------------------------------------------------------------- pure plans

def silver_frames(bronze: DataFrame, fields: Sequence[Field], run_id: str) -> tuple[DataFrame, DataFrame]:
    """(deduplicated Silver rows, stamped quarantine rows) of a Bronze scope."""
    cand = S.candidate(bronze, fields, defer_missing=True)
    accepted, rejected = S.split_valid(cand)
    return (latest_silver(accepted, fields, bronze.columns, run_id),
            S.complete(S.stamp_quarantine(rejected, run_id), fields))


def latest_silver(accepted: DataFrame, fields: Sequence[Field], source_columns, run_id: str) -> DataFrame:
    """W1 then the Silver stamps: keep the newest row per business key.

    Order: Bronze ingestion time, then source file, both descending; the
    fields fed by a source column complete the order (Q5).  The run stamps
    are constants, so they are added after the shuffle.
    """
    varying = [f.name for f in fields if S._source(source_columns, f.source_column) is not None]
    rows = accepted.withColumnRenamed("ingested_at", "bronze_ingested_at")
    latest = dedup_latest(rows, BUSINESS_KEY, tie_break=varying)
    stamped = S.stamp_silver(latest.withColumnRenamed("bronze_ingested_at", "ingested_at"), run_id)
    return S.complete(stamped, fields)  # constant-NULL fields join after the shuffle


# ---------------------------------------------------------------- layer jobs

#: Reason of lines whose file has no header; reasons of one kind share what stands before the colon.
MISSING_HEADER = "missing_header_line:"


def quarantine(spark: SparkSession, rows: DataFrame, lake: Lakehouse) -> None:
    """Append rejected rows, those of a (file, kind of reason) that the table does not hold yet.

    Files are immutable once landed and an append commits whole, so a kind that
    is there for a file is there for all its rows: a replayed run of a release
    or of one file leaves every row once (Q8).
    """
    if table_exists(spark, lake.quarantine):
        kind = F.split_part("rejection_reason", F.lit(":"), F.lit(1))
        lineage = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("rejection_reason", T.StringType())])
        known = read_table(spark, lake.quarantine, lineage).select("source_file", kind.alias("_kind")).distinct()
        rows = rows.withColumn("_kind", kind).join(known, ["source_file", "_kind"], "left_anti").select(*rows.columns)
    create_or_append(spark, rows, lake.quarantine)


def run_bronze(spark: SparkSession, raw_paths, release_id, lake: Lakehouse, run_id: str) -> Drops:
    """Read raw CSV drops by layout (drift-safe), stamp, then create / evolve /
    append Bronze.  ``release_id`` is a literal or a Column (e.g. the folder
    of each file).  The lines of files without a header go to quarantine, and
    no other file waits for them; a run without any other file fails."""
    drops = find_layouts(spark, raw_paths)
    if drops.layouts:
        B.write_bronze(spark, B.bronze_frame(read_layouts(spark, drops), release_id, run_id), lake.bronze)
    if drops.headless:
        lines = B.stamp(headless_lines(spark, drops), release_id, run_id).drop("processing_run_id")
        quarantine(spark, lines.withColumnRenamed("value", "raw_line").withColumns({
            "rejection_reason": F.lit(f"{MISSING_HEADER}file"), "rejected_at": F.current_timestamp(),
            "quarantine_processing_run_id": F.lit(run_id)}), lake)
    if not drops.layouts:
        raise ValueError(_headless_text(drops) if drops.headless else f"No CSV line found under {raw_paths}")
    return drops


def _headless_text(drops: Drops) -> str:
    return f"CSV file(s) without a header line are in quarantine: {list(drops.headless[:10])}"


#: Parts by key hash that the Silver job counts in each partition: a key of very many rows makes its part the larger one.
KEY_CELLS = 16


def has_hot_key(cells: Sequence[int]) -> bool:
    """Whether some key of a partition has more rows than a task should hold, by the rows of the partition's ``KEY_CELLS`` cells."""
    return max(cells) - (min(cells) if len(cells) == KEY_CELLS else 0) > TASK_ROWS


def run_silver(spark: SparkSession, release_id: str, lake: Lakehouse, run_id: str,
               fields: Sequence[Field] | None = None, source_file: str | None = None) -> dict:
    """Bronze scope -> quarantine (append) + Silver (upsert).

    For one release (and one or several of its files) the result holds ``measured``:
    the DQ metrics of the scope, taken while the partitions were written.

    One pass over the required fields answers every driver-side question at
    once - is the scope empty, are there rejects, which (release, month)
    partitions does the upsert touch, is there a hot key - with a result bounded
    by the number of partitions, not rows.  The typed rows of whole releases are
    not cached: that would cost more than to type them again, and would need
    room in proportion to the scope.
    """
    fields = list(fields or drivestats_fields())
    bronze = scope(read_table(spark, lake.bronze), release_id, source_file)
    missing = S.missing_required(fields, bronze.columns)
    if missing:  # E6: quarantine the whole scope with one reason, then fail
        require_rows(bronze, f"No Bronze data found for release_id={release_id}")
        q = S.quarantine_schema(bronze, missing, run_id)
        quarantine(spark, q, lake)
        raise ValueError(f"Required source columns missing: {missing}")
    # a single-file scope is one or two Parquet files: spread it before typing
    cand = S.candidate(spread(bronze) if source_file else bronze, fields, defer_missing=True)
    with persisted(cand) if source_file else nullcontext(cand) as c:
        bad = F.col("_rejection_reason").isNotNull()
        stats = (c.groupBy("release_id", F.date_format("snapshot_date", "yyyy-MM").alias("snapshot_month"),
                           F.pmod(F.xxhash64(*BUSINESS_KEY), F.lit(KEY_CELLS)).alias("cell"))
                 .agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")).collect())
        if not stats:  # S7: empty scope fails before any write
            raise ValueError(f"No Bronze data found for release_id={release_id}"
                             + (f", source_file={source_file}" if source_file else ""))
        accepted, rejected = S.split_valid(c)
        n_rejected = sum(r["rejected"] for r in stats)
        if n_rejected:
            quarantine(spark, S.complete(S.stamp_quarantine(rejected, run_id), fields), lake)
        cells: dict = {}
        for r in stats:
            if r["rows"] > r["rejected"]:
                cells.setdefault((r["release_id"], r["snapshot_month"]), []).append(r["rows"] - r["rejected"])
        touched = {values: sum(n) for values, n in cells.items()}
        measured = None
        if touched:
            one = not isinstance(release_id, (list, tuple, set, frozenset))
            in_scope = F.col("release_id") == F.lit(str(release_id)) if one else F.lit(False)
            if source_file is not None:
                in_scope = in_scope & F.col("source_file").isin(source_file if isinstance(source_file, list) else [source_file])
            # keep-latest (W1, order as in latest_silver), then upsert (K4)
            varying = sorted(f.name for f in fields if f.name not in BUSINESS_KEY and S._source(bronze.columns, f.source_column) is not None)
            found = upsert(spark, S.stamp_silver(accepted, run_id), lake.silver, BUSINESS_KEY, touched,
                           cluster_by=("release_id", "snapshot_month"), order=("bronze_ingested_at", "source_file", *varying),
                           measure=Q.scope_measures(in_scope) if one else {}, hot_keys=any(map(has_hot_key, cells.values())))
            measured = {**found, "bronze_rows": sum(r["rows"] for r in stats)} if one else None
    return {"rows": sum(r["rows"] for r in stats), "rejected": n_rejected, "partitions": len(touched), "measured": measured}


def run_dq(spark: SparkSession, release_id, lake: Lakehouse, run_id: str,
           fields: Sequence[Field] | None = None, source_file: str | None = None,
           raise_on_fail: bool = True, measured: dict | None = None):
    """DQ of one scope (returns its verdict) or of a list of releases (returns
    ``{release: verdict}``, all releases checked by one grouped aggregation).
    With ``measured`` from the Silver job of the same scope no table is scanned."""
    fields = list(fields or drivestats_fields())
    many = isinstance(release_id, (list, tuple, set, frozenset))
    silver = scope(read_table(spark, lake.silver), release_id, source_file)
    # D9 only counts Bronze rows of the scope: read the two scope columns,
    # no schema inference and no data columns (row counts come from footers).
    lineage = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("release_id", T.StringType())])
    bronze = scope(read_table(spark, lake.bronze, lineage), release_id, source_file)
    results = Q.evaluate(silver, bronze, fields, run_id, None if many else release_id, by_release=many, measured=measured)
    verdicts = Q.persist_results(spark, results, lake.dq, raise_on_fail)
    if many:
        return verdicts
    return max(verdicts.values(), key=lambda v: Q.SEVERITY[v])


def run_gold(spark: SparkSession, release_id, lake: Lakehouse, run_id: str) -> tuple[int, int]:
    """Recompute Gold for whole releases (late files included, Z4).

    Jobs: the cached totals per drive, those per model and the cached days of
    the 5-column Silver scope feed one validation aggregate, the two grains (cached, tiny),
    one conservation aggregate that also yields the row counts, two partition
    overwrites, two grouped read-backs.
    ``release_id`` may be a list: every release is computed in the same jobs.
    """
    silver = scope(read_table(spark, lake.silver), release_id).select(*G.GOLD_INPUT_COLUMNS)
    by_drive = G.drive_totals(silver)
    with persisted(by_drive, G.model_totals(by_drive), G.observed_days(silver)) as (drives, models, days):
        report = G.gold_input_report(models).collect()  # one row per release, Silver totals included
        wanted = release_id if isinstance(release_id, (list, tuple, set, frozenset)) else [release_id]
        empty = sorted(set(map(str, wanted)) - {r["release_id"] for r in report})
        if empty:  # S7: a release without Silver rows fails before any write
            raise G.GoldValidationError(f"No Silver rows found for release_id={', '.join(empty)}")
        bad = {}  # a bad release does not keep the good ones from their Gold
        for row in report:
            try:
                G.assert_gold_input(row)
            except G.GoldValidationError as exc:
                bad[row["release_id"]] = exc
        good = [r for r in report if r["release_id"] not in bad]
        if not good:
            raise next(iter(bad.values()))
        if bad:
            drives, models, days = (f.where(F.col("release_id").isin([r["release_id"] for r in good])) for f in (drives, models, days))
        release, model = G.gold_of_totals(models, drives, days, run_id)
        totals = spark.createDataFrame(
            [(r["release_id"], r["total_rows"], r["silver_failures"]) for r in good],
            "release_id string, total_rows long, silver_failures long")
        with persisted(release, model) as (r, m):
            checks = []
            for c in G.conservation(totals, r, m).collect():
                try:
                    G.assert_conservation([c])
                    checks.append(c)
                except RuntimeError as exc:
                    bad[c["release_id"]] = exc
            if not checks:
                raise next(iter(bad.values()))
            kept = F.col("release_id").isin([c["release_id"] for c in checks])
            overwrite_partitions(r.where(kept) if bad else r, lake.gold_release)
            overwrite_partitions(m.where(kept) if bad else m, lake.gold_model)
    verify_written_by(spark, lake.gold_release, {c["release_id"]: c["release_rows"] for c in checks})
    verify_written_by(spark, lake.gold_model, {c["release_id"]: c["model_rows"] for c in checks})
    if bad:
        raise G.GoldValidationError("; ".join(f"release_id={k}: {v}" for k, v in sorted(bad.items())))
    return sum(c["release_rows"] for c in checks), sum(c["model_rows"] for c in checks)


def run_release(spark: SparkSession, raw_paths, release_id: str, lake: Lakehouse,
                run_id: str | None = None, fields: Sequence[Field] | None = None) -> str:
    """Backfill one release end to end; returns the DQ verdict."""
    run_id = run_id or new_run_id()
    drops = run_bronze(spark, raw_paths, release_id, lake, run_id)
    silver = run_silver(spark, release_id, lake, run_id, fields)
    status = run_dq(spark, release_id, lake, run_id, fields, measured=silver["measured"])
    run_gold(spark, release_id, lake, run_id)
    if drops.headless:  # all other files are published
        raise ValueError(_headless_text(drops))
    return status


def run_backfill(spark: SparkSession, raw_paths, lake: Lakehouse, run_id: str | None = None,
                 fields: Sequence[Field] | None = None, releases_per_job: int | None = None,
                 timings: dict | None = None) -> dict:
    """Backfill every release found under ``raw_paths`` in one set of jobs.

    The release of a row is the folder of its file.  One CSV scan feeds one
    Bronze write; Silver, DQ and Gold then run once over the list of
    releases (partition-pruned IN-list), grouping by ``release_id`` where the
    reference runs one job per release.  Releases whose DQ verdict is FAIL
    keep their DQ rows and get no Gold; the run then fails naming them.
    ``releases_per_job`` bounds how many releases share one Silver/DQ/Gold
    pass (and so the size of the cached, typed Silver scope) when a whole
    history is backfilled at once.  ``timings`` (a dict) receives seconds per
    phase.
    """
    import re
    import time
    clock = {} if timings is None else timings

    def timed(phase, fn, *args, **kw):
        t0 = time.perf_counter()
        try:
            return fn(*args, **kw)
        finally:
            clock[phase] = round(clock.get(phase, 0.0) + time.perf_counter() - t0, 3)

    run_id = run_id or new_run_id()
    drops = timed("bronze", run_bronze, spark, raw_paths, B.release_from_path(F.col("source_file")), lake, run_id)
    # release list from the file listing (driver metadata, one entry per file)
    pattern = re.compile(r"(?:release_id=)?([^/=]+)/[^/]+$")
    headed = set(drops.files) - set(drops.headless)
    releases = sorted({m.group(1) for f in headed if (m := pattern.search(f))})
    step = releases_per_job or max(len(releases), 1)
    verdicts: dict = {}
    problems: list[str] = [_headless_text(drops)] if drops.headless else []
    for i in range(0, len(releases), step):
        chunk = releases[i:i + step]
        timed("silver", run_silver, spark, chunk, lake, run_id, fields)
        chunk_verdicts = timed("dq", run_dq, spark, chunk, lake, run_id, fields, raise_on_fail=False)
        verdicts.update(chunk_verdicts)
        passed = [r for r, v in chunk_verdicts.items() if v != "FAIL"]
        for r in sorted(set(chunk) - set(chunk_verdicts)):  # S7: a drop without data rows is an outcome, not silence
            verdicts[r] = "EMPTY"
            problems.append(f"No Bronze data found for release_id={r}")
        if passed:
            try:
                timed("gold", run_gold, spark, passed, lake, run_id)
            except G.GoldValidationError as exc:  # its good releases are published; the run fails at the end
                problems.append(str(exc))
    failed = sorted(r for r, v in verdicts.items() if v == "FAIL")
    if failed:
        raise Q.DataQualityError(f"Data quality verdict is FAIL for release(s) {', '.join(map(str, failed))}")
    if problems:
        raise G.GoldValidationError("; ".join(problems))
    return verdicts
