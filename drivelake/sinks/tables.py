"""Table writes (K1-K8, E1): create, append, upsert, partition overwrite.

All writes go to path-backed Parquet tables (snappy).  Writes are
idempotent where the reference relies on it: ``upsert`` and
``overwrite_partitions`` replace whole partitions with dynamic partition
overwrite, so a replayed batch (lost executor, stream restart) converges to
the same table.  Files are staged by the Hadoop commit protocol and the
replaced partitions only disappear at job commit, so reading the target in
the same plan is safe and a retried task re-reads intact input.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivelake.sources.tables import Table, read_table, store_schema, stored_schema, table_exists, table_schema, with_string_parts


def _writer(df: DataFrame, table: Table):
    w = df.write.format("parquet").option("compression", "snappy")
    if table.partition_by:
        w = w.partitionBy(*table.partition_by)
    return w


def create_table(df: DataFrame, table: Table) -> None:
    """K1/K3: create a partitioned Parquet table from ``df`` and store its schema.

    A schema that a crashed creation left behind is extended, as its files are not there.
    """
    spark = df.sparkSession
    if table_exists(spark, table):
        raise ValueError(f"Table {table.path} already exists")
    if table.schema is None:
        generation, known = stored_schema(spark, table)
        wanted = with_string_parts(df.schema, table.partition_by)
        schema = merged_schema(known, df, table.partition_by) if known else wanted
        if schema != known:
            store_schema(spark, table, schema, generation)
        df = align(df, schema) if known else df
    append(df, table)


def append(df: DataFrame, table: Table) -> None:
    """K2: append (columns are matched by name when the table is read)."""
    _writer(df, table).mode("append").save(table.path)


def create_or_append(spark: SparkSession, df: DataFrame, table: Table) -> None:
    """K1/K2/K7: the create-vs-append choice of every first write."""
    if table_exists(spark, table):
        append_merging(spark, df, table)
    else:
        create_table(df, table)


def overwrite_partitions(df: DataFrame, table: Table) -> None:
    """K5: replace exactly the partitions present in ``df``; others stay."""
    if not table.partition_by:
        raise ValueError("overwrite_partitions needs a partitioned table")
    (_writer(df, table).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").save(table.path))


def evolve(existing: T.StructType, incoming: Iterable[str]) -> list[str]:
    """Incoming column names absent from the table (case-insensitive, Q17)."""
    known = {f.name.lower() for f in existing.fields}
    out, seen = [], set()
    for c in incoming:
        if c.lower() not in known and c.lower() not in seen:
            out.append(c)
            seen.add(c.lower())
    return out


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name: cast present columns, typed
    NULL for absent ones, table order; extra ``df`` columns are dropped."""
    present = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return df.select(*cols)


def merged_schema(existing: T.StructType, df: DataFrame, partition_by: Sequence[str] = ()) -> T.StructType:
    """Existing columns first, then new ``df`` columns (as typed in ``df``),
    partition columns last."""
    parts = set(partition_by)
    fields = [f for f in existing.fields if f.name not in parts]
    for name in evolve(existing, [c for c in df.columns if c not in parts]):
        fields.append(T.StructField(name, df.schema[name].dataType, True))
    by_name = {f.name: f for f in existing.fields}
    for p in partition_by:
        fields.append(by_name.get(p) or T.StructField(p, T.StringType(), True))
    return T.StructType(fields)


def append_merging(spark: SparkSession, df: DataFrame, table: Table) -> T.StructType:
    """Append with additive schema evolution; returns the new schema.

    New columns are stored as the table's next generation before the rows are
    written, so a reader always knows the columns of every committed file.
    """
    existing = table.schema or table_schema(spark, table)
    schema = merged_schema(existing, df, table.partition_by)
    if table.schema is None:
        generation, known = stored_schema(spark, table)
        if schema != known:
            store_schema(spark, table, schema, generation)
    append(align(df, schema), table)
    return schema


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key; Catalyst puts a partial top-1 before the exchange on the key."""
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def newest_generation(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """K4/J1 in one pass: per key the row of the newest generation, a new one
    before an existing one; rows of one generation follow ``order`` descending.

    One exchange on the key.  A partial top-1 stands before it, so a task sends
    one row a key, and both generations go through it together (no anti-join,
    no second pass over ``new``).  With ``order``, ``new`` may hold several rows
    of a key (W1 is done in the same exchange); without it, one.
    """
    both = existing.withColumn("_generation", F.lit(0)).unionByName(new.withColumn("_generation", F.lit(1)))
    return first_per_key(both, keys, [F.desc("_generation"), *[F.desc_nulls_last(c) for c in order]]).drop("_generation")


def replace_partitions(existing: DataFrame, new: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """K5 core: rows of the partitions ``new`` does not touch, plus ``new`` -
    the table content after a dynamic partition overwrite with ``new``."""
    touched = new.select(*partition_cols).distinct()
    return existing.join(touched, on=list(partition_cols), how="left_anti").unionByName(new)


#: Rows that one task holds, sorts and writes at most: rows of a partition beyond it go to further tasks.
TASK_ROWS = 150_000


def by_partition(df: DataFrame, parts: Sequence[str]) -> dict[tuple, int]:
    """Rows of each partition that ``df`` holds, as many entries as partitions; of a table these come from its footers."""
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*parts).agg(F.count(F.lit(1))).collect()}


def clustered_by_partition(df: DataFrame, parts: Sequence[str], keys: Sequence[str], rows: dict[tuple, int]) -> DataFrame:
    """``df`` in tasks of some ``TASK_ROWS`` rows of one partition, rows of equal keys together; adds ``_bucket``.

    ``rows`` bounds the rows of each partition, so the tasks grow in number
    with the table and not in size.  Bytes would not bound them: rows that
    compress well are many times larger in memory than in the exchange.
    """
    spark = df.sparkSession
    buckets = {values: max(1, -(-n // TASK_ROWS)) for values, n in rows.items()}
    if not any(n > 1 for n in buckets.values()):
        # by the partition alone: a constant would stay in the exchange only, and a window by partition and bucket would ask for another one
        return df.repartition(max(1, len(buckets)), *parts).withColumn("_bucket", F.lit(0).cast("long"))
    names = [f"_p{i}" for i in range(len(parts))]
    schema = T.StructType([T.StructField(n, df.schema[p].dataType) for n, p in zip(names, parts)] + [T.StructField("_buckets", T.LongType())])
    counts = spark.createDataFrame([(*values, n) for values, n in buckets.items()], schema)
    same = [F.col(n).eqNullSafe(F.col(p)) for n, p in zip(names, parts)]
    placed = df.join(F.broadcast(counts), same, "left").withColumn(
        "_bucket", F.pmod(F.xxhash64(*keys), F.coalesce("_buckets", F.lit(1).cast("long")))).drop(*names, "_buckets")
    return placed.repartition(sum(buckets.values()), *parts, "_bucket")


def held_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns in which some row of ``df`` has a value; row groups without one are skipped by their stats."""
    if not columns:
        return []
    some = df.where(reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in columns]))
    if some.isEmpty():
        return []
    found = some.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in columns]).first()
    return [c for c in columns if found[c]]


def upsert(spark: SparkSession, df: DataFrame, table: Table, keys: Sequence[str],
           touched: Sequence[tuple] | dict[tuple, int] | None = None, cluster_by: Sequence[str] | None = None, order: Sequence[str] = (),
           measure: dict[str, Column] | None = None, hot_keys: bool = True) -> dict:
    """MERGE on ``keys`` - a matched row is replaced by the new one,
    an unmatched row is inserted.

    ``keys`` must determine the partition (true for the Silver key: release and
    snapshot date fix the release/month partition), so rewriting the touched
    partitions as ``old rows without a new twin`` + ``new rows`` is complete.
    Only the touched partitions are scanned (partition pruning from a literal
    list) and rewritten (dynamic overwrite).  ``df`` must be key-unique.
    ``touched`` (the partition values of ``df``, with their rows or more) can be
    passed when a cheaper frame than ``df`` knows them, e.g. the cached pre-dedup
    rows.

    ``cluster_by`` (the partition columns) puts the rows of a partition into
    tasks of their own, as many as its rows need (``clustered_by_partition``):
    a few large files per partition instead of one small file per (task,
    partition), and no sampling job.  Existing rows go through that one exchange
    only.  Columns without a value in the touched partitions join after the last
    sort, so no task holds them.

    With ``order``, ``df`` may hold a key in many rows; ``hot_keys=False`` says
    that no key has more of them than one task holds.  The newest row is then
    taken after that one exchange, in its sort; otherwise hot keys are cut to one
    row a task before it, in an exchange of their own.

    ``measure`` (aggregates by name) is taken of the rows of the touched partitions
    while they are written, in the writing stage, where Spark counts every
    partition once however often its task runs; the values are returned, and
    the number of rows is read back (K8).
    """
    seen = Observation()
    parts = list(table.partition_by)
    by_order = [F.desc_nulls_last(c) for c in order]
    in_task = [*parts, "_bucket", *[k for k in keys if k not in parts]]  # by partition first, as the writer wants its rows sorted

    def watched(frame: DataFrame) -> DataFrame:
        if measure is None:
            return frame
        return frame.observe(seen, F.count(F.lit(1)).alias("_written"), *[c.alias(n) for n, c in measure.items()])

    def measured(rows: DataFrame) -> dict:
        if measure is None:
            return {}
        found = dict(seen.get)
        expected, got = found.pop("_written"), rows.count()  # by the footers
        if got != expected:
            raise RuntimeError(f"Read-back check failed for {table.path}: expected {expected} rows, found {got}")
        return found

    # The touched partitions are bounded by the number of partitions, not rows.
    if touched is None and (cluster_by or table_exists(spark, table)):
        touched = by_partition(df, parts)
    if not table_exists(spark, table):
        late = bool(order and cluster_by and touched and not hot_keys)
        rows = first_per_key(df, keys, by_order) if order and not late else df
        if cluster_by and touched:
            rows = clustered_by_partition(rows, parts, keys, _counted(spark, df, parts, touched))
            rows = first_per_key(rows, in_task, by_order).drop("_bucket") if late else rows.drop("_bucket").sortWithinPartitions(*parts)
        create_table(watched(align(rows, table.schema) if table.schema else rows), table)
        return measured(read_table(spark, table))
    if not touched:
        return {}
    schema = merged_schema(read_table(spark, table).schema, df, parts)
    if table.schema is None and schema != stored_schema(spark, table)[1]:
        store_schema(spark, table, schema, stored_schema(spark, table)[0])
    existing = read_table(spark, table, schema)
    cond = None
    for values in touched:
        term = None
        for p, v in zip(parts, values):
            t = F.col(p) == F.lit(v) if v is not None else F.col(p).isNull()
            term = t if term is None else term & t
        cond = term if cond is None else cond | term
    existing = existing.filter(cond)
    given = {c.lower() for c in df.columns}
    old = held_columns(existing, [c for c in schema.names if c.lower() not in given])
    held = T.StructType([f for f in schema.fields if f.name.lower() in given or f.name in old])
    new = align(df, held)
    if cluster_by:
        rows = dict(_counted(spark, df, parts, touched))
        for values, n in by_partition(existing, parts).items():
            rows[values] = rows.get(values, 0) + n
        # a hot key of the new rows is cut to one row before the exchange of both generations
        new = first_per_key(new, keys, by_order) if order and hot_keys else new
        both = align(existing, held).withColumn("_generation", F.lit(0)).unionByName(new.withColumn("_generation", F.lit(1)))
        both = clustered_by_partition(both, parts, keys, rows)
        latest = first_per_key(both, in_task, [F.desc("_generation"), *by_order])
        latest = latest.drop("_generation", "_bucket")
    else:
        latest = newest_generation(align(existing, held), new, keys, order)
    overwrite_partitions(watched(align(latest, schema)), table)
    return measured(read_table(spark, table, schema).filter(cond))


def _counted(spark: SparkSession, df: DataFrame, parts: Sequence[str], touched) -> dict[tuple, int]:
    return touched if isinstance(touched, dict) else by_partition(df, parts)


def verify_written_by(spark: SparkSession, table: Table, expected: dict, column: str = "release_id") -> None:
    """K8: one grouped count over the written partitions of several scopes,
    compared with the rows computed per scope."""
    df = read_table(spark, table).filter(F.col(column).isin([str(k) for k in expected]))
    got = {r[0]: r[1] for r in df.groupBy(column).count().collect()}
    bad = {k: (n, got.get(str(k), 0)) for k, n in expected.items() if got.get(str(k), 0) != n}
    if bad:
        raise RuntimeError(f"Read-back check failed for {table.path}: (expected, found) {bad}")
