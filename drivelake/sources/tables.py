"""Table scans and scope guards.

Tables are path-backed, partitioned Parquet directories.  Partition values are
always read as STRING (``release_id=2013`` must not turn into an INT), so a
read passes an explicit schema.  The schema of an evolving table is data next
to it: ``_schema/<generation>.json``, one immutable file a generation, written
before the first rows that need it.  So a read or an append opens one small
file, and never the footers of all data files.  A filter on a partition column
prunes directories; a filter on ``source_file`` is pushed to Parquet row-group
stats.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """A path-backed Parquet table, its partition columns and - for tables
    with a declared layout (Silver, DQ, Gold) - its schema.  Evolving tables
    (Bronze, quarantine) leave ``schema`` unset and have a stored one."""
    path: str
    partition_by: tuple[str, ...] = field(default_factory=tuple)
    schema: T.StructType | None = None


def table_exists(spark: SparkSession, table: Table) -> bool:
    """A table exists once a write has committed data files or partitions.

    Not by a success marker, which committers of object stores may leave out;
    uncommitted output is below names that begin with ``_`` or ``.``.
    """
    if "://" not in table.path and not table.path.startswith("/"):
        return spark.catalog.tableExists(table.path)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    entries = fs.listStatusIterator(path)
    while entries.hasNext():
        if entries.next().getPath().getName()[:1] not in ("_", "."):
            return True
    return False


def _schema_folder(spark: SparkSession, table: Table):
    """(file system, folder) of the stored generations."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.path}/_schema")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def stored_schema(spark: SparkSession, table: Table) -> tuple[int, T.StructType | None]:
    """(generation, schema) of the table's latest stored schema; (0, None) where it has none."""
    fs, folder = _schema_folder(spark, table)
    if not fs.exists(folder):
        return 0, None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    latest = max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)
    if not latest:
        return 0, None
    stream = fs.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{latest:06d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return latest, T.StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, table: Table, schema: T.StructType, after: int) -> int:
    """Store the generation that follows ``after``; fails if another writer has stored it first.

    The file appears whole under its name: it is written beside and renamed, which never replaces.
    """
    fs, folder = _schema_folder(spark, table)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    own, goal = hadoop(folder, f".{uuid.uuid4().hex}"), hadoop(folder, f"{after + 1:06d}.json")
    stream = fs.create(own, False)
    try:
        stream.write(bytearray(json.dumps(schema.jsonValue()).encode()))
    finally:
        stream.close()
    if fs.exists(goal) or not fs.rename(own, goal):
        fs.delete(own, False)
        raise RuntimeError(f"Schema generation {after + 1} of {table.path} was stored by another writer")
    return after + 1


def with_string_parts(schema: T.StructType, partition_by) -> T.StructType:
    """The data fields, then the partition columns typed STRING."""
    parts = set(partition_by)
    return T.StructType([f for f in schema.fields if f.name not in parts]
                        + [T.StructField(p, T.StringType(), True) for p in partition_by])


def table_schema(spark: SparkSession, table: Table) -> T.StructType:
    """The stored schema, partition columns typed STRING; merged footers only for a table written without one."""
    found = stored_schema(spark, table)[1] or spark.read.option("mergeSchema", "true").parquet(table.path).schema
    return with_string_parts(found, table.partition_by)


def read_table(spark: SparkSession, table: Table, schema: T.StructType | None = None) -> DataFrame:
    schema = schema or table.schema or table_schema(spark, table)
    return spark.read.schema(schema).option("basePath", table.path).parquet(table.path)


def scope(df: DataFrame, release_id=None, source_file=None) -> DataFrame:
    """Restrict to one release and/or one source file (or a list of
    them).  Both predicates compare as strings (Q2) and are combined
    (Q14); a release literal or IN-list prunes partitions."""
    if isinstance(release_id, (list, tuple, set, frozenset)):
        df = df.filter(F.col("release_id").isin([str(r) for r in release_id]))
    elif release_id is not None:
        df = df.filter(F.col("release_id") == F.lit(str(release_id)))
    if isinstance(source_file, (list, tuple, set, frozenset)):
        df = df.filter(F.col("source_file").isin(list(source_file)))
    elif source_file is not None:
        df = df.filter(F.col("source_file") == F.lit(source_file))
    return df


#: Rows of a stored table that one task takes at most when it is spread.
SPREAD_ROWS = 300_000


def spread_stored(df: DataFrame, *keys: str) -> DataFrame:
    """``spread`` for columns of a stored table: tasks grow in number with its rows, which its footers tell, and not in size.

    Dealt by ``keys`` that hardly repeat, which takes no sort of the rows, as dealing them in turn does.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS)), *keys)


def spread(df: DataFrame, target: int | None = None) -> DataFrame:
    """Round-robin the rows over ``target`` tasks, by default the cluster's parallelism.

    For single-file scopes: a daily drop is one or two Parquet files, so the
    CPU-heavy typing would run on as many cores.  The exchange has no key, so no
    skew, and AQE merges small partitions afterwards.
    """
    return df.repartition(target or df.sparkSession.sparkContext.defaultParallelism)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail before any work when the scope holds no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
