"""Helpers shared by the corpus operators: scratch tables, column selection, batching."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.util import checkpoint_dir

#: Characters of text that one Python step holds at once.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared folder of the session (``spark.checkpoint.dir``)."""
    own = spark.sparkContext.master.split("[")[0] == "local" and not spark.conf.get("spark.checkpoint.dir", None)
    folder = checkpoint_dir(spark, tempfile.mkdtemp(prefix="corpus-") if own else None)  # one process needs no shared folder
    return f"{folder.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, spark: SparkSession, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_path(spark, tag)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark's cleaner removes them once nothing on the driver refers to
    them any more, so its garbage is collected here instead of whenever its heap is full. For jobs of many rounds."""
    for _ in range(2):  # what the first round lets go of refers to the shuffles
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, (id as long, text); null text is the empty text. Other columns, of any name, are left out."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about ``chars`` bytes of text each; a longer row makes a slice of its own."""
    if not batch.num_rows:
        return
    import pyarrow.compute as pc
    sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + (n or 0) > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    yield batch.slice(start)
