"""Raw CSV drops -> all-string DataFrames with file lineage.

Daily CSV files drift: columns get added, reordered or re-cased over the
years.  A single multi-file CSV read takes one header for every file and maps
the others *by position*.  Here files with one header line are one *layout*:

* ``find_layouts``: one distributed text job finds the header line of each
  file (its first line that is not blank) and whether a quoted field of it may
  run over a line break; the driver gets a row per file, as many as it lists.
* ``read_layouts``: each layout is a CSV scan of its own with its own columns,
  in which Spark's reader takes off the header at the start of every file; the
  scans are united by name.  So a header is never data, however the files are
  split, and nothing of the text is cached, joined or shuffled.  Files whose
  records may span lines are read whole, all others in splits.

A file without a column of another file has NULL there; a run whose files all
lack ``date`` reaches the schema quarantine.  A first line that holds a date is
data: such a file has no header.  Its rows are never read under guessed names:
the reader names the file, and a backfill quarantines its lines.
"""

from __future__ import annotations

import contextlib
import re
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivelake.functions.paths import decode_path

# Fixed value: a first line with a field like this is data, so its file has no header.
DATA_FIELD = r'(^|,)"?\d{4}-\d{2}-\d{2}"?(,|$)'


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def header_columns(line: str) -> list[str]:
    """Split a CSV header line into column names (quotes stripped)."""
    import csv
    return [c.strip() for c in next(csv.reader([line]))]


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _dedupe_names(cols: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for c in cols:
        k = c.lower()
        if k in seen:
            seen[k] += 1
            out.append(f"{c}_{seen[k]}")
        else:
            seen[k] = 0
            out.append(c)
    return out


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """Every ``*.csv`` line under ``paths`` (recursively) with its decoded file path and block."""
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[cC][sS][vV]")
            .text(_as_list(paths))
            .select(F.col("value"), decode_path(F.col("_metadata.file_path")).alias("source_file"),
                    F.col("_metadata.file_block_start").alias("block_start")))


@dataclass(frozen=True)
class Layout:
    """Files with one header line; ``multiline`` where records may hold line breaks."""
    columns: tuple[str, ...]
    multiline: bool
    files: tuple[str, ...]


@dataclass(frozen=True)
class Drops:
    """CSV files by layout, and those that have no layout: without a header, or without any line."""
    layouts: tuple[Layout, ...]
    headless: tuple[str, ...]
    empty: tuple[str, ...]

    @property
    def files(self) -> list[str]:
        return sorted([*(f for x in self.layouts for f in x.files), *self.headless, *self.empty])


def file_headers(lines: DataFrame, file_col: str = "source_file") -> DataFrame:
    """(file, header, open_quotes, blanks): the first line of each file that is not blank, a byte order
    mark taken off, whether any line has an odd number of quotes, escaped ones aside, and whether a
    line of blanks stands before the header.

    Only within this one scan are the lines of a file compared: a block's lines keep their order within their task.
    """
    lines = lines.withColumn("line", F.monotonically_increasing_id())  # of every line, so not within a condition
    at = F.struct("block_start", "line")
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '[^"]', ""))
    text = F.when(F.trim("value") != "", F.col("value"))
    placed = lines.select(file_col, text.alias("text"), F.when(text.isNotNull(), at).alias("at"), (quotes % 2 == 1).alias("odd"),
                          F.when((F.length("value") > 0) & text.isNull(), at).alias("blank_at"))
    firsts = placed.groupBy(file_col).agg(F.min_by("text", "at").alias("header"), F.max("odd").alias("open_quotes"),
                                          F.coalesce(F.min("blank_at") < F.min("at"), F.lit(False)).alias("blanks"))
    return firsts.withColumn("header", F.regexp_replace("header", "^\ufeff", ""))


def find_layouts(spark: SparkSession, paths) -> Drops:
    """The layouts of every ``*.csv`` file under ``paths`` (recursively), from one job over their lines."""
    lines = text_lines(spark, paths)
    found = file_headers(lines).collect()  # a row per listed file
    held = {re.sub("^file:/+", "file:/", r["source_file"]) for r in found}
    headed, headless, empty = {}, [], [f for f in map(decoded, lines.inputFiles()) if f not in held]
    for r in found:
        if r["header"] is None:
            empty.append(r["source_file"])
        elif re.search(DATA_FIELD, r["header"]) or re.sub(r"\\.", "", r["header"]).count('"') % 2:  # no whole header in this line
            headless.append(r["source_file"])
        elif r["blanks"] and r["open_quotes"]:  # read whole, a line of blanks would pass for its header
            headless.append(r["source_file"])
        else:
            headed.setdefault((r["header"], r["open_quotes"]), []).append(r["source_file"])
    layouts = [Layout(tuple(_dedupe_names([c.lower() for c in header_columns(h)])), multi, tuple(sorted(files)))
               for (h, multi), files in sorted(headed.items())]
    return Drops(tuple(layouts), tuple(sorted(headless)), tuple(sorted(empty)))


def decoded(uri: str) -> str:
    """One listed path as the ``_metadata`` of its rows has it, decoded."""
    from urllib.parse import unquote
    return unquote(re.sub("^file:/+", "file:/", uri))


def literal_path(path: str) -> str:
    """A path for a reader that would take these characters for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def read_layouts(spark: SparkSession, drops: Drops) -> DataFrame:
    """All-string rows of the files of all layouts, united by column name, plus ``source_file``."""
    if not drops.layouts:
        return spark.createDataFrame([], "source_file string")

    def scan(layout: Layout) -> DataFrame:
        reader = spark.read.schema(string_schema(layout.columns)).options(header=True, multiLine=layout.multiline)
        own = [F.col(f"`{c}`") for c in layout.columns if c != "source_file"]
        return reader.csv([literal_path(f) for f in layout.files]).select(*own, decode_path(F.col("_metadata.file_path")).alias("source_file"))

    names = list(dict.fromkeys(c for x in drops.layouts for c in x.columns if c != "source_file"))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(scan, drops.layouts))
    return united.select(*[F.col(f"`{c}`") for c in names], "source_file")


def headless_lines(spark: SparkSession, drops: Drops) -> DataFrame:
    """(value, source_file): the lines of files without a header, for quarantine."""
    return text_lines(spark, [literal_path(f) for f in drops.headless]).where(F.trim("value") != "").select("value", "source_file")


def _headers_needed(drops: Drops) -> Drops:
    if drops.headless:
        raise ValueError(f"CSV file(s) without a header line: {list(drops.headless[:10])}")
    return drops


def read_raw(spark: SparkSession, paths, lineage: bool = True) -> DataFrame:
    """Every CSV under ``paths`` as strings, drift-safe, with ``source_file``.

    Column names are lower-cased (Q17: Spark resolves names case-insensitively,
    so ``Model`` and ``model`` are one column).
    """
    drops = _headers_needed(find_layouts(spark, paths))
    if not drops.layouts:
        raise ValueError(f"No CSV line found under {paths}")
    out = read_layouts(spark, drops)
    return out if lineage else out.drop("source_file")


@contextlib.contextmanager
def raw_drops(spark: SparkSession, paths):
    """Yields ``(rows, files)`` - the drift-safe all-string rows of every
    CSV under ``paths`` (plus ``source_file``), and the list of files read."""
    drops = _headers_needed(find_layouts(spark, paths))
    if not drops.layouts:
        raise ValueError(f"No CSV line found under {paths}")
    yield read_layouts(spark, drops), drops.files


def check_single_file(path: str, prefix: str) -> None:
    """S2 guard: one concrete ``.csv`` object under the allowed prefix."""
    if not path.startswith(prefix):
        raise ValueError(f"input_path must start with {prefix}: {path}")
    if "*" in path:
        raise ValueError(f"input_path must name one file, not a pattern: {path}")
    if not path.lower().endswith(".csv"):
        raise ValueError(f"input_path must be a .csv file: {path}")


def with_source_file(df: DataFrame, path: str | None = None) -> DataFrame:
    """S3: per-row file lineage, or a literal path for single-file runs."""
    if path is None:
        return df.withColumn("source_file", decode_path(F.col("_metadata.file_path")))
    return df.withColumn("source_file", F.lit(path))
