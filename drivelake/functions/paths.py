"""Object-key and file-path helpers (F15-F17, S3 lineage normalisation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_key(c) -> Column:
    """form-decode an object key ('+' -> blank, %xx -> byte).

    A malformed escape leaves the key as it came, like a lenient decoder.
    """
    c = _col(c)
    return F.coalesce(F.try_url_decode(c), c)


def decode_path(c) -> Column:
    """Q4: one decoded form for file URIs ('%20' -> blank, '+' kept); a path without an escape is as it is."""
    c = _col(c)
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)).otherwise(c)


def file_name(c) -> Column:
    """Last path segment."""
    return F.regexp_extract(_col(c), r"([^/]*)$", 1)


def release_from_key(key, prefix: str) -> Column:
    """F16: first path segment after ``prefix``; NULL when the key has no
    folder under the prefix or the folder name is empty."""
    key = _col(key)
    rel = F.substring(key, len(prefix) + 1, 1 << 30)
    first = F.substring_index(rel, "/", 1)
    has_folder = F.instr(rel, "/") > 0
    return F.when(has_folder & (F.length(first) > 0), first)


def source_date_from_key(key) -> Column:
    """F16: file stem of a ``.csv`` key when it has three '-' separated parts."""
    name = file_name(key)
    stem = F.regexp_extract(name, r"^(.*)\.csv$", 1)
    ok = name.endswith(F.lit(".csv")) & (F.size(F.split(stem, "-", -1)) == 3)
    return F.when(ok, stem)


def utc_iso(ts) -> Column:
    """ISO-8601 UTC text with a ``Z`` suffix, whatever the session time zone
    (the instant is shifted to UTC wall time before formatting)."""
    return F.date_format(F.to_utc_timestamp(_col(ts), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
