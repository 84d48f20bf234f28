"""Keep-latest deduplication on a business key.

``row_number() == 1`` over the key lets Catalyst plan a partial
``WindowGroupLimit`` before the shuffle: every map task keeps only its newest
row per key, so a hot key (even one holding a third of the input) reaches
the exchange as one row per task, and the final top-1 runs after it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SILVER_ORDER = ("bronze_ingested_at", "source_file")


def _desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = SILVER_ORDER,
                 tie_break: bool | Sequence[str] = True) -> DataFrame:
    """Keep the first row per ``keys`` ordered by ``order`` descending.

    With ``tie_break`` the remaining columns (name order, descending, NULLs
    last) complete the order, so equal rows tie only when they are identical
    and the result is deterministic (Q5).  A list restricts the tie-break to
    those columns - pass the columns that can vary (columns built from a
    constant cannot break a tie and would only widen the sort key).
    """
    ordering = [_desc(c) for c in order]
    if tie_break:
        pool = df.columns if tie_break is True else list(tie_break)
        rest = sorted(c for c in pool if c not in set(keys) | set(order))
        ordering += [_desc(c) for c in rest]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
