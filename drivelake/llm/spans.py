"""Matches of a pattern with their places, in DataFrame operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,rank:int,kind:string,`end`:int,value:string>"


def span(start, rank: int, kind: str, end, value) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.cast("int").alias("end"), value.alias("value"))


def places(pieces: Column, matches: Column, rank: int, kind: str, keep: Callable[[Column], Column] | None = None, offset: Column | None = None) -> Column:
    """Spans of the kept matches; pieces is the text split (limit -1) at these matches. Places count code points."""
    parts = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("hit"))
    begin = F.lit(0) if offset is None else offset

    def step(state, x):
        at = state["at"] + F.length(x["piece"])
        end = at + F.length(x["hit"])
        new = F.concat(state["found"], F.array(span(at, rank, kind, end, x["hit"])))
        return F.struct(end.cast("int").alias("at"), (F.when(keep(x["hit"]), new).otherwise(state["found"]) if keep else new).alias("found"))

    return F.aggregate(parts, F.struct(begin.cast("int").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found")), step, lambda s: s["found"])


def joined(spans) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
