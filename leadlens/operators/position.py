"""Numbering rows in an order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.session import cut_lineage


def with_position(df: DataFrame, order: Sequence[str | Column], out: str = "position") -> DataFrame:
    """``df`` with its rows numbered from 1 in ``order`` (SO1).

    A global sort deals rows into ranges; a row's place in its range is known
    when the sorted table is written, and each range starts where those before
    it end. Only the ranges' sizes reach the driver. Rows that are equal in
    ``order`` are numbered in an arbitrary order, so extend it where that matters.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, at = [], 1
    for p, n in sorted((r["_part"], r["n"]) for r in sizes):
        starts.append((p, at))
        at += n
    starts = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")      # a row for each range
            .withColumn(out, F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
            .select(*df.columns, out))
