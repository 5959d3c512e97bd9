"""Statistics of gridded values kept as chunks, an array of values per row, without one row per value.

A chunk index has the range, the sum and the counts of each chunk. Statistics of any group of chunks are merged from it, and a selection by
value opens only the chunks whose range reaches it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present(values: Column) -> Column:
    return F.filter(values.cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v))


def chunk_index(chunks: DataFrame, values: str, *keys: str) -> DataFrame:
    """Per chunk: ``low``, ``high``, ``total`` of the values present, how many these are, and how many are missing."""
    have = _present(F.col(values))
    return chunks.select(
        *keys, F.array_min(have).alias("low"), F.array_max(have).alias("high"), F.aggregate(have, F.lit(0.0), lambda a, v: a + v).alias("total"),
        F.size(have).cast("bigint").alias("present"), (F.coalesce(F.size(values), F.lit(0)) - F.size(have)).cast("bigint").alias("missing"))


def merged_stats(index: DataFrame, *keys: str) -> DataFrame:
    """Smallest, largest and mean value and the number of missing ones of each group of chunks."""
    total = F.sum("present")
    return index.groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                    (F.sum("total") / F.when(total > 0, total)).alias("mean"), F.sum("missing").alias("nulls"))


def chunks_within(index: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """The index rows of chunks that may hold a value from ``low`` to ``high``."""
    reach = F.col("present") > 0
    if low is not None:
        reach &= F.col("high") >= low
    if high is not None:
        reach &= F.col("low") <= high
    return index.where(reach)


def count_within(chunks: DataFrame, index: DataFrame, values: str, keys: list[str], low: float | None = None, high: float | None = None) -> DataFrame:
    """``keys, n``: how many values of each chunk lie from ``low`` to ``high``; chunks out of reach are not opened and have no row."""
    opened = chunks.join(chunks_within(index, low, high).select(*keys), keys, "left_semi")
    hit = F.size(F.filter(F.col(values).cast("array<double>"), lambda v: ~F.isnan(v) & (v >= low if low is not None else F.lit(True)) & (v <= high if high is not None else F.lit(True))))
    return opened.select(*keys, hit.cast("bigint").alias("n")).where("n > 0")


def cell_series(chunks: DataFrame, values: str, cell: int, *keys: str) -> DataFrame:
    """The value of one cell of every chunk, null where a chunk is too short."""
    return chunks.select(*keys, F.get(F.col(values), F.lit(cell)).cast("double").alias("value"))
