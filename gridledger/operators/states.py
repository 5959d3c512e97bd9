"""Summaries that are kept and merged: quantile sketches per chunk, and exact bitmaps for distinct counts at several grains."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.session import materialise

SKETCH_SIZE = 400


# --- quantiles -----------------------------------------------------------------------------------------

def rank_error(size: int) -> float:
    """Three times the share of values by which the rank of a sketch of this size is off in one case of a hundred."""
    return 3 * 2.296 / size ** 0.9723


def quantile_states(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``keys, state, n, low, high, size``: a sketch of the values of each group; groups without values are left out.

    States of any groups can be kept and merged. A larger ``size`` gives closer bounds.
    """
    v = F.col(value).cast("double")
    have = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"))
    return have.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", F.lit(size)).alias("state"), F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"),
                                   F.lit(size).alias("size"))


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of coarser groups."""
    return states.groupBy(*keys).agg(F.kll_merge_agg_double("state").alias("state"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("size").alias("size"))


def quantile_bounds(states: DataFrame, keys: Sequence[str], probs: Sequence[float], size: int = SKETCH_SIZE) -> DataFrame:
    """``keys, prob, n, at_least, estimate, at_most``: a quantile lies between the estimates as far away as the sketch can be off.

    The bounds end at the smallest and largest value, which are exact. ``size`` is that of the sketches.
    """
    def at(p: float) -> Column:
        return F.kll_sketch_get_quantile_double("state", F.lit(float(min(1.0, max(0.0, p)))))

    off = rank_error(size)
    rows = [F.struct(F.lit(float(p)).alias("prob"), (F.col("low") if p - off <= 0 else at(p - off)).alias("at_least"), at(p).alias("estimate"),
                     (F.col("high") if p + off >= 1 else at(p + off)).alias("at_most")) for p in probs]
    return states.select(*keys, "n", F.inline(F.array(*rows))).select(*keys, "prob", "n", "at_least", "estimate", "at_most")


# --- distinct counts -----------------------------------------------------------------------------------

def dense_ids(df: DataFrame, column: str, name: str = "id") -> DataFrame:
    """``column, name``: the distinct values numbered from 0 in their order; nulls are left out.

    The values are sorted in ranges and kept once; a range begins at the number of values in those before it.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(tasks, column).sortWithinPartitions(column)
    placed = materialise(values.select(column, F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)                  # one row per range
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(first), "_part")
    return numbered.select(column, (F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def distinct_at_grains(df: DataFrame, number: str, sets: Sequence[Sequence[str]], *cols: str) -> DataFrame:
    """``grain, cols, n``: how many distinct whole numbers there are in each group of each set of columns; nulls do not count.

    The numbers of the finest groups become bitmaps of a few thousand neighbours each, which merge for the coarser sets, so nothing is counted
    anew; numbers should be dense (``dense_ids``). ``grain`` names the columns a row is grouped by.
    """
    sets = [list(s) for s in sets]
    used = [c for c in cols if any(c in s for s in sets)]
    value = F.col(number).cast("bigint")
    finest = df.where(value.isNotNull()).groupBy(*used, F.bitmap_bucket_number(value).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("_bits"))
    grouped = [*used, "_bucket"]
    mask = [sum(1 << (len(grouped) - 1 - grouped.index(c)) for c in used if c not in s) for s in sets]
    merged = finest.groupingSets([[*[F.col(c) for c in s], F.col("_bucket")] for s in sets], *[F.col(c) for c in grouped]).agg(
        F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"), F.grouping_id().alias("_id"))
    grain = reduce(lambda acc, mn: acc.when(F.col("_id") == mn[0], F.lit(mn[1])), zip(mask, [",".join(s) if s else "all" for s in sets]), F)
    counted = merged.select(grain.alias("grain"), *used, "_n").groupBy("grain", *used).agg(F.sum("_n").cast("bigint").alias("n"))
    return counted.select("grain", *[F.col(c) if c in used else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cols], "n")
