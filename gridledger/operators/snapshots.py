"""Comparing two kept revisions by digests of ranges, reading only the ranges that differ.

A snapshot is written by ranges, a folder for each, with a digest per range. The digests form a tree: those of neighbouring ranges are
summed up, and equal sums end the descent. Ranges come from a hash of the key, so equal keys of both revisions are in the same range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.operators.revise import revision_diff

RANGES = 256
_RANGE = "_range"


def write_snapshot(df: DataFrame, folder: str, key: str, ranges: int = RANGES) -> None:
    """Writes ``folder``/rows by range and ``folder``/digests, a row per range that has rows.

    A digest is the sum of a hash of every row, so it does not depend on their order; the number of rows goes with it.
    """
    placed = df.withColumn(_RANGE, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(ranges)).cast("int"))
    placed.hint("rebalance", _RANGE).write.partitionBy(_RANGE).parquet(f"{folder}/rows")
    rows = df.sparkSession.read.schema(placed.schema).parquet(f"{folder}/rows")
    digest = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)"))
    rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest")).coalesce(1).write.parquet(f"{folder}/digests")


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/rows")


def digest_tree(digests: DataFrame, ranges: int = RANGES, fan: int = 16) -> DataFrame:
    """``level, node, rows, digest``: level 0 are the ranges, each further level sums up ``fan`` nodes, the last is one node."""
    levels, width, out = [1], ranges, []
    while width > 1:
        levels.append(levels[-1] * fan)
        width = -(-width // fan)
    nodes = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col(_RANGE) / step).cast("int").alias("node")) for k, step in enumerate(levels)]))
    return digests.select(nodes.alias("n"), "rows", "digest").groupBy("n.level", "n.node").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))


def differing_ranges(spark: SparkSession, left: str, right: str, ranges: int = RANGES, fan: int = 16) -> list[int]:
    """The ranges whose rows differ, found from the root of both trees downwards; at most ``ranges``."""
    trees = [digest_tree(spark.read.parquet(f"{folder}/digests"), ranges, fan).toPandas().set_index(["level", "node"]) for folder in (left, right)]
    both = trees[0].join(trees[1], how="outer", lsuffix="_l", rsuffix="_r")
    unlike = both[~((both["rows_l"] == both["rows_r"]) & (both["digest_l"] == both["digest_r"]))]
    top = int(both.index.get_level_values("level").max()) if len(both) else 0
    open_nodes = [n for level, n in unlike.index if level == top]
    for level in range(top - 1, -1, -1):
        there = {n for k, n in unlike.index if k == level}
        open_nodes = [n for p in open_nodes for n in range(p * fan, (p + 1) * fan) if n in there]
    return sorted(open_nodes)


def snapshot_diff(spark: SparkSession, left: str, right: str, attrs: Sequence[str], key: str = "uid", ranges: int = RANGES) -> DataFrame:
    """As ``revision_diff`` of the two snapshots; ranges with equal digests are not read."""
    found = differing_ranges(spark, left, right, ranges)
    sides = [read_snapshot(spark, folder).where(F.col(_RANGE).isin(found)).drop(_RANGE) for folder in (left, right)]
    return revision_diff(*sides, attrs, key)
