"""Outputs by two keys in files clustered by both, with an index of which file holds which pair.

A folder per pair would be one per requested combination. Here rows are ordered by the interleaved bits of both keys' hashes, so rows of a
pair are neighbours, and rows of one value of either key lie in few files; statistics of the row groups and the index tell the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 8 << 20
_BITS = 16


def interleaved(first: Column, second: Column, bits: int = _BITS) -> Column:
    """The low bits of two hashes in turn, as one number."""
    a, b = (F.xxhash64(c.cast("string")) for c in (first, second))
    parts = [F.shiftleft(F.shiftright(x, k).bitwiseAND(F.lit(1)), 2 * k + side) for k in range(bits) for side, x in ((1, a), (0, b))]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def write_clustered(df: DataFrame, folder: str, first: str, second: str, files: int | None = None, dealt: str | None = None) -> None:
    """Writes ``folder``/rows, clustered by both keys, and ``folder``/pairs: ``first, second, file, rows``.

    A pair with many rows is spread over several files by all columns; the number of files is that of shuffle partitions, or given.
    ``dealt`` names a column with ``interleaved`` of both keys by whose ranges the rows are dealt already: every task writes a file of its
    own, no row is shuffled, and the column is not written.
    """
    if dealt:
        rows = df.sortWithinPartitions(dealt, first, second).drop(dealt)
    else:
        order = [interleaved(F.col(first), F.col(second)), F.col(first), F.col(second)]
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartitionByRange(n, *order, spread).sortWithinPartitions(*order)
    rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{folder}/rows")
    back = df.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")
    held = back.groupBy(first, second, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    held.repartitionByRange(first, second, "file").sortWithinPartitions(first, second, "file").write.parquet(f"{folder}/pairs")


def pair_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pairs")


def read_pair(spark: SparkSession, folder: str, first: str, second: str, values: tuple) -> DataFrame:
    """The rows of one pair, from the files that hold it, by their row groups' statistics; of an unknown pair none."""
    chosen = (F.col(first) == values[0]) & (F.col(second) == values[1])
    files = [r[0] for r in pair_index(spark, folder).where(chosen).select("file").distinct().collect()]      # the files of one pair
    rows = spark.read.parquet(f"{folder}/rows")
    if not files:
        return rows.where(F.lit(False))
    return spark.read.schema(rows.schema).parquet(*[f"{folder}/rows/{f}" for f in sorted(files)]).where(chosen)
